"""All checks, collected from the modules that register them."""

from . import (  # noqa: F401
    band_checks,
    explore_checks,
    feature_checks,
    metric_checks,
    model_checks,
    sample_checks,
    source_checks,
)
from .registry import ORACLES, QUERIES  # noqa: F401
