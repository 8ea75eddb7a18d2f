"""Queries of the training-data operators and their DuckDB SQL."""

from . import (  # noqa: F401
    chat,
    decontamination,
    exact_dedup,
    html_text,
    language_id,
    ngram_join,
    packing,
    phrases,
    pii,
    secret_scan,
    substring_dedup,
    vector_codes,
    warc,
)
from .common import ORACLES, QUERIES  # noqa: F401
