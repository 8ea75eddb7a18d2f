"""Spark-native wildfire-hazard analytics: rasters to features, heads, hazard and metrics."""

__version__ = "0.1.0"
