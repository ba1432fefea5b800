"""Spark-native operations analytics: claims recovery status, daily KPI reporting,
and data lineage with quality overlays, written on the DataFrame API."""

__version__ = "0.1.0"
