"""driftline: Spark-native tabular analytics, ML data work and drift monitoring."""

__version__ = "0.1.0"
