"""longtide: a Spark-native engine for large collections of long-format time series."""

__version__ = "0.1.0"
