"""snaploom: a PySpark-native engine that reconciles snapshots of administrative records."""

__version__ = "0.1.0"
