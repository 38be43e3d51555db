"""threadloom: a PySpark-native engine for discussion data."""

__version__ = "0.1.0"
