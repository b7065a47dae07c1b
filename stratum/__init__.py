"""A Spark-native engine for contract-first layered (bronze/silver/gold) data."""

__version__ = "0.1.0"
