"""Daily market-data engine on PySpark: clean, merge, fill, expand and audit keyed tables."""

__version__ = "0.1.0"
