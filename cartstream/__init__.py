"""Commerce event analytics on PySpark: DataFrame operators and streaming jobs."""

__version__ = "0.1.0"
