"""Feature preparation, data checks and model gates for tables of any size, on PySpark."""
