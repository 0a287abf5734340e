"""Document-stream analytics on PySpark."""
