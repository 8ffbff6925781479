"""Contract-driven ingestion and daily analytics on PySpark DataFrames and streams."""
