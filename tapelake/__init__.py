"""Market-data operators on Spark DataFrames: ingestion, medallion tables, analytics, quality, governance, streaming."""
