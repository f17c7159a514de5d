"""strata: config-driven table ingestion and data quality on Spark DataFrames."""
