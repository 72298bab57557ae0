"""strata: user-level analytics marts, semantic metrics, text enrichment,
forecasting and ML on Spark DataFrames and Structured Streaming."""

__version__ = "0.1.0"
