"""Column profiling, semantic typing and fuzzy matching as Spark DataFrame jobs."""
