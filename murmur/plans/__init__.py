"""Query catalog (Spark callables + DuckDB oracle text) and composed jobs."""
