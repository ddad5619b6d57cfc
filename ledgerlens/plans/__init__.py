"""Query catalogue (Spark) and its DuckDB oracle text."""
