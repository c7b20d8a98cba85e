"""Contact-table work on Spark: clean, match, extract, deduplicate, resume."""
