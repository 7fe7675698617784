"""Multi-feed data processing on Spark: load, clean, validate, total, flag, merge, report."""
