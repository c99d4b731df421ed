"""Gleaner: Spark operators that turn web-archive data into entity tables."""
