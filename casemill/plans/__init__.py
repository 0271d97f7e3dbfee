"""Whole jobs over the zones, and the query catalogue on the sample tables."""
