"""Layered-table operators for Spark: change apply, history, quality, star schema."""
