"""Layered-table analytics on Spark: scans, cleaning, joins, aggregates, streams, models."""
