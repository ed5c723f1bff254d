"""Tideline: keyed tables and their change logs on Spark, from snapshot to exactly-once state."""

__version__ = "0.1.0"
