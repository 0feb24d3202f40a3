"""Rostrum: speech and text analytics as Spark DataFrame operations."""
