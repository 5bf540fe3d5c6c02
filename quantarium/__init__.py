"""Spark-first analytics engine for experimental-measurement data."""
