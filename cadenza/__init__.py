"""Cadenza: a Spark-first analytics engine for time-coded text."""
