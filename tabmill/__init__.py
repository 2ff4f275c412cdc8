"""Tabular preparation, scoring and run analytics as Spark DataFrame operators."""
