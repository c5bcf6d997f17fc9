"""Spark-first analytics for locus-to-gene prioritisation."""
