"""Radar migration analytics as Spark DataFrame operators."""
