"""Spatial detection analytics as Spark DataFrame plans."""
