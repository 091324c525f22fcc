"""Catalogue and review analytics as Spark DataFrame operators."""
