"""Corpus preparation and training-run analytics as Spark DataFrame operators."""
