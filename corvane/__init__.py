"""Columnar building blocks for auditing and shaping large text corpora on Spark."""
