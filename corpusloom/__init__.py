"""Spark-first operators for text corpora that exist in several imperfect readings."""

__version__ = "0.1.0"
