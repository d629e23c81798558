"""Spark-first engine for evaluating span labelers and curating the text they are trained on."""

__version__ = "0.1.0"
