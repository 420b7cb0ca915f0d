"""Spark-native equity-research analytics: bars, factors, labels, portfolios, fills."""

__version__ = "0.1.0"
