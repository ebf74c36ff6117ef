"""Spark-native engine for packets of evidence: parse, resolve, repair, score and prepare text at scale."""

__version__ = "0.1.0"
