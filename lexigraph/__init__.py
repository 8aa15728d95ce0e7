"""Lexigraph: a PySpark-native engine for lexicon-style corpora."""

__version__ = "0.1.0"
