"""Loomwell: a Spark-native engine for building text corpora from web archives."""
