"""Governed star-schema analytics, retrieval, evaluation and monitoring on Spark."""
