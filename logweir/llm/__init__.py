"""Operators for preparing language-model training data, each a plan of Spark jobs."""
