"""Operators for training-data pipelines: ten operators and their queries."""
