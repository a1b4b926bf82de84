"""Operators for training-data pipelines: ten of them, their queries and their SQL equivalents."""
