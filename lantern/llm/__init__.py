"""Operators of a training-data pipeline over documents, pages, benchmarks and conversations."""
