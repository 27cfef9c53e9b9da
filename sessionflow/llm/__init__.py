"""Operators for training-data pipelines on documents, pages and benchmarks.

Nothing outside this subpackage imports it.
"""
