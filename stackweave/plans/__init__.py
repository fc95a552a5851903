"""Whole plans: the pipeline, the registered queries and their SQL checks."""
