"""Operators for large training-data pipelines (language, dedup, packing, ...)."""
