"""Operators for training-data pipelines; nothing else in the package imports them."""
