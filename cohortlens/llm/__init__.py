"""Operators for preparing text corpora and vectors for model training."""
