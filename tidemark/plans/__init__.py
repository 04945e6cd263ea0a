"""Composite analyses assembled from the operators."""
