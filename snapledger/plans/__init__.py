"""Datasets, layers and the daily run, composed from the operators."""
