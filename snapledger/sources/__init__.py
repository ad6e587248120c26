"""Readers for partitioned snapshot tables."""
