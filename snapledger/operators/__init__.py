"""Operators on DataFrames: pages, snapshots, coverage, checks."""
