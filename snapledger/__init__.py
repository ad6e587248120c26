"""Dated-snapshot tables from collections of web pages, as Spark DataFrame jobs."""
