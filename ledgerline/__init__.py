"""Analytical table patterns as plain PySpark DataFrame operators."""
