"""Probata: evidence auditing and training-data preparation on Spark."""
