"""Preparing tabular event records and learning a binary outcome, on Spark."""
