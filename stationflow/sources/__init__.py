"""Inputs: fixture views over the given tables, and the partitioned lake."""
