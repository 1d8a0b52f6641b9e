"""Pipelines over the operators, and test views over the driver tables."""
