"""Whole-batch jobs that chain the operators and write their tables."""
