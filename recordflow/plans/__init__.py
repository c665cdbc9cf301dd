"""Whole jobs: wide extract, structuring, report."""
