"""Operators of the cohort-extraction library."""
