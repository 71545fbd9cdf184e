"""Streaming of the cohort-extraction library."""
