"""Functions of the cohort-extraction library."""
