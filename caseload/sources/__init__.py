"""Sources of the cohort-extraction library."""
