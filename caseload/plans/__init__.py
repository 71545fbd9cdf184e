"""Plans of the cohort-extraction library."""
