"""Cohort extraction and population factors on Spark DataFrames."""

from caseload.functions.rows import dense_id, sample_rows, stable_id
from caseload.functions.scope import Scope, fyear_code, in_scope, relabel
from caseload.operators.measure import roll_up, sum_factors
from caseload.operators.shape import long_to_wide, wide_to_long
from caseload.plans.cohorts import Cohorts, cohort_factory
from caseload.sources.dataset import Dataset, cached

__all__ = [
    "Cohorts", "Dataset", "cohort_factory", "Scope", "cached", "dense_id", "fyear_code", "in_scope", "long_to_wide",
    "relabel", "roll_up", "sample_rows", "stable_id", "sum_factors", "wide_to_long",
]
