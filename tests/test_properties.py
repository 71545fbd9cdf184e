"""Property tests against brute force on small generated fixtures: hash sample and stable ids
against Python's hashlib, region roll-up and dense ids against pandas."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from caseload import dense_id, roll_up, sample_rows, stable_id
from caseload.functions.rows import sample_threshold

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.one_of(st.none(), st.text(alphabet="ab\\\x1fN|", max_size=3))


def _token(v) -> str:
    if v is None:
        return "N"
    return "V" + str(v).replace("\\", "\\\\").replace("\x1f", "\\u")


@SETTINGS
@given(rns=st.lists(st.integers(min_value=0, max_value=10**12), min_size=1, max_size=40, unique=True),
       rate=st.floats(min_value=0.0, max_value=1.0), seed=st.integers(min_value=0, max_value=10**6))
def test_hash_sample_matches_hashlib(spark, rns, rate, seed):
    df = spark.createDataFrame([(r,) for r in rns], "rn long")
    got = {r["rn"] for r in sample_rows(df, rate, seed).collect()}
    if rate <= 0:
        want = set()
    elif rate >= 1:
        want = set(rns)
    else:
        bound = sample_threshold(rate)
        want = {r for r in rns if hashlib.md5(f"{seed}|{r}".encode()).hexdigest()[:8] < bound}
    assert got == want


@SETTINGS
@given(data=st.lists(st.tuples(keys, keys), min_size=1, max_size=20))
def test_stable_id_matches_hashlib(spark, data):
    df = spark.createDataFrame(data, "b string, a string")
    got = Counter((r["a"], r["b"], r["rn"]) for r in stable_id(df, ["b", "a"]).collect())
    # keys are name-sorted: a before b
    want = Counter((a, b, hashlib.sha256("\x1f".join([_token(a), _token(b)]).encode()).hexdigest())
                   for b, a in data)
    assert got == want


rows_strategy = st.lists(
    st.tuples(st.sampled_from(["x", "y", None]),
              st.one_of(st.none(), st.sampled_from([1.5, 2.5, float("nan")])),
              st.one_of(st.none(), st.integers(min_value=0, max_value=9))),
    min_size=1, max_size=30)


@SETTINGS
@given(data=rows_strategy)
def test_region_roll_up_matches_pandas(spark, data):
    df = spark.createDataFrame(data, "k string, w double, m long")
    got = roll_up(df, ["m"], ["k", "w"], null_sum=0, nan_as_null=True)
    got_rows = sorted(((r["k"], r["w"], r["m"]) for r in got.collect()), key=str)
    pdf = pd.DataFrame(data, columns=["k", "w", "m"], dtype=object)
    pdf["w"] = pdf["w"].map(lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else v)
    pdf["m"] = pd.to_numeric(pdf["m"])
    want = pdf.groupby(["k", "w"], dropna=False, as_index=False)["m"].sum()
    want_rows = sorted(((None if pd.isna(k) else k, None if pd.isna(w) else w, int(m))
                        for k, w, m in want.itertuples(index=False)), key=str)
    assert got_rows == want_rows


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from(["r1", "r2", "r3"]), st.one_of(st.none(), st.integers(0, 50))),
                     min_size=1, max_size=40, unique=True))
def test_dense_id_matches_sorted_enumeration(spark, data):
    df = spark.createDataFrame(data, "req string, k long")
    got = {(r["req"], r["k"]): r["rn"] for r in dense_id(df, ["k"], within=["req"], method="range", partitions=3).collect()}
    want = {}
    for req in {d[0] for d in data}:
        ks = sorted((d[1] for d in data if d[0] == req), key=lambda v: (v is None, v if v is not None else 0))
        want.update({(req, k): i for i, k in enumerate(ks)})
    assert got == want
