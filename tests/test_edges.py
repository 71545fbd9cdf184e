"""Hand-made edge rows (NULLs, NaN, prefixes, empty years, catchments, semi joins, ids, samples)."""

from __future__ import annotations

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from caseload import Cohorts, Dataset, Scope, fyear_code, sample_rows, stable_id, wide_to_long
from caseload.functions.rows import dense_id, sample_threshold
from caseload.operators.shape import long_to_wide
from caseload.streaming.intake import request_metadata

from .conftest import rows

OP_SCHEMA = ("index long, fyear int, dataset string, sitetret string, icb string, sushrg_trimmed string, "
             "imd_quintile int, attendances long, tele_attendances long")


def _op(spark, data):
    return spark.createDataFrame(data, OP_SCHEMA)


def test_null_key_kept_and_all_null_sum(spark):
    op = _op(spark, [
        (1, 2000, "P1", "S", "R1", None, 1, 3, 1),
        (2, 2000, "P1", "S", "R1", None, 1, 4, None),
        (3, 2000, "P1", "S", "R1", "A", 1, None, 0),
        (4, 2000, "P1", "S", "R1", "A", 1, None, 0),
    ])
    data = Dataset(spark, tables={"op": op})
    region = Cohorts(data, Scope.region("R1"), 2000).op()
    got = {r["sushrg_trimmed"]: (r["attendances"], r["tele_attendances"]) for r in region.collect()}
    assert got == {None: (7, 1), "A": (0, 0)}  # all-NULL sum reads 0 for a region
    national = Cohorts(data, Scope.national(1.0, 1), 2000).op()
    got = {(r["attendances"], r["tele_attendances"]) for r in national.collect()}
    # national collapses sushrg_trimmed, so both groups merge; the all-NULL case shows on aae
    assert got == {(7.0, 1.0)}


def test_national_all_null_sum_is_null(spark):
    aae = spark.createDataFrame([(1, 2024, "P", "S", "R", "t1", 1, None), (2, 2024, "P", "S", "R", "t1", 1, None)],
                                "index long, fyear int, dataset string, sitetret string, icb string, aedepttype string, acuity int, arrivals long")
    out = Cohorts(Dataset(spark, tables={"aae": aae}), Scope.national(0.5, 1), 2024).aae().collect()
    assert len(out) == 1 and out[0]["arrivals"] is None
    region = Cohorts(Dataset(spark, tables={"aae": aae}), Scope.region("R"), 2024).aae().collect()
    assert region[0]["arrivals"] == 0


def test_nan_and_null_keys(spark):
    df = spark.createDataFrame([
        (1, 2000, "P", "S", "R", 1.5, 2), (2, 2000, "P", "S", "R", float("nan"), 3), (3, 2000, "P", "S", "R", None, 4)],
        "index long, fyear int, dataset string, sitetret string, icb string, weight double, arrivals long")
    data = Dataset(spark, tables={"aae": df})
    region = Cohorts(data, Scope.region("R"), 2000).aae()
    assert sorted((r["weight"] is None, r["arrivals"]) for r in region.collect()) == [(False, 2), (True, 7)]
    national = Cohorts(data, Scope.national(1.0, 0), 2000).aae()
    assert national.count() == 3  # NaN and NULL stay apart


def _wide(spark, data, types=("decimal(18,2)", "decimal(18,2)")):
    schema = f"dataset string, fyear int, variant string, age int, sex int, `2020` {types[0]}, `2021` {types[1]}"
    return spark.createDataFrame(data, schema)


def test_variant_prefix_and_null(spark):
    wide = _wide(spark, [
        ("P", 2000, None, 1, 1, Decimal("1"), Decimal("1")),
        ("P", 2000, "custom", 1, 1, Decimal("1"), Decimal("1")),
        ("P", 2000, "custom_x", 1, 1, Decimal("1"), Decimal("1")),
        ("P", 2000, "Custom", 1, 1, Decimal("2"), None),
        ("Q", 2000, "Custom", 1, 1, Decimal("3"), None),
    ])
    out = Cohorts(Dataset(spark, tables={"demographic_factors": wide}), Scope.national(), 2000).demographic_factors()
    got = out.collect()
    assert [r["variant"] for r in got] == ["Custom"]
    assert got[0]["2020"] == Decimal("5") and got[0]["2021"] is None  # a year all NULL stays, NULL


def test_no_rows_for_year_keeps_columns(spark):
    wide = _wide(spark, [("P", 1999, "a", 1, 1, Decimal("1"), Decimal("1"))])
    out = Cohorts(Dataset(spark, tables={"demographic_factors": wide}), Scope.national(), 2000).demographic_factors()
    assert out.columns == ["variant", "age", "sex", "2020", "2021"]
    assert out.count() == 0


def test_mixed_year_types_unpivot_to_widest(spark):
    wide = spark.createDataFrame([("a", 1, 1, 2, 2.5)], "variant string, age int, sex int, `2020` int, `2021` double")
    long = wide_to_long(wide, ["variant", "age", "sex"])
    assert dict(long.dtypes)["value"] == "double"
    assert rows(long, order=["year", "value"]) == [("2020", 2.0), ("2021", 2.5)]


def test_long_to_wide_null_year_and_explicit_years(spark):
    df = spark.createDataFrame([("a", 2020, 1.0), ("a", None, 5.0), ("a", 2021, 2.0)], "k string, year int, v double")
    found = long_to_wide(df, ["k"], F.col("v"))
    assert found.columns == ["k", "null", "2020", "2021"]
    fixed = long_to_wide(df, ["k"], F.col("v"), years=[2020, 2022])
    assert fixed.columns == ["k", "2020", "2022"]
    assert fixed.first()["2022"] is None


def _projections(spark):
    births = spark.createDataFrame(
        [(1, "p", 2020, 2022, 0, Decimal("100.00")), (2, "p", 2020, 2022, 0, Decimal("10.00")),
         (3, "p", 2020, 2022, 0, Decimal("7.00")), (1, "p", 2020, 2018, 0, Decimal("999.00"))],
        "area_code int, projection string, year int, projection_year int, age int, value decimal(18,2)")
    catchments = spark.createDataFrame(
        [(1, "R1", Decimal("0.75")), (1, "R2", Decimal("0.25")), (2, "R2", Decimal("1.00"))],
        "area_code int, icb string, pcnt decimal(3,2)")
    return Dataset(spark, tables={"births": births, "icb_catchments": catchments})


def test_area_in_two_regions_and_area_without_catchment(spark):
    data = _projections(spark)
    r1 = Cohorts(data, Scope.region("R1"), 2000).birth_factors().collect()
    r2 = Cohorts(data, Scope.region("R2"), 2000).birth_factors().collect()
    assert [(r["sex"], r["variant"], float(r["2020"])) for r in r1] == [(2, "p", 75.0)]
    assert [float(r["2020"]) for r in r2] == [35.0]  # area 3 has no catchment: dropped


def _strategy_data(spark):
    ip = spark.createDataFrame([(1, 2000, "P", "S", "R"), (1, 2000, "P", "S", "R"), (None, 2000, "P", "S", "R"),
                                (2, 2000, "P", "S", "R")], "rn long, fyear int, dataset string, sitetret string, icb string")
    st = spark.createDataFrame([(1, "P", 2000, "a"), (1, "P", 2000, "b"), (None, "P", 2000, "c"), (3, "P", 2000, "d")],
                               "rn long, dataset string, fyear int, strategy string")
    return Dataset(spark, tables={"ip": ip, "ip_activity_avoidance_strategies": st})


@pytest.mark.parametrize("scope", [Scope.provider("P"), Scope.region("R"), Scope.national(1.0, 0)])
def test_semi_join_duplicates_and_nulls(spark, scope):
    out = Cohorts(_strategy_data(spark), scope, 2000).strategies("activity_avoidance")
    assert sorted(r["strategy"] for r in out.collect()) == ["a", "b"]


def test_sample_rate_bounds_and_threshold(spark):
    df = spark.range(1000).withColumnRenamed("id", "rn")
    assert sample_rows(df, 0.0, 1).count() == 0
    assert sample_rows(df, 1.0, 1).count() == 1000
    assert sample_threshold(0.25) == "40000000"
    kept = sample_rows(df, 0.25, 42).count()
    assert 200 < kept < 300


def test_sample_and_ids_independent_of_partitioning(spark):
    df = spark.range(2000).select(F.col("id").alias("rn"), (F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"))
    one, eight = df.repartition(1), df.repartition(8)
    assert rows(sample_rows(one, 0.3, 9)) == rows(sample_rows(eight, 0.3, 9))
    assert rows(stable_id(one, ["a", "b"], "h")) == rows(stable_id(eight, ["b", "a"], "h"))
    groups1 = one.groupBy("a", "b").count()
    groups8 = eight.groupBy("a", "b").count()
    assert rows(dense_id(groups1, ["a", "b"], method="range", partitions=1)) == rows(dense_id(groups8, ["a", "b"], method="range", partitions=5))


def test_dense_id_range_equals_window(spark):
    df = spark.range(500).select((F.col("id") % 13).alias("req"), F.col("id").alias("k"),
                                 F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 11).alias("j"))
    for within in ([], ["req"]):
        ranged = dense_id(df, ["k", "j"], within=within, method="range", partitions=6)
        window = dense_id(df, ["k", "j"], within=within, method="window")
        auto = dense_id(df, ["k", "j"], within=within)
        assert rows(ranged) == rows(window) == rows(auto)
    ids = [r["rn"] for r in dense_id(df, ["k"], method="range", partitions=4).collect()]
    assert sorted(ids) == list(range(500))


def test_dense_id_hot_group_split_over_partitions(spark):
    # one request holds most rows: its ids still run 0..n-1 while its rows span several partitions
    df = spark.range(3000).select(F.when(F.col("id") < 2500, F.lit("hot")).otherwise(F.lit("cold")).alias("req"),
                                  F.col("id").alias("k"))
    out = dense_id(df, ["k"], within=["req"], method="range", partitions=8)
    hot = sorted(r["rn"] for r in out.where("req = 'hot'").collect())
    assert hot == list(range(2500))


def test_fyear_code_at_century():
    assert fyear_code(1999) == 199900
    assert fyear_code(2099) == 209900
    assert fyear_code(2023) == 202324


def test_separator_inside_key_gives_distinct_ids(spark):
    df = spark.createDataFrame([("a\x1f", "b"), ("a", "\x1fb"), (None, "N"), ("N", None), ("a\\", "b")], "x string, y string")
    ids = [r["rn"] for r in stable_id(df, ["x", "y"]).collect()]
    assert len(set(ids)) == 5


def test_metadata_keeps_scalars_by_json_type(spark):
    text = '{"app_version":"v1","seed":42,"flag":true,"n":null,"d":{"a":1},"l":[1],"s":"{x}"}'
    meta = spark.createDataFrame([(text,)], "t string").select(request_metadata(F.col("t")).alias("m")).first()["m"]
    assert meta == {"app_version": "v1", "seed": "42", "flag": "true", "n": None, "s": "{x}"}


def test_nan_measure_skipped_for_region(spark):
    df = spark.createDataFrame([(1, 2000, "P", "S", "R", "x", 1.0), (2, 2000, "P", "S", "R", "x", float("nan"))],
                               "index long, fyear int, dataset string, sitetret string, icb string, t string, arrivals double")
    out = Cohorts(Dataset(spark, tables={"aae": df}), Scope.region("R"), 2000).aae().first()
    assert not math.isnan(out["arrivals"]) and out["arrivals"] == 1.0


def test_dataset_sources_and_factory(spark, tmp_path):
    from caseload import cohort_factory

    df = spark.createDataFrame([(1, 2000, "P", "S", "R")], "rn long, fyear int, dataset string, sitetret string, icb string")
    df.write.parquet(str(tmp_path / "base" / "ip"))
    df.write.parquet(str(tmp_path / "elsewhere"))
    df.createOrReplaceTempView("ip_view")
    for data in (Dataset(spark, str(tmp_path / "base")),
                 Dataset(spark, None, {"ip": str(tmp_path / "elsewhere")}),
                 Dataset(spark, None, {"ip": "ip_view"}),
                 Dataset(spark, None, {"ip": df}),
                 Dataset(spark, None, {"ip": lambda s: df})):
        make = cohort_factory(data, "region")
        assert make(2000, "R").ip().count() == 1
        assert cohort_factory(data, "national", sample_rate=1.0, seed=3)(2000, None).ip().count() == 1
    with pytest.raises(NotImplementedError):
        cohort_factory(Dataset(spark, None, {}), "provider")(2000, "P").hsa_gams()
    with pytest.raises(KeyError):
        Dataset(spark, None, {}).table("ip")


def test_catchment_join_beyond_the_broadcast_bound(spark):
    """Forcing the shuffle path (no broadcast after the bounded count) gives the same factors."""
    from caseload.operators.measure import apportion

    data = _projections(spark)
    births = data.table("births").where("projection_year = 2022")
    catchments = data.table("icb_catchments")
    hinted, weighted = apportion(births, catchments, max_catchment_rows=10)
    shuffled, _ = apportion(births, catchments, max_catchment_rows=0)
    assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    assert rows(hinted.select("area_code", "icb", weighted.alias("w"))) == rows(shuffled.select("area_code", "icb", weighted.alias("w")))


def test_discovered_pivot_years_are_sorted_and_keep_null(spark):
    from caseload.operators.shape import long_to_wide

    df = spark.createDataFrame([("a", 2021, 1.0), ("a", 2019, 2.0), ("b", None, 4.0), ("b", 2021, 8.0), ("a", 2021, 0.5)],
                               "k string, year int, v double")
    out = long_to_wide(df, ["k"], F.col("v"))
    assert out.columns == ["k", "null", "2019", "2021"]
    assert rows(out, out.columns) == [("a", None, 2.0, 1.5), ("b", 4.0, None, 8.0)]
    assert long_to_wide(df.where("k = 'z'"), ["k"], F.col("v")).columns == ["k"]


@pytest.mark.parametrize("rate", [0.0, 0.5, 1.0])
def test_sampling_is_the_same_single_and_in_batch(spark, rate):
    """NULL keys: kept at rate 1, not below; several keys cannot be sampled by hash in either form."""
    from caseload.plans.batch import extract_all

    ip = spark.createDataFrame([(None if i % 10 == 0 else i, 2000, "P", "S", "R") for i in range(200)],
                               "rn long, fyear int, dataset string, sitetret string, icb string")
    data = Dataset(spark, tables={"ip": ip})
    reqs = spark.createDataFrame([("q", 2000, rate, 7)], "request_id string, fyear int, sample_rate double, seed long")
    single = Cohorts(data, Scope.national(rate, 7), 2000).ip()
    assert rows(extract_all(data, reqs, "ip", "national").drop("request_id")) == rows(single)
    assert single.where("rn is null").count() == (20 if rate == 1 else 0)
    with pytest.raises(ValueError):
        Cohorts(data, Scope.national(0.5, 7), 2000, keys=["rn", "dataset"]).ip()
    with pytest.raises(ValueError):
        extract_all(data, reqs, "ip", "national", keys=["rn", "dataset"])


def test_bernoulli_sample_size(spark):
    ip = spark.range(20000).selectExpr("id AS rn", "2000 AS fyear", "'P' AS dataset", "'S' AS sitetret", "'R' AS icb")
    got = Cohorts(Dataset(spark, tables={"ip": ip}), Scope.national(0.25, 3), 2000, sample_method="bernoulli").ip()
    assert 4700 < got.count() < 5300 and got.select("rn").distinct().count() == got.count()


def test_duplicate_episode_keys(spark):
    ip = spark.createDataFrame([(1, 2000, "P", "S", "R"), (1, 2000, "Q", "S", "R"), (2, 2000, "P", "S", "R"),
                                (None, 2000, "P", "S", "R"), (None, 2000, "Q", "S", "R"), (1, 1999, "P", "S", "R")],
                               "rn long, fyear int, dataset string, sitetret string, icb string")
    got = Cohorts(Dataset(spark, tables={"ip": ip}), Scope.region("R"), 2000).duplicate_episode_keys().collect()
    assert [(r["rn"], r["rows"]) for r in got] == [(1, 2)]


def test_threshold_index_is_the_sample_of_every_request(spark):
    """Requests of one seed share a hash per row; each gets the rows of its own sample, at the bounds too."""
    from caseload.functions.rows import sampled_requests, threshold_index

    rates = [-1.0, 0.0, 1e-9, 0.01, 0.1, 0.25, 0.25, 0.5, 0.5 + 2.0**-32, 0.999, 1.0, 2.0]
    requests = spark.createDataFrame([(f"{seed}-{k}", seed, r) for seed in (1, 7) for k, r in enumerate(rates)],
                                     "request_id string, seed long, sample_rate double")
    data = spark.range(2_000).select(F.when(F.col("id") != 5, F.col("id")).alias("rn"))
    want = {}
    for r in requests.collect():
        kept = sample_rows(data, r["sample_rate"], r["seed"]).collect() if r["sample_rate"] > 0 else []
        want[r["request_id"]] = sorted((x["rn"] is None, x["rn"] or 0) for x in kept)
    for blocks in (1, 3):
        index = threshold_index(requests, [], blocks)
        found = sampled_requests(data.crossJoin(F.broadcast(index)), "rn").select("rn", F.explode("_requests").alias("request_id")).collect()
        got = {k: [] for k in want}
        for r in found:
            got[r["request_id"]].append((r["rn"] is None, r["rn"] or 0))
        assert {k: sorted(v) for k, v in got.items()} == want
    assert len(want["1-10"]) == len(want["1-11"]) == 2_000 and want["1-0"] == want["1-1"] == []
