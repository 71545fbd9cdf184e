"""

``entry(spark)`` runs the flagship extract (region outpatient roll-up) on sf0.001.
``queries()`` maps each implemented operator/extract to a callable (spark, sf_dir) -> DataFrame.
``oracle_sql()`` gives, per query, DuckDB SQL over the raw test tables; the reference-shaped views
are inlined as CTEs so the oracle reads the same tables the Spark side reads.

Test parameters: provider ``NATION_3``, region ``min(r_name)``, year 2000 (A&E: 2024), seed 42,
sample rate 0.25.
"""

from __future__ import annotations

import importlib
import re
import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from caseload.functions.rows import stable_id  # noqa: E402
from caseload.functions.scope import Scope  # noqa: E402
from caseload.operators.joins import duplicate_keys  # noqa: E402
from caseload.operators.shape import wide_to_long  # noqa: E402
from caseload.plans.batch import extract_all  # noqa: E402
from caseload.plans.cohorts import Cohorts  # noqa: E402
from caseload.plans.job import run_requests  # noqa: E402
from caseload.session import ensure_checkpoint_dir  # noqa: E402
from caseload.sources import dataset as names  # noqa: E402
from caseload.sources.dataset import Dataset  # noqa: E402
from caseload.sources.layout import write_table  # noqa: E402
from caseload.sources.sinks import read_extracts  # noqa: E402
from caseload.sources.testdata import FACTOR_YEARS, raw, mapped_dataset  # noqa: E402
from caseload.streaming.intake import request_table  # noqa: E402

try:
    # The training-text operators are optional: the other queries work without their package.
    llm_queries = importlib.import_module("caseload.llm.queries")
except ImportError as error:
    print(f"training-text queries left out: {error}", file=sys.stderr)
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed test parameters.
PROVIDER_CODE = "NATION_3"
YEAR = 2000
AAE_YEAR = 2024
SEED = 42
RATE = 0.25
GIVEN_FACTOR_YEARS = (1999, 2000)
BATCH_YEARS = (1999, 2000)
RUN_LABELS = {"app_version": "v1", "scenario": "base", "create_datetime": "20240101_090000"}
REQUEST_YEARS = (1999, 2000, 2024)
BATCH_KINDS = ("ip", "strategies_activity_avoidance", "strategies_efficiencies", "op", "aae", "birth_factors",
               "demographic_factors", "hsa_activity", "inequalities")


# ------------------------------------------------------------------------------------------------
# Spark side
# ------------------------------------------------------------------------------------------------

def _region_code(spark: SparkSession, sf_dir: str) -> str:
    return raw(spark, sf_dir, "region").agg(F.min("r_name")).first()[0]


def _scope(spark: SparkSession, sf_dir: str, level: str) -> Scope:
    if level == "provider":
        return Scope.provider(PROVIDER_CODE)
    if level == "region":
        return Scope.region(_region_code(spark, sf_dir))
    return Scope.national(RATE, SEED)


def _cohorts(spark: SparkSession, sf_dir: str, level: str, year: int = YEAR) -> Cohorts:
    ensure_checkpoint_dir(spark)
    return Cohorts(mapped_dataset(spark, sf_dir), _scope(spark, sf_dir, level), year)


def _as_double(df: DataFrame, columns) -> DataFrame:
    """Cast decimal factor columns to double at the edge (the oracle does the same)."""
    return df.withColumns({c: F.col(f"`{c}`").cast("double") for c in columns})


def _extract(level: str, method: str, year: int = YEAR, **kw) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cohort = _cohorts(spark, sf_dir, level, year)
        return getattr(cohort, method)(**kw)
    return run


def _factors(level: str, method: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(_cohorts(spark, sf_dir, level), method)()
        return _as_double(df, [c for c in df.columns if c.isdigit()])
    return run


def _factors_two_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region factors with the pivot years given by the caller: exactly these columns."""
    ensure_checkpoint_dir(spark)
    cohort = Cohorts(mapped_dataset(spark, sf_dir), _scope(spark, sf_dir, "region"), YEAR, factor_years=GIVEN_FACTOR_YEARS)
    return _as_double(cohort.birth_factors(), [str(y) for y in GIVEN_FACTOR_YEARS])


def _by_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A provider's episodes from a parquet folder under a base path."""
    base = f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"
    mapped_dataset(spark, sf_dir).table(names.IP).write.partitionBy("fyear").parquet(f"{base}/{names.IP}")
    return Cohorts(Dataset(spark, base), Scope.provider(PROVIDER_CODE), YEAR).ip()


def _by_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A region's inequalities from a table of the session's catalog, stored by year and with collected statistics."""
    place = f"{ensure_checkpoint_dir(spark)}/catalog-{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS spark_catalog.caseload_tables LOCATION '{place}'")
    table = f"spark_catalog.caseload_tables.inequalities_{uuid.uuid4().hex}"
    write_table(mapped_dataset(spark, sf_dir).table(names.INEQUALITIES), table, f"{place}/inequalities")
    data = Dataset(spark, tables={names.INEQUALITIES: table})
    return Cohorts(data, _scope(spark, sf_dir, "region"), YEAR).inequalities()


def _request_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Params texts made of the orders, read as typed requests with their scalar metadata, a row per entry."""
    order, day = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.to_json(F.struct(
        F.lit("v1").alias("app_version"), F.col("o_orderpriority").alias("dataset"), F.lit("base").alias("scenario"),
        F.col("o_custkey").alias("seed"), F.lit(YEAR).alias("start_year"), (F.col("o_orderstatus") == "F").alias("late"),
        F.struct(order.alias("x")).alias("nested"), F.array("o_custkey").alias("list")))
    files = raw(spark, sf_dir, "orders").select(
        order.cast("string").alias("params_path"), order.cast("string").alias("request_id"), text.alias("params_text"),
        F.make_timestamp(F.lit(2024), F.month(day), F.day(day), F.lit(9), (order % 60).cast("int"), F.lit(7)).alias("params_modified"))
    requests = request_table(files.withColumn("params", F.try_parse_json("params_text")), level="region")
    return requests.select("request_id", "code", "fyear", "seed", "create_datetime", F.explode("metadata").alias("key", "value"))


def _duplicate_composite_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes keyed by several columns that do not name them: most keys repeat."""
    data = mapped_dataset(spark, sf_dir)
    return Cohorts(data, Scope.national(RATE, SEED), YEAR, keys=("dataset", "sitetret", "admigroup")).duplicate_episode_keys()


def _sink(level: str, kind: str, full: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    """Runs of all requests of a level written through the sinks (with another kind beside it), and one kind read back."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = f"{ensure_checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
        requests = _level_requests(spark, sf_dir, level)
        missing = {"code": F.lit("NATIONAL"), "seed": F.lit(None).cast("long"), "sample_rate": F.lit(None).cast("double")}
        requests = requests.withColumns({
            **{c: v for c, v in missing.items() if c not in requests.columns}, **{c: F.lit(v) for c, v in RUN_LABELS.items()},
            "params_path": F.col("request_id"), "metadata": F.create_map(F.lit("scenario"), F.lit(RUN_LABELS["scenario"]))})
        kinds = ["strategies_activity_avoidance", "strategies_efficiencies"] if full else [kind, "inequalities"]
        run_requests(mapped_dataset(spark, sf_dir), requests, level, out, full=full, kinds=kinds)
        df = read_extracts(spark, out, kind)
        return _as_double(df, [c for c in df.columns if c.isdigit()])
    return run


def _duplicate_strategy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = mapped_dataset(spark, sf_dir).table(names.STRATEGY_TABLES["activity_avoidance"])
    return duplicate_keys(table, ["rn", "strategy"])


def _stable_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["attendance_type", "sushrg_trimmed", "imd_quintile"]
    op = mapped_dataset(spark, sf_dir).table(names.OP)
    return stable_id(op.select(*keys).distinct(), keys)


def _wide_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = mapped_dataset(spark, sf_dir).table(names.DEMOGRAPHIC_FACTORS)
    wide = _as_double(wide.select("variant", "age", "sex", *FACTOR_YEARS), FACTOR_YEARS)
    return wide_to_long(wide, ["variant", "age", "sex"], list(FACTOR_YEARS))


def _provider_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per (nation, year): every provider for two years, derived from the nation table."""
    years = F.array(*[F.lit(y) for y in BATCH_YEARS])
    return (raw(spark, sf_dir, "nation")
            .select(F.col("n_name").alias("code"), F.explode(years).alias("fyear"))
            .select(F.concat_ws("-", "code", F.col("fyear").cast("string")).alias("request_id"), "code", "fyear"))


def _batch(kind: str, level: str = "provider") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return extract_all(mapped_dataset(spark, sf_dir), _provider_requests(spark, sf_dir), kind, level)
    return run


def _level_requests(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """Request tables for the batch checks, derived from the nation and region tables.

    provider: every nation for each of REQUEST_YEARS; region: every region for each year;
    national: one request per region and year, rate (regionkey+1)/8 and seed regionkey+40.
    """
    years = F.explode(F.array(*[F.lit(y) for y in REQUEST_YEARS])).alias("fyear")
    if level == "provider":
        base = raw(spark, sf_dir, "nation").select(F.col("n_name").alias("code"), years)
    else:
        base = raw(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("code"), years)
    if level != "national":
        return base.select(F.concat_ws("-", "code", F.col("fyear").cast("string")).alias("request_id"), "code", "fyear")
    key = F.col("r_regionkey")
    return base.select(
        F.concat(F.lit("n"), key.cast("string"), F.lit("-"), F.col("fyear").cast("string")).alias("request_id"),
        "fyear",
        ((key + 1).cast("double") / 8.0).alias("sample_rate"),
        (key + 40).cast("long").alias("seed"),
    )


def _batch_level(kind: str, level: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        df = extract_all(mapped_dataset(spark, sf_dir), _level_requests(spark, sf_dir, level), kind, level)
        if kind.endswith("factors"):
            df = _as_double(df, [c for c in df.columns if c.isdigit()])
        return df
    return run


#: Runs that are written and read back.
SINKS = {
    "sink_provider_strategies_full": ("provider", "strategies_efficiencies"),
    "sink_region_op": ("region", "op"),
    "sink_national_demographic_factors": ("national", "demographic_factors"),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for level in ("provider", "region", "national"):
        q[f"{level}_ip"] = _extract(level, "ip")
        q[f"{level}_strategies_avoidance"] = _extract(level, "strategies", kind="activity_avoidance")
        q[f"{level}_strategies_efficiencies"] = _extract(level, "strategies", kind="efficiencies")
        q[f"{level}_op"] = _extract(level, "op")
        q[f"{level}_aae"] = _extract(level, "aae", AAE_YEAR)
        q[f"{level}_birth_factors"] = _factors(level, "birth_factors")
        q[f"{level}_demographic_factors"] = _factors(level, "demographic_factors")
        q[f"{level}_hsa_activity"] = _extract(level, "hsa_activity")
        q[f"{level}_inequalities"] = _extract(level, "inequalities")
    q["region_birth_factors_all_years"] = _factors("region", "birth_factors")
    q["region_demographic_factors_all_years"] = _factors("region", "demographic_factors")
    q["region_birth_factors_given_years"] = _factors_two_years
    q["source_by_path_provider_ip"] = _by_path
    q["source_by_catalog_region_inequalities"] = _by_catalog
    q["request_metadata"] = _request_metadata
    q["duplicate_strategy_keys"] = _duplicate_strategy_keys
    q["duplicate_episode_keys"] = _extract("national", "duplicate_episode_keys")
    q["duplicate_composite_keys"] = _duplicate_composite_keys
    for name, (level, kind) in SINKS.items():
        q[name] = _sink(level, kind, full=kind.startswith("strategies_"))
    q["stable_row_id"] = _stable_row_id
    q["batch_provider_ip"] = _batch("ip")
    q["wide_to_long"] = _wide_to_long
    for level in ("provider", "region", "national"):
        for kind in BATCH_KINDS:
            name = f"batch_{level}_requests_{kind}"
            q[name] = _batch_level(kind, level)
    if llm_queries:
        q |= llm_queries.queries()
    return q


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: a region's outpatient roll-up with dense ids, on sf0.001."""
    return queries()["region_op"](spark, SMOKE_DIR)


# ------------------------------------------------------------------------------------------------
# DuckDB oracles
# ------------------------------------------------------------------------------------------------

# Reference-shaped views over the raw test tables (defined in FIXTURES.md §2), in dependency order.
VIEWS: dict[str, str] = {
    "ip": """SELECT o_orderkey AS rn, CAST(year(o_orderdate) AS INT) AS fyear, n_name AS dataset, c_mktsegment AS sitetret, r_name AS icb, o_orderpriority AS admigroup, o_totalprice AS cost
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "ip_activity_avoidance_strategies": """SELECT l_orderkey AS rn, n_name AS dataset, CAST(year(o_orderdate) AS INT) AS fyear, concat('aa_',l_returnflag) AS strategy, l_discount AS sample_rate
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey WHERE l_linestatus='F'""",
    "ip_efficiencies_strategies": """SELECT l_orderkey AS rn, n_name AS dataset, CAST(year(o_orderdate) AS INT) AS fyear, concat('eff_',l_returnflag) AS strategy, l_discount AS sample_rate
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey WHERE l_linestatus='O'""",
    "op": """SELECT l_orderkey*10+l_linenumber AS "index", CAST(year(o_orderdate) AS INT) AS fyear, n_name AS dataset, c_mktsegment AS sitetret, r_name AS icb,
 CASE WHEN l_linenumber=7 THEN NULL ELSE l_returnflag END AS sushrg_trimmed, CAST(l_partkey%5+1 AS INT) AS imd_quintile, o_orderstatus AS attendance_type,
 CASE WHEN l_linenumber=6 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS attendances, CASE WHEN l_linestatus='O' THEN CAST(l_linenumber AS BIGINT) ELSE CAST(0 AS BIGINT) END AS tele_attendances
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "aae": """SELECT event_id AS "index", CAST(year(ts) AS INT) AS fyear, n_name AS dataset, n_name AS sitetret, r_name AS icb, event_type AS aedepttype, CAST(user_id%3 AS INT) AS acuity, CAST(1 AS BIGINT) AS arrivals
FROM events JOIN nation ON user_id%25=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "demographic_factors": """SELECT n_name AS dataset, CAST(year(o_orderdate) AS INT) AS fyear, CASE WHEN o_orderpriority='5-LOW' THEN 'custom_low' ELSE o_orderpriority END AS variant, CAST(o_custkey%10 AS INT) AS age, CAST(o_custkey%2+1 AS INT) AS sex,
 CAST(o_totalprice AS DECIMAL(18,2)) AS "2019", CASE WHEN o_orderstatus='P' THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS "2020", CAST(o_totalprice*2 AS DECIMAL(18,2)) AS "2021"
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey""",
    "birth_factors": """SELECT * FROM demographic_factors WHERE sex=2""",
    "demographics": """SELECT c_nationkey AS area_code, c_mktsegment AS projection, CAST(year(o_orderdate) AS INT) AS "year", 2022 AS projection_year, CAST(o_custkey%10 AS INT) AS age, CAST(o_custkey%2+1 AS INT) AS sex, CAST(o_totalprice AS DECIMAL(18,2)) AS "value"
FROM orders JOIN customer ON o_custkey=c_custkey""",
    "births": """SELECT area_code, projection, "year", projection_year, age, "value" FROM demographics""",
    "icb_catchments": """SELECT n_nationkey AS area_code, r_name AS icb, CASE WHEN r_regionkey=n_regionkey THEN CAST(0.75 AS DECIMAL(3,2)) ELSE CAST(0.25 AS DECIMAL(3,2)) END AS pcnt
FROM nation JOIN region ON r_regionkey=n_regionkey OR r_regionkey=(n_regionkey+1)%5""",
    "hsa_activity_tables": """SELECT n_name AS dataset, r_name AS icb, CAST(year(o_orderdate) AS INT) AS fyear, l_returnflag AS hsagrp, CAST(o_custkey%2+1 AS INT) AS sex, CAST(o_custkey%10 AS INT) AS age, l_quantity AS activity
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey""",
    "hsa_activity_tables_icb": """SELECT icb, CAST(fyear*100+(fyear+1)%100 AS INT) AS fyear, hsagrp, sex, age, activity FROM hsa_activity_tables""",
    "inequalities": """SELECT n_name AS dataset, r_name AS icb, CAST(year(o_orderdate) AS INT) AS fyear, o_orderpriority AS sushrg_trimmed, CAST(o_custkey%5+1 AS INT) AS imd_quintile, count(*) AS activity
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey GROUP BY 1,2,3,4,5""",
}

_REGION = "(SELECT min(r_name) FROM region)"
_SAMPLE = "substr(md5(concat('42|',CAST({rn} AS VARCHAR))),1,8) < '40000000'"
_STRATEGY = ("SELECT s.rn, s.dataset, s.fyear, s.strategy, s.sample_rate FROM {table} s WHERE {where} "
             "AND EXISTS (SELECT 1 FROM ip WHERE ip.rn=s.rn AND {cohort})")
_TABLES = {"avoidance": "ip_activity_avoidance_strategies", "efficiencies": "ip_efficiencies_strategies"}
_COHORT = {
    "provider": ("s.dataset='NATION_3' AND s.fyear=2000", "ip.dataset='NATION_3' AND ip.fyear=2000"),
    "region": ("s.fyear=2000", f"ip.icb={_REGION} AND ip.fyear=2000"),
    "national": ("s.fyear=2000", "ip.fyear=2000 AND " + _SAMPLE.format(rn="ip.rn")),
}


def _tok(expr: str) -> str:
    return f"coalesce('V'||{expr},'N')"


QUERIES: dict[str, str] = {
    "provider_ip": "SELECT * FROM ip WHERE dataset='NATION_3' AND fyear=2000",
    "provider_op": 'SELECT "index" AS rn, fyear, dataset, sitetret, icb, sushrg_trimmed, imd_quintile, attendance_type, attendances, tele_attendances FROM op WHERE dataset=\'NATION_3\' AND fyear=2000',
    "provider_aae": 'SELECT "index" AS rn, fyear, dataset, sitetret, icb, aedepttype, acuity, arrivals FROM aae WHERE dataset=\'NATION_3\' AND fyear=2024',
    "provider_birth_factors": 'SELECT fyear, variant, age, sex, CAST("2019" AS DOUBLE) AS "2019", CAST("2020" AS DOUBLE) AS "2020", CAST("2021" AS DOUBLE) AS "2021" FROM birth_factors WHERE dataset=\'NATION_3\' AND fyear=2000',
    "provider_demographic_factors": 'SELECT fyear, variant, age, sex, CAST("2019" AS DOUBLE) AS "2019", CAST("2020" AS DOUBLE) AS "2020", CAST("2021" AS DOUBLE) AS "2021" FROM demographic_factors WHERE dataset=\'NATION_3\' AND fyear=2000',
    "provider_hsa_activity": "SELECT icb, hsagrp, sex, age, activity FROM hsa_activity_tables WHERE dataset='NATION_3' AND fyear=2000",
    "provider_inequalities": "SELECT * FROM inequalities WHERE dataset='NATION_3' AND fyear=2000",
    "region_ip": f"SELECT rn, fyear, icb AS dataset, dataset AS sitetret, icb, admigroup, cost FROM (SELECT rn, fyear, dataset, icb, admigroup, cost FROM ip) t WHERE icb={_REGION} AND fyear=2000",
    "region_op": f"""SELECT fyear, icb AS dataset, provider AS sitetret, icb, sushrg_trimmed, imd_quintile, attendance_type, CAST(coalesce(sum(attendances),0) AS BIGINT) AS attendances, CAST(coalesce(sum(tele_attendances),0) AS BIGINT) AS tele_attendances,
 CAST(row_number() OVER (ORDER BY attendance_type NULLS LAST, fyear NULLS LAST, icb NULLS LAST, imd_quintile NULLS LAST, provider NULLS LAST, sushrg_trimmed NULLS LAST)-1 AS BIGINT) AS rn
FROM (SELECT fyear, dataset AS provider, icb, sushrg_trimmed, imd_quintile, attendance_type, attendances, tele_attendances FROM op) t WHERE icb={_REGION} AND fyear=2000 GROUP BY fyear, provider, icb, sushrg_trimmed, imd_quintile, attendance_type""",
    "region_aae": f"""SELECT fyear, icb AS dataset, provider AS sitetret, icb, aedepttype, acuity, CAST(coalesce(sum(arrivals),0) AS BIGINT) AS arrivals,
 CAST(row_number() OVER (ORDER BY acuity NULLS LAST, aedepttype NULLS LAST, fyear NULLS LAST, icb NULLS LAST, provider NULLS LAST)-1 AS BIGINT) AS rn
FROM (SELECT fyear, dataset AS provider, icb, aedepttype, acuity, arrivals FROM aae) t WHERE icb={_REGION} AND fyear=2024 GROUP BY fyear, provider, icb, aedepttype, acuity""",
    "region_birth_factors": f'SELECT age, 2 AS sex, projection AS variant, CAST(sum(CASE WHEN "year"=1999 THEN "value"*pcnt END) AS DOUBLE) AS "1999", CAST(sum(CASE WHEN "year"=2000 THEN "value"*pcnt END) AS DOUBLE) AS "2000" FROM births JOIN icb_catchments USING (area_code) WHERE projection_year=2022 AND icb={_REGION} GROUP BY age, projection',
    "region_demographic_factors": f'SELECT age, sex, projection AS variant, CAST(sum(CASE WHEN "year"=1999 THEN "value"*pcnt END) AS DOUBLE) AS "1999", CAST(sum(CASE WHEN "year"=2000 THEN "value"*pcnt END) AS DOUBLE) AS "2000" FROM demographics JOIN icb_catchments USING (area_code) WHERE projection_year=2022 AND icb={_REGION} GROUP BY age, sex, projection',
    "region_hsa_activity": f"SELECT hsagrp, sex, age, avg(activity) AS activity FROM hsa_activity_tables_icb WHERE icb={_REGION} AND fyear=200001 GROUP BY hsagrp, sex, age",
    "region_inequalities": f"SELECT * FROM inequalities WHERE icb={_REGION} AND fyear=2000",
    "national_ip": "SELECT rn, fyear, 'NATIONAL' AS dataset, 'NATIONAL' AS sitetret, icb, admigroup, cost FROM ip WHERE fyear=2000 AND " + _SAMPLE.format(rn="rn"),
    "national_op": f"""SELECT 'NATIONAL' AS dataset, 'NATIONAL' AS sitetret, 'NATIONAL' AS icb, 'HRG' AS sushrg_trimmed, 0 AS imd_quintile, attendance_type, CAST(sum(attendances) AS DOUBLE)*CAST(0.25 AS DOUBLE) AS attendances, CAST(sum(tele_attendances) AS DOUBLE)*CAST(0.25 AS DOUBLE) AS tele_attendances,
 sha256(concat({_tok('attendance_type')},chr(31),'VNATIONAL',chr(31),'VNATIONAL',chr(31),'V0',chr(31),'VNATIONAL',chr(31),'VHRG')) AS rn
FROM op WHERE fyear=2000 GROUP BY attendance_type""",
    "national_aae": f"""SELECT 'NATIONAL' AS dataset, 'NATIONAL' AS sitetret, 'NATIONAL' AS icb, aedepttype, acuity, CAST(sum(arrivals) AS DOUBLE)*CAST(0.25 AS DOUBLE) AS arrivals,
 sha256(concat({_tok('CAST(acuity AS VARCHAR)')},chr(31),{_tok('aedepttype')},chr(31),'VNATIONAL',chr(31),'VNATIONAL',chr(31),'VNATIONAL')) AS rn
FROM aae WHERE fyear=2024 GROUP BY aedepttype, acuity""",
    "national_birth_factors": 'SELECT variant, age, sex, CAST(sum("2019") AS DOUBLE) AS "2019", CAST(sum("2020") AS DOUBLE) AS "2020", CAST(sum("2021") AS DOUBLE) AS "2021" FROM birth_factors WHERE fyear=2000 AND variant NOT LIKE \'custom%\' GROUP BY variant, age, sex',
    "national_demographic_factors": 'SELECT variant, age, sex, CAST(sum("2019") AS DOUBLE) AS "2019", CAST(sum("2020") AS DOUBLE) AS "2020", CAST(sum("2021") AS DOUBLE) AS "2021" FROM demographic_factors WHERE fyear=2000 AND variant NOT LIKE \'custom%\' GROUP BY variant, age, sex',
    "national_hsa_activity": "SELECT hsagrp, sex, age, avg(activity) AS activity FROM hsa_activity_tables_icb WHERE fyear=200001 GROUP BY hsagrp, sex, age",
    "national_inequalities": "SELECT * FROM inequalities WHERE fyear=2000",
    "stable_row_id": f"SELECT attendance_type, sushrg_trimmed, imd_quintile, sha256(concat({_tok('attendance_type')},chr(31),{_tok('CAST(imd_quintile AS VARCHAR)')},chr(31),{_tok('sushrg_trimmed')})) AS rn FROM (SELECT DISTINCT attendance_type, sushrg_trimmed, imd_quintile FROM op) t",
    "batch_provider_ip": "SELECT q.request_id, ip.* FROM ip JOIN (SELECT concat(n_name,'-',CAST(y AS VARCHAR)) AS request_id, n_name, y FROM nation CROSS JOIN (SELECT 1999 AS y UNION ALL SELECT 2000) yy) q ON ip.dataset=q.n_name AND ip.fyear=q.y",
    "wide_to_long": 'SELECT variant, age, sex, \'2019\' AS "year", CAST("2019" AS DOUBLE) AS "value" FROM demographic_factors UNION ALL SELECT variant, age, sex, \'2020\', CAST("2020" AS DOUBLE) FROM demographic_factors UNION ALL SELECT variant, age, sex, \'2021\', CAST("2021" AS DOUBLE) FROM demographic_factors',
}
QUERIES["duplicate_episode_keys"] = "SELECT rn, count(*) AS \"rows\" FROM ip WHERE fyear=2000 AND rn IS NOT NULL GROUP BY rn HAVING count(*) > 1"
# Years present in the order dates of every test scale (1995-2001): the discovered pivot columns.
_ALL_YEARS = range(1995, 2002)
_ALL_SUMS = ", ".join(f'CAST(sum(CASE WHEN "year"={y} THEN "value"*pcnt END) AS DOUBLE) AS "{y}"' for y in _ALL_YEARS)
QUERIES["region_birth_factors_given_years"] = QUERIES["region_birth_factors"]
QUERIES["region_birth_factors"] = QUERIES["region_birth_factors_all_years"] = f"SELECT age, 2 AS sex, projection AS variant, {_ALL_SUMS} FROM births JOIN icb_catchments USING (area_code) WHERE projection_year=2022 AND icb={_REGION} GROUP BY age, projection"
QUERIES["region_demographic_factors"] = QUERIES["region_demographic_factors_all_years"] = f"SELECT age, sex, projection AS variant, {_ALL_SUMS} FROM demographics JOIN icb_catchments USING (area_code) WHERE projection_year=2022 AND icb={_REGION} GROUP BY age, sex, projection"
QUERIES["source_by_path_provider_ip"] = QUERIES["provider_ip"]
QUERIES["source_by_catalog_region_inequalities"] = QUERIES["region_inequalities"]
QUERIES["duplicate_strategy_keys"] = "SELECT rn, strategy, count(*) AS \"rows\" FROM ip_activity_avoidance_strategies GROUP BY rn, strategy HAVING count(*) > 1"
QUERIES["duplicate_composite_keys"] = """SELECT dataset, sitetret, admigroup, count(*) AS "rows" FROM ip
WHERE fyear=2000 AND dataset IS NOT NULL AND sitetret IS NOT NULL AND admigroup IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1"""
QUERIES["request_metadata"] = f"""WITH r AS (SELECT *, CAST(o_orderkey AS VARCHAR) AS id,
 strftime(make_timestamp(2024, month(o_orderdate), day(o_orderdate), 9, o_orderkey % 60, 7), '%Y%m%d_%H%M%S') AS stamp FROM orders)
SELECT id AS request_id, o_orderpriority AS code, CAST({YEAR} AS INT) AS fyear, CAST(o_custkey AS BIGINT) AS seed, stamp AS create_datetime, key, value
FROM r, LATERAL (VALUES ('app_version','v1'),('dataset',o_orderpriority),('scenario','base'),('seed',CAST(o_custkey AS VARCHAR)),('start_year','{YEAR}'),
 ('late',CASE WHEN o_orderstatus='F' THEN 'true' ELSE 'false' END),('create_datetime',stamp)) AS e(key, value)"""
for _level, (_where, _cohort) in _COHORT.items():
    for _kind, _table in _TABLES.items():
        QUERIES[f"{_level}_strategies_{_kind}"] = _STRATEGY.format(table=_table, where=_where, cohort=_cohort)


# Batch oracles: the request table ``q`` (as built by _level_requests) joined to each table.
_YEARS_SQL = " UNION ALL ".join(f"SELECT {y} AS y" for y in REQUEST_YEARS)
_REQ_SQL = {
    "provider": f"SELECT n_name||'-'||CAST(y AS VARCHAR) AS request_id, n_name AS code, y AS fyear FROM nation CROSS JOIN ({_YEARS_SQL}) yy",
    "region": f"SELECT r_name||'-'||CAST(y AS VARCHAR) AS request_id, r_name AS code, y AS fyear FROM region CROSS JOIN ({_YEARS_SQL}) yy",
    "national": f"SELECT 'n'||CAST(r_regionkey AS VARCHAR)||'-'||CAST(y AS VARCHAR) AS request_id, y AS fyear, CAST(r_regionkey+1 AS DOUBLE)/8 AS sample_rate, CAST(r_regionkey+40 AS BIGINT) AS seed FROM region CROSS JOIN ({_YEARS_SQL}) yy",
}
_Q_SAMPLE = ("substr(md5(concat(CAST(q.seed AS VARCHAR),'|',CAST({rn} AS VARCHAR))),1,8) < "
             "lower(lpad(hex(CAST(floor(q.sample_rate*4294967296) AS BIGINT)),8,'0'))")
_ON = {"provider": "{t}.dataset=q.code AND {t}.fyear=q.fyear", "region": "{t}.icb=q.code AND {t}.fyear=q.fyear",
       "national": "{t}.fyear=q.fyear"}
_FACTOR_COLS = ", ".join(f'CAST("{y}" AS DOUBLE) AS "{y}"' for y in FACTOR_YEARS)
_FACTOR_SUMS = ", ".join(f'CAST(sum("{y}") AS DOUBLE) AS "{y}"' for y in FACTOR_YEARS)
_PIVOT_SUMS = ", ".join(f'CAST(sum(CASE WHEN "year"={y} THEN "value"*pcnt END) AS DOUBLE) AS "{y}"' for y in _ALL_YEARS)
_NATIONAL_KEYS_OP = f"sha256(concat({_tok('attendance_type')},chr(31),'VNATIONAL',chr(31),'VNATIONAL',chr(31),'V0',chr(31),'VNATIONAL',chr(31),'VHRG'))"
_NATIONAL_KEYS_AAE = f"sha256(concat({_tok('CAST(acuity AS VARCHAR)')},chr(31),{_tok('aedepttype')},chr(31),'VNATIONAL',chr(31),'VNATIONAL',chr(31),'VNATIONAL'))"


def _batch_sql(level: str, kind: str) -> str:
    on = _ON[level].format(t="t")
    if kind == "ip":
        if level == "provider":
            body = f"SELECT q.request_id, t.* FROM ip t JOIN q ON {on}"
        elif level == "region":
            body = f"SELECT q.request_id, t.rn, t.fyear, t.icb AS dataset, t.dataset AS sitetret, t.icb, t.admigroup, t.cost FROM ip t JOIN q ON {on}"
        else:
            body = (f"SELECT q.request_id, t.rn, t.fyear, 'NATIONAL' AS dataset, 'NATIONAL' AS sitetret, t.icb, t.admigroup, t.cost "
                    f"FROM ip t JOIN q ON {on} WHERE " + _Q_SAMPLE.format(rn="t.rn"))
    elif kind.startswith("strategies_"):
        table = "ip_" + kind[len("strategies_"):] + "_strategies"
        s_on = _ON[level if level == "provider" else "national"].format(t="s")
        cohort = _ON[level].format(t="ip") + (" AND " + _Q_SAMPLE.format(rn="ip.rn") if level == "national" else "")
        body = (f"SELECT q.request_id, s.rn, s.dataset, s.fyear, s.strategy, s.sample_rate FROM {table} s JOIN q ON {s_on} "
                f"WHERE EXISTS (SELECT 1 FROM ip WHERE ip.rn=s.rn AND {cohort})")
    elif kind in ("op", "aae"):
        detail = "sushrg_trimmed, imd_quintile, attendance_type" if kind == "op" else "aedepttype, acuity"
        measures = ["attendances", "tele_attendances"] if kind == "op" else ["arrivals"]
        if level == "provider":
            body = (f'SELECT q.request_id, t."index" AS rn, t.fyear, t.dataset, t.sitetret, t.icb, {detail}, '
                    f"{', '.join(measures)} FROM {kind} t JOIN q ON {on}")
        elif level == "region":
            order = ("attendance_type, fyear, icb, imd_quintile, provider, sushrg_trimmed" if kind == "op"
                     else "acuity, aedepttype, fyear, icb, provider")
            order = ", ".join(f"{c} NULLS LAST" for c in order.split(", "))
            sums = ", ".join(f"CAST(coalesce(sum({m}),0) AS BIGINT) AS {m}" for m in measures)
            body = (f"SELECT request_id, fyear, code AS dataset, provider AS sitetret, icb, {detail}, {sums}, "
                    f"CAST(row_number() OVER (PARTITION BY request_id ORDER BY {order})-1 AS BIGINT) AS rn "
                    f"FROM (SELECT q.request_id, q.code, t.fyear, t.dataset AS provider, t.icb, {detail}, {', '.join(measures)} "
                    f"FROM {kind} t JOIN q ON {on}) x GROUP BY request_id, code, fyear, provider, icb, {detail}")
        else:
            consts = "'NATIONAL' AS dataset, 'NATIONAL' AS sitetret, 'NATIONAL' AS icb"
            if kind == "op":
                consts += ", 'HRG' AS sushrg_trimmed, 0 AS imd_quintile"
                group, rid = "attendance_type", _NATIONAL_KEYS_OP
            else:
                group, rid = "aedepttype, acuity", _NATIONAL_KEYS_AAE
            sums = ", ".join(f"CAST(sum({m}) AS DOUBLE)*q.sample_rate AS {m}" for m in measures)
            body = (f"SELECT q.request_id, {consts}, {group}, {sums}, {rid} AS rn FROM {kind} t JOIN q ON {on} "
                    f"GROUP BY q.request_id, q.sample_rate, {group}")
    elif kind.endswith("factors"):
        wide, long_ = ("birth_factors", "births") if kind == "birth_factors" else ("demographic_factors", "demographics")
        if level == "provider":
            body = f"SELECT q.request_id, t.fyear, t.variant, t.age, t.sex, {_FACTOR_COLS} FROM {wide} t JOIN q ON {on}"
        elif level == "region":
            sex, group = ("2 AS sex", "age, projection") if kind == "birth_factors" else ("sex", "age, sex, projection")
            body = (f"SELECT q.request_id, age, {sex}, projection AS variant, {_PIVOT_SUMS} FROM {long_} JOIN icb_catchments c "
                    f"USING (area_code) JOIN q ON c.icb=q.code WHERE projection_year=2022 GROUP BY q.request_id, {group}")
        else:
            body = (f"SELECT q.request_id, variant, age, sex, {_FACTOR_SUMS} FROM {wide} t JOIN q ON {on} "
                    f"WHERE variant NOT LIKE 'custom%' GROUP BY q.request_id, variant, age, sex")
    elif kind == "hsa_activity":
        if level == "provider":
            body = f"SELECT q.request_id, t.icb, t.hsagrp, t.sex, t.age, t.activity FROM hsa_activity_tables t JOIN q ON {on}"
        else:
            code = "t.fyear=q.fyear*100+(q.fyear+1)%100" + (" AND t.icb=q.code" if level == "region" else "")
            body = (f"SELECT q.request_id, hsagrp, sex, age, avg(activity) AS activity FROM hsa_activity_tables_icb t "
                    f"JOIN q ON {code} GROUP BY q.request_id, hsagrp, sex, age")
    else:
        body = f"SELECT q.request_id, t.* FROM inequalities t JOIN q ON {on}"
    return body


def _with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the views it needs (transitively), in dependency order, then ``extra``."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                pending.append(body)
    ctes = [f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed]
    ctes += [f"{name} AS ({body})" for name, body in (extra or {}).items()]
    return ("WITH " + ",\n".join(ctes) + "\n" + sql) if ctes else sql


for _level in ("provider", "region", "national"):
    for _kind in BATCH_KINDS:
        QUERIES[f"batch_{_level}_requests_{_kind}"] = _batch_sql(_level, _kind)


for _name, (_level, _kind) in SINKS.items():
    _code = "'NATIONAL'" if _level == "national" else "runs.code"
    _labels = ", ".join(f"'{v}' AS {c}" for c, v in RUN_LABELS.items())
    QUERIES[_name] = f"SELECT b.*, {_code} AS run_dataset, {_labels} FROM ({_batch_sql(_level, _kind)}) b JOIN q runs ON runs.request_id=b.request_id"


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, sql in QUERIES.items():
        if name not in queries():
            continue
        if name in SINKS or name.startswith("batch_") and "_requests_" in name:
            level = name.split("_")[1]
            out[name] = _with_views(sql, extra={"q": _REQ_SQL[level]})
        else:
            out[name] = _with_views(sql)
    if llm_queries:
        out |= llm_queries.oracle_sql()
    return out
