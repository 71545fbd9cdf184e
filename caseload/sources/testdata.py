"""Reference-shaped tables derived from the generated TPC-H-style test tables.

The real inputs are parquet tables of hospital episodes, strategies, outpatient and A&E activity,
factors and catalog tables. For tests and the bench they are derived from the driver's tables
(orders, lineitem, customer, nation, region, events) by the joins below. Each builder returns a lazy
DataFrame, so the derived tables grow with the source tables and Catalyst pushes a cohort's filters
through them (e.g. ``dataset = ...`` reaches the nation scan).

This is test scaffolding; the extract operators never depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseload.functions.scope import fyear_code_col
from caseload.sources import dataset as names
from caseload.sources.dataset import Dataset

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed parameters of the mapping.
PROJECTION_YEAR = 2022
HOME_REGION_SHARE = "0.75"
NEXT_REGION_SHARE = "0.25"
FACTOR_YEARS = ("2019", "2020", "2021")
FACTOR_DECIMAL = "decimal(18,2)"


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fyear(ts: str) -> Column:
    return F.year(ts).cast("int")


class _Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def t(self, name: str) -> DataFrame:
        return raw(self.spark, self.sf_dir, name)

    # ---- shared joins -------------------------------------------------------------------------
    def orders_geo(self, with_region: bool = True) -> DataFrame:
        df = (self.t("orders")
              .join(self.t("customer"), F.col("o_custkey") == F.col("c_custkey"))
              .join(self.t("nation"), F.col("c_nationkey") == F.col("n_nationkey")))
        if with_region:
            df = df.join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return df

    def lines_geo(self, with_region: bool = True) -> DataFrame:
        return self.t("lineitem").join(self.orders_geo(with_region), F.col("l_orderkey") == F.col("o_orderkey"))

    # ---- reference-shaped tables ---------------------------------------------------------------
    def ip(self) -> DataFrame:
        return self.orders_geo().select(
            F.col("o_orderkey").alias("rn"),
            _fyear("o_orderdate").alias("fyear"),
            F.col("n_name").alias("dataset"),
            F.col("c_mktsegment").alias("sitetret"),
            F.col("r_name").alias("icb"),
            F.col("o_orderpriority").alias("admigroup"),
            F.col("o_totalprice").alias("cost"),
        )

    def strategies(self, prefix: str, linestatus: str) -> DataFrame:
        return self.lines_geo(with_region=False).where(F.col("l_linestatus") == linestatus).select(
            F.col("l_orderkey").alias("rn"),
            F.col("n_name").alias("dataset"),
            _fyear("o_orderdate").alias("fyear"),
            F.concat(F.lit(prefix), F.col("l_returnflag")).alias("strategy"),
            F.col("l_discount").alias("sample_rate"),
        )

    def op(self) -> DataFrame:
        return self.lines_geo().select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("index"),
            _fyear("o_orderdate").alias("fyear"),
            F.col("n_name").alias("dataset"),
            F.col("c_mktsegment").alias("sitetret"),
            F.col("r_name").alias("icb"),
            F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_returnflag")).alias("sushrg_trimmed"),
            (F.col("l_partkey") % 5 + 1).cast("int").alias("imd_quintile"),
            F.col("o_orderstatus").alias("attendance_type"),
            F.when(F.col("l_linenumber") == 6, F.lit(None).cast("long"))
            .otherwise(F.col("l_quantity").cast("long")).alias("attendances"),
            F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("long"))
            .otherwise(F.lit(0).cast("long")).alias("tele_attendances"),
        )

    def aae(self) -> DataFrame:
        return (self.t("events")
                .join(self.t("nation"), (F.col("user_id") % 25) == F.col("n_nationkey"))
                .join(self.t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select(
                    F.col("event_id").alias("index"),
                    _fyear("ts").alias("fyear"),
                    F.col("n_name").alias("dataset"),
                    F.col("n_name").alias("sitetret"),
                    F.col("r_name").alias("icb"),
                    F.col("event_type").alias("aedepttype"),
                    (F.col("user_id") % 3).cast("int").alias("acuity"),
                    F.lit(1).cast("long").alias("arrivals"),
                ))

    def demographic_factors(self) -> DataFrame:
        price = F.col("o_totalprice")
        return self.orders_geo(with_region=False).select(
            F.col("n_name").alias("dataset"),
            _fyear("o_orderdate").alias("fyear"),
            F.when(F.col("o_orderpriority") == "5-LOW", F.lit("custom_low"))
            .otherwise(F.col("o_orderpriority")).alias("variant"),
            (F.col("o_custkey") % 10).cast("int").alias("age"),
            (F.col("o_custkey") % 2 + 1).cast("int").alias("sex"),
            price.cast(FACTOR_DECIMAL).alias("2019"),
            F.when(F.col("o_orderstatus") == "P", F.lit(None).cast(FACTOR_DECIMAL))
            .otherwise(price.cast(FACTOR_DECIMAL)).alias("2020"),
            (price * 2).cast(FACTOR_DECIMAL).alias("2021"),
        )

    def birth_factors(self) -> DataFrame:
        return self.demographic_factors().where(F.col("sex") == 2)

    def demographics(self) -> DataFrame:
        return (self.t("orders")
                .join(self.t("customer"), F.col("o_custkey") == F.col("c_custkey"))
                .select(
                    F.col("c_nationkey").alias("area_code"),
                    F.col("c_mktsegment").alias("projection"),
                    _fyear("o_orderdate").alias("year"),
                    F.lit(PROJECTION_YEAR).alias("projection_year"),
                    (F.col("o_custkey") % 10).cast("int").alias("age"),
                    (F.col("o_custkey") % 2 + 1).cast("int").alias("sex"),
                    F.col("o_totalprice").cast(FACTOR_DECIMAL).alias("value"),
                ))

    def births(self) -> DataFrame:
        return self.demographics().select("area_code", "projection", "year", "projection_year", "age", "value")

    def icb_catchments(self) -> DataFrame:
        # Each nation serves its own region (0.75) and the next one (0.25): one equi-join on an
        # exploded pair instead of a join on an OR condition.
        links = self.t("nation").select(
            F.col("n_nationkey").alias("area_code"),
            F.explode(F.array(
                F.struct(F.col("n_regionkey").alias("link"), F.lit(HOME_REGION_SHARE).cast("decimal(3,2)").alias("pcnt")),
                F.struct(((F.col("n_regionkey") + 1) % 5).alias("link"),
                         F.lit(NEXT_REGION_SHARE).cast("decimal(3,2)").alias("pcnt")),
            )).alias("l"),
        )
        return (links.join(self.t("region"), F.col("l.link") == F.col("r_regionkey"))
                .select("area_code", F.col("r_name").alias("icb"), F.col("l.pcnt").alias("pcnt")))

    def hsa_activity_tables(self) -> DataFrame:
        return self.lines_geo().select(
            F.col("n_name").alias("dataset"),
            F.col("r_name").alias("icb"),
            _fyear("o_orderdate").alias("fyear"),
            F.col("l_returnflag").alias("hsagrp"),
            (F.col("o_custkey") % 2 + 1).cast("int").alias("sex"),
            (F.col("o_custkey") % 10).cast("int").alias("age"),
            F.col("l_quantity").alias("activity"),
        )

    def hsa_activity_tables_icb(self) -> DataFrame:
        return self.hsa_activity_tables().select(
            "icb", fyear_code_col(F.col("fyear")).alias("fyear"), "hsagrp", "sex", "age", "activity")

    def inequalities(self) -> DataFrame:
        return (self.orders_geo()
                .groupBy(
                    F.col("n_name").alias("dataset"),
                    F.col("r_name").alias("icb"),
                    _fyear("o_orderdate").alias("fyear"),
                    F.col("o_orderpriority").alias("sushrg_trimmed"),
                    (F.col("o_custkey") % 5 + 1).cast("int").alias("imd_quintile"),
                )
                .agg(F.count(F.lit(1)).alias("activity")))


def mapped_dataset(spark: SparkSession, sf_dir: str) -> Dataset:
    """A :class:`Dataset` whose tables are derived lazily from the test tables in ``sf_dir``."""
    t = _Tables(spark, sf_dir)

    def lazy(method, *args):
        return lambda _spark: method(*args)

    tables = {
        names.IP: lazy(t.ip),
        names.STRATEGY_TABLES["activity_avoidance"]: lazy(t.strategies, "aa_", "F"),
        names.STRATEGY_TABLES["efficiencies"]: lazy(t.strategies, "eff_", "O"),
        names.OP: lazy(t.op),
        names.AAE: lazy(t.aae),
        names.BIRTH_FACTORS: lazy(t.birth_factors),
        names.DEMOGRAPHIC_FACTORS: lazy(t.demographic_factors),
        names.HSA_ACTIVITY: lazy(t.hsa_activity_tables),
        names.INEQUALITIES: lazy(t.inequalities),
        names.BIRTHS: lazy(t.births),
        names.DEMOGRAPHICS: lazy(t.demographics),
        names.CATCHMENTS: lazy(t.icb_catchments),
        names.HSA_ACTIVITY_REGION: lazy(t.hsa_activity_tables_icb),
        # The national catalog table has the same shape; the test data serves both from one view.
        names.HSA_ACTIVITY_NATIONAL: lazy(t.hsa_activity_tables_icb),
    }
    return Dataset(spark, None, tables)

