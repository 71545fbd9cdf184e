"""Row-level identity: partition-independent sampling, stable hash ids and dense 0-based ids.

Everything here is built from JVM-side expressions (md5, sha2, window, range partitioning), so it
stays inside whole-stage codegen and never routes rows through Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from caseload.operators.joins import small_side

# Fixed values of the id encodings.
KEY_SEPARATOR = "\x1f"  # char 31 between key tokens
PRESENT_MARK = "V"  # prefix of a present value
NULL_MARK = "N"  # token of a NULL value
SAMPLE_SEPARATOR = "|"  # between seed and key in the sample hash

_TWO_32 = 4294967296  # 2**32
# Rows that one task puts in order, and sampled places per range of the order.
RANGE_ROWS = 1_000_000
SAMPLES = 20
# Hex digits sort below this: the threshold of a sample that keeps everything.
_ALL = "g"


# --------------------------------------------------------------------------------------------
# Sampling (SMP1, SMP3)
# --------------------------------------------------------------------------------------------

def sample_threshold(rate: float) -> str:
    """Lower-case 8-digit hex of ``floor(rate * 2**32)``; a row is kept when the first 8 hex
    digits of its hash sort below it."""
    return format(int(math.floor(rate * _TWO_32)), "08x")


def _sample_hash(key: Column, seed: Column) -> Column:
    return F.substring(F.md5(F.concat(seed.cast("string"), F.lit(SAMPLE_SEPARATOR), key.cast("string"))), 1, 8)


def sample_predicate(rate: float, seed: int, key: str | Column = "rn") -> Column:
    """Predicate keeping about ``rate`` of the rows, decided by ``md5(seed|key)`` alone.

    The decision for a row depends only on its key, so it is the same on any partitioning, and the
    same predicate applied to another table keyed by ``key`` selects the matching rows (SMP3).
    A rate of 1 keeps every row; below it a row with a NULL key has no hash and is not kept.
    """
    if rate <= 0:
        return F.lit(False)
    if rate >= 1:
        return F.lit(True)
    key_col = F.col(key) if isinstance(key, str) else key
    return _sample_hash(key_col, F.lit(int(seed))) < F.lit(sample_threshold(rate))


def sample_threshold_col(rate: Column) -> Column:
    """Column form of :func:`sample_threshold`, with the bounds folded in: rate <= 0 gives ``''``
    (no hash sorts below it) and rate >= 1 gives ``'g'`` (every hex hash sorts below it)."""
    hex_bound = F.lower(F.lpad(F.hex(F.floor(rate * F.lit(float(_TWO_32))).cast("long")), 8, "0"))
    return F.when(rate <= 0, F.lit("")).when(rate >= 1, F.lit(_ALL)).otherwise(hex_bound)


def seed_prefix_col(seed: Column) -> Column:
    return F.concat(seed.cast("string"), F.lit(SAMPLE_SEPARATOR))


def threshold_index(requests: DataFrame, within: Sequence[str], blocks: int = 1) -> DataFrame:
    """The samples that ``requests`` (request_id, seed, sample_rate) ask for, one row per distinct ``within`` and seed:
    ``_seed_prefix``, ``_samples``, the requests with their thresholds in ascending order, and ``_highest``, the last threshold.
    A row of data is hashed once per seed and finds its requests as the end of that list (:func:`sampled_requests`).
    ``blocks`` deals the requests of a seed over that many rows by a hash of their ids."""
    samples = F.array_sort(F.collect_list(F.struct(sample_threshold_col(F.col("sample_rate")).alias("threshold"), "request_id")))
    block = F.pmod(F.xxhash64("request_id"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    return (requests.groupBy(*within, seed_prefix_col(F.col("seed")).alias("_seed_prefix"), block.alias("_block"))
            .agg(samples.alias("_samples"), F.max(sample_threshold_col(F.col("sample_rate"))).alias("_highest")).drop("_block"))


def _first_above(samples: Column, value: Column) -> Column:
    """Number of the first sample whose threshold is above ``value``, by binary search; the length if there is none."""
    start = F.struct(F.lit(0).alias("low"), F.size(samples).alias("high"))

    def halve(s: Column, _step: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        above = F.get(samples, middle)["threshold"] > value
        return F.when(s["low"] >= s["high"], s).otherwise(F.struct(
            F.when(above, s["low"]).otherwise(middle + 1).alias("low"), F.when(above, middle).otherwise(s["high"]).alias("high")))

    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(samples) + F.lit(1))).cast("int"))
    return F.aggregate(steps, start, halve, lambda s: s["low"])


def sampled_requests(rows: DataFrame, key: str) -> DataFrame:
    """Of ``rows`` joined to a :func:`threshold_index`, those that some request keeps, with ``_requests``, the ids of all that do, in
    place of the index's columns. Decided like :func:`sample_predicate`: a rate of 1 keeps every row, below it a row with a
    NULL key is not kept."""
    # Sorts above every threshold but that of a sample that keeps everything.
    no_hash = F.lit("f" * 9)
    hashed = F.coalesce(F.substring(F.md5(F.concat("_seed_prefix", F.col(key).cast("string"))), 1, 8), no_hash)
    # Exploded, as the optimizer would otherwise copy the hash into the filter and the search.
    rows = rows.withColumn("_hash", F.explode(F.array(hashed))).where(F.col("_hash") < F.col("_highest"))
    several = F.transform(F.array(_first_above(F.col("_samples"), F.col("_hash"))), lambda first: F.transform(
        F.slice("_samples", first + 1, F.size("_samples") - first), lambda s: s["request_id"]))[0]
    one = F.array(F.col("_samples")[0]["request_id"])  # its threshold is the highest
    return rows.withColumn("_requests", F.when(F.size("_samples") == 1, one).otherwise(several)).drop("_hash", "_highest", "_samples", "_seed_prefix")


def sample_rows(df: DataFrame, rate: float, seed: int, key: str = "rn", method: str = "hash") -> DataFrame:
    """Row sample without replacement.

    ``method="hash"`` (default) keeps a row when ``md5(seed|key)`` falls below the rate, which is
    reproducible under any partitioning. ``method="bernoulli"`` is Spark's ``sample`` (its result
    changes with the partitioning of the input).
    """
    if method == "bernoulli":
        if rate >= 1:
            return df
        return df.sample(withReplacement=False, fraction=max(rate, 0.0), seed=seed)
    if method != "hash":
        raise ValueError(f"unknown sample method {method!r}")
    if rate >= 1:
        return df
    return df.filter(sample_predicate(rate, seed, key))


# --------------------------------------------------------------------------------------------
# Stable ids (RID1)
# --------------------------------------------------------------------------------------------

def _token(name: str) -> Column:
    text = F.col(name).cast("string")
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(KEY_SEPARATOR), F.lit("\\u"))
    return F.coalesce(F.concat(F.lit(PRESENT_MARK), text), F.lit(NULL_MARK))


def stable_id_col(keys: Sequence[str]) -> Column:
    """SHA-256 over the name-sorted keys: ``V<value>`` or ``N`` per key, joined with char 31.

    Backslash and char 31 inside values are escaped, so (``a``+sep, ``b``) and (``a``, sep+``b``)
    differ; NULL and the string ``N`` differ by the ``V`` mark.
    """
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[_token(k) for k in sorted(keys)]), 256)


def stable_id(df: DataFrame, keys: Sequence[str], name: str = "rn") -> DataFrame:
    """Add an id that depends only on the key values (same on every run and partitioning)."""
    return df.withColumn(name, stable_id_col(keys))


# --------------------------------------------------------------------------------------------
# Dense ids (RID2)
# --------------------------------------------------------------------------------------------

def _order(keys: Sequence[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]


def dense_id(
    df: DataFrame,
    keys: Sequence[str],
    within: Sequence[str] = (),
    name: str = "rn",
    method: str = "auto",
    partitions: int | None = None,
) -> DataFrame:
    """0-based position of each row in the order of its name-sorted ``keys`` (NULLs last),
    restarting for each value of ``within`` (e.g. a request id).

    ``method="range"`` (``"auto"`` is the same): the input, usually a small aggregate over a large
    scan, is checkpointed once and counted on the way. Its order is cut into ``partitions`` ranges (default: one for
    every ``RANGE_ROWS`` rows) at explicit splitters, keys taken from the rows themselves (:func:`_splitters`), so which
    range a row is in depends on the row alone. A row's position is its place in its range plus the rows of the same
    ``within`` group in earlier ranges. No task holds more than one range of one group, even when one
    group has most of the rows; a single range needs neither splitters nor offsets.

    ``method="window"`` is ``row_number()`` over one window; without ``within`` that runs in a
    single task, so it is only for results known to be small.
    """
    within = list(within)
    sort_keys = sorted(keys)
    if method == "window":
        return _window_ids(df, sort_keys, within, name)
    if method not in ("auto", "range"):
        raise ValueError(f"unknown dense id method {method!r}")
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows")).checkpoint(eager=True)
    ranges = partitions or -(-counted.get["rows"] // RANGE_ROWS)
    if ranges <= 1:
        return _window_ids(rows, sort_keys, within, name)
    return _range_ids(rows, sort_keys, within, name, ranges)


def _window_ids(df: DataFrame, sort_keys: list[str], within: list[str], name: str) -> DataFrame:
    spec = Window.partitionBy(*within) if within else Window.partitionBy()
    spec = spec.orderBy(*_order(sort_keys))
    return df.withColumn(name, (F.row_number().over(spec) - 1).cast("long"))


def _place(keys: Sequence[str]) -> Column:
    """A struct that compares as rows are ordered: NULLs last."""
    return F.struct(*[c for i, k in enumerate(keys) for c in (F.col(k).isNull().alias(f"n{i}"), F.col(k).alias(f"k{i}"))])


def _splitters(df: DataFrame, keys: Sequence[str], ranges: int) -> Column:
    """``ranges - 1`` places (fewer, for few rows) that cut the order of ``df`` into ranges of about equal size, as a literal array.

    Of every hash class of the rows the least place is a sample of the order; there are ``SAMPLES`` classes per range. Only
    the splitters leave the executors."""
    place = _place(keys)
    classes = F.pmod(F.xxhash64(place), F.lit(ranges * SAMPLES))
    sample = df.groupBy(classes.alias("c")).agg(F.min_by(place, F.xxhash64(place, F.lit(1))).alias("place"))
    ordered = sample.agg(F.array_sort(F.collect_list("place")).alias("places"))
    step = F.size("places") / ranges
    cuts = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("places", F.floor(i * step).cast("int")))
    found = ordered.select(F.to_json(F.array_distinct(cuts), {"ignoreNullFields": "false"}).alias("cuts"))
    kind = ordered.schema["places"].dataType
    return F.from_json(F.lit(found.first()["cuts"]), kind, {"allowNonNumericNumbers": "true"})


def _range_of(place: Column, splitters: Column) -> Column:
    """How many splitters are at or before ``place``, by binary search."""
    def halve(s: Column, _step: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        after = F.get(splitters, middle) > place
        return F.when(s["low"] >= s["high"], s).otherwise(F.struct(
            F.when(after, s["low"]).otherwise(middle + 1).alias("low"), F.when(after, middle).otherwise(s["high"]).alias("high")))

    start = F.struct(F.lit(0).alias("low"), F.size(splitters).alias("high"))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(splitters) + F.lit(1))).cast("int"))
    return F.aggregate(steps, start, halve, lambda s: s["low"])


def _range_ids(df: DataFrame, sort_keys: list[str], within: list[str], name: str, ranges: int) -> DataFrame:
    lead = within + sort_keys
    ranged = df.withColumn("_part", _range_of(_place(lead), _splitters(df, lead, ranges)))
    runs = ranged.groupBy("_part", *within).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (Window.partitionBy(*within) if within else Window.partitionBy()).orderBy("_part")
    offset = F.coalesce(F.sum("_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row per range, or per (range, group): broadcast after a bounded count.
    runs = small_side(runs.select("_part", *within, offset.alias("_offset")))
    spec = Window.partitionBy("_part", *within).orderBy(*_order(sort_keys))
    placed = ranged.withColumn("_pos", F.row_number().over(spec) - 1)
    join_cond = [placed["_part"] == runs["_part"]] + [placed[c].eqNullSafe(runs[c]) for c in within]
    out = placed.join(runs, join_cond, "inner").select(
        placed["*"], (placed["_pos"] + runs["_offset"]).cast("long").alias(name)
    )
    return out.drop("_part", "_pos")
