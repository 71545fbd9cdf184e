"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has bit i set when bit i is set in more than half of the 64-bit hashes of its word
shingles. Fingerprints link at a Hamming distance of at most ``max_bits``. To find all links the 64 bits are
cut into segments with a tolerance each, such that sum(tolerance + 1) = max_bits + 1: two linked fingerprints
are then within the tolerance in at least one segment. Every distinct fingerprint is stored in a table under
each segment's exact value and probes it under every value of the segment's Hamming ball; the fingerprints that
meet under one key are verified over all 64 bits.

Within a key only links that connect something are emitted (a spanning forest for crowded keys), never all
pairs. A key that may be met by more than 2 * ``bucket_rows`` fingerprints, stored there or probing from a
neighbouring value, is dealt out in blocks: its table rows meet its probing rows in block pairs of bounded size,
so the work is split without losing a pair. Copies have one fingerprint and enter once.

A null or empty text, or one of white space only, has fingerprint zero and links like any other. Rows
without doc_id get a component like the others but never name it. An empty table gives no rows. Other columns
of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.components import components
from caseload.llm.storage import BROADCAST_IDS, stored, without_ids
from caseload.llm.tokens import slices
from caseload.llm.worker import map_batches

#: (bits, tolerance) of each segment, from the lowest bit: 22-bit keys keep tables sparse up to about 10^8 texts.
SEGMENTS = ((22, 1), (21, 1), (21, 0))
MAX_BITS = 4
SHINGLE = 4
SEED = 42
#: Table and probing rows of one key that a task compares at once: this many of each.
BUCKET_ROWS = 20_000
#: Keys with up to this many table rows are verified pair by pair, larger ones as a forest.
SMALL_TABLE = 16

_LOW_BITS = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle, len(words)) - 1
    starts, ends = starts[:len(words) - last].tolist(), ends[last:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends)], np.uint64)
    # Bit counts, eight bits of a hash per byte lane; 255 rows fill a lane at most.
    rows = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    rows[:len(hashes)] = hashes
    counts = np.zeros(64, np.int64)
    for k in range(8):
        lanes = ((rows >> np.uint64(k)) & _LOW_BITS).reshape(-1, 255).sum(axis=1)
        counts[k::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row of ``docs``."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in slices(batch)):
            fps = pa.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), fps], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, fp long")


def _masks(bits: int, tolerance: int) -> list[int]:
    return [sum(1 << b for b in flips) for n in range(tolerance + 1) for flips in combinations(range(bits), n)]


def _keys(fp: Column, segments) -> Column:
    """All (key, table) entries of a fingerprint: its own value and its ball in each segment."""
    entries, low = [], 0
    for number, (bits, tolerance) in enumerate(segments):
        value = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1))
        for mask in _masks(bits, tolerance):
            key = value.bitwiseXOR(F.lit(mask)).bitwiseOR(F.lit(number << 32))
            entries.append(F.struct(key.cast("long").alias("key"), F.lit(mask == 0).alias("table")))
        low += bits
    return F.array(*entries)


def _around(key: Column, segments) -> Column:
    """The keys under which the rows of a table key probe: its own and those of its ball."""
    balls = [F.array(*[key.bitwiseXOR(F.lit(m).cast("long")) for m in _masks(bits, tolerance)]) for bits, tolerance in segments]
    return F.get(F.array(*balls), F.shiftright(key, 32).cast("int"))


def crowded_keys(fps: DataFrame, segments=SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(key, blocks) of the keys that more than ``bucket_rows`` rows may meet beside ``bucket_rows`` of light values.

    A value's rows are counted where they are stored and then added to every key that they probe. Values too light to
    fill a bucket even if all values around a key were like them are left out of the sums: together they add less than
    ``bucket_rows`` to a key, which the number of blocks allows for.
    """
    values = F.explode(F.filter(_keys(F.col("fp"), segments), lambda e: e["table"])).alias("e")
    ball = max(len(_masks(*s)) for s in segments)
    heavy = fps.select(values).groupBy("e.key").count().where(F.col("count") * ball > bucket_rows)
    met = heavy.select(F.explode(_around(F.col("key"), segments)).alias("key"), "count").groupBy("key").agg(F.sum("count").alias("rows"))
    return met.where(F.col("rows") > bucket_rows).select("key", (F.ceil(F.col("rows") / bucket_rows) + 1).cast("int").alias("blocks"))


def _forest(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all members within ``max_bits`` of one another, one per newly reached member."""
    rest = np.unique(members)
    left, right = [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(rest ^ at) <= max_bits
            if near.any():
                found, rest = rest[near], rest[~near]
                left.append(np.full(len(found), at))
                right.append(found)
                queue.extend(found)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _verify(keys: np.ndarray, fps: np.ndarray, table: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows that share a key; rows are sorted by key, table rows first within a key."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[starts, len(keys)])
    stored_rows = np.add.reduceat(table.astype(np.int64), starts)
    left, right = [], []
    small = (stored_rows > 0) & (sizes > 1) & (stored_rows <= SMALL_TABLE)
    at, size, in_table = starts[small], sizes[small], stored_rows[small]
    for k in range(int(in_table.max()) if len(in_table) else 0):
        more = in_table > k
        at, size, in_table = at[more], size[more], in_table[more]
        rest = size - k - 1
        a = np.repeat(fps[at + k], rest)
        first = np.repeat(at + k + 1 - np.r_[0, np.cumsum(rest)[:-1]], rest)
        b = fps[first + np.arange(rest.sum())]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
        left.append(a[near])
        right.append(b[near])
    for s, n in zip(starts[stored_rows > SMALL_TABLE], sizes[stored_rows > SMALL_TABLE]):
        a, b = _forest(fps[s:s + n], max_bits)
        left.append(a)
        right.append(b)
    none = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _linker(max_bits: int):
    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # rows of the last key so far, which the next batch may continue
        for batch in batches:
            if not len(batch):
                continue
            key, block = batch["key"].to_numpy(), batch["block"].to_numpy()
            same = (key == key[-1]) & (block == block[-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut or (held and (held[-1]["key"].iloc[-1], held[-1]["block"].iloc[-1]) != (key[0], block[0])):
                yield _links(pd.concat([*held, batch.iloc[:cut]]), max_bits)
                held = []
            held.append(batch.iloc[cut:])
        if held:
            yield _links(pd.concat(held), max_bits)

    return run


def _links(rows: pd.DataFrame, max_bits: int) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
    key, block = rows["key"].to_numpy(), rows["block"].to_numpy()
    group = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (block[1:] != block[:-1])])
    # Unsigned: numpy counts the bits of a negative number's absolute value.
    a, b = _verify(group, rows["fp"].to_numpy().view(np.uint64), rows["table"].to_numpy(), max_bits)
    return pd.DataFrame({"u": a.view(np.int64), "v": b.view(np.int64)}).drop_duplicates()


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments=SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (u, v) that connect every two of the distinct fingerprints ``fps`` (column fp) within ``max_bits``."""
    if sum(t + 1 for _, t in segments) != max_bits + 1 or sum(b for b, _ in segments) != 64:
        raise ValueError("segments must cover 64 bits and their tolerances must sum to max_bits + 1 - segments")
    # A fingerprint is 8 bytes, but becomes 46 rows: dealt out over all tasks first. By a hash of its own, as a
    # repartition by the column that the fingerprints were grouped by is optimised away.
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    entries = fps.select("fp", F.explode(_keys(F.col("fp"), segments)).alias("e")).select("fp", "e.key", "e.table")
    # Fewer than one for every bucket_rows of the entries: broadcast when that is small, else joined by a shuffle.
    crowded = stored(crowded_keys(fps, segments, bucket_rows), "crowded-keys")
    crowded = crowded.hint("broadcast") if crowded.count() <= BROADCAST_IDS else crowded
    entries = entries.join(crowded, "key", "left")
    blocks = F.coalesce("blocks", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    # Block pairs (a, b): table rows of block a against all rows of block b. A row of block x is a table row in
    # (x, *) and a probing row in (*, x).
    every = F.sequence(F.lit(0), blocks - 1)
    as_table = F.transform(every, lambda b: F.struct((own * blocks + b).alias("block"), F.lit(True).alias("t")))
    as_probe = F.transform(every, lambda a: F.struct((a * blocks + own).alias("block"), F.lit(False).alias("t")))
    placed = F.when(blocks == 1, F.array(F.struct(F.lit(0).alias("block"), F.col("table").alias("t")))).when(
        F.col("table"), F.concat(as_table, F.filter(as_probe, lambda e: e["block"] != own * blocks + own))).otherwise(as_probe)
    entries = (entries.select("key", "fp", F.explode(placed).alias("p"))
               .select("key", "p.block", "fp", F.col("p.t").alias("table")))
    dealt = entries.repartition("key", "block").sortWithinPartitions("key", "block", F.desc("table"))
    return dealt.mapInPandas(_linker(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, segments=SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable)."""
    rows = stored(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(distinct.select("fp"), max_bits, segments, bucket_rows))
    # Fingerprints with links are few; only their classes need a second look for the smallest id.
    linked = roots.join(distinct, roots["node"] == distinct["fp"]).select("node", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component"))
    classes = linked.join(least, "root").select(F.col("node").alias("fp"), "component")
    # Stored, so that the last join stands alone on its shuffles and a fingerprint with very many copies can be split.
    own = stored(distinct.join(classes, "fp", "left").select("fp", F.coalesce("component", "first_id").alias("component_id")),
                 "fingerprint-classes")
    return rows.join(own, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that name their component, with all their columns."""
    found = near_duplicates(docs, **options)
    drop = found.where("doc_id <> component_id").select("doc_id").distinct()
    return without_ids(docs, drop, options.get("id_col", "doc_id"))
