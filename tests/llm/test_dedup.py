from __future__ import annotations

import random
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from caseload.llm import exact_dedup, simhash
from caseload.llm.components import components

from .conftest import EDGE_TEXTS, frame, prose

SF = "/root/testdata/sf0.001"


def roots_of(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- exact ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("keep,choose", [("smallest", min), ("largest", max)])
def test_exact_groups(spark, keep, choose):
    texts = [random.Random(i).choice(["a", "b", "", None, "A", "a "]) for i in range(60)]
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(frame(spark, list(enumerate(texts))), keep=keep).collect()}
    for i, t in enumerate(texts):
        same = [j for j, u in enumerate(texts) if (u or "") == (t or "")]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (choose(same), len(same), i == choose(same))


def test_exact_compares_bytes_when_hashes_collide(spark):
    docs = frame(spark, [(1, "a"), (2, "b"), (3, "a"), (4, "c")])
    got = exact_dedup.exact_duplicates(docs, content_hash=lambda t: F.unhex(F.lit("00"))).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {1: (1, 2), 3: (1, 2), 2: (2, 1), 4: (4, 1)}


def test_exact_edges(edge_docs, empty_docs):
    got = exact_dedup.exact_duplicates(edge_docs, keep="largest").collect()
    assert len(got) == len(EDGE_TEXTS) + 3
    same = [r for r in got if r.group_size == 4]
    assert len(same) == 4 and {r.keep_id for r in same} == {10}  # two ids, one of them twice, and a null
    assert {r.doc_id for r in got if r.kept is False} == {0, 9, None}  # empty: ids 0, 1 and a null
    assert exact_dedup.exact_duplicates(empty_docs).count() == 0


def test_exact_keep_one(edge_docs, empty_docs):
    kept = exact_dedup.keep_one(edge_docs, keep="largest")
    assert kept.columns == edge_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert 9 not in ids and 0 not in ids and ids[10] == 1 and ids[None] == 2  # rows without an id pass
    assert exact_dedup.keep_one(empty_docs).count() == 0


def test_exact_plan_is_native(spark, capsys):
    exact_dedup.exact_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


# --- components ----------------------------------------------------------------------------------

def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(200 + i, 201 + i) for i in range(20)]
    edges += [(5, 5), (1, 2), (1, 2)] + [(300, 300 + i) for i in range(40)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    linked = {n for u, v in edges if u != v for n in (u, v)}
    expected = roots_of(edges, {n for e in edges for n in e})
    assert {(r.node, r.root) for r in got} == {(n, expected[n]) for n in linked} and len(got) == len(linked)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# --- SimHash -------------------------------------------------------------------------------------

def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    texts = [*EDGE_TEXTS, "One two\tTHREE\x0bfour five", "a b c", prose(1, 700), "ÀB c d e f"]
    for t in texts:
        assert simhash.fingerprint(t) % (1 << 64) == slow_fingerprint(t)


def test_spark_hash_is_the_same(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("one two three four")).alias("h")).first()
    assert row.h % (1 << 64) == xxhash.xxh64_intdigest(b"one two three four", 42)


def near_texts(seed, groups=12, copies=6):
    rng, out = random.Random(seed), []
    for g in range(groups):
        words = prose(seed * 100 + g, 150).split()
        for _ in range(copies):
            mine = list(words)
            for _ in range(rng.randint(0, 4)):
                mine[rng.randrange(len(mine))] = "changed"
            out.append(" ".join(mine))
    return out + [None, "", " ", "one"]


@pytest.mark.parametrize("bucket_rows", [simhash.BUCKET_ROWS, 3])
def test_near_duplicates_match_all_pairs(spark, bucket_rows):
    texts = near_texts(7)
    fps = [slow_fingerprint(t) for t in texts]
    edges = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    roots = roots_of(edges, range(len(fps)))
    got = simhash.near_duplicates(frame(spark, list(enumerate(texts))), bucket_rows=bucket_rows).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f:016x}", roots[i]) for i, f in enumerate(fps)}
    assert len(set(roots.values())) < len(fps)


def test_links_of_crowded_keys(spark):
    """Fingerprints that share a segment's value: verified pair by pair, as a forest, and in block pairs alike."""
    rng = random.Random(2)
    fps = [0b1011 << 40 ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 6))) for _ in range(300)]
    fps = sorted({f % (1 << 63) for f in fps})
    expected = roots_of([(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4], fps)
    for bucket_rows in (1000, 25):
        df = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(4)
        found = [(r.u, r.v) for r in simhash.links(df, bucket_rows=bucket_rows).distinct().collect()]
        assert all(0 < (u ^ v).bit_count() <= 4 for u, v in found)
        assert roots_of(found, fps) == expected


def test_probes_of_neighbouring_values_make_a_key_crowded(spark):
    """Keys that hold one table row each, or none, but are probed by the rows of very many values around them."""
    values = [1 << b for b in range(22)]  # each one bit from 0 in the lowest segment
    fps = sorted({v | other << 22 for v in values for other in range(1, 15)} | {3 << 43})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r.key: r.blocks for r in simhash.crowded_keys(df, bucket_rows=100).collect()}
    bits, masks = simhash.SEGMENTS, simhash._masks
    met, low = Counter(), 0
    for number, (size, tolerance) in enumerate(bits):
        for f in fps:
            for m in masks(size, tolerance):
                met[(f >> low & (1 << size) - 1) ^ m | number << 32] += 1
        low += size
    assert got[0] * 100 >= met[0] > 300  # value 0 of the first segment: probed by all, stored for one
    assert all(met[key] <= 200 for key in met if key not in got)
    assert all(blocks * 100 >= met[key] for key, blocks in got.items())
    found = [(r.u, r.v) for r in simhash.links(df, bucket_rows=100).distinct().collect()]
    expected = roots_of([(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4], fps)
    assert roots_of(found, fps) == expected


def test_links_use_all_tasks(spark):
    """AQE would put the few bytes of the fingerprints in a task or two before they become 46 rows each."""
    fps = spark.range(5000).select((F.col("id") * 7919).alias("fp")).distinct()
    dealt = simhash.links(fps)
    dealt.count()
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_segments_must_cover():
    with pytest.raises(ValueError):
        simhash.links(None, max_bits=4, segments=((32, 0), (32, 0)))


def test_simhash_edges(edge_docs, empty_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == len(EDGE_TEXTS) + 3
    zero = {r.doc_id for r in got if r.fingerprint == "0" * 16}
    assert zero == {0, 1, 2, 3, None} and {r.component_id for r in got if r.fingerprint == "0" * 16} == {0}
    assert simhash.near_duplicates(empty_docs).count() == 0
    kept = simhash.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns and {r.doc_id for r in kept.collect()} >= {0, 4, 9, None}
    assert not {r.doc_id for r in kept.collect()} & {1, 2, 3, 10}
