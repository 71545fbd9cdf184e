from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from caseload.llm import line_dedup as ld

from .conftest import frame

SF = "/root/testdata/sf0.001"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
    return row[-1]


def changed(line, k, rng):
    out = list(line)
    for _ in range(k):
        at = rng.randrange(len(out))
        rng.choice([lambda: out.insert(at, "x"), lambda: out.pop(at), lambda: out.__setitem__(at, "é")])()
    return "".join(out)


def sample_lines(seed, n, bases=12):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcde é") for _ in range(rng.randint(20, 50))) for _ in range(bases)]
    return [changed(rng.choice(base), rng.randint(0, 4), rng) for _ in range(n)]


@pytest.mark.parametrize("max_edits", [1, 2, 3])
def test_pairs_match_all_pairs(spark, max_edits):
    lines = sorted({x for x in sample_lines(3, 150) if x.strip()})
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {tuple(sorted((r.a, r.b))) for r in ld.near_pairs(df, max_edits, 20).collect()}
    expected = {(j, i) for i, a in enumerate(lines) for j, b in enumerate(lines[:i]) if len(a) >= 20 and len(b) >= 20 and edits(a, b) <= max_edits}
    assert got == expected and len(got) > 10


def plain_report(docs, max_edits=2, min_chars=20):
    first = {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        for place, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                first.setdefault(line, (doc, place))
    near = {a for a in first for b in first if first[b] < first[a] and min(len(a), len(b)) >= min_chars
            and abs(len(a) - len(b)) <= max_edits and edits(a, b) <= max_edits}
    out = {}
    for doc, text in docs:
        lines = [(p, x) for p, x in enumerate((text or "").split("\n")) if x.strip(" ")]
        drop = [p for p, x in lines if x in near or first[x] != (doc, p)]
        out[doc] = (len(lines), len(drop), sum(first[x] == (doc, p) for p, x in lines if x in near), drop)
    return out


def test_report_matches_plain_version(spark):
    rng = random.Random(8)
    lines = sample_lines(5, 120) + ["short", "shorx", "", " ", "Same long line in very many documents of the corpus"]
    docs = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(40)] + [(40, None), (41, "")]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.n_near, r.dropped_places) for r in ld.line_report(frame(spark, docs)).collect()}
    assert got == plain_report(docs)


def test_drop_repeated_lines(spark):
    line = "A line that is long enough to be near another one"
    docs = frame(spark, [(1, f"{line}\nkeep\n\nkeep"), (2, f"own\n{line.replace('near', 'neer')}\n"), (3, None)])
    out = ld.drop_repeated_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: f"{line}\nkeep\n", 2: "own\n", 3: None}


def test_rows_that_share_an_id_lose_only_their_own_repeats(spark):
    line = "A line that is long enough to be near another one"
    docs = frame(spark, [(None, "first of all\nown"), (None, f"{line}\nown two"), (3, f"three\n{line}"), (3, f"{line}s\nthree"), (3, "other\nmore")])
    out = sorted((r.doc_id or 0, r.text) for r in ld.drop_repeated_lines(docs).collect())
    # `three` first comes at place 0 of document 3, so that at place 1 goes; near lines of document 3 come after the row without id.
    assert out == sorted([(0, "first of all\nown"), (0, f"{line}\nown two"), (3, "three"), (3, ""), (3, "other\nmore")])


def test_line_edges(edge_docs, empty_docs):
    got = ld.line_report(edge_docs).collect()
    assert len(got) == 17  # ids 0 to 15 and the rows without an id together
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].n_dropped == 0  # rows without an id come first
    assert by_id[9].n_lines == 2 and by_id[9].n_dropped == 2 and by_id[10].n_dropped == 1
    assert by_id[7].n_lines == 1 and by_id[7].n_dropped == 0
    assert ld.line_report(empty_docs).count() == 0


def test_lines_plan_is_native(spark, capsys):
    ld.dropped_lines(spark.read.parquet(f"{SF}/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_short_segments_are_refused(spark):
    with pytest.raises(ValueError):
        ld.near_pairs(spark.createDataFrame([], "id long, line string"), 3, 4)


def allowed(length):
    return max(2, min(length // ld.EDIT_CHARS, ld.MOST_EDITS))


def test_long_lines_match_all_pairs(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abcde é") for _ in range(n)) for n in (117, 119, 121, 160, 230, 342, 520)]
    base += ["ab" * 150, "".join(rng.choice("😀😁x") for _ in range(200)), "".join(rng.choice("abcd") for _ in range(250))]
    lines = sorted({changed(b, rng.randint(0, len(b) // 30), rng) for b in base for _ in range(7)})
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {tuple(sorted((r.a, r.b))) for r in ld.near_pairs(df).collect()}
    expected = {(j, i) for i, a in enumerate(lines) for j, b in enumerate(lines[:i])
                if abs(len(a) - len(b)) <= 45 and edits(a, b) <= allowed(max(len(a), len(b)))}
    assert got == expected and len(got) > 50 and any(edits(lines[i], lines[j]) > 5 for i, j in got)


def test_earlier_line_may_be_below_the_least_length(spark):
    docs = frame(spark, [(1, "nineteen characters"), (2, "nineteen characters!"), (3, "nineteen characterz")])
    got = {r.doc_id: r.dropped_places for r in ld.line_report(docs).collect()}
    assert got == {1: [], 2: [0], 3: []}


def test_report_names_classes_and_links(spark):
    line = "A line that is long enough to be near another one"
    docs = frame(spark, [(1, f"own\n{line}"), (2, line.replace("near", "neer")), (3, line.replace("near", "naer")), (4, line), (5, "x")])
    got = {r.doc_id: [tuple(x) for x in r.linked_lines] for r in ld.line_report(docs).collect()}
    assert got == {1: [(1, "1:1", 2)], 2: [(0, "1:1", 2)], 3: [(0, "1:1", 2)], 4: [(0, "1:1", 2)], 5: []}


def test_common_opening_or_passage_at_other_places_makes_no_candidates(spark):
    rng = random.Random(6)
    passage = "a passage that very many long lines have in common"
    lines = []
    for k in range(60):
        own = "".join(rng.choice("abcde é") for _ in range(400))
        lines.append(f"{own[:20 + 6 * k]} {passage} {own[20 + 6 * k:]}")
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    # All pairs met before: the passage's keys did not tell at which place it stands.
    assert ld._long_candidates(df, 2).distinct().count() < 60 * 59 / 2 / 2
    assert ld.near_pairs(df).count() == 0


def random_lines(seed, n, size):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh  ") for _ in range(size)) for _ in range(n)]


def test_keys_of_long_lines_are_not_kept_on_disk(spark, tmp_path, monkeypatch):
    texts = random_lines(9, 1500, 360)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    monkeypatch.setattr(ld.storage, "shared_folder", lambda spark, name: f"{tmp_path}/{name}-{random.random()}")
    kept, store = [], ld.storage.stored

    def measured(*args):
        out = store(*args)
        kept.append(sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file()))
        return out

    monkeypatch.setattr(ld.storage, "stored", measured)
    assert ld.near_pairs(df).count() == 0
    # Before, the keys of all segments lay there while they were joined, and took more than the lines themselves.
    assert max(kept) < sum(map(len, texts)) / 4


def test_candidates_verified_in_parts_are_the_same(spark, tmp_path, monkeypatch):
    rng = random.Random(10)
    lines = sorted({changed(b, rng.randint(0, 4), rng) for b in random_lines(10, 12, 200) for _ in range(8)})
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    whole = {(r.a, r.b) for r in ld.near_pairs(df).collect()}
    monkeypatch.setattr(ld, "PAIR_CHARS", 1)
    names, store = [], ld.storage.stored
    monkeypatch.setattr(ld.storage, "stored", lambda df, name, path=None: names.append(name) or store(df, name, path))
    assert {(r.a, r.b) for r in ld.near_pairs(df).collect()} == whole and len(whole) > 100
    assert names.count("near-pairs") > 1


def test_long_lines_with_edits_gathered_at_class_borders(spark):
    rng = random.Random(11)
    lines, group = [], []
    for k, size in enumerate((117, 119, 120, 159, 160, 199, 201, 399, 400, 1599, 1600, 1641)):
        base = "".join(rng.choice("aaeéè 😀\t  日本") for _ in range(size))
        for at in (0, size // 3, size - 41):
            edit = base[at:at + 40]
            for piece in (edit[min(2, size // 40):], edit[:20] + "x" * allowed(size) + edit[20:]):
                lines.append(base[:at] + piece + base[at + 40:])
                group.append(k)
        lines.append(base)
        group.append(k)
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {tuple(sorted((r.a, r.b))) for r in ld.near_pairs(df).collect()}
    # The base and what it became are near; two of those may not be.
    expected = {(j, i) for i, g in enumerate(group) for j in range(i) if group[j] == g and (i + 1 == len(group) or group[i + 1] != g)
                and edits(lines[j], lines[i]) <= allowed(max(len(lines[j]), len(lines[i])))}
    assert len(expected) > 50 and expected <= got


def test_differing_parts_keep_characters_whole(spark):
    pairs = [("aéb", "aèb"), ("é", "è"), ("x😀", "x😁"), ("日本", "日木"), ("abc", "abcabc"), ("ééé", "éééé"), ("ĀĀ", "Āā"), ("", "é"), ("aXbYc", "aZbVc")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(ld._differing(F.col("a"), F.col("b"), lambda a, b: F.concat_ws("|", a, b)).alias("x")).collect()
    assert [r.x for r in got] == ["é|è", "é|è", "😀|😁", "本|木", "|abc", "|é", "Ā|ā", "|é", "XbY|ZbV"]
