"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of every training token: a row holds a term, a segment and the ascending places of the
term there. A segment is a run of consecutive documents of one input partition (at most ``SEGMENT_WORDS`` words, one document
at least), so a term that occurs everywhere has as many rows as there are segments, each of bounded length, and building
shuffles nothing. Places count the words of a segment one document after the other with a gap between them that no phrase can
bridge; one more row per segment lists its documents.

A query phrase is a window of ``window`` consecutive words of a benchmark item (a shorter item is one phrase). Phrases are
rows too: joined with the corpus frequencies of their terms they are ordered from the rarest term, and the rarest term's
postings say in which segments a phrase can occur at all. A segment's lists and the phrases that may occur there then meet in
one group: the rarest term's places, shifted to the phrase's start, are intersected with the other lists from the rarest on.
Phrases beyond ``BLOCK_PHRASES`` are dealt out in blocks, each its own group. No part of the benchmark goes through the
driver, and the plan is the same for any size of either table.

Proximity matches are those places of the rarest term where every other term stands within ``slop`` words of where the phrase
would put it; they come from the same pass and are told apart from exact ones by distance.

Words: A-Z are lower-cased and maximal runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] taken. Null and empty texts have
no words; items without words have no phrase. Items that repeat (also under one item_id) are each searched, equal ids
count once; a null item_id is named as the empty string. Rows that repeat a doc_id get one result row each. Empty
documents give no rows, an empty benchmark gives clean documents. Other columns of the inputs are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.storage import stored, without_ids
from caseload.llm.tokens import slices
from caseload.llm.worker import map_batches

WINDOW = 10
SLOP = 3
#: Words and documents of a segment: bound a list, and what a task holds while it builds or searches one (some 20 bytes a word).
SEGMENT_WORDS = 2_000_000
SEGMENT_DOCS = 200_000
#: Phrases that meet a segment's lists in one group.
BLOCK_PHRASES = 500_000
#: Terms of an Arrow batch of postings, and places tried at once in a search.
BATCH_TERMS = 20_000
TRIED = 1_000_000

_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str | None) -> list[bytes]:
    """The words of a text, as UTF-8."""
    return _WORD.findall((text or "").encode("utf-8", "replace").lower())


def word_column(text: Column) -> Column:
    """The words of a text column (none of null)."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


class _Numbers(dict):
    """Numbers given to words in the order of their first appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


class _Segment:
    """The documents of a segment while it is filled."""

    def __init__(self) -> None:
        self.numbers, self.codes, self.ids, self.sizes, self.total = _Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        found = words(text)
        self.codes.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
        self.ids.append(doc_id)
        self.sizes.append(len(found))
        self.total += len(found)

    def full(self, most_words: int) -> bool:
        return self.total >= most_words or len(self.ids) >= SEGMENT_DOCS

    def rows(self, segment: int, gap: int) -> Iterator[pa.RecordBatch]:
        """The row of the documents (no term; their numbers of words as places), then a row per term."""
        yield _postings([segment], [None], [len(self.ids)], [0, len(self.sizes)], np.array(self.sizes, np.int32), [self.ids])
        codes = np.concatenate(self.codes)
        places = (np.arange(len(codes)) + np.repeat(np.arange(1, len(self.sizes) + 1) * gap, self.sizes)).astype(np.int32)
        places = places[np.argsort(codes, kind="stable")]
        ends = np.r_[0, np.cumsum(np.bincount(codes, minlength=len(self.numbers)))]
        terms = list(self.numbers)
        for k in range(0, len(terms), BATCH_TERMS):
            part = terms[k:k + BATCH_TERMS]
            at = ends[k:k + len(part) + 1]
            yield _postings([segment] * len(part), part, np.diff(at), at - at[0], places[at[0]:at[-1]], [None] * len(part))


_INDEX = "segment long, term string, n long, places array<int>, doc_ids array<long>"


def _postings(segment, term, n, ends, places, doc_ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(segment, pa.int64()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32())), pa.array(doc_ids, pa.list_(pa.int64()))],
        ["segment", "term", "n", "places", "doc_ids"])


def _indexer(gap: int, segment_words: int):
    """Turns rows (doc_id, text) into the rows of their segments."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, _Segment()
        for batch in (part for whole in batches for part in slices(whole)):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                held.add(doc_id, text)
                if held.full(segment_words):
                    yield from held.rows(number, gap)
                    number, held = number + 1, _Segment()
        if held.ids:
            yield from held.rows(number, gap)

    return run


@dataclass(frozen=True)
class PositionalIndex:
    """A stored index: ``table`` holds segment, term, n, places, and in the row without a term doc_ids; documents of a segment
    are ``gap`` places apart."""

    table: DataFrame
    gap: int

    @property
    def postings(self) -> DataFrame:
        """term, segment, n, places."""
        return self.table.where("term IS NOT NULL").drop("doc_ids")

    @property
    def documents(self) -> DataFrame:
        """segment, row, doc_id, n_words: one row per input row."""
        listed = self.table.where("term IS NULL").select("segment", F.posexplode(F.arrays_zip("doc_ids", "places")).alias("row", "d"))
        return listed.select("segment", "row", F.col("d.doc_ids").alias("doc_id"), F.col("d.places").cast("long").alias("n_words"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = WINDOW + SLOP,
                segment_words: int = SEGMENT_WORDS) -> PositionalIndex:
    """Store the postings of every word of ``docs``; phrases of up to ``gap - slop`` words can be looked up."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return PositionalIndex(stored(map_batches(rows, _indexer(gap, segment_words), _INDEX), "positional-index"), gap)


def benchmark_phrases(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """item_id, phrase (array of words): the distinct windows of each item."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"), word_column(F.col(text_col)).alias("ws"))
    items = items.where("size(ws) > 0").withColumn("n", F.least(F.lit(window), F.size("ws")))
    windows = F.expr("transform(sequence(1, size(ws) - n + 1), i -> slice(ws, i, n))")
    return items.select("item_id", F.explode(windows).alias("phrase")).distinct()


def rarest_first(index: PositionalIndex, phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The phrases (phrase_id, phrase) whose terms all occur somewhere, with their terms' numbers from the rarest on and the
    terms' places in the phrase; and the numbers (term, term_id, frequency) of their terms."""
    used = phrases.select(F.explode("phrase").alias("term")).distinct()
    # Stored tables have a size: a small benchmark is broadcast to the postings, a large one is shuffled.
    used = stored(used, "benchmark-terms")
    counted = index.postings.select("term", "n").join(used, "term").groupBy("term").agg(F.sum("n").alias("frequency"))
    terms = stored(counted.withColumn("term_id", F.monotonically_increasing_id()), "term-frequencies")
    places = phrases.select("phrase_id", F.size("phrase").alias("size"), F.posexplode("phrase").alias("shift", "term")).join(terms, "term")
    ordered = places.groupBy("phrase_id", "size").agg(F.array_sort(F.collect_list(F.struct("frequency", "shift", "term_id"))).alias("t"))
    ordered = ordered.where("size(t) = size").select("phrase_id", "size", F.col("t.term_id").alias("terms"), F.col("t.shift").alias("shifts"))
    return stored(ordered, "ordered-phrases"), terms


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column one after the other, and where each list starts (and the last ends)."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(sizes)].astype(np.int64)


_MATCHES = pa.schema([("segment", pa.int64()), ("row", pa.int32()), ("phrase_id", pa.int64()), ("start", pa.int32()),
                      ("length", pa.int32()), ("exact", pa.bool_())])


def _searcher(gap: int, slop: int):
    """Matches of phrases (left) in the lists of one segment (right; the row of term -1 holds the documents' sizes)."""
    def run(phrases: pa.Table, lists: pa.Table) -> pa.Table:
        if not phrases.num_rows or not lists.num_rows:
            return _MATCHES.empty_table()
        lists = lists.sort_by("term_id")
        ids = lists.column("term_id").to_numpy()
        values, ends = _flat(lists.column("places"))
        sizes, ids, values, ends = values[:ends[1]], ids[1:], values[ends[1]:], ends[1:] - ends[1]
        firsts = np.r_[0, np.cumsum(sizes[:-1])] + np.arange(1, len(sizes) + 1) * gap
        # All lists as one sorted array: the term's rank in the upper half of a key, the place in the lower.
        keys = np.repeat(np.arange(len(ids), dtype=np.int64) << 32, np.diff(ends)) + values
        flat, at = _flat(phrases.column("terms"))
        shifts, _ = _flat(phrases.column("shifts"))
        rank = np.minimum(np.searchsorted(ids, flat), max(len(ids) - 1, 0))
        known = ids[rank] == flat if len(ids) else np.zeros(len(flat), bool)
        chosen = np.flatnonzero(np.logical_and.reduceat(known, at[:-1]))
        here = np.diff(ends)[rank[at[chosen]]] if len(chosen) else np.zeros(0, np.int64)
        found = []
        for part in np.split(np.arange(len(chosen)), np.searchsorted(np.cumsum(here), np.arange(TRIED, here.sum(), TRIED))):
            if len(part):
                found.append(_tried(chosen[part], here[part], at, rank, shifts, ends, values, keys, slop))
        if not found:
            return _MATCHES.empty_table()
        phrase, start, first, off = (np.concatenate(x) for x in zip(*found))
        row = np.searchsorted(firsts, first, "right") - 1
        exact = off == 0
        pair = phrase * len(sizes) + row
        kept = exact | ~np.isin(pair, pair[exact])
        phrase, row, exact, start = phrase[kept], row[kept], exact[kept], start[kept]
        return pa.Table.from_arrays(
            [pa.array(np.full(len(row), lists.column("segment")[0].as_py())), pa.array(row, pa.int32()),
             phrases.column("phrase_id").combine_chunks().take(pa.array(phrase)), pa.array(start - firsts[row], pa.int32()),
             pa.array(np.diff(at)[phrase], pa.int32()), pa.array(exact)], schema=_MATCHES)

    return run


def _tried(phrase, here, at, rank, shifts, ends, values, keys, slop):
    """The places of some phrases' rarest terms, intersected with the other lists: phrase, its start, place of the rarest
    term and summed distance of the others for those that stay."""
    rarest = rank[at[phrase]]
    which = np.repeat(phrase, here)
    first = values[np.repeat(ends[rarest], here) + np.arange(here.sum()) - np.repeat(np.cumsum(here) - here, here)].astype(np.int64)
    start = first - shifts[at[which]]
    off = np.zeros(len(which), np.int64)
    for k in range(1, int(np.diff(at)[phrase].max())):
        more = np.flatnonzero(k < (at[which + 1] - at[which]))
        term = at[which[more]] + k
        wanted = (rank[term] << 32) + start[more] + shifts[term]
        spot = np.searchsorted(keys, wanted)
        away = np.minimum(np.abs(keys[np.minimum(spot, len(keys) - 1)] - wanted), np.abs(keys[np.maximum(spot - 1, 0)] - wanted))
        off[more] += away
        stays = np.ones(len(which), bool)
        stays[more] = away <= slop
        which, first, start, off = which[stays], first[stays], start[stays], off[stays]
    return which, start, first, off


def search(index: PositionalIndex, phrases: DataFrame, slop: int | None = SLOP, block_phrases: int = BLOCK_PHRASES) -> DataFrame:
    """segment, row, phrase_id, start, length, exact: where the phrases (phrase_id, phrase; at most ``index.gap - slop``
    words) occur; without ``slop`` exact matches only."""
    ordered, terms = rarest_first(index, phrases)
    blocks = max(1, -(-ordered.count() // block_phrases))
    ordered = ordered.withColumns({"block": F.pmod(F.xxhash64("phrase_id"), F.lit(blocks)), "term_id": F.get("terms", F.lit(0))})
    numbered = index.postings.join(terms.select("term", "term_id"), "term")
    phrases_there = numbered.select("term_id", "segment").join(ordered, "term_id").select(
        F.col("segment").alias("home"), "block", "phrase_id", "terms", "shifts")
    documents = index.table.where("term IS NULL").select("segment", F.lit(-1).cast("long").alias("term_id"), "places")
    lists = numbered.select("segment", "term_id", "places").unionByName(documents)
    lists = lists.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    schema = "segment long, row int, phrase_id long, start int, length int, exact boolean"
    return phrases_there.groupBy("home", "block").cogroup(lists.groupBy("segment", "block")).applyInArrow(
        _searcher(index.gap, slop or 0), schema)


def phrase_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                   slop: int | None = SLOP, block_phrases: int = BLOCK_PHRASES, segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_words, hits (item_id, start, length), near.

    ``hits`` are the exact phrase matches by word position; ``near`` names the items with a phrase whose terms all
    occur within ``slop`` words of their places, but not exactly (None: not looked for).
    """
    index = build_index(docs, id_col, text_col, window + (slop or 0), segment_words)
    of_items = stored(benchmark_phrases(benchmark, item_col, item_text_col, window), "benchmark-phrases")
    phrases = stored(of_items.select("phrase").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    found = stored(search(index, phrases, slop, block_phrases), "phrase-matches")
    named = found.join(phrases.join(of_items, "phrase").select("phrase_id", "item_id"), "phrase_id")
    hit = F.when(F.col("exact"), F.struct("item_id", "start", "length"))
    per_row = named.groupBy("segment", "row").agg(F.array_sort(F.collect_set(hit)).alias("hits"),
                                                  F.array_sort(F.collect_set(F.when(~F.col("exact"), F.col("item_id")))).alias("near"))
    none = {"hits": F.array().cast("array<struct<item_id:string,start:int,length:int>>"), "near": F.array().cast("array<string>")}
    rows = index.documents.join(per_row, ["segment", "row"], "left")
    return rows.select("doc_id", "n_words", *(F.coalesce(F.col(c), empty).alias(c) for c, empty in none.items()))


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, items (sorted ids), n_items, n_near, contaminated."""
    found = phrase_matches(docs, benchmark, **options)
    covered = F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1)))
    items = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    found = found.select("doc_id", "n_words", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                         items.alias("items"), "near")
    return found.select("doc_id", "n_words", "n_hit", "items", F.size("items").cast("long").alias("n_items"),
                        F.size(F.array_except("near", "items")).cast("long").alias("n_near"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without an exact phrase of the benchmark, with all their columns."""
    found = contamination(docs, benchmark, slop=None, **options)
    return without_ids(docs, found.where("contaminated").select("doc_id").distinct(), options.get("id_col", "doc_id"))
