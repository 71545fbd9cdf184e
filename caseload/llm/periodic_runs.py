"""Periodic runs of words: stretches in which the same words come round again and again.

A run is a stretch of consecutive words with smallest period q that holds at least ``min_exponent`` periods and
``min_length`` words and that no neighbouring word extends keeping period q. Runs are found by enumerating maximal pairs:

* The suffixes of all documents of a batch are grouped by their first 1, 2, 4, ... words (prefix doubling; a suffix
  that has become unique is finished), which gives a suffix array and, by the stored ranks, the LCP of its neighbours.
* The LCP intervals are visited bottom-up. A node holds its positions in order, each with its class, the word to its
  left. When a child joins, pairs of positions from both sides with different left words are maximal pairs: equal for
  lcp words, and not for one more word on either side. The smaller side looks into the larger one.
* A maximal pair (i, j) of l words at distance d = j - i with l >= (min_exponent - 1) * d and l + d >= min_length *is* the
  run [i, j + l): nothing is extended. The distances of one stretch are the multiples of its smallest period (the
  stretch is longer than any two of them together), so the smallest distance met is q.

Only positions up to l / (min_exponent - 1) apart matter. As that is at most half of l, the occurrences of the l words in
such a window lie a fixed step apart, and all but the first follow the same word. So a window holds at most one
position of another class to the left, and to the right all or none: whole classes are skipped without a look. A run with k periods
gives at most k pairs, so the work is n log n and a document that repeats one word costs no more than others.

Words are split at the ASCII white space. Null and empty texts have no words and no runs; a row stays a row
whatever its doc_id is (null or repeated). Texts are never cut; memory is a few integers a word and doubling round for a slice of
documents (1 MB of text, or one longer document). An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.tokens import slices
from caseload.llm.worker import map_batches

#: Words and periods that a stretch must hold to be a run.
MIN_LENGTH = 6
MIN_EXPONENT = 4

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def least_pair(min_length: int, min_exponent: int) -> int:
    """Words of the shortest maximal pair that can be a run."""
    return min(max((min_exponent - 1) * d, min_length - d) for d in range(1, min_length + 1))


def suffix_array(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes of documents in order, and for h = 1, 2, 4, ... each suffix's rank by its first h words.

    ``words``: word numbers of all documents, one document after another; ``doc``: each word's document; ``end``: where that document ends.
    Ranks of suffixes of different documents differ, and so do those of suffixes that end within h words.
    """
    n = len(words)
    key = doc.astype(np.int64) * (int(words.max()) + 1) + words
    places = np.argsort(key)
    held = np.arange(n)
    block = np.zeros(n, np.int64)  # where the group in which a suffix was so far begins
    rank = np.empty(n, np.int64)
    order = np.empty(n, np.int64)
    active, key = places, key[places]
    ranks: list[np.ndarray] = []
    h = 1
    while len(active):
        # Suffixes of one group so far stand together; within it the key orders them.
        begins = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        at = block + held - np.repeat(begins, np.diff(np.r_[begins, len(block)]))
        fresh = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[fresh, len(key)])
        rank[active] = np.repeat(at[fresh], sizes)
        order[at] = active
        ranks.append(rank.astype(np.int32 if n < 2**31 else np.int64))
        active = active[np.repeat(sizes > 1, sizes)]
        after = active + h
        following = np.where(after < end[active], rank[np.minimum(after, n - 1)], -1)
        key = rank[active] * (n + 1) + following + 1
        places = np.argsort(key)
        active, key = active[places], key[places]
        block, held = rank[active], np.arange(len(active))
        h *= 2
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], end: np.ndarray, least: int) -> np.ndarray:
    """Words that each suffix of ``order`` shares with the one before it; 0 where that is less than ``least``."""
    n = len(order)
    level = min(least.bit_length() - 1, len(ranks) - 1)
    first = ranks[level][order]
    at = np.flatnonzero(first[1:] == first[:-1]) + 1
    a, b = order[at - 1], order[at]
    shared = np.zeros(len(at), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < end[a]) & (y < end[b])
        same = inside & (ranks[k][np.minimum(x, n - 1)] == ranks[k][np.minimum(y, n - 1)])
        shared += same << k
    out = np.zeros(n, np.int64)
    out[at] = np.where(shared >= least, shared, 0)
    return out


class _Runs:
    """Runs met so far: (start, end) and the smallest distance of their maximal pairs."""

    def __init__(self, left: np.ndarray, min_length: int, min_exponent: int):
        self.left = left
        self.min_length, self.parts = min_length, min_exponent - 1
        self.found: dict[tuple[int, int], int] = {}

    def _pair(self, i: int, j: int, shared: int) -> None:
        if shared + j - i >= self.min_length:
            run = (i, j + shared)
            self.found[run] = min(self.found.get(run, j - i), j - i)

    def join(self, one: list[int], other: list[int], shared: int) -> list[int]:
        """The positions of two children of an interval of ``shared`` words; their maximal pairs are kept."""
        large, small = (one, other) if len(one) >= len(other) else (other, one)
        left, window, many = self.left, shared // self.parts, len(large)
        for i in small:
            own = left[i]
            k = bisect_left(large, i - window)
            if k < many and large[k] < i and left[large[k]] != own:
                self._pair(large[k], i, shared)
            k = bisect_right(large, i, k)
            while k < many and large[k] <= i + window and left[large[k]] != own:
                self._pair(i, large[k], shared)
                k += 1
        if len(small) < 8:
            for i in small:
                insort(large, i)
        else:
            large.extend(small)
            large.sort()
        return large

    def visit(self, suffixes: list[int], prefixes: list[int]) -> None:
        """All intervals over neighbouring suffixes, bottom-up; ``prefixes[k]`` is shared by suffixes k - 1 and k, and > 0 for k > 0."""
        open_: list[tuple[int, list[int]]] = []
        child = [suffixes[0]]
        for suffix, shared in zip(suffixes[1:], prefixes[1:]):
            while open_ and open_[-1][0] >= shared:
                words, node = open_.pop()
                child = self.join(node, child, words)
                if words == shared:
                    break
            open_.append((shared, child))
            child = [suffix]
        while open_:
            words, node = open_.pop()
            child = self.join(node, child, words)


def find_runs(words: np.ndarray, lengths: np.ndarray, min_length: int = MIN_LENGTH,
              min_exponent: int = MIN_EXPONENT) -> np.ndarray:
    """(start, end, period) of all runs, by start, then period; ``words`` holds the word numbers of documents of the given
    lengths, one after another, and places count from the first document's first word."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more: pairs must share twice their distance")
    if not len(words):
        return np.zeros((0, 3), np.int64)
    stops = np.cumsum(lengths)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    end = stops[doc]
    order, ranks = suffix_array(words, doc, end)
    shared = common_prefixes(order, ranks, end, least_pair(min_length, min_exponent))
    left = np.r_[-1, words[:-1]]
    left[(stops - lengths)[lengths > 0]] = -1  # a document's first word follows none
    runs = _Runs(left, min_length, min_exponent)
    inside = shared > 0
    first = np.flatnonzero(inside & ~np.r_[False, inside[:-1]]) - 1
    last = np.flatnonzero(inside & ~np.r_[inside[1:], False]) + 1
    runs.left = left.tolist() if len(first) else left
    for a, b in zip(first.tolist(), last.tolist()):
        runs.visit(order[a:b].tolist(), shared[a:b].tolist())
    found = sorted((s, q, e) for (s, e), q in runs.found.items())
    return np.array([(s, e, q) for s, q, e in found], np.int64).reshape(-1, 3)


def _of_batch(batch: pa.RecordBatch, min_length: int, min_exponent: int) -> pa.RecordBatch:
    rows = len(batch)
    split = pc.ascii_split_whitespace(pc.fill_null(batch.column("text"), ""))
    values = split.flatten()
    real = pc.greater(pc.binary_length(values), 0)  # white space at either end of a text splits off an empty string
    doc = np.asarray(pc.list_parent_indices(split))[np.asarray(real)]
    values = values.filter(real)
    lengths = np.bincount(doc, minlength=rows)
    begin = np.cumsum(lengths) - lengths
    runs = find_runs(np.asarray(values.dictionary_encode().indices).astype(np.int64), lengths, min_length, min_exponent)
    # Steps that sum to the number of runs in which a word comes after the first period.
    steps = np.zeros(len(values) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    stays = np.cumsum(steps[:-1]) == 0
    held = np.bincount(doc[stays], minlength=rows)
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(held)], pa.int32()),
                                                        values.filter(pa.array(stays)).cast(pa.string())), " ")
    of = doc[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    listed = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begin[of]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])],
                                        ["start", "length", "period"])
    offsets = pa.array(np.r_[0, np.cumsum(np.bincount(of, minlength=rows))], pa.int32())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.ListArray.from_arrays(offsets, listed).cast(_RUNS), collapsed],
        ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """One row per input row: doc_id, n_words, runs (word number of the start, words, period; by start, then period) and
    collapsed, the text's words without those that any run contains after its first period, joined by one space."""
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _of_batch(part, min_length, min_exponent)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, runs {RUNS}, collapsed string")
