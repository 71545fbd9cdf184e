"""Masked pseudo-likelihood of texts under a small bidirectional window network.

Tokens are words, and every word of the corpus has a probability of its own. It is a product: the network predicts the class of
each token from the classes of the ``SIDE`` tokens on either side of it (the token itself is masked): one embedding per class
and place, summed, a tanh layer, and a softmax over all classes; within its class a word has its share of the class's tokens. The
most frequent words are classes by themselves, the others share classes by hash. A text's score is the sum of the log-probabilities
of all its tokens.

The words of all documents are counted into a stored table, which grows with the corpus. Texts are read once more and stored as
classes. On the way the shares of the ``KNOWN`` most frequent words are added up from a table of bounded size; each occurrence of
any other word is kept beside the classes and meets its count in a join by word, so no word is dropped or merged.

Training runs where the data is. In each of ``ROUNDS`` rounds, every task trains
a copy of the network by mini-batch gradient descent on every ``STRIDE``-th token of its share of all documents, each round on the
next phase of the stride, so that STRIDE rounds learn from every token once, and the copies are averaged, weighted by their tokens,
in two levels of tasks. The network that goes back is of fixed size.

Null and empty texts have no tokens: log-likelihood 0 and no mean. A corpus without words leaves the untrained network. Rows
that repeat a doc_id get one result row each. An empty table gives no rows. Other columns of the input are ignored. Scores depend
on how the stored classes are partitioned, as the training order does; the same partitions give the same scores.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.storage import stored
from caseload.llm.tokens import slices
from caseload.llm.worker import kept, map_batches

#: Classes: 0 stands before and after a text, then FREQUENT words, then BUCKETS shared by the rest.
FREQUENT = 63
BUCKETS = 64
IDS = 1 + FREQUENT + BUCKETS
SIDE = 2
WIDTH = 24
ROUNDS = 2
STRIDE = 2
#: Words whose shares every task holds (some 10 MB); occurrences of others are joined with the counts.
KNOWN = 65_536
BATCH = 512
RATE = 0.4
#: Tokens scored at once, and distinct words counted before they are handed on.
CHUNK = 1024
COUNTED = 200_000

_PLACES = [k for k in range(-SIDE, SIDE + 1) if k]
_ONE_HOT = np.eye(IDS, dtype=np.float32)


def words(text: str | None) -> list[str]:
    """Runs of characters other than white space, lower-cased."""
    return (text or "").lower().split()


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column("text"):
            counts.update(words(text.as_py()))
            if len(counts) > COUNTED:
                yield out(counts)
                counts = Counter()
    yield out(counts)


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word, n: how often each word occurs in all documents, stored."""
    counts = map_batches(docs.select(F.col(text_col).alias("text")), _count, "word string, n long")
    return stored(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def _bucket(word: Column) -> Column:
    """The shared class of a word, from 0."""
    return (F.crc32(word.cast("binary")) % BUCKETS).cast("int")


@dataclass(frozen=True)
class Vocabulary:
    """The words that are classes by themselves; tokens of the other words by shared class; log-shares of frequent words."""

    frequent: list[str]
    totals: list[int]
    shares: dict[str, float]

    @classmethod
    def of(cls, counts: DataFrame, frequent: int = FREQUENT, known: int = KNOWN) -> Vocabulary:
        """From word counts; ties among the ``frequent`` ones are broken alphabetically. Known are the words of the highest
        eighths of a power of two that hold at most ``known`` words together."""
        top = [(r["word"], r["n"]) for r in counts.orderBy(F.desc("n"), "word").limit(frequent).collect()]
        own = [w for w, _ in top]
        height = F.floor(F.log2("n") * 8)
        heights = sorted(((r["h"], r["count"]) for r in counts.groupBy(height.alias("h")).count().collect()), reverse=True)
        inside = [h for (h, _), held in zip(heights, np.cumsum([k for _, k in heights])) if held <= known]
        common = {r["word"]: r["n"] for r in counts.where(height >= inside[-1]).collect()} if inside else {}
        totals = [0] * BUCKETS
        for r in counts.groupBy(_bucket(F.col("word")).alias("b")).agg(F.sum("n").alias("n")).collect():
            totals[r["b"]] = r["n"]
        for word, n in top:
            totals[_crc(word)] -= n
            common.pop(word, None)
        shares = {w: math.log(n / totals[_crc(w)]) for w, n in common.items()} | dict.fromkeys(own, 0.0)
        return cls(own, totals, shares)

    def log_share(self, word: Column, n: Column) -> Column:
        """Log of the part of its shared class's tokens that are the word (a class may hold no word but frequent ones)."""
        return F.log(F.try_divide(n, F.get(F.array(*(F.lit(t) for t in self.totals)), _bucket(word))))


def _crc(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS


class Ids(dict):
    """Word -> class; words without a class of their own get a shared one."""

    def __init__(self, frequent: list[str]):
        super().__init__((w, k + 1) for k, w in enumerate(frequent))
        self.fixed = len(frequent)

    def __missing__(self, word: str) -> int:
        found = 1 + FREQUENT + _crc(word)
        if len(self) < COUNTED:
            self[word] = found
        return found

    def of(self, found: list[str]) -> np.ndarray:
        """Ids of words, with SIDE boundary ids on either side."""
        out = np.zeros(len(found) + 2 * SIDE, np.int16)
        out[SIDE:SIDE + len(found)] = list(map(self.__getitem__, found))
        return out


class _Codes(dict):
    """Known word -> number from 0; any other word -> -1 - its shared class."""

    def __missing__(self, word: str) -> int:
        return -1 - _crc(word)


def _encoder(vocabulary: Vocabulary):
    """Turns rows (doc_id, text) into key, doc_id, n_tokens, ids, the summed log-shares of known words, and the other words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = TaskContext.get().partitionId() << 33, Ids(vocabulary.frequent)
        codes = _Codes((w, k) for k, w in enumerate(vocabulary.shares))
        classes = np.array([own[w] for w in codes] or [0], np.int16)
        shares = np.array(list(vocabulary.shares.values()) or [0.0])
        for batch in (part for whole in batches for part in slices(whole)):
            sizes, ids, sums, rest = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = words(text)
                code = np.fromiter(map(codes.__getitem__, found), np.int32, len(found))
                known = code >= 0
                out = np.zeros(len(found) + 2 * SIDE, np.int16)
                out[SIDE:SIDE + len(found)] = np.where(known, classes.take(np.maximum(code, 0)), FREQUENT - code)
                sizes.append(len(found))
                ids.append(out.tobytes())
                sums.append(float(shares.take(code[known]).sum()))
                rest.append([found[k] for k in np.flatnonzero(~known).tolist()])
            keys = pa.array(np.arange(key, key + len(sizes)))
            key += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), pa.array(sums, pa.float64()),
                 pa.array(rest, pa.list_(pa.string()))], ["key", "doc_id", "n_tokens", "ids", "known", "rest"])

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored classes of all texts: key (a row's own), doc_id, n_tokens, ids, known, rest."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"key long, doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids binary, known double, rest array<string>"
    return stored(map_batches(rows, _encoder(vocabulary), schema), "classes")


def rest_shares(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """key, rest_sum: the summed log-shares of a row's words that are not among the known ones."""
    shares = counts.select("word", vocabulary.log_share(F.col("word"), F.col("n")).alias("share"))
    found = encoded.select("key", F.explode("rest").alias("word")).join(shares, "word")
    return found.groupBy("key").agg(F.sum("share").alias("rest_sum"))


class Network:
    """Parameters: embeddings (places x ids x width), hidden bias, output weights (width x ids), output bias."""

    def __init__(self, parameters: list[np.ndarray]):
        self.parameters = parameters

    @classmethod
    def new(cls) -> Network:
        rng = np.random.default_rng(0)
        scale = np.float32(0.1)
        return cls([rng.standard_normal((len(_PLACES), IDS, WIDTH), np.float32) * scale, np.zeros(WIDTH, np.float32),
                    rng.standard_normal((WIDTH, IDS), np.float32) * scale, np.zeros(IDS, np.float32)])

    @classmethod
    def load(cls, raw: bytes) -> Network:
        shapes = [p.shape for p in cls.new().parameters]
        flat, at, parameters = np.frombuffer(raw, "<f4"), 0, []
        for shape in shapes:
            size = int(np.prod(shape))
            parameters.append(flat[at:at + size].reshape(shape).copy())
            at += size
        return cls(parameters)

    def dump(self) -> bytes:
        return np.concatenate([p.ravel() for p in self.parameters]).astype("<f4").tobytes()

    def logits(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and logits (rows x ids) at the given places of ``ids``."""
        embed, bias, weights, out_bias = self.parameters
        hidden = np.broadcast_to(bias, (len(at), WIDTH)).copy()
        for table, place in zip(embed, _PLACES):
            hidden += table.take(ids.take(at + place), axis=0)
        np.tanh(hidden, out=hidden)
        logits = hidden @ weights
        logits += out_bias
        np.minimum(logits, np.float32(60), out=logits)  # far beyond what training reaches; keeps exp finite
        return hidden, logits

    def log_likelihood(self, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Log-probability of the id at each given place, from its neighbours."""
        out = np.empty(len(at))
        for k in range(0, len(at), CHUNK):
            part = at[k:k + CHUNK]
            _, logits = self.logits(ids, part)
            own = logits[np.arange(len(part)), ids[part]]
            np.exp(logits, out=logits)
            out[k:k + CHUNK] = own - np.log(logits.sum(axis=1))
        return out

    def learn(self, ids: np.ndarray, at: np.ndarray) -> None:
        """One step of gradient descent on the given places."""
        embed, bias, weights, out_bias = self.parameters
        hidden, error = self.logits(ids, at)
        np.exp(error, out=error)
        step = np.float32(RATE / len(at))
        error *= step / error.sum(axis=1, keepdims=True)
        error[np.arange(len(at)), ids[at]] -= step
        back = (error @ weights.T) * (1 - hidden * hidden)
        weights -= hidden.T @ error
        out_bias -= error.sum(axis=0)
        bias -= back.sum(axis=0)
        # A step per token, not per batch, for the embeddings: each is touched by few tokens of a batch.
        back *= np.float32(8)
        for table, place in zip(embed, _PLACES):
            table -= _ONE_HOT.take(ids.take(at + place), axis=0).T @ back


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of several texts one after the other, the places of their tokens, and each text's number of tokens."""
    sizes = np.array([len(p) - 2 * SIDE for p in parts])
    ids = np.concatenate(parts)
    inner = np.ones(len(ids), bool)
    ends = np.cumsum(sizes + 2 * SIDE)
    for k in range(SIDE):
        inner[ends - 1 - k] = False
        inner[ends - sizes - 2 * SIDE + k] = False
    return ids, np.flatnonzero(inner), sizes


def _trainer(raw: bytes, stride: int, phase: int = 0):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen, passed = Network.load(raw), 0, 0
        held, rest = [np.zeros(2 * SIDE, np.int16)], 0
        for batch in batches:
            for own in batch.column("ids"):
                part = np.frombuffer(own.as_py(), np.int16)
                if len(part) > 2 * SIDE:
                    held.append(part)
                    rest += len(part)
                if rest >= BATCH * stride:
                    ids, at, _ = _joined(held)
                    at, passed = at[(phase - passed) % stride::stride], passed + len(at)
                    for k in range(0, len(at), BATCH):
                        network.learn(ids, at[k:k + BATCH])
                    seen += len(at)
                    held, rest = [], 0
        if rest:
            ids, at, _ = _joined(held)
            at = at[(phase - passed) % stride::stride]
            for k in range(0, len(at), BATCH):
                network.learn(ids, at[k:k + BATCH])
            seen += len(at)
        yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([network.dump()], pa.binary())], ["n", "raw"])

    return run


def _averager(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, sums = 0, None
    for batch in batches:
        for n, raw in zip(batch.column("n").to_pylist(), batch.column("raw").to_pylist()):
            if n:
                part = np.frombuffer(raw, "<f4").astype(np.float64) * n
                total, sums = total + n, part if sums is None else sums + part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([(sums / total).astype("<f4").tobytes()], pa.binary())],
                                         ["n", "raw"])


def train(encoded: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> bytes:
    """The parameters of a network trained on stored classes."""
    raw = Network.new().dump()
    for k in range(rounds):
        copies = map_batches(encoded.select("ids"), _trainer(raw, stride, k % stride), "n long, raw binary")
        # Two levels, so that no task adds up the copies of all others.
        some = copies.repartition(F.pmod(F.xxhash64("raw"), F.lit(64))).mapInArrow(_averager, "n long, raw binary")
        whole = some.repartition(1).mapInArrow(_averager, "n long, raw binary").first()
        raw = bytes(whole["raw"]) if whole else raw
    return raw


def class_likelihoods(ids: list[np.ndarray], raw: bytes) -> list[float]:
    """Summed log-probability of the classes of each text."""
    if not ids:
        return []
    network = kept(("network", raw), lambda: Network.load(raw))
    joined, at, sizes = _joined(ids)
    sums = np.add.reduceat(np.r_[network.log_likelihood(joined, at), 0.0], np.r_[0, np.cumsum(sizes)[:-1]])
    return np.where(sizes > 0, sums, 0.0).tolist()


def _scorer(raw: bytes):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = class_likelihoods([np.frombuffer(x.as_py(), np.int16) for x in batch.column("ids")], raw)
            columns = [batch.column(c) for c in ("key", "doc_id", "n_tokens", "known")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sums, pa.float64())], ["key", "doc_id", "n_tokens", "known", "classes"])

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                    stride: int = STRIDE, known: int = KNOWN) -> DataFrame:
    """One row per input row: doc_id, n_tokens, log_likelihood, mean_log_likelihood (null without tokens)."""
    counts = word_counts(docs, text_col)
    vocabulary = Vocabulary.of(counts, known=known)
    encoded = encode(docs, vocabulary, id_col, text_col)
    raw = train(encoded, rounds, stride)
    kind = dict(encoded.dtypes)["doc_id"]
    scored = map_batches(encoded.drop("rest"), _scorer(raw), f"key long, doc_id {kind}, n_tokens long, known double, classes double")
    scored = scored.join(rest_shares(encoded, counts, vocabulary), "key", "left")
    total = F.col("classes") + F.col("known") + F.coalesce("rest_sum", F.lit(0.0))
    return scored.select("doc_id", "n_tokens", total.alias("log_likelihood"),
                         F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))
