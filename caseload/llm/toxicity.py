"""Toxicity by a support vector machine with a subsequence string kernel and Nyström landmarks.

The kernel counts the subsequences of three letters that two strings share, each weighted by ``DECAY`` to the power of the
letters it spans in either string (at most ``SPAN``). Letters between the three cost a factor instead of the match, so an
insult with gaps or inserted letters stays close to the plain one. Case is ignored; punctuation, digits and symbols inside
a sentence are passed over (``i.d.i.o.t``); a run of white space is one symbol, as a letter is. Sentences end at line feeds
and at ``.``, ``!`` and ``?`` before white space; no subsequence crosses them.

Training reads labelled sentences: a sentence has its document's label, but of a toxic document only some sentences are toxic.
So the machine learns by windows (``WINDOW`` neighbouring starts of subsequences) and chooses them itself, as in multiple-instance
learning: of a document labelled toxic the windows above the decision are toxic (none, if its label is wrong); of the others none
is and those that score highest count. The first choice is by four-letter sequences that occur in toxic documents more often,
beyond what they do in 99 of 100 others.
Windows that differ from one another become the landmarks; the Nyström map turns a window into its kernel values against them,
whitened by the landmarks' own kernel matrix; a linear machine with squared hinge loss is solved there by Newton steps.

A landmark is a sum over subsequences, and so is the machine: its expansion over landmarks is added up once into one
weight per subsequence, with the same values. Every sentence of every whole text is scored by it. A document's score is
that of its highest window, through a logistic curve fitted on sampled documents that were kept apart, at the classes' real shares.

Learned from a bounded sample of labelled documents (``SAMPLE_DOCS`` and ``SAMPLE_CHARS`` for each label, whole documents in the order
of a hash). Ids, languages and sources are not read by a score.

Null and empty texts score as a text without any window of note. Rows with null or repeated doc_id are scored like
others. Labels other than 0 and 1 are not learned from; an id that is labelled both is 1. Without sampled documents of both labels
every score is the share of label 1 (0 without labels). An empty table gives no rows. Texts beyond ``PIECE`` characters are read in
pieces that overlap by ``OVERLAP``, the best piece counts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.tokens import slices, text_batches
from caseload.llm.worker import kept, map_batches

#: Weight of a subsequence per letter that it spans, and the most letters between its first and its last.
DECAY = 0.6
SPAN = 5
#: Starts of subsequences that are one window.
WINDOW = 8
#: Bounds of the training sample, for labels 0 and 1.
SAMPLE_DOCS = (3_000, 1_500)
SAMPLE_CHARS = (10_000_000, 5_000_000)
#: Letters with a symbol of their own; the rest share one.
LETTERS = 45
#: Landmarks from toxic and from other documents, and how alike two of them may be.
LANDMARKS = (256, 128)
ALIKE = 0.75
#: Rounds of choosing windows, windows chosen in a toxic document, cost of a margin violation.
ROUNDS = 5
CHOSEN = 6
COST = 10.0
#: Share of the sample that only the logistic curve sees.
KEPT_APART = 0.3
#: Characters read together, and how much of one piece of a longer text the next one repeats.
PIECE = 1_000_000
OVERLAP = 2_000

BREAK, SPACE, OTHER, FIRST = 0, 1, 2, 3
_MARK, _DROP = 254, 255
_STEPS = [(a, b) for a in range(1, SPAN) for b in range(1, SPAN - a + 1)]


class Symbols:
    """Texts as symbols: a letter's class, a space, or a break that no window crosses."""

    def __init__(self, letters: str):
        self.letters = letters
        self.size = FIRST + len(letters)
        self.table = np.full(0x110000, _DROP, np.uint8)
        known = {ch: FIRST + k for k, ch in enumerate(letters)}
        for code in range(0x110000):
            ch = chr(code)
            if ch.isalpha():
                self.table[code] = known.get(ch.lower(), OTHER)
            elif ch.isspace():
                self.table[code] = SPACE
        self.table[[ord(c) for c in ".!?"]] = _MARK
        self.table[ord("\n")] = BREAK

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All texts' symbols, and where each text begins. Every text ends with a break, a break is ``WINDOW`` symbols."""
        codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        last = np.zeros(len(codes), bool)
        last[np.cumsum(lengths) - 1] = True
        kind = self.table[codes]
        marks = np.flatnonzero(kind == _MARK)
        kind[marks] = np.where(kind[marks + 1] <= SPACE, BREAK, _DROP)  # a text's own break follows its last mark
        held = np.flatnonzero(kind != _DROP)
        kind, last = kind[held], last[held]
        doc = np.cumsum(last) - last
        for gap in (SPACE, BREAK):  # one space for a run of them, and none beside a break
            before = np.r_[BREAK, kind[:-1]]
            if gap == SPACE:
                stays = (kind != SPACE) | ((before != SPACE) & (before != BREAK))
                kind, last, doc = kind[stays], last[stays], doc[stays]
                after = np.r_[kind[1:], BREAK]
                stays = (kind != SPACE) | (after != BREAK)
            else:
                stays = (kind != BREAK) | (before != BREAK) | last
            kind, last, doc = kind[stays], last[stays], doc[stays]
        times = np.where(kind == BREAK, WINDOW, 1)
        begins = np.r_[0, np.cumsum(np.bincount(doc, weights=times, minlength=len(texts)).astype(np.int64))[:-1]]
        return np.repeat(kind, times), begins


def _windows(values: np.ndarray) -> np.ndarray:
    """Sums of ``WINDOW`` values from each place on."""
    total = np.r_[0.0, np.cumsum(values, dtype=np.float64)]
    return total[np.minimum(np.arange(len(values)) + WINDOW, len(values))] - total[:-1]


def _subsequences(symbols: np.ndarray, size: int) -> Iterator[tuple[float, np.ndarray]]:
    """For each pair of steps: the weight of such subsequences, and their numbers from every place that has one."""
    one = symbols.astype(np.int32)
    two = one * size
    three = two * size
    n = len(one)
    for a, b in _STEPS:
        if n > a + b:
            yield DECAY ** (a + b + 1), three[:n - a - b] + two[a:n - b] + one[a + b:]


def window_scores(symbols: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """The machine's value (without its offset) of the window at every place."""
    values = np.zeros(len(symbols), np.float32)
    for weight, numbers in _subsequences(symbols, size):
        values[:len(numbers)] += np.float32(weight) * weights.take(numbers)
    return _windows(values)


def _features(symbols: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences of the windows at ``places``: their numbers and weights, a row per window."""
    padded = np.r_[symbols, np.zeros(WINDOW + SPAN, symbols.dtype)]
    near = padded[places[:, None] + np.arange(WINDOW + SPAN)].astype(np.int64)
    numbers, weights = [], []
    for a, b in _STEPS:
        one, two, three = near[:, :WINDOW], near[:, a:a + WINDOW], near[:, a + b:a + b + WINDOW]
        numbers.append((one * size + two) * size + three)
        weights.append(np.where((one == BREAK) | (two == BREAK) | (three == BREAK), 0.0, DECAY ** (a + b + 1)))
    return np.concatenate(numbers, 1), np.concatenate(weights, 1).astype(np.float32)


def _spread(values: np.ndarray, begins: np.ndarray, most: int, least: float) -> list[np.ndarray]:
    """For each text the places of its highest windows above ``least``, ``WINDOW`` places apart or more: at most ``most``."""
    out = []
    for a, b in zip(begins, [*begins[1:], len(values)]):
        own = values[a:b].copy()
        found = []
        while len(found) < most:
            k = int(own.argmax())
            if own[k] <= least:
                break
            found.append(a + k)
            own[max(0, k - WINDOW + 1):k + WINDOW] = -np.inf
        out.append(np.array(found, np.int64))
    return out


def _solve(x: np.ndarray, y: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Squared-hinge machine on the rows of ``x``: Newton steps on the rows inside the margin."""
    x = np.c_[x, np.ones(len(x), x.dtype)]
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    v = np.zeros(x.shape[1])
    inside = np.ones(len(x), bool)
    for _ in range(rounds):
        part = x[inside]
        v = np.linalg.solve(ridge + COST * (part.T @ part).astype(np.float64), COST * (part.T.astype(np.float64) @ y[inside]))
        now = y * (x @ v) < 1
        if (now == inside).all():
            break
        inside = now
    return v[:-1], float(v[-1])


def _logistic(values: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve through the documents' values, with Platt's softened targets."""
    many = np.array([(~toxic).sum(), toxic.sum()])
    target = np.where(toxic, (many[1] + 1) / (many[1] + 2), 1 / (many[0] + 2))
    x = np.c_[values, np.ones(len(values))]
    u = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ u, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (weight * (target - p)) - 1e-6 * u)
        u = u + step * min(1.0, 2 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return float(max(u[0], 0.0)), float(u[1])


@dataclass
class Machine:
    """Letters and weights of subsequences; slope and offset of the curve. Without weights every score is ``share``."""

    share: float
    letters: str = ""
    weights: np.ndarray | None = None
    slope: float = 0.0
    offset: float = 0.0

    def values(self, symbols: Symbols, texts: list[str | None]) -> np.ndarray:
        """The highest window of each text."""
        pieces, owner = [], []
        for k, text in enumerate(texts):
            text = text or ""
            for a in range(0, max(len(text), 1), PIECE - OVERLAP):
                pieces.append(text[a:a + PIECE])
                owner.append(k)
                if a + PIECE >= len(text):
                    break
        out = np.full(len(texts), -np.inf)
        for a, b in text_batches(pieces, PIECE):
            read, begins = symbols.read(pieces[a:b])
            np.maximum.at(out, owner[a:b], np.maximum.reduceat(window_scores(read, self.weights, symbols.size), begins))
        return out

    def score(self, symbols: Symbols | None, texts: list[str | None]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.share)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.values(symbols, texts) + self.offset, -500, 500)))


def _read_all(symbols: Symbols, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of many texts, read a few at a time."""
    read, begins, at = [], [], 0
    for a, b in text_batches(texts, PIECE):
        own, starts = symbols.read(texts[a:b])
        read.append(own)
        begins.append(starts + at)
        at += len(own)
    return np.concatenate(read), np.concatenate(begins)


def _common_letters(texts: list[str]) -> str:
    counts = np.zeros(0x110000, np.int64)
    for text in texts:
        np.add.at(counts, np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32), 1)
    letters = [c for c in np.argsort(-counts, kind="stable")[:4 * LETTERS].tolist() if counts[c] and chr(c).isalpha() and chr(c).lower() == chr(c)]
    return "".join(map(chr, sorted(letters[:LETTERS])))


def _quadruples(symbols: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of the four symbols at every place, and whether no break is among them."""
    one = np.r_[symbols, np.zeros(3, symbols.dtype)].astype(np.int32)
    n = len(symbols)
    whole = (one[:n] != BREAK) & (one[1:n + 1] != BREAK) & (one[2:n + 2] != BREAK) & (one[3:] != BREAK)
    return ((one[:n] * size + one[1:n + 1]) * size + one[2:n + 2]) * size + one[3:], whole


def _telling(symbols: np.ndarray, begins: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """For each place, how much more often (in deviations) its four symbols occur in toxic documents than in others; 0 if not telling."""
    has = np.zeros((2, size**4), np.float32)
    for a, b in _cuts(begins, len(symbols)):
        grams, whole = _quadruples(symbols[a:b], size)
        doc = np.searchsorted(begins, np.arange(a, b)[whole], side="right") - 1
        met = np.unique(doc * size**4 + grams[whole])
        for value in (0, 1):
            has[value] += np.bincount(met[toxic[met // size**4] == value] % size**4, minlength=size**4)
    many, many_toxic = len(toxic), max(int(toxic.sum()), 1)
    rest = max(many - many_toxic, 1)
    p = (has.sum(0) + 1) / (many + 2)
    # Less one: what only one toxic document has tells nothing of another.
    z = ((has[1] - 1) / many_toxic - has[0] / rest) / np.sqrt(p * (1 - p) * (1 / many_toxic + 1 / rest))
    z[z < 2] = 0
    out = np.zeros(len(symbols), np.float32)
    for a, b in _cuts(begins, len(symbols)):
        grams, whole = _quadruples(symbols[a:b], size)
        out[a:b] = np.where(whole, z[grams], 0)
    return out


def _landmarks(symbols: np.ndarray, places: np.ndarray, size: int, basis: np.ndarray, taken: int, most: int) -> int:
    """Add to ``basis`` (a row each, of length one) the first windows that differ from all chosen before; their number then."""
    for a in range(0, len(places), 500):
        for row, w in zip(*_features(symbols, places[a:a + 500], size)):
            if taken == most:
                return taken
            vector = np.bincount(row, weights=w, minlength=size**3).astype(np.float32)
            norm = float(np.sqrt(vector @ vector))
            used = np.unique(row)
            if norm > 0 and (basis[:taken, used] @ vector[used] <= ALIKE * norm).all():
                basis[taken] = vector / norm
                taken += 1
    return taken


def train(texts: list[str], labels: list[int], shares: tuple[float, float] | None = None) -> Machine:
    """The machine learned from documents with labels 0 and 1; ``shares``: how many documents each label stands for."""
    toxic = np.array(labels, bool)
    shares = shares or (float((~toxic).sum()), float(toxic.sum()))
    share = shares[1] / max(sum(shares), 1e-12)
    if toxic.all() or not toxic.any():
        return Machine(share if len(toxic) else 0.0)
    symbols = Symbols(_common_letters(texts))
    size = symbols.size
    # Documents kept apart for the curve: every third or so of either label; all documents if few are labelled.
    turn = np.zeros(len(toxic), np.int64)
    for value in (False, True):
        turn[toxic == value] = np.arange((toxic == value).sum())
    apart = np.floor(turn * KEPT_APART) != np.floor((turn - 1) * KEPT_APART)
    if min(toxic[apart].sum(), (~toxic[apart]).sum()) < 20:
        apart = np.zeros(len(toxic), bool)
    learned = np.flatnonzero(~apart)
    read, begins = _read_all(symbols, [texts[i] for i in learned])
    bad = toxic[learned]

    values = _windows(_telling(read, begins, bad, size)).astype(np.float32)
    highest = np.maximum.reduceat(values, begins)
    least = float(np.quantile(highest[~bad], 0.99))
    basis = whitened = used = row_of = None
    weights = np.zeros(size**3, np.float32)
    others = np.zeros(0, np.int64)  # windows of documents that are not toxic, of all rounds
    for _ in range(ROUNDS):
        found = _spread(values, begins, CHOSEN, least)
        positive = np.concatenate([found[k] for k in np.flatnonzero(bad)])
        highest = _spread(values, begins, 2, -np.inf)
        hard = np.concatenate([highest[k] for k in np.flatnonzero(~bad)])
        if not len(positive):
            positive = np.concatenate([highest[k][:1] for k in np.flatnonzero(bad)])
        ends = np.r_[begins[1:], len(read)]
        plain = np.concatenate([np.linspace(a, b - 1, 4).astype(np.int64)[1:3] for a, b in zip(begins[~bad], ends[~bad])])
        if basis is None:
            rows = np.zeros((sum(LANDMARKS), size**3), np.float32)
            taken = _landmarks(read, positive[np.argsort(-values[positive], kind="stable")], size, rows, 0, LANDMARKS[0])
            taken = _landmarks(read, np.r_[hard, plain], size, rows, taken, taken + LANDMARKS[1])
            if not taken:
                return Machine(share)
            # Only the subsequences that some landmark has; the last row stands for all others.
            used = np.flatnonzero(rows[:taken].any(0))
            row_of = np.full(size**3, len(used), np.int32)
            row_of[used] = np.arange(len(used))
            basis = np.zeros((len(used) + 1, taken), np.float32)
            basis[:-1] = rows[:taken, used].T
            del rows
            roots, axes = np.linalg.eigh((basis.T @ basis).astype(np.float64))
            whitened = (axes / np.sqrt(np.maximum(roots, 0) + 1e-3)) @ axes.T
        others = np.unique(np.concatenate([others, hard, plain]))
        places = np.concatenate([positive, others])
        y = np.where(np.arange(len(places)) < len(positive), 1.0, -1.0)
        kernel = []
        for k in range(0, len(places), 500):
            numbers, w = _features(read, places[k:k + 500], size)
            kernel.append(np.einsum("ij,ijk->ik", w, basis[row_of[numbers]]).astype(np.float32))
        v, offset = _solve(np.concatenate(kernel) @ whitened.astype(np.float32), y)
        weights[used] = basis[:-1] @ (whitened @ v).astype(np.float32)
        values = np.concatenate([(window_scores(read[a:b], weights, size) + offset).astype(np.float32) for a, b in _cuts(begins, len(read))])
        least = 0.0
    out = Machine(share, symbols.letters, weights)
    curve = np.flatnonzero(apart) if apart.any() else np.arange(len(toxic))
    of = toxic[curve]
    weight = np.where(of, shares[1] / max(of.sum(), 1), shares[0] / max((~of).sum(), 1))
    out.slope, out.offset = _logistic(out.values(symbols, [texts[i] for i in curve]), of, weight * len(of) / weight.sum())
    return out


def _cuts(begins: np.ndarray, end: int, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about ``most`` symbols."""
    at = 0
    for b in [*begins[1:].tolist(), end]:
        if b - at >= most or b == end:
            yield at, b
            at = b


def labelled_sample(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", sample_docs: tuple[int, int] = SAMPLE_DOCS,
                    sample_chars: tuple[int, int] = SAMPLE_CHARS) -> tuple[list, list, tuple]:
    """Texts and labels of a bounded sample, and how many labelled documents there are of each label.

    Of each label the ``sample_docs`` ids with the least hashes, of their documents those with the least hashes; documents that would exceed
    ``sample_chars`` together are passed over. Only the chosen documents' texts reach the driver.
    """
    named = labels if learn_from is None else labels.where(learn_from)
    named = (named.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("label")))
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    ids = [r for value in (0, 1) for r in named.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(sample_docs[value]).collect()]
    if not ids:
        return [], [], (0.0, 0.0)
    spark = docs.sparkSession
    picked = F.broadcast(spark.createDataFrame(ids, f"id {dict(named.dtypes)['id']}, label int"))  # at most sum(sample_docs) rows
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
            .join(picked, "id").withColumn("h", F.xxhash64("id", "text")))
    chosen: list[int] = []
    for value in (0, 1):
        held = 0
        sizes = rows.where(F.col("label") == value).select("h", F.length("text").alias("chars")).distinct()
        for r in sizes.orderBy("h").limit(sample_docs[value]).collect():
            if held + r["chars"] <= sample_chars[value]:
                held += r["chars"]
                chosen.append(r["h"])
    hashes = F.broadcast(spark.createDataFrame([(h,) for h in chosen], "h long"))
    found = rows.join(hashes, "h").dropDuplicates(["h"]).select("h", "label", "text").collect() if chosen else []
    found.sort(key=lambda r: r["h"])
    return [r["text"] for r in found], [r["label"] for r in found], (float(counts.get(0, 0)), float(counts.get(1, 0)))


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", **bounds) -> DataFrame:
    """One row per input row: doc_id and score (0 to 1). ``learn_from``: the rows of ``labels`` that may be learned from."""
    texts, known, shares = labelled_sample(docs, labels, learn_from, id_col, text_col, label_col, **bounds)
    machine = train(texts, known, shares if sum(shares) else None)
    name = hashlib.sha256(machine.letters.encode() + (b"" if machine.weights is None else machine.weights.tobytes())).hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                symbols = kept(("symbols", name), lambda: Symbols(machine.letters)) if machine.weights is not None else None
                scores = machine.score(symbols, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double")
