"""Language identification by cross-parsing entropy.

For every labelled language a suffix automaton is built over a bounded sample of its text: pieces hashed from whole documents. A text is parsed against
each automaton into the longest phrases that occur in that language's sample; the language that needs the fewest
phrases per character, normalised by the language's own rate on held-back sample text, wins. Texts are read whole:
they are cut into lanes of ``LANE`` characters (a phrase ends at a lane's end) and all lanes of a batch advance
together, one character per numpy step.

Characters are lower-cased; everything that is not a letter becomes a space and runs of spaces become one.

Null texts and texts without a letter are ``und`` with score 0, and so is everything when no labelled text was
learned from. Equal phrase rates go to the alphabetically first language. Rows with null doc_id are predicted like
others. Rows with null lang, and those the caller excludes, are never learned from. An empty table gives no rows.
Other columns of the input are ignored.
"""

from __future__ import annotations

import json
import re
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseload.llm.tokens import slices, text_batches
from caseload.llm.worker import kept, map_batches

UNKNOWN = "und"
#: Characters of a text that one lane parses.
LANE = 1024
#: Sample bounds, per language: documents looked at, and characters learned from.
SAMPLE_DOCS = 64
SAMPLE_CHARS = 48_000
#: Characters of a piece of a document, the unit in which the sample is drawn.
PIECE = 500
#: Automata beyond this many languages are kept in unnamed files that are mapped to memory.
IN_MEMORY = 64
#: Share of a sample held back from the automaton to measure the language's own phrase rate.
HELD_BACK = 0.25
#: Characters looked at together, and lanes advanced together.
BATCH_CHARS = 3_000_000
WIDTH = 8192

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> str:
    """Lower-case letters with single spaces between words; empty if the text has no letter."""
    cleaned = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return cleaned if any(map(str.isalpha, cleaned)) else ""  # not for numerals such as one half


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Transitions of the suffix automaton of ``text``; state 0 is the start."""
    following: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for ch in text:
        state = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and ch not in following[p]:
            following[p][ch] = state
            p = link[p]
        if p >= 0:
            q = following[p][ch]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and following[p].get(ch) == q:
                    following[p][ch] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return following


def _mapped(values: np.ndarray) -> np.ndarray:
    """The same values in a file without a name."""
    with tempfile.TemporaryFile() as file:
        out = np.memmap(file, values.dtype, "w+", shape=values.shape)
    out[:] = values
    return out


class CrossParser:
    """Phrase counts of texts against every language's sample."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        alphabet = sorted({ch for s in samples.values() for ch in s})
        self.width = len(alphabet) + 1  # the last class: characters of no sample
        # Letters outside the samples share one class; the class of a code point is a table lookup.
        self.classes = np.full(0x110000, self.width - 1, np.uint8 if self.width < 256 else np.uint16)
        for k, ch in enumerate(alphabet):
            self.classes[ord(ch)] = k
        self.tables: list[np.ndarray] = []
        for lang in self.languages:
            sample = samples[lang]
            learned = sample[:len(sample) - int(len(sample) * HELD_BACK)] if len(sample) > 1 else sample
            following = suffix_automaton(learned)
            table = np.full((len(following), self.width), -1, np.int32)
            for state, moves in enumerate(following):
                for ch, to in moves.items():
                    table[state, self.classes[ord(ch)]] = to
            self.tables.append(table.ravel() if len(self.tables) < IN_MEMORY else _mapped(table.ravel()))
        self.rates = np.ones(len(self.languages))
        for k, lang in enumerate(self.languages):
            held = samples[lang][len(samples[lang]) - int(len(samples[lang]) * HELD_BACK):]
            if len(held) >= LANE:
                self.rates[k] = self.phrases([held])[0, k] / len(held)
            else:  # too little text to measure a rate on: the mean of the others', set below
                self.rates[k] = np.nan
        known = self.rates[~np.isnan(self.rates)]
        self.rates = np.where(np.isnan(self.rates), known.mean() if len(known) else 1.0, self.rates)

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases that each of the (normalised) texts needs in each language."""
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        lanes_of = -(-lengths // LANE)
        text_of = np.repeat(np.arange(len(texts)), lanes_of)
        within = np.arange(len(text_of)) - np.repeat(np.cumsum(lanes_of) - lanes_of, lanes_of)
        begin = np.repeat(np.cumsum(lengths) - lengths, lanes_of) + within * LANE
        size = np.minimum(LANE, np.repeat(lengths, lanes_of) - within * LANE)
        order = np.argsort(-size, kind="stable")
        out = np.zeros((len(texts), len(self.languages)))
        classes = self.classes[codes]
        for k in range(0, len(order), WIDTH):
            pick = order[k:k + WIDTH]
            np.add.at(out, text_of[pick], self._parse(classes, begin[pick], size[pick]))
        return out

    def _parse(self, classes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each lane in each language; lanes are sorted by falling size."""
        n, width = len(begin), self.width
        step = np.arange(int(size[0]), dtype=np.int32)
        active = n - np.searchsorted(size[::-1], step, side="right")
        columns = classes[np.minimum(begin.astype(np.int32)[None, :] + step[:, None], np.int32(len(classes) - 1))]
        counts = np.zeros((len(self.languages), n), np.int32)
        start = np.int32(0)
        for j, table in enumerate(self.tables):
            first = np.array(table[:width])  # where each character leads from the start
            first_or_start = np.where(first < 0, start, first)
            state = np.full(n, start, np.int32)
            count = counts[j]
            for t in range(len(columns)):
                m = active[t]
                ch = columns[t, :m]
                to = table.take(state[:m] * np.int64(width) + ch)
                ended = to < 0
                # A phrase that cannot grow ends before this character, which begins the next one.
                count[:m] += ended & (state[:m] != start)
                fresh = ended & (first.take(ch) < 0)  # the character occurs in no phrase: one of its own
                count[:m] += fresh
                state[:m] = np.where(ended, first_or_start.take(ch), to)
            count += state != start  # the lane's last phrase
        return counts.T

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and score of each text: the score is 1 - best / second-best normalised rate, squashed to 0..1."""
        parts = [self._predict(texts[a:b]) for a, b in text_batches(texts, BATCH_CHARS)]
        return [lang for langs, _ in parts for lang in langs], np.concatenate([np.zeros(0), *(s for _, s in parts)])

    def _predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        clean = [normalised(t) for t in texts]
        found = np.flatnonzero([bool(t) for t in clean]) if self.languages else np.zeros(0, np.int64)
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if len(found):
            counts = self.phrases([clean[i] for i in found])
            rate = counts / np.array([len(clean[i]) for i in found])[:, None] / self.rates
            best = rate.argmin(axis=1)
            for i, b in zip(found, best):
                langs[i] = self.languages[b]
            lowest = rate.min(axis=1)
            share = 1.0 / np.maximum((lowest[:, None] / rate) ** 8, 0).sum(axis=1)
            scores[found] = np.clip(share, 0.0, 1.0)
        return langs, scores


def labelled_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Bounded training text per language: of each of ``sample_docs`` hash classes of ids the least hash.

    Two passes: the first reads ids and labels only and picks at most sample_docs ids per language, the second reads those
    documents' texts. Their pieces are taken in turns, each document's in the order of their hashes, until the bound is full.
    """
    key = F.xxhash64(F.col(id_col))
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    picked = (rows.groupBy(F.col(lang_col).alias("lang"), F.pmod(key, F.lit(sample_docs)).alias("c"))
              .agg(F.min_by(F.col(id_col), key).alias("id")))
    ids = [r["id"] for r in picked.select("id").distinct().collect()]
    if not ids:
        return {}
    most = 2 * sample_chars  # normalised, pieces get shorter
    texts = (rows.where(F.col(id_col).isin(ids)).select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
             .where(F.length("text") > 0))
    numbers = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE).cast("int"))
    order = F.array_sort(F.transform(numbers, lambda k: F.struct(F.xxhash64("id", k).alias("h"), k.alias("k"))))
    pieces = (texts.select("lang", "id", "text", F.posexplode(F.slice(order, 1, -(-most // PIECE))).alias("turn", "p"))
              .select("lang", "id", "turn", "p.h", "p.k", F.substring("text", F.col("p.k") * PIECE + 1, F.lit(PIECE)).alias("piece")))
    turns = Window.partitionBy("lang").orderBy("turn", "h", "piece").rowsBetween(Window.unboundedPreceding, -1)
    taken = (pieces.withColumn("before", F.coalesce(F.sum(F.length("piece")).over(turns), F.lit(0))).where(F.col("before") < most)
             .orderBy("lang", "before").collect())
    # Full in the order of the turns, then put in the order of the texts.
    chosen: dict[str, list] = {}
    held: dict[str, int] = {}
    for r in taken:
        more = normalised(r["piece"])
        if more and held.get(r["lang"], 0) < sample_chars:
            held[r["lang"]] = held.get(r["lang"], -1) + 1 + len(more)
            chosen.setdefault(r["lang"], []).append((r["id"], r["k"], more))
    out: dict[str, str] = {}
    for lang, found in chosen.items():
        places = {i: n for n, i in enumerate(dict.fromkeys(i for i, _, _ in found))}
        out[lang] = " ".join(more for _, _, more in sorted(found, key=lambda f: (places[f[0]], f[1])))[:sample_chars]
    return out


def _identified(model: str, batches: Iterable[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    """Slices of the batches with their texts' languages and scores."""
    for batch in batches:
        for part in slices(batch, column=text_col, max_bytes=BATCH_CHARS):
            parser = kept(("languages", model), lambda: CrossParser(json.loads(model)))
            yield part, *parser.predict(part.column(text_col).to_pylist())


def held_out_fold(id_col: str = "doc_id") -> Column:
    """True for ids whose decimal text has a CRC-32 of 2 modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify_languages(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id",
                       text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score. ``learn_from``: the rows whose labels may be used."""
    model = _model(docs, learn_from, id_col, text_col, lang_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, langs, scores in _identified(model, batches, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)],
                                             ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double")


def keep_identified(docs: DataFrame, learn_from: Column | None = None, min_score: float = 0.0,
                    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` with a known language and a score of at least ``min_score``, with their columns."""
    model = _model(docs, learn_from, id_col, text_col, lang_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, langs, scores in _identified(model, batches, text_col):
            yield part.filter(pa.array([lang != UNKNOWN and score >= min_score for lang, score in zip(langs, scores)], pa.bool_()))

    return map_batches(docs, run, docs.schema)


def _model(docs: DataFrame, learn_from: Column | None, id_col: str, text_col: str, lang_col: str) -> str:
    learned = docs if learn_from is None else docs.where(learn_from)
    return json.dumps(labelled_sample(learned, id_col, text_col, lang_col), sort_keys=True)
