"""Token ids of whole texts, as the tokenizers library gives them for a tokenizer file.

Both supported kinds of file split a text into pieces that never join across certain white space, so the ids of a
text are the ids of its chunks in order. Chunks repeat far more often than texts; each distinct chunk is encoded
by the library once per worker and looked up afterwards:

* byte-level BPE with the library's own splitting pattern: a single space between two other characters starts a
  new piece and a single line feed is a piece of its own;
* BPE that removes white space when splitting: every run of white space is a boundary.

Texts for which that does not hold (runs of white space or unusual white space in the first kind, control
characters that only some libraries count as white space in the second, special strings in either) and all texts
of other files go through the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from caseload.llm.worker import kept

#: Distinct chunks that a worker keeps in each of two generations (about 50 MB).
CACHED_CHUNKS = 250_000

_ODD_SPACE = re.compile(r"[\x0b\x0c\x1c-\x1f\x85]")
#: Chunks that both kinds of file split into one piece, or two: letters that neither case nor composition turns into anything but
#: letters, and closing marks.
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?)\"]{0,3})").fullmatch
#: All white space but the space and the line feed.
_OTHER_SPACE = [chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n"]


def tokenizer_version(content: str) -> str:
    """SHA-256 over a tokenizer file's content and the library's version."""
    import tokenizers

    return hashlib.sha256(f"{tokenizers.__version__}\n{content}".encode()).hexdigest()


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class _Recent:
    """Ids of chunks that were met lately: two generations, the older of which is dropped as a whole."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, wanted: set[str], renew: bool = True) -> list[str]:
        """The chunks that are in neither generation; the others are in the young one afterwards."""
        if renew and len(self.young) > CACHED_CHUNKS:
            self.young, self.old = {}, self.young
        new, young, old = [], self.young, self.old
        for w in wanted.difference(young):
            ids = old.get(w)
            if ids is None:
                new.append(w)
            else:
                young[w] = ids
        return new


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.loads(content)
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        plain = [t for t in spec.get("added_tokens") or [] if t.get("special") and not (t.get("lstrip") or t.get("rstrip"))]
        self.mark, self.mark_id = (plain[0]["content"], plain[0]["id"]) if plain else ("", -1)
        self.kind = self._kind(spec) if plain else "whole"
        # Of every id, whether a piece that a space goes before begins with it, or whether a piece ends with it.
        suffix = spec["model"].get("end_of_word_suffix") or "\0"
        vocabulary = self.library.get_vocab()
        self.edge = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.startswith("\u0120") if self.kind == "spaced" else t.endswith(suffix))]] = True
        self.first = _Recent()  # chunks at the start of a line (or anywhere, if white space is dropped)
        self.after = _Recent()  # chunks that a single space goes before
        self.marks: dict[str, bytes] = {}  # closing marks of plain chunks

    @staticmethod
    def _kind(spec: dict) -> str:
        split, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not norm:
            return "spaced"
        steps = [s.get("type") for s in split.get("pretokenizers", [])]
        norms = [n.get("type") for n in norm.get("normalizers", [])]
        drops = steps[:1] == ["Split"] and split["pretokenizers"][0].get("behavior") == "Removed"
        if drops and norms == ["NFC", "Replace", "Lowercase"]:
            return "dropped"
        return "whole"

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def _learn(self, wanted: set[str], known: _Recent, prefix: str) -> dict[str, bytes]:
        """Ids of all ``wanted`` chunks. Unknown ones are encoded many to a call. Plain words, taken off their closing marks, stand
        side by side there, as each is one piece that the vocabulary tells from the next; between others stands a special string,
        which no chunk holds."""
        new = known.missing(wanted)
        other, marked = new, []
        if self.kind == "dropped" or prefix:
            other, words = [], set()
            for w, m in zip(new, map(_PLAIN, new)):
                if m is None:
                    other.append(w)
                else:
                    words.add(m[1])
                    if m[2]:
                        marked.append((w, m[1], m[2]))
            plain = known.missing(words, renew=False)
            for k in range(0, len(plain), 5_000):
                part = plain[k:k + 5_000]
                ids = np.array(self.library.encode_batch_fast([prefix + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
                at = np.flatnonzero(self.edge[ids])
                if len(at) != len(part):  # not what such words are taken to be: the safe way
                    other += part
                elif self.kind == "spaced":
                    self._keep(known, part, ids, at, np.r_[at[1:], len(ids)])
                else:
                    self._keep(known, part, ids, np.r_[0, at[:-1] + 1], at + 1)
        for k in range(0, len(other), 5_000):
            part = other[k:k + 5_000]
            joined = self.library.encode_batch_fast([self.mark.join([prefix + w for w in part])], add_special_tokens=False)
            ids = np.array(joined[0].ids, "<u4")
            ends = np.r_[np.flatnonzero(ids == self.mark_id), len(ids)]
            self._keep(known, part, ids, np.r_[0, ends[:-1] + 1], ends)
        young, marks = known.young, self.marks
        for w, word, mark in marked:
            if mark not in marks:
                marks[mark] = self._encode([mark])[0]
            young[w] = young[word] + marks[mark]
        return young

    @staticmethod
    def _keep(known: _Recent, chunks: list[str], ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> None:
        raw = ids.tobytes()
        known.young.update(zip(chunks, [raw[a:b] for a, b in zip((4 * begins).tolist(), (4 * ends).tolist())]))

    def _regular(self, text: str) -> bool:
        if any(s in text for s in self.special):
            return False
        if self.kind == "spaced":  # all white space is single spaces and line feeds between other characters
            return not any(c in text for c in _OTHER_SPACE) and len(text.split()) == text.count(" ") + text.count("\n") + 1
        return self.kind == "dropped" and not _ODD_SPACE.search(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as bytes; a null text counts as empty."""
        out: list[bytes] = [b""] * len(texts)
        plans: list[tuple[int, list[list[str]]]] = []
        first: set[str] = set()
        after: set[str] = set()
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self._regular(text):
                out[i] = self._encode([text])[0]
            elif self.kind == "spaced":
                lines = [line.split(" ") for line in text.split("\n")]
                plans.append((i, lines))
                first.update(line[0] for line in lines)
                for line in lines:
                    after.update(line[1:])
            else:
                words = text.split()
                plans.append((i, [words]))
                first.update(words)
        at_first = self._learn(first, self.first, "").__getitem__
        at_after = self._learn(after, self.after, " ").__getitem__
        line_feed = self._encode(["\n"])[0] if self.kind == "spaced" else b""
        for i, lines in plans:
            if self.kind == "spaced":
                out[i] = line_feed.join([b"".join([at_first(line[0]), *map(at_after, line[1:])]) for line in lines])
            else:
                out[i] = b"".join(map(at_first, lines[0]))
        return out


def encoder(content: str) -> Encoder:
    """The encoder of a tokenizer file's content, built once per Python worker."""
    return kept(("tokenizer", content), lambda: Encoder(content))


def text_batches(texts: list[str | None], max_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Cut a list of texts into index ranges of at most ``max_chars`` characters (one text at least)."""
    return ranges([len(t) if t else 0 for t in texts], max_chars)


def ranges(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Index ranges whose sizes sum to at most ``most`` (one index at least)."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def slices(batch: pa.RecordBatch, max_bytes: int = 1_000_000, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of at most ``max_bytes`` of its text column (one row at least), so that few texts are Python
    objects at a time."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    for a, b in ranges(sizes, max_bytes):
        yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()
