from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caseload.llm import packing, range_coder, token_counts, token_files
from caseload.llm.storage import shared_folder
from caseload.llm.tokens import Encoder, read_tokenizer, text_batches

from .conftest import EDGE_TEXTS, frame, prose

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def library_ids(path, texts):
    return [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module", params=[BYTES, WORDS])
def both(request):
    return Encoder(read_tokenizer(request.param)), Tokenizer.from_file(request.param)


def same(both, texts):
    coder, library = both
    got = [np.frombuffer(b, "<u4").tolist() for b in coder.encode(texts)]
    return got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_on_odd_texts(both):
    assert both[0].kind in ("spaced", "dropped")
    odd = [*EDGE_TEXTS, "  a", "a  b", "a\n b", "a \nb", "\na", "a\n", "don't we'll 's'", "\x1ca b\x1db", "a\r\nb", "日本 語", "a b　c",
           "Σ ΑΣ ς İ", "é ́", "x<|endoftext|> y", "<|startoftext|>a", "1 22 333", prose(3, 500), "a\x85b c"]
    assert same(both, odd)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZé 's\n\t1!ñ 😀."), max_size=40), max_size=8))
def test_encoder_is_the_library(both, texts):
    assert same(both, texts)


def test_unknown_kind_of_file_goes_whole():
    spec = '{"version":"1.0","truncation":null,"padding":null,"added_tokens":[],"normalizer":null,"pre_tokenizer":{"type":"Whitespace"},' \
           '"post_processor":null,"decoder":null,"model":{"type":"WordLevel","vocab":{"a":0,"b":1,"?":2},"unk_token":"?"}}'
    coder = Encoder(spec)
    assert coder.kind == "whole" and np.frombuffer(coder.encode(["a b c"])[0], "<u4").tolist() == [0, 1, 2]


def test_text_batches():
    texts = ["x" * n for n in (5, 1, 9, 0, 3)] + [None]
    parts = list(text_batches(texts, 6))
    assert parts[0] == (0, 2) and parts[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


# --- counts --------------------------------------------------------------------------------------

def test_counts_and_cache(spark, edge_docs, empty_docs):
    cache = shared_folder(spark, "cache")
    rows = edge_docs.collect()
    expected = {(r.doc_id, r.text): (len((r.text or "").encode()), len(i)) for r, i in zip(rows, library_ids(BYTES, [r.text for r in rows]))}
    got = token_counts.count_tokens(edge_docs, BYTES, cache).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted((str(r.doc_id), *expected[r.doc_id, r.text]) for r in rows)
    stored = token_counts.read_cache(spark, cache)
    distinct = len({r.text or "" for r in rows})
    assert stored.count() == distinct  # each text once
    token_counts.count_tokens(edge_docs.union(frame(spark, [(500, "new text")])), BYTES, cache).collect()
    assert token_counts.read_cache(spark, cache).count() == distinct + 1  # only the miss was encoded
    token_counts.count_tokens(frame(spark, [(1, "new text")]), WORDS, cache).collect()
    assert token_counts.read_cache(spark, cache).count() == distinct + 2  # another tokenizer has its own counts
    assert token_counts.count_tokens(empty_docs, BYTES, cache).count() == 0
    assert token_counts.count_tokens(empty_docs, BYTES, shared_folder(spark, "cache")).count() == 0


def test_stored_counts_are_used(spark):
    from pyspark.sql import functions as F
    cache = shared_folder(spark, "cache")
    version = token_counts.tokenizer_version(read_tokenizer(BYTES))
    df = spark.range(1).select(F.unhex(F.sha2(F.lit("abc"), 256)).alias("digest"), F.lit(version).alias("tokenizer"), F.lit(99).cast("long").alias("n_tokens"))
    df.union(df).write.parquet(cache)  # also: a digest appended twice
    assert [r.n_tokens for r in token_counts.count_tokens(frame(spark, [(1, "abc")]), BYTES, cache).collect()] == [99]


# --- range coder and files ------------------------------------------------------------------------

@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**20), max_size=60), max_size=6), st.integers(0, 3))
def test_range_coder_round_trip(lists, repeat):
    blocks = [np.array(x * (repeat + 1), np.uint32) for x in lists]
    table = range_coder.rank_table(np.concatenate([*blocks, np.zeros(0, np.uint32)]))
    coded = range_coder.encode_blocks(blocks, table)
    assert [b.tolist() for b in range_coder.decode_blocks(coded, table)] == [b.tolist() for b in blocks]
    # any block alone
    for c, b in zip(coded[1:2], blocks[1:2]):
        assert range_coder.decode_blocks([c], table)[0].tolist() == b.tolist()


def test_range_coder_large_alphabet_and_gain():
    rng = np.random.default_rng(1)
    wide = rng.permutation(200_000).astype(np.uint32)
    table = range_coder.rank_table(wide)
    assert (range_coder.decode_blocks(range_coder.encode_blocks([wide], table), table)[0] == wide).all()
    skewed = [np.minimum(rng.geometric(0.05, 2048), 400).astype(np.uint32) for _ in range(8)]
    table = range_coder.rank_table(np.concatenate(skewed))
    assert sum(map(len, range_coder.encode_blocks(skewed, table))) < 8 * 2048 * 0.85  # below a byte an id: entropy is about 6 bits


def test_damage_is_found():
    ids = np.arange(500, dtype=np.uint32) % 37
    table = range_coder.rank_table(ids)
    coded = bytearray(range_coder.encode_blocks([ids], table)[0])
    coded[12] ^= 64
    with pytest.raises(ValueError):
        range_coder.decode_blocks([bytes(coded)], table)


def test_token_files(spark, edge_docs):
    rows = edge_docs.collect()
    folder = shared_folder(spark, "files")
    token_files.write_token_files(edge_docs, folder, BYTES, segment_ids=40)
    assert spark.read.parquet(folder).count() >= 2
    order = sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
    expected, start = [], 0
    for r, ids in zip(order, library_ids(BYTES, [r.text for r in order])):
        raw = np.array([*ids, 0], "<u4").tobytes()
        expected.append((r.doc_id, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    got = [tuple(r) for r in token_files.token_file_digests(spark, folder).collect()]
    assert sorted(got, key=lambda t: t[1]) == expected
    whole = token_files.read_token_files(spark, folder).orderBy("start").collect()
    assert [len(r.ids) for r in whole] == [e[2] for e in expected] and whole[-1].ids[-1] == 0


def test_token_files_of_nothing(spark, empty_docs):
    folder = shared_folder(spark, "files")
    token_files.write_token_files(empty_docs, folder, BYTES)
    assert token_files.token_file_digests(spark, folder).count() == 0


# --- packing -------------------------------------------------------------------------------------

def check_sequences(full, lengths):
    seen = {}
    for window in full:
        n = sum(p[2] for p in window)
        assert n <= 2048 and n & (n - 1) == 0  # nothing to pad
        for doc, start, size in window:
            assert size > 0
            seen.setdefault(doc, []).append((start, start + size))
    for doc, n in enumerate(lengths):
        at = 0
        for a, b in sorted(seen[doc]):
            assert a == at
            at = b
        assert at == n


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 40), st.integers(1, 2100), st.integers(1, 9000)), max_size=40))
def test_packing_covers_without_padding(lengths):
    full, loose = packing.pack(lengths)
    assert not loose
    check_sequences(full, lengths)
    some, loose = packing.pack(lengths, last=False)
    assert sum(p[2] for w in some for p in w) + sum(p[2] for p in loose) == sum(lengths)
    assert all(sum(p[2] for p in w) in packing.TIERS for w in some)


def test_routing():
    routed = packing.route([100, 256, 257, 2048, 5000])
    assert routed == {2048: [(3, 0, 2048), (4, 0, 2048), (4, 2048, 2048)],
                      1024: [(4, 4096, 904)], 512: [(2, 0, 257)], 256: [(0, 0, 100), (1, 0, 256)]}


def test_step_groups_are_even():
    rng = random.Random(1)
    costs = [rng.randint(1, 1000) ** 2 for _ in range(64)]
    groups = packing.step_groups(costs, 16)
    assert sorted(groups) == sorted([0, 1, 2, 3] * 16)
    totals = [sum(c for c, g in zip(costs, groups) if g == k) for k in range(4)]
    assert max(totals) - min(totals) < 0.1 * max(totals)


@pytest.mark.parametrize("pool_tokens", [packing.POOL_TOKENS, 3000])
def test_pack_documents(spark, edge_docs, pool_tokens):
    docs = edge_docs.union(frame(spark, [(1000 + i, prose(i, 5 + i * 13 % 900)) for i in range(40)]))
    rows = docs.collect()
    ids = {(r.doc_id, r.text): [*i, 1] for r, i in zip(rows, library_ids(WORDS, [r.text for r in rows]))}
    got = packing.pack_documents(docs, WORDS, pool_tokens=pool_tokens).collect()
    by_doc, by_sequence = {}, {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for (doc_id, _), own in ids.items():
        if doc_id is None or doc_id == 9:
            continue
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            piece = own[p.start:p.start + p.length]
            assert p.start == at and p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
            at += p.length
        assert at == len(own)
    assert sum(p.length for p in got) == sum(len(ids[r.doc_id, r.text]) for r in rows)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048 and at & (at - 1) == 0 and {p.tier for p in pieces} == {at}
    tokens = {}
    for s, pieces in by_sequence.items():
        tokens.setdefault(pieces[0].step_group, []).append(sum(p.length for p in pieces))
    assert all(sum(t) <= packing.STEP_TOKENS and len(set(t)) == 1 for t in tokens.values())


def test_packing_edges(empty_docs):
    assert packing.pack_documents(empty_docs, WORDS).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(empty_docs, WORDS, tiers=(1000,))
