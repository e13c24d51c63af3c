import functools
import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import support as S
from tidemark.llm import packing as K
from tidemark.llm import token_files as T
from tidemark.llm import word_bpe as W
from tidemark.llm.common import scratch_path
from tidemark.llm.tokens import ByteBpe, default_path

TEXTS = ["", "a  b", " lead", "trail ", "x\n\n y\t z", "it's  'll", "<|endoftext|> in text", "ünï çødé 漢字  x", "a b   c", "n\0ul \0", "É́ é ſ İ Σς", "1234 56,7", "\x1c\x85 q"]


@functools.cache
def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_chunked_encoding_equals_the_library():
    lib, own = library("byte_bpe_50k.json"), ByteBpe.shared(default_path("byte_bpe_50k.json"))
    for _ in range(2):
        got = own.encode([*TEXTS, None])
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [lib.encode(t, add_special_tokens=False).ids for t in [*TEXTS, ""]]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab '.\n\t é <|>1"), max_size=40), max_size=6))
def test_chunked_encoding_equals_the_library_on_random_texts(texts):
    lib, own = library("byte_bpe_50k.json"), ByteBpe.shared(default_path("byte_bpe_50k.json"))
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**12), max_size=700))
def test_elias_fano_round_trip(values):
    values = sorted(values)
    ef = T.EliasFano.from_bytes(T.EliasFano.build(np.array(values, np.uint64)).to_bytes())
    assert ef.all().tolist() == values
    assert [ef.select(i) for i in range(0, len(values), 7)] == values[::7]


def test_elias_fano_is_near_minimal():
    v = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    size = 8 * len(T.EliasFano.build(v).to_bytes()) / len(v)
    assert size < 2.3 + np.log2(v[-1] / len(v))


def test_token_files_round_trip(spark):
    texts = S.corpus(n=50) + TEXTS
    lib = library("byte_bpe_50k.json")
    df = S.docs(spark, texts, [9 * i - 50 for i in range(len(texts))])
    out = T.write_token_files(df, scratch_path(spark, "t"), shard_ids=900)
    assert out.count() > 5
    got = sorted(T.read_token_files(out).collect())
    start = 0
    for r, t in zip(got, texts, strict=True):
        ids = [*lib.encode(t, add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    shard = T.Shard(T.read_bytes(out.first().path))
    assert [shard.span(i) for i in range(shard.n_docs)] == list(zip([0, *shard.ends.all()[:-1].tolist()], shard.ends.all().tolist()))
    assert shard.doc_id(0) == shard.doc_ids()[0]


def test_token_files_awkward_rows(spark):
    got = T.token_files_round_trip(S.clashing(S.awkward(spark))).collect()
    assert len(got) == 11 and sum(r.doc_id is None for r in got) == 1
    assert [r.start for r in got if r.doc_id is None] == [0]
    assert T.token_files_round_trip(S.empty(spark)).count() == 0
    with pytest.raises(ValueError, match="not a token-id shard"):
        T.Shard(b"x" * 100)


def test_token_files_encode_bounded_texts_at_once(spark, monkeypatch):
    """A worker holds the chunks of a bounded stretch of texts, however many a batch brings; results stay the same."""
    shared = T.ByteBpe.shared

    class Watched:
        @staticmethod
        def shared(path, dtype):
            class One:
                def encode(self, texts):
                    if len(texts) > 1 and sum(len(t or "") for t in texts) > 300:
                        raise ValueError("too many characters at once")
                    return shared(path, dtype).encode(texts)

            return One()

    df = S.docs(spark, S.corpus(n=30) + TEXTS).coalesce(1)
    want = sorted(T.token_files_round_trip(df).collect())
    monkeypatch.setattr(T, "ByteBpe", Watched)
    monkeypatch.setattr(T, "ENCODE_CHARS", 300, raising=False)
    assert sorted(T.token_files_round_trip(df).collect()) == want


def test_word_bpe_equals_the_library(spark, monkeypatch):
    texts = S.corpus(n=60) + TEXTS + ["<|startoftext|> a<|endoftext|>b"]
    lib = library("word_bpe_49k.json")
    got = {r.doc_id: r for r in W.encode_decode(S.docs(spark, texts), with_values=True).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = lib.encode(t, add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        assert (got[i].ids, got[i].decoded, got[i].n_tokens) == (ids, text, len(ids))
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_word_bpe_awkward_rows(spark):
    got = W.encode_decode(S.clashing(S.awkward(spark))).collect()
    assert len(got) == 11 and {r.doc_id: r.n_tokens for r in got}[1] == 0
    assert W.encode_decode(S.empty(spark)).count() == 0


def test_word_bpe_rows_are_bounded(spark, monkeypatch):
    """A block's documents come in parts of bounded words, a long text in spans; results stay the library's."""
    monkeypatch.setattr(W, "PART_WORDS", 200, raising=False)
    monkeypatch.setattr(W, "SPAN_WORDS", 7, raising=False)
    texts = [*S.corpus(n=40), "", " \n", " ".join(f"q{i}é x{i % 7}" for i in range(300)), *TEXTS]
    rows = S.docs(spark, texts).coalesce(1)
    parts = [r.counts for r in W.split_blocks(rows, 4, "doc_id", "text").where("bucket < 0").collect()]
    assert sum(map(len, parts)) == len(texts) and max(map(sum, parts)) >= 600
    assert all(sum(p) <= 200 or len(p) == 1 for p in parts)
    lib = library("word_bpe_49k.json")
    got = {r.doc_id: r for r in W.encode_decode(rows).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = lib.encode(t, add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def check_packing(rows, ids_of, capacity):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, ids in ids_of.items():
        at = 0
        pieces = sorted(by_doc[d], key=lambda r: r.piece)
        for r in pieces:
            part = ids[r.start : r.start + r.length]
            assert r.start == at and r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += r.length
        assert at == len(ids) and all(r.length == capacity for r in pieces[1:])
    for rows_ in by_seq.values():
        at = 0
        for r in sorted(rows_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_seq)


def test_packing(spark):
    texts = S.corpus(n=200, words=(1, 120)) + TEXTS
    lib = library("byte_bpe_50k.json")
    ids = {i: [*lib.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    n = check_packing(K.pack(S.docs(spark, texts), capacity=128).collect(), ids, 128)
    assert n <= -(-sum(map(len, ids.values())) // 128) + 5


def test_packing_awkward_rows(spark):
    got = K.pack(S.clashing(S.awkward(spark))).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, 10, None}
    assert K.pack(S.empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), min_size=1, max_size=20))
def test_solved_histograms_hold_every_piece(hist):
    bins = K.solve(hist, 64)
    held = {}
    for p, n in bins.items():
        assert n > 0 and sum(p) <= 64
        for x in p:
            held[x] = held.get(x, 0) + n
    assert held == hist


def test_local_search_empties_bins():
    # best fit leaves a bin that exchanges can empty
    bins = {(5, 3): 1, (4, 4, 1): 1, (6, 2): 1, (2,): 1}
    before = sum(bins.values())
    assert sum(K.local_search(bins, 10).values()) < before


def gains(bins, capacity):
    """Every move or exchange that raises the squared fill, by the book."""
    from itertools import combinations

    under = [p for p in bins if sum(p) < capacity]
    for a in under:
        for b in under:
            if a == b and bins[a] < 2:
                continue
            some = [((x,), y) for x in a for y in [(), *((v,) for v in b), *combinations(b, 2)]]
            some += [(x, (y,)) for x in combinations(a, 2) for y in b]
            for out, back in some:
                d = sum(out) - sum(back)
                if 0 < d <= capacity - sum(b) and (sum(b) + d) ** 2 + (sum(a) - d) ** 2 > sum(a) ** 2 + sum(b) ** 2:
                    yield a, b, out, back


def test_local_search_goes_on_when_the_least_filled_bin_is_stuck():
    # (3) has no exchange, but 9 for 8 between the other two makes it room
    hist = {9: 2, 8: 4, 3: 3}
    assert sum(K.best_fit(hist, 20).values()) == 4
    assert sum(K.solve(hist, 20).values()) == 3


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(5, 63), st.integers(1, 30), min_size=1, max_size=12))
def test_local_search_ends_at_the_lower_bound_or_without_gains(hist):
    bins = K.solve(hist, 64)
    if sum(bins.values()) > -(-sum(x * n for x, n in hist.items()) // 64):
        assert next(gains(bins, 64), None) is None
