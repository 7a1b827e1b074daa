"""Operators 2, 4 and 10: ids against the tokenizer libraries, exact round trips, packing laws."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from helpers import EDGE, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chronoframe.llm import bpe, packing, token_store
from chronoframe.llm.pieces import PieceTable, library_table

ALPHABET = " \n\t\x03\x1c\x1d\xa0 ab'sçß1!.,Éé  \r\n語́<|endoftext|>ΣςA"


def fuzz(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def coder():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return bpe.MatrixBpe(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_matrix_bpe_equals_the_library(coder, library):
    r = random.Random(2)
    table = PieceTable(coder.encode_chunks, True, capacity=50)
    texts = fuzz(1500) + ["a" * 5000, "ab!" * 2000, "".join(r.choice("abcdeth") for _ in range(9000))]
    for t, ids in zip(texts, table.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(t)
        assert coder.decode(ids).decode() == t


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunk_table_equals_the_library(name, spaced):
    with open(P.path(name), "rb") as f:
        table = library_table(f.read(), spaced)
    table.capacity = 100
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    texts = fuzz(1500, 3) + ["word " * 3000]
    for t, ids in zip(texts, table.encode(texts)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("name, spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_capitals_whose_lower_case_holds_a_mark(name, spaced):
    with open(P.path(name), "rb") as f:
        table = library_table(f.read(), spaced)
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    r = random.Random(5)
    signs = ["İ", "I", "i", ".", ",", " ", "\n", "a", "é", "\u0301", "ẞ", "word", "<|endoftext|>"]
    texts = ["İ.", "İ. ", "İ,\nx", "aİ. b"] + ["".join(r.choice(signs) for _ in range(r.randint(1, 12))) for _ in range(3000)]
    for t, ids in zip(texts, table.encode(texts)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_perfect_hash_is_minimal_and_survives_bytes():
    keys = token_store.mix64(np.arange(5000, dtype=np.uint64))
    f = token_store.PerfectHash.build(keys)
    again, _ = token_store.PerfectHash.from_bytes(f.to_bytes())
    assert sorted(again.slots(keys).tolist()) == list(range(5000))
    with pytest.raises(ValueError):
        token_store.PerfectHash.build(np.array([1, 1], dtype=np.uint64))
    n = np.arange(5000)
    index = token_store.KeyIndex(token_store.KeyIndex.pack(keys, n, n * 2, n * 3))
    there, rec = index.find(np.concatenate([keys, token_store.mix64(np.arange(10**6, 10**6 + 20000, dtype=np.uint64))]))
    assert there[:5000].all() and there[5000:].sum() == 0 and (rec["offset"][:5000] == n * 2).all()


def expected(rows, name, end=2):
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    return [(i, np.array(tok.encode(t or "", add_special_tokens=False).ids + [end], dtype="<u4").tobytes()) for i, t in rows]


def test_store_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    df = documents(spark, EDGE)
    token_store.write_store(df, path, P.path("byte_bpe_50k.json"), partitions=3, shard_bytes=3000, bucket_keys=4)
    places = token_store.lookup(df, path)
    got = token_store.read_ids(places, path).collect()
    assert sorted(((r.doc_id, bytes(r.ids)) for r in got), key=repr) == sorted(expected(EDGE, "byte_bpe_50k.json"), key=repr)
    starts = {r.shard: r.base for r in token_store.shard_starts(spark, path).collect()}
    order = sorted(got, key=lambda r: starts[r.shard] + r.offset)
    assert [r.doc_id for r in order] == [None] + sorted(i for i, _ in EDGE if i is not None)
    at = 0
    for r in order:
        assert starts[r.shard] + r.offset == at
        at += r.n_tokens
    other = spark.createDataFrame([(77,), (4,)], "doc_id long")
    assert {r.doc_id: r.shard is not None for r in token_store.lookup(other, path).collect()} == {77: False, 4: True}


def test_store_of_an_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/empty"
    df = documents(spark, [(1, "x")]).where("false")
    token_store.write_store(df, path, P.path("byte_bpe_50k.json"), partitions=2)
    assert token_store.read_ids(token_store.lookup(df, path), path).count() == 0
    assert token_store.shard_starts(spark, path).count() == 0


def test_bpe_operator_on_edge_rows(spark, library):
    df = documents(spark, EDGE)
    ranks = P.path("byte_bpe_50k.tiktoken")
    got = bpe.decode(bpe.encode(df, ranks, P.PATTERN), ranks, P.PATTERN).collect()
    want = [(i, np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t in EDGE]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=repr) == sorted(want, key=repr)
    assert bpe.encode(df.where("false"), ranks, P.PATTERN).count() == 0


def brute_level(counts, size, window):
    """The level whose choice makes the sum of squared counts least; ties to a used level, then the fullest."""
    best = None
    for h in range(window - size + 1):
        if h and not counts.get(h):
            continue
        c = dict(counts)
        if h:
            c[h] -= 1
        if h + size < window:
            c[h + size] = c.get(h + size, 0) + 1
        key = (sum(v * v for v in c.values()), -h)
        if best is None or key < best[0]:
            best = (key, h)
    return best[1]


def test_sum_of_squares_choice_is_the_brute_force_one():
    r = random.Random(5)
    packer = packing.SumOfSquares(32)
    for _ in range(600):
        size = r.choice([3, 5, 7, 11, 20, 31, 32])
        counts = {h: int(c) for h, c in enumerate(packer.count[:32]) if c}
        assert {h: len(x) for h, x in enumerate(packer.level) if x} == counts
        if size < 32:
            assert packer.choose(size) == brute_level(counts, size, 32)
        packer.add(0, np.arange(size, dtype=np.uint32))


def check_packing(rows, pieces, window):
    want = sorted((i, zlib.crc32(x), len(x) // 4) for i, x in expected(rows, "word_bpe_49k.json"))
    by = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        by.setdefault(p.sequence_id, []).append(p)
    for s in by.values():
        assert [p.offset for p in s] == np.cumsum([0] + [p.length for p in s])[:-1].tolist()
        n = sum(p.length for p in s)
        assert n <= window and (n == window or n & (n - 1) == 0)  # nothing is padded
    return want


@pytest.mark.parametrize("max_open", [2048, 1])
def test_packing_on_edge_rows(spark, max_open):
    rows = [(i, t) for i, t in EDGE if i not in (None, 5)] + [(100 + k, "some words " * k) for k in range(40)]
    df = documents(spark, rows)
    pieces = packing.pack(df.repartition(2), P.path("word_bpe_49k.json"), window=64, max_open=max_open)
    got = pieces.collect()
    want = check_packing(rows, got, 64)
    docs = {}
    for p in sorted(got, key=lambda p: (p.doc_id, p.start)):
        have = docs.setdefault(p.doc_id, b"")
        assert p.start * 4 == len(have) and p.length * 4 == len(p.ids)
        docs[p.doc_id] = have + bytes(p.ids)
    assert sorted((i, zlib.crc32(x), len(x) // 4) for i, x in docs.items()) == want
    whole = packing.sequences(pieces, 64).agg(F.max(F.length("ids")), F.sum("n_tokens")).first()
    assert whole[0] == 256 and whole[1] == sum(n for _, _, n in want)


def test_packing_keeps_null_ids_and_repeats_and_takes_empty_tables(spark):
    df = documents(spark, EDGE)
    got = packing.pack(df, P.path("word_bpe_49k.json")).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("d")).collect()
    counts = {r.doc_id: r.n // r.d for r in got}
    assert counts.pop(5) == 2 and set(counts.values()) == {1} and None in counts
    assert packing.pack(df.where("false"), P.path("word_bpe_49k.json")).count() == 0
