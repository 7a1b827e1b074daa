"""Operator 13: against plain Python by the contract, also with pairs outside the broadcast table, and edge rows."""

import functools
import hashlib
import random
from collections import Counter, defaultdict

import pytest
from helpers import EDGE, documents, words

pt = pytest.importorskip("public_tokenizers")
from chronoframe.llm import align as al  # noqa: E402

A, B = pt.path("byte_bpe_50k.json"), pt.path("piece_bpe_32k.model")


@functools.cache
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    return tok, SentencePieceProcessor(model_file=B)


def tokens(text):
    """Token lists (id, bytes) of both sides by the libraries alone."""
    if not text:
        return [], []
    tok, sp = libraries()
    sign = al._byte_level()
    a = [(i, bytes(sign[c] for c in tok.id_to_token(i))) for i in tok.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in sp.encode(text):
        p = sp.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    return a, b


def brute(texts):
    out, docs_of = [], Counter()
    for text in texts:
        a, b = tokens(text)
        ends = []
        for side in (a, b):
            at, e = 0, []
            for _, x in side:
                at += len(x)
                e.append(at)
            ends.append(e)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j = [], 0, 0
        for c in cuts:
            ga, gb = [], []
            while i < len(a) and ends[0][i] <= c:
                ga.append(a[i][0])
                i += 1
            while j < len(b) and ends[1][j] <= c:
                gb.append(b[j][0])
                j += 1
            groups.append((ga, gb))
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        docs_of.update(links.keys())
        s = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), sum(links.values()), links, hashlib.sha256(s.encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (x, _), n in docs_of.items():
        best[x] = max(best[x], n)
    return [(na, nb, g, n, sum(t for p, t in links.items() if docs_of[p] == best[p[0]]), sum(t * docs_of[p] for p, t in links.items()), h)
            for na, nb, g, n, links, h in out]


def fixture():
    r = random.Random(5)
    letters = ["the ", "and", "é", " ", "  ", "\n", "語", "ß", ".", ",", "aaaa", "İ", "▁", "🙂", "<s>", "<|endoftext|>", "\x00", "ing", "tion ", " ", "=====", "0x41>", "\x03", "\r\n"]
    rows = [(i, "".join(r.choice(letters) for _ in range(r.randint(0, 60)))) for i in range(20, 140)]
    return EDGE + rows + [(200, "zz" * 700), (201, "=" * 333 + "語" * 50), (202, " ".join(words(300, 9))), (202, "repeated id"), (203, "repeated id")]


@pytest.mark.parametrize("keep", [1 << 20, 40, 0])
def test_against_plain_python(spark, keep):
    rows = fixture()
    df = documents(spark, rows)
    got = al.align(df, A, B, keep_pairs=keep, capacity=100).collect()
    want = brute([r[1] for r in rows])
    assert sorted([tuple(r) for r in got], key=repr) == sorted([(r[0], *w) for r, w in zip(rows, want)], key=repr)


def test_a_long_group_costs_its_distinct_ids():
    import numpy as np

    pair = al.Aligner(open(A, "rb").read(), open(B, "rb").read(), 1000)
    a, b = np.full(100_000, 7), np.full(100_000, 9)
    zero = np.zeros(100_000, dtype=np.int64)
    key, times = pair._links((a, b), zero, zero, np.array([100_000]), np.array([100_000]), np.array([0]))
    assert key.tolist() == [7 * pair.size_b + 9] and times.tolist() == [10**10]


def test_empty_table(spark):
    assert al.align(documents(spark, []), A, B).collect() == []
