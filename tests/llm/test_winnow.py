"""Operator 8: against brute force, match guarantee, order and edge rows."""

import hashlib
import random

import numpy as np
from helpers import EDGE, documents

from chronoframe.llm import winnow as w


def brute(text, gram, window):
    c = [ord(x) + 1 for x in text]
    if not c:
        return []
    gram = min(gram, len(c))
    hashes = []
    for i in range(len(c) - gram + 1):
        h = 0
        for x in c[i:i + gram]:
            h = (h * int(w.BASE) + x) % 2**64
        hashes.append(int(w.mix64(np.array([h], dtype=np.uint64))[0]))
    window = min(window, len(hashes))
    out = set()
    for i in range(len(hashes) - window + 1):
        low = min(x >> 24 for x in hashes[i:i + window])
        j = max(j for j in range(i, i + window) if hashes[j] >> 24 == low)
        out.add((j, hashes[j]))
    return sorted(out)


def test_against_brute_force_also_in_blocks():
    r = random.Random(3)
    for _ in range(250):
        t = "".join(r.choice("abé") for _ in range(r.randint(0, 200)))
        gram, window = r.randint(1, 12), r.randint(1, 20)
        want = brute(t, gram, window)
        for block in (1 << 22, 64):
            p, h = w.winnow(t, gram, window, block)
            assert list(zip(p.tolist(), h.tolist())) == want


def test_shared_passage_is_found_and_runs_choose_the_rightmost():
    r = random.Random(4)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passage = text(32 + 97 - 1)
    a, b = w.winnow(text(500) + passage + text(300)), w.winnow(text(77) + passage + text(900))
    assert set(a[1].tolist()) & set(b[1].tolist())
    p, _ = w.winnow("a" * 300, 5, 10)
    assert p.tolist() == list(range(9, 296))


def test_edited_rows_against_plain_python(spark):
    got = {}
    df = documents(spark, EDGE)
    for blocks_conf in ("2", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", blocks_conf)
        got[blocks_conf] = sorted(w.edited_fingerprints(df).collect(), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got["2"] == got["9"]
    rows = sorted(((i, t or "") for i, t in EDGE), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        n = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        e = t[:len(t) - half] + n[:half]
        pt, pe, pn = (w.winnow(x) for x in (t, e, n))
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), w.as_text(*pt), w.as_text(*pe), w.likeness(pt[1], pe[1]), w.likeness(pt[1], pn[1])))
    assert sorted((tuple(r) for r in got["2"]), key=repr) == sorted(want, key=repr)


def test_plain_fingerprints_one_row_and_empty_tables(spark):
    df = documents(spark, EDGE)
    rows = w.fingerprints(df).collect()
    assert len(rows) == len(EDGE) and {r.doc_id: r.positions for r in rows}[2] == []
    one = w.edited_fingerprints(df.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert w.edited_fingerprints(df.where("false")).count() == 0


def test_short_texts_keep_their_likeness():
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    off = []
    for n in range(46, 257):
        a, b = text(n), text(n)
        e = a[:n - n // 2] + b[:n // 2]
        near = w.likeness(w.winnow(a)[1], w.winnow(e)[1])
        exact = w.likeness(*(w.gram_hashes(w.codes(x), w.GRAM) for x in (a, e)))
        assert near > 0 and w.likeness(w.winnow(a)[1], w.winnow(b)[1]) < 0.1
        off.append(abs(near - exact))
    assert np.mean(off) < 0.08
    passage = text(23)
    assert set(w.winnow(text(500) + passage + text(300))[1].tolist()) & set(w.winnow(text(77) + passage + text(900))[1].tolist())


def test_blocks_are_dealt_one_to_a_partition(spark):
    from pyspark.sql import functions as F

    from chronoframe.llm.common import deal_blocks
    df = spark.range(500).select((F.col("id") % 23).cast("int").alias("b"), "id")
    at = deal_blocks(df, "b", 24).withColumn("p", F.spark_partition_id()).select("b", "p").distinct().collect()
    assert len(at) == 23 == len({r.p for r in at}) and deal_blocks(df, "b", 24).columns == ["b", "id"]
