"""Operator 5: law of near-equal bytes, slots, groups, any number of shards, edge rows."""

import random
import zlib

import pytest
from helpers import EDGE, documents, words
from pyspark.sql import functions as F

from chronoframe.llm import kdshard


def rows(n=600):
    r = random.Random(7)
    texts = [" ".join(words(r.choice([3, 10, 40, 90]), k)) for k in range(n)]
    return [(k, t) for k, t in enumerate(texts)] + [(10_000 + k, "a copy") for k in range(5)]


@pytest.mark.parametrize("shards", [8, 5, 1])
def test_bytes_are_near_equal_and_groups_stay(spark, shards):
    data = rows()
    got = kdshard.shard(documents(spark, data), shards=shards).collect()
    text = dict(data)
    assert sorted(r.doc_id for r in got) == sorted(text)
    assert all(r["size"] == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    size, slots = {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(size) == set(range(shards))
    assert max(size.values()) - min(size.values()) <= 4 * max(r["size"] for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id >= 10_000}) == 1


def test_a_group_of_a_third_is_cut(spark):
    data = rows(300) + [(20_000 + k, "same words again and again " * 4) for k in range(400)]
    got = kdshard.shard(documents(spark, data), shards=8).collect()
    size = {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r["size"]
    assert max(size.values()) < 1.1 * min(size.values())


def test_target_bytes_and_edge_rows(spark):
    df = documents(spark, EDGE)
    total = sum(len((t or "").encode()) + 1 for _, t in EDGE)
    got = kdshard.shard(df, target_bytes=total // 3).collect()
    assert len(got) == len(EDGE) and {r.shard for r in got} <= set(range(4))
    null = [r for r in got if r.doc_id == 1]
    assert null[0]["size"] == 1 and null[0].text_crc32 == 0
    assert kdshard.shard(df.where("false"), shards=8).count() == 0
    with pytest.raises(ValueError):
        kdshard.shard(df)


def test_partitioning_does_not_matter(spark):
    df = documents(spark, rows(200))
    a = kdshard.shard(df.repartition(1), shards=4).collect()
    b = kdshard.shard(df.repartition(7), shards=4).collect()
    assert sorted(a) == sorted(b)


def test_text_dimensions_are_ranks_of_whole_values(spark):
    names = [f"src{k}" for k in range(20)] + ["https://a/1", "https://a/2"]
    df = spark.createDataFrame([(n,) for n in names * 3] + [(None,)], "v string")
    got = {r.v: r.d for r in kdshard.ranked(df.withColumn("w", F.col("v")), "w", "d").select("v", "d").collect()}
    assert got[None] == 0 and [n for n, _ in sorted(((n, p) for n, p in got.items() if n), key=lambda x: x[1])] == sorted(names) and len(set(got.values())) == 23


def test_a_tree_along_sources_with_a_common_prefix(spark):
    """Texts of one length and language: only the source can part them; a cut may be a document off the border of two sources."""
    rows = [(k, f"text {k:06d}", "en", f"https://host/{k % 8}", 11) for k in range(800)]
    got = {r.doc_id: r.shard for r in kdshard.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), shards=8).collect()}
    most = [max(sum(got[k] == shard for k in range(s, 800, 8)) for shard in range(8)) for s in range(8)]
    assert min(most) >= 97 and len(set(got.values())) == 8
