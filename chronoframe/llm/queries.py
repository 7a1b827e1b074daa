"""Queries of this subpackage: one for each operator, on its whole table, with its contract's columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import table
from ..sources.io import scratch_path
from . import align, bagminhash, bpe, kdshard, langid, line_chunks, metric_join, packing, page_diff, quality, token_store, whiten, winnow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "tokens")
    token_store.write_store(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    read = token_store.read_ids(token_store.lookup(docs, path), path)
    return read.join(token_store.shard_starts(spark, path), "shard").select(
        "doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = bpe.encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    back = bpe.decode(ids, ranks, public_tokenizers.PATTERN)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs)).select("doc_id", "held_out", "lang_pred", "score")


@query
def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op5_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdshard.shard(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup(table(spark, sf_dir, "documents"))


SQL["op6_line_chunks"] = line_chunks.oracle()


@query
def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


SQL["op9_bagminhash"] = """
WITH RECURSIVE w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[ \\t\\n\\r\\f\\v]+'), lambda x: x <> '') AS w FROM documents),
rep AS (SELECT min(doc_id) AS rep, text, any_value(w) AS w FROM w WHERE len(w) > 0 GROUP BY text),
s AS (SELECT rep, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS s FROM rep),
c AS (SELECT rep, s, count(*) AS n FROM s GROUP BY rep, s),
t AS (SELECT rep, sum(n) AS total FROM c GROUP BY rep),
o AS (SELECT a.rep AS a, b.rep AS b, sum(least(a.n, b.n)) AS both_n FROM c a JOIN c b ON a.s = b.s AND a.rep <> b.rep GROUP BY a.rep, b.rep),
l AS (SELECT a, b FROM o JOIN t x ON x.rep = a JOIN t y ON y.rep = b WHERE both_n >= 0.8 * (x.total + y.total - both_n)),
reach AS (SELECT rep AS a, rep AS b FROM rep UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
comp AS (SELECT a AS rep, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a AS rep, count(*) AS n_links FROM l GROUP BY a)
SELECT d.doc_id, coalesce(r.rep, d.doc_id) AS rep_id, coalesce(deg.n_links, 0) AS n_links, coalesce(comp.component_id, d.doc_id) AS component_id,
  coalesce(d.doc_id = comp.component_id, true) AS kept
FROM documents d LEFT JOIN rep r ON r.text = d.text LEFT JOIN comp ON comp.rep = r.rep LEFT JOIN deg ON deg.rep = r.rep"""


@query
def op1_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_join.near_vectors(table(spark, sf_dir, "embeddings"))


SQL["op1_metric_join"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
comp AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a AS vec_id, count(DISTINCT b) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM comp LEFT JOIN deg USING (vec_id)"""


@query
def op7_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_diff.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op13_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.filter_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query
def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))
