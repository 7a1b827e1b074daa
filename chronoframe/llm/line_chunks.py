"""Line dedup by content-defined chunks of lines.

A text is cut at line feeds; a rolling hash covers every two neighbouring lines (md5 over the md5 of the two).
A chunk begins before line i where the rolling hash is a local minimum: less than the one before it, not more
than the one after.  Whether a place is a boundary thus depends on four lines around it and on nothing else, so
the same passage is cut alike wherever it stands, and a chunk never has fewer than two lines unless the text
has one.  A chunk of two or more lines that occurs again anywhere in the corpus is removed there; the first
occurrence in the order (id, place in the text) stays.  Equality is that of the bytes: occurrences are grouped
by hash and text of the chunk (with map-side combine, so a passage that a third of all rows share meets as a
few rows), and in a document a chunk goes only if it equals the listed one byte for byte.

Rows: a null text stays null, an empty one empty; blank chunks and texts of one line are never removed; a null
id counts as greater than all others, and each row of null id is a document of its own, numbered in the order of the
table (written once, so that the number stays); rows that repeat an id count as one document and keep what either holds
first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_text

# Nested one-element arrays bind a value once for the expressions inside.
CHUNKS = r"""
transform(array(split(_text, '\n', -1)), lns ->
  if(size(lns) < 4, array(_text),
    transform(array(transform(lns, x -> md5(cast(x as binary)))), hs ->
      transform(array(transform(sequence(1, size(lns) - 1), i -> md5(cast(concat(get(hs, i - 1), get(hs, i)) as binary)))), rs ->
        transform(array(filter(sequence(0, size(lns) - 2), i -> i = 0 or (i >= 2 and get(rs, i - 1) < get(rs, i - 2) and get(rs, i - 1) <= get(rs, i)))), st ->
          transform(st, (b, k) -> array_join(slice(lns, b + 1, coalesce(get(st, k + 1), size(lns)) - b), '\n')))[0])[0])[0]))[0]
"""

LAST = 2**63  # of null ids: above every id


def chunks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``_id, _nul, _ord, _text, _chunks``: the chunks of each text in order (null for a null text); ``_c0, _c1, …``
    hold the columns in ``carry``; ``_nul, _ord`` (null id, id or number of the row) tell documents apart."""
    base = id_text(df, id_col, text_col, carry).withColumn("_nul", F.col("_id").isNull()).withColumn("_ord", F.col("_id"))
    nameless = base.where("_nul")
    if not nameless.select("_nul").isEmpty():
        numbered = materialize(nameless.withColumn("_ord", F.monotonically_increasing_id()), "line-chunks-null-ids")
        base = base.where(~F.col("_nul")).unionByName(numbered)
    return base.withColumn("_chunks", F.when(F.col("_text").isNotNull(), F.expr(CHUNKS)))


def occurrences(chunked: DataFrame) -> DataFrame:
    """``_nul, _ord, pos, h, chunk, own`` of every chunk that may be removed; ``own`` orders occurrences."""
    e = chunked.select("_nul", "_ord", F.posexplode("_chunks").alias("pos", "chunk"))
    e = e.where(F.col("chunk").contains("\n") & F.col("chunk").rlike(r"\S"))
    order = F.col("_ord").cast("decimal(20,0)") + F.when(F.col("_nul"), F.lit(Decimal(LAST))).otherwise(F.lit(0)).cast("decimal(20,0)")
    own = order * F.lit(2**31).cast("decimal(12,0)") + F.col("pos")
    return e.select("_nul", "_ord", "pos", F.xxhash64("chunk").alias("h"), "chunk", own.cast("decimal(38,0)").alias("own"))


def repeated(chunked: DataFrame) -> DataFrame:
    """``h, chunk, n, first`` of the chunks with more than one occurrence."""
    g = occurrences(chunked).groupBy("h", "chunk")
    return g.agg(F.count(F.lit(1)).alias("n"), F.min("own").alias("first")).where(F.col("n") > 1)


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id_col, text, n_lines, n_removed`` for every row: the text without repeated chunks, the number of its
    lines before (null: 0) and of those removed; then the columns named in ``carry``."""
    chunked = chunks(df, id_col, text_col, carry)
    seen = occurrences(chunked).select("_nul", "_ord", "pos", "h", "own")
    out = seen.join(repeated(chunked).select("h", "chunk", "first"), "h").where(F.col("own") != F.col("first"))
    gone = out.groupBy("_nul", "_ord").agg(F.collect_list(F.concat(F.col("pos").cast("string"), F.lit(":"), "chunk")).alias("_gone"))
    kept = F.expr("transform(array_except(transform(_chunks, (c, k) -> concat(cast(k as string), ':', c)), _gone), x -> substring(x, locate(':', x) + 1))")
    r = chunked.drop("_chunks").join(gone, ["_nul", "_ord"], "left").withColumn("_chunks", F.when(F.col("_gone").isNotNull(), F.expr(CHUNKS)))
    r = r.withColumn("_kept", F.when(F.col("_gone").isNotNull(), kept))
    lines = F.coalesce(F.length("_text") - F.length(F.translate("_text", "\n", "")) + 1, F.lit(0))
    left = F.when(F.col("_gone").isNull(), lines).otherwise(F.aggregate("_kept", F.lit(0), lambda a, c: a + F.length(c) - F.length(F.translate(c, "\n", "")) + 1))
    return r.select(F.col("_id").alias(id_col), F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join("_kept", "\n")).alias("text"),
                    lines.cast("long").alias("n_lines"), (lines - left).cast("long").alias("n_removed"),
                    *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)])


def oracle(table: str = "documents") -> str:
    """The same in DuckDB SQL (ids not null)."""
    return f"""
WITH lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM {table}),
hashed AS (SELECT *, list_transform(l, lambda x: md5(x)) AS h FROM lines),
rolled AS (SELECT *, list_transform(range(2, len(l) + 1), lambda i: md5(h[i - 1] || h[i])) AS r FROM hashed),
starts AS (SELECT *, CASE WHEN len(l) < 4 THEN [0] ELSE [0] || list_filter(range(2, len(l) - 1), lambda i: r[i] < r[i - 1] AND r[i] <= r[i + 1]) END AS s FROM rolled),
cut AS (SELECT *, list_transform(range(1, len(s) + 1), lambda k: array_to_string(l[s[k] + 1 : coalesce(s[k + 1], len(l))], chr(10))) AS c FROM starts),
parts AS (SELECT doc_id, unnest(c) AS chunk, unnest(range(0, len(c))) AS pos FROM cut),
marked AS (SELECT *, (contains(chunk, chr(10)) AND regexp_matches(chunk, '\\S')
                      AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, pos) > 1) AS gone FROM parts),
built AS (SELECT doc_id, string_agg(chunk, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept,
                 CAST(coalesce(sum(len(chunk) - len(replace(chunk, chr(10), '')) + 1) FILTER (gone), 0) AS BIGINT) AS n_removed FROM marked GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(b.kept, '') END AS text,
       CAST(CASE WHEN d.text IS NULL THEN 0 ELSE len(d.text) - len(replace(d.text, chr(10), '')) + 1 END AS BIGINT) AS n_lines,
       coalesce(b.n_removed, 0) AS n_removed
FROM {table} d LEFT JOIN built b ON d.doc_id = b.doc_id"""
