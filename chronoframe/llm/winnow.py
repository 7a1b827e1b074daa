"""Document fingerprints by winnowing.

The polynomial hash of every ``gram`` code points rolls over the text; of every ``window`` neighbouring hashes
the least is chosen, the rightmost on ties, and kept with its position.  Two texts that share a passage of at
least ``gram + window − 1`` code points share a chosen hash, whatever stands around it; no passage under
``gram`` code points can match.  The defaults find every shared passage of 23 code points, at all lengths of text.  A fingerprint is written as ``position:hash`` (decimal, 16 hex digits) joined by spaces, a
likeness is the Jaccard index of the hash sets.

Rows: a null text is empty; an empty text has the empty fingerprint, and two empty fingerprints are alike
(1.0); a text under ``gram`` code points is one gram; a text under ``window`` grams is one window; repeated
rows have equal fingerprints.  :func:`with_next` orders by (id, text); null ids come first; a table of one row
is its own next row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import block_of, codes, deal_blocks, id_text, mix64, text_groups

BASE = np.uint64(0x100000001B3)
LOW = np.uint64((1 << 24) - 1)
GRAM, WINDOW = 8, 16  # shared passages of 23 code points are found


def gram_hashes(c: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every ``gram`` code points, modulo 2**64: spans of powers of two are joined by doubling."""
    if not len(c):
        return np.zeros(0, dtype=np.uint64)
    gram = min(gram, len(c))
    span, h = 1, c.astype(np.uint64) + np.uint64(1)
    done, out = 0, None
    while True:
        if gram & span:
            n = len(c) - done - span + 1
            out = h[:n] if out is None else out[:n] * BASE ** np.uint64(span) + h[done: done + n]
            done += span
        if done == gram:
            return mix64(out)
        h = h[:-span] * BASE ** np.uint64(span) + h[span:]
        span *= 2


def winnow(text: str, gram: int = GRAM, window: int = WINDOW, block: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Positions (ascending) and hashes of the chosen grams."""
    c = codes(text)
    positions, hashes = [], []
    step = block - gram - window
    for a in range(0, max(1, len(c)), step):  # one block for most texts; blocks overlap by a window of grams
        part = c[a: a + block]
        if a and len(part) < gram + window - 1:
            break
        h = gram_hashes(part, gram)
        if not len(h):
            break
        key = (h & ~LOW) | (LOW - np.arange(len(h), dtype=np.uint64))  # the higher position is the lesser key
        left, span = min(window, len(h)), 1
        low = key
        while span < left:
            jump = min(span, left - span)
            low = np.minimum(low[: len(low) - jump], low[jump:])
            span += jump
        at = (LOW - (low[np.concatenate([[True], low[1:] != low[:-1]])] & LOW)).astype(np.int64)
        positions.append(at + a)
        hashes.append(h[at])
        if a + block >= len(c):
            break
    if not positions:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    p, first = np.unique(np.concatenate(positions), return_index=True)
    return p, np.concatenate(hashes)[first]


def as_text(p: np.ndarray, h: np.ndarray) -> str:
    digits = h.astype(">u8").tobytes().hex()
    return " ".join([f"{x}:{digits[16 * i: 16 * i + 16]}" for i, x in enumerate(p.tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of two sets of hashes."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``id_col, n_chars, positions`` (array of long)``, hashes`` (array of long: the 64 bits, signed) of every row."""
    names = [id_col, "n_chars", "positions", "hashes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in text_groups(b.column(0), b.column(1)):
                got = [winnow(t or "", gram, window) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(t or "") for t in texts], pa.int64()), pa.array([p for p, _ in got], pa.list_(pa.int64())),
                                                  pa.array([h.view(np.int64) for _, h in got], pa.list_(pa.int64()))], names=names)

    return id_text(df, id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_chars long, positions array<long>, hashes array<long>")


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> tuple[DataFrame, list]:
    """Rows laid out so that each follows its predecessor in id order inside one partition.

    Ids are cut into blocks of about equal counts at quantiles of the id column; each block's first row is
    also put at the end of the block before it (of the last block for the first one).  Gives the columns
    ``_block, _id, _text, _end`` sorted by them, and the cuts.
    """
    spark = df.sparkSession
    rows = id_text(df, id_col, text_col)
    n = blocks or 2 * shuffle_partitions(spark)
    cuts = rows.approxQuantile("_id", [k / n for k in range(1, n)], 0.1 / n) if n > 1 else []
    cuts = sorted({int(c) for c in cuts or []})
    rows = rows.withColumn("_block", block_of(F.coalesce("_id", F.lit(-2**63)), cuts))
    found = rows.groupBy("_block").agg(F.min("_id").alias("low"), F.max(F.col("_id").isNull()).alias("nul")).orderBy("_block").collect()
    if not found:
        return rows.select("_block", "_id", "_text", F.lit(0).alias("_end")), cuts
    order = [r["_block"] for r in found]
    before = dict(zip(order, order[-1:] + order[:-1]))
    firsts = [None if r["nul"] else r["low"] for r in found]
    known = [i for i in firsts if i is not None]
    wanted = F.col("_id").isin(known) if known else F.lit(False)
    if None in firsts:
        wanted = wanted | F.col("_id").isNull()
    tails = rows.where(wanted).groupBy("_block", "_id").agg(F.min(F.coalesce("_text", F.lit(""))).alias("_text"))
    to = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    tails = tails.select(F.element_at(to, F.col("_block")).alias("_block"), "_id", "_text", F.lit(1).alias("_end"))
    heads = rows.select("_block", "_id", F.coalesce("_text", F.lit("")).alias("_text"), F.lit(0).alias("_end"))
    laid = deal_blocks(heads.unionByName(tails), "_block", n).sortWithinPartitions("_block", "_end", F.asc_nulls_first("_id"), "_text")
    return laid, cuts


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprint of each text and of its edited form (the last half replaced by the beginning of the next
    row's text in id order): ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``."""
    laid, _ = with_next(df, id_col, text_col)
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # block, id, text, positions, hashes
        for b in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            for block, doc, text, end in zip(*(b.column(i).to_pylist() if i != 2 else b.column(2) for i in range(4))):
                text = text.as_py()
                p, h = winnow(text, gram, window)
                if last is not None and last[0] == block:
                    _, doc0, text0, p0, h0 = last
                    half = len(text0) // 2
                    edited = text0[: len(text0) - half] + text[:half]
                    ep, eh = winnow(edited, gram, window)
                    row = (doc0, len(text0), hashlib.sha256(edited.encode("utf-8")).hexdigest(), as_text(p0, h0), as_text(ep, eh), likeness(h0, eh), likeness(h0, h))
                    for c, v in zip(out, row):
                        c.append(v)
                    size += len(row[3]) + len(row[4])
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                        out, size = [[] for _ in names], 0
                last = None if end else (block, doc, text, p, h)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return laid.mapInArrow(run, f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
