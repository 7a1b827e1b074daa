"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_text(df: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Only the id (``_id`` long) and the text (``_text``), and as ``_c0, _c1, …`` the columns in ``carry``:
    other columns, whatever their names, stay out."""
    more = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)]
    return df.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"), *more)


def text_groups(ids: pa.Array, texts: pa.Array, group_bytes: int = 1 << 20) -> Iterator[tuple[list, list]]:
    """:func:`arrow_groups` as lists; a null text is given as ``None``."""
    for i, t in arrow_groups(ids, texts, group_bytes):
        yield i.to_pylist(), t.to_pylist()


def arrow_groups(ids: pa.Array, texts: pa.Array, group_bytes: int = 4 << 20) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Slices of one Arrow batch with about ``group_bytes`` of text each (a longer text stands alone)."""
    n = len(texts)
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    part = (np.cumsum(size) - size) // group_bytes
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [n]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield ids.slice(a, b - a), texts.slice(a, b - a)


def block_of(value, cuts: list):
    """Number of ``cuts`` (sorted, bounded by the caller) that are not above the value, by binary search.
    The value must not be null (a column of whole numbers with nulls would reach Python as floats)."""
    keep = list(cuts)

    @F.pandas_udf("int")
    def place(s: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(keep, v) for v in s.tolist()], dtype="int32")

    return place(value) if keep else F.lit(0)


def deal_blocks(df: DataFrame, block: str, n: int) -> DataFrame:
    """Partitions for the block numbers 0 to n - 1, one block each: the rows are dealt by a key of their block that hashes to a
    partition of its own (by the numbers themselves about a third of the partitions would stay empty and others get several)."""
    key = F.col("id").cast("int")
    found = df.sparkSession.range(32 * n).groupBy(F.pmod(F.hash(key), F.lit(n)).alias("p")).agg(F.min(key).alias("k")).collect()
    of = {r["p"]: r["k"] for r in found}
    keys = F.array(*[F.lit(of.get(b, b)).cast("int") for b in range(n)])
    return df.withColumn("_deal", F.get(keys, F.col(block))).repartition(n, "_deal").drop("_deal")


def codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift and multiply): every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] … starts[i]+lengths[i]-1`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)
