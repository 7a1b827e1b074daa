"""Sum-of-squares online packing of tokenised documents into training windows.

Each task packs the documents of its input partition in their order, without a shuffle.  ``count[h]`` holds
how many open windows are filled to ``h`` tokens; a document of ``s`` tokens goes to the level (or to a new
window) that makes the sum of the squared counts least, ties to the fullest level.  A document above the
window size first gives whole windows; its rest is placed.  Documents are cut freely only where windows are
closed: when more than ``max_open`` windows are open, or at the end of the partition, the emptiest windows
give their tokens to the fullest ones, and what is left at the end becomes windows of powers of two, which
need no padding.  Memory holds at most ``max_open`` open windows and one document.

Rows: a null or empty text is a document of the end id alone; repeated rows are packed each for itself; a
null id stays null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_groups, id_text
from .pieces import library_table, worker_table

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


class SumOfSquares:
    """Online packer: ``add`` gives the windows that a document fills, ``finish`` the rest.

    A window is a list of pieces ``(doc, start, ids, doc_tokens)``.
    """

    def __init__(self, window: int, max_open: int = 2048):
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, dtype=np.int64)
        self.level: list[list[list]] = [[] for _ in range(window)]
        self.open = 0

    def choose(self, size: int) -> int:
        """Level to place ``size`` tokens on; 0 stands for a new window."""
        c = self.count
        gain = 2 * (c[size + 1:] - c[1: self.window + 1 - size]) + 2  # from level h to h + size, h = 1 …
        if len(gain):
            gain[-1] -= 1  # a full window is not counted any more
        there = c[1: self.window + 1 - size] > 0
        best, at = 2 * int(c[size]) + 1, 0
        if there.any():
            gain = np.where(there, gain, np.iinfo(np.int64).max)
            k = len(gain) - 1 - int(gain[::-1].argmin())
            if gain[k] <= best:
                at = k + 1
        return at

    def _put(self, pieces: list, fill: int) -> None:
        self.level[fill].append(pieces)
        self.count[fill] += 1
        self.open += 1

    def add(self, doc, ids: np.ndarray) -> list[list]:
        full, n, w = [], len(ids), self.window
        whole = n // w * w
        for a in range(0, whole, w):
            full.append([(doc, a, ids[a: a + w], n)])
        size = n - whole
        if size:
            h = self.choose(size)
            pieces = []
            if h:
                pieces = self.level[h].pop()
                self.count[h] -= 1
                self.open -= 1
            pieces.append((doc, whole, ids[whole:], n))
            if h + size == w:
                full.append(pieces)
            else:
                self._put(pieces, h + size)
        if self.open > self.max_open:
            full += self._close()
        return full

    def _close(self) -> list[list]:
        """Fill the fullest windows with tokens of the emptiest ones; at most one window stays open."""
        rest = [(h, p) for h, many in enumerate(self.level) for p in many]
        self.level = [[] for _ in range(self.window)]
        self.count[:] = 0
        self.open = 0
        full, lo, hi = [], 0, len(rest) - 1
        while lo < hi:
            fill, pieces = rest[hi]
            had, donor = rest[lo]
            doc, start, ids, n = donor.pop()
            need = min(self.window - fill, len(ids))
            pieces.append((doc, start, ids[:need], n))
            if need < len(ids):
                donor.append((doc, start + need, ids[need:], n))
            rest[hi], rest[lo] = (fill + need, pieces), (had - need, donor)
            if fill + need == self.window:
                full.append(pieces)
                hi -= 1
            if had == need:
                lo += 1
        if lo == hi and rest and rest[lo][0] == self.window:
            full.append(rest[lo][1])
        elif lo == hi and rest[lo][0]:
            self._put(rest[lo][1], rest[lo][0])
        return full

    def finish(self) -> list[list]:
        out = self._close()
        left = [p for many in self.level for w in many for p in w]
        fill = sum(len(p[2]) for p in left)
        while fill:
            size = 1 << (fill.bit_length() - 1)
            fill -= size
            pieces = []
            while size:
                doc, start, ids, n = left.pop(0)
                take = min(size, len(ids))
                pieces.append((doc, start, ids[:take], n))
                if take < len(ids):
                    left.insert(0, (doc, start + take, ids[take:], n))
                size -= take
            out.append(pieces)
        self.level = [[] for _ in range(self.window)]
        self.count[:] = 0
        self.open = 0
        return out


def pack(df: DataFrame, vocabulary_path: str, window: int = 4096, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text", max_open: int = 2048) -> DataFrame:
    """Pieces ``doc_id, start, length, ids`` (binary, little-endian unsigned 32-bit)``, doc_tokens, sequence_id,
    offset`` of all documents, each with ``end_id`` after its ids."""
    with open(vocabulary_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        table = worker_table(("words", hash(data)), lambda: library_table(data, False, 400_000))
        packer = SumOfSquares(window, max_open)
        number = TaskContext.get().partitionId() << 32
        end = np.array([end_id], dtype=np.uint32)

        def rows(windows: list[list]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            out: list[list] = [[] for _ in range(7)]
            for pieces in windows:
                at = 0
                for doc, start, ids, n in pieces:
                    for c, v in zip(out, (doc, start, len(ids), ids.astype("<u4").tobytes(), n, number, at)):
                        c.append(v)
                    at += len(ids)
                number += 1
            if out[0]:
                kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)],
                                                 names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for b in batches:
            for docs, texts in arrow_groups(b.column(0), b.column(1)):
                full: list[list] = []
                for doc, ids in zip(docs.to_pylist(), table.encode(texts)):
                    full += packer.add(doc, np.concatenate([ids, end]))
                yield from rows(full)
        yield from rows(packer.finish())

    return id_text(df, id_col, text_col).mapInArrow(run, SCHEMA)


def sequences(pieces: DataFrame, window: int = 4096, pad_id: int = 0) -> DataFrame:
    """Whole sequences ``sequence_id, n_tokens, ids`` from :func:`pack`: pieces joined in offset order (a
    sequence has at most ``window`` of them) and padded to ``window`` unless the length is a power of two."""
    parts = F.expr("concat_ws('', transform(array_sort(collect_list(struct(offset, hex(ids) AS ids))), p -> p.ids))")
    s = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("hex"))
    exact = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    pad = F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(window) - F.col("n_tokens")).cast("int"))
    return s.select("sequence_id", "n_tokens", F.unhex(F.when(exact, F.col("hex")).otherwise(F.concat("hex", pad))).alias("ids"))
