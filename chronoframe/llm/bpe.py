"""Byte-level BPE encoding and decoding by a file of ranks.

Every match of the split pattern is a row of byte symbols.  Rows of like length share a padded matrix; in
each round every row merges its leftmost pair of the least rank, found by ``argmin`` over a matrix of pair
ranks, closes the gap, and looks up the two pairs that are new through an open-addressing hash table of
pairs.  Rows without a known pair leave the matrix.  A row longer than ``LONG`` symbols runs the same rule
alone over blocks with kept block minima, so that a round costs about its square root and not its length.

Rows: a null text is empty; empty texts have no ids; a null id and repeated rows stay as they are; other
columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_groups, id_text, ragged
from .pieces import PieceTable, chunk_of, parted, worker_table

NONE = np.int32(2**31 - 1)
LONG = 512


class PairHash:
    """Open addressing with linear probes: pair of symbols -> rank of their union."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(len(rank) * 3).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.ranks = np.full(1 << bits, NONE, dtype=np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = self.keys[slot[todo]] == -1
            first = todo[free]
            _, pick = np.unique(slot[first], return_index=True)
            won = first[pick]
            self.keys[slot[won]], self.ranks[slot[won]] = key[won], rank[won]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; ``NONE`` for unknown pairs and where a symbol is negative (padding)."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.size, NONE, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        key = left[todo].astype(np.int64) << 32 | right[todo].astype(np.int64)
        slot = self._slot(key)
        while len(todo):
            there = self.keys[slot]
            hit = there == key
            out[todo[hit]] = self.ranks[slot[hit]]
            go = ~hit & (there != -1)
            todo, key, slot = todo[go], key[go], (slot[go] + 1) & self.mask
        return out.reshape(shape)


class MatrixBpe:
    """Encoder and decoder of one rank file (lines of base64 token and rank)."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.token = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.token[r] = t
        self.byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        if (self.byte < 0).any():
            raise ValueError("the rank file lacks single bytes")
        found = [(self.ranks[t[:i]], self.ranks[t[i:]], r) for t, r in self.ranks.items() for i in range(1, len(t))
                 if t[:i] in self.ranks and t[i:] in self.ranks]
        left, right, rank = np.array(found or [(0, 0, 0)][:0], dtype=np.int32).reshape(-1, 3).T
        self.pairs = PairHash(left, right, rank)
        self.split = regex.compile(pattern)

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece (no split pattern): length buckets, one matrix for each."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            r = self.ranks.get(p)
            if r is not None or not p:
                out[i] = np.array([r] if p else [], dtype=np.uint32)
            elif len(p) > LONG:
                out[i] = self._long(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for bits, rows in buckets.items():
            step = max(1, (1 << 20) >> bits)
            for a in range(0, len(rows), step):
                self._matrix(pieces, rows[a: a + step], 1 << bits, out)
        return out

    def _matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list) -> None:
        size = np.array([len(pieces[i]) for i in rows])
        sym = np.full((len(rows), width), -1, dtype=np.int32)
        at = np.arange(width)
        sym[at < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces[i] for i in rows), dtype=np.uint8)]
        rank = np.full((len(rows), width), NONE, dtype=np.int32)
        rank[:, :-1] = self.pairs.get(sym[:, :-1], sym[:, 1:])
        rows = np.array(rows)
        while len(rows):
            best = rank.argmin(axis=1)
            every = np.arange(len(rows))
            least = rank[every, best]
            done = least == NONE
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[rows[k]] = sym[k, : size[k]].astype(np.uint32)
                go = ~done
                sym, rank, rows, size, best, least = sym[go], rank[go], rows[go], size[go], best[go], least[go]
                if not len(rows):
                    break
                width = int(size.max())
                sym, rank, at, every = sym[:, :width], rank[:, :width], np.arange(width), np.arange(len(rows))
            after = at > best[:, None]
            for m, fill in ((sym, -1), (rank, NONE)):  # close the gap to the right of the merged symbol
                moved = np.full_like(m, fill)
                moved[:, :-1] = m[:, 1:]
                m[after] = moved[after]
            sym[every, best] = least
            size -= 1
            nxt = np.minimum(best + 1, width - 1)
            rank[every, best] = self.pairs.get(least, np.where(best + 1 < size, sym[every, nxt], -1))
            has = best > 0
            rank[every[has], best[has] - 1] = self.pairs.get(sym[every[has], best[has] - 1], least[has])

    def _long(self, piece: bytes, block: int = 256) -> np.ndarray:
        n = len(piece)
        blocks = -(-n // block)
        sym = np.full(blocks * block, -1, dtype=np.int32)
        sym[:n] = self.byte[np.frombuffer(piece, dtype=np.uint8)]
        rank = np.full(blocks * block, NONE, dtype=np.int32)
        rank[: n - 1] = self.pairs.get(sym[: n - 1], sym[1:n])
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        grid = rank.reshape(blocks, block)
        low = grid.min(axis=1)
        ranks, token = self.ranks, self.token

        def renew(i: int) -> None:
            j = int(nxt[i])
            rank[i] = NONE if j >= n else ranks.get(token[sym[i]] + token[sym[j]], NONE)

        while True:
            b = int(low.argmin())
            if low[b] == NONE:
                break
            i = b * block + int(grid[b].argmin())
            j = int(nxt[i])
            sym[i], sym[j], rank[j] = rank[i], -1, NONE
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            renew(i)
            touched = {i // block, j // block}
            if prv[i] >= 0:
                renew(int(prv[i]))
                touched.add(int(prv[i]) // block)
            for t in touched:
                low[t] = grid[t].min()
        return sym[:n][sym[:n] >= 0].astype(np.uint32)

    def encode_chunks(self, keys: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks (see :mod:`.pieces`): matches of the pattern, each distinct one encoded once."""
        distinct: dict[str, int] = {}
        rows, counts = [], []
        for k in keys:
            found = self.split.findall(chunk_of(k))
            counts.append(len(found))
            rows += [distinct.setdefault(m, len(distinct)) for m in found]
        ids, starts, lengths = parted(self.encode_pieces([m.encode("utf-8") for m in distinct]))
        n = lengths[rows]
        cum = np.concatenate([[0], np.cumsum(n)])
        bounds = cum[np.concatenate([[0], np.cumsum(counts)])]
        return ids[ragged(starts[rows], n)], bounds[:-1], np.diff(bounds)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.token.__getitem__, ids.tolist()))


_CODERS: dict = {}


def _coder(rank_file: bytes, pattern: str) -> MatrixBpe:
    key = (hash(rank_file), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = MatrixBpe(rank_file, pattern)
    return _CODERS[key]


def _emit(ids: pa.Array, payload: list, extra: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids, pa.array(payload, pa.binary()), pa.array(extra, pa.int64())], names=names)


def encode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (binary, little-endian unsigned 32-bit), ``n_tokens`` for every row.

    The rank file (a few MB whatever the input) is read on the driver and broadcast.
    """
    with open(rank_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        coder = _coder(data, pattern)
        table = worker_table(("bpe", hash(data), pattern), lambda: PieceTable(coder.encode_chunks, True, capacity=300_000))
        for b in batches:
            for ids, texts in arrow_groups(b.column(0), b.column(1)):
                got = table.encode(texts)
                yield _emit(ids, [x.astype("<u4").tobytes() for x in got], [len(x) for x in got], [id_col, "ids", "n_tokens"])

    return id_text(df, id_col, text_col).mapInArrow(run, f"`{id_col}` long, ids binary, n_tokens long")


def decode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``df`` (``id_col``, ``ids_col``, ``n_tokens``) with ``decoded`` (binary): the bytes that the ids stand for."""
    with open(rank_path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value, pattern)
        for b in batches:
            size, start = 0, 0
            out: list = []
            for i, raw in enumerate(b.column(1)):
                out.append(coder.decode(np.frombuffer(raw.as_buffer() or b"", dtype="<u4")))
                size += len(out[-1])
                if size > 1 << 22 or i == b.num_rows - 1:
                    part = b.slice(start, i + 1 - start)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[id_col, ids_col, "n_tokens", "decoded"])
                    size, start, out = 0, i + 1, []

    return df.select(id_col, ids_col, "n_tokens").mapInArrow(run, f"`{id_col}` long, `{ids_col}` binary, n_tokens long, decoded binary")
