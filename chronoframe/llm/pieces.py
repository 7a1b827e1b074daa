"""Token ids of whole texts by way of the distinct chunks between spaces.

A byte-level tokenizer never joins a character with a space that follows it, so a text may be cut before
every space that is not itself followed by white space, and each distinct chunk is encoded once.  A
tokenizer that drops white space may be cut at every blank and line feed.  Both keep letters apart from a full stop or
comma, which is cut off where a letter stands before it and a space or the end behind it.  Texts are split and
their words numbered by Arrow; Python sees the distinct words of a group of texts only.  The table of known
chunks holds about ``capacity`` of them; later ones are encoded again when they return, so memory is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import ragged

# White space of the tokenizers' patterns: Python's also has U+001C to U+001F.
_RUNS = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
# The sign of a chunk without a space before it, and texts that are cut by _RUNS: those with the sign, or with a
# space before any kind of white space.
_BARE = "\x03"
_SLOW = r" [\s\x0b\x1c-\x1f\x{85}\p{Z}]|\x03"
_STOP = r"(\p{L})([.,])( |$)"


def chunk_of(key) -> str:
    """Keys of chunks: ``w`` stands for a space followed by ``w``, ``(c,)`` for ``c`` itself."""
    return key[0] if type(key) is tuple else " " + key


class PieceTable:
    """Ids of distinct chunks. ``encode_many(keys)`` gives the ids of chunks as one array, and the start and
    length of each chunk's part of it.  ``spaced`` says whether a space belongs to the chunk that it begins or is
    dropped like a line feed.  Chunks are kept until there are ``capacity`` of them, or as many characters as
    ``16 * capacity``."""

    def __init__(self, encode_many: Callable[[list], tuple[np.ndarray, np.ndarray, np.ndarray]], spaced: bool, capacity: int = 600_000):
        self.encode_many, self.spaced, self.capacity = encode_many, spaced, capacity
        self.index: dict = {}
        self.flat = np.zeros(1 << 20, dtype=np.uint32)
        self.start = np.zeros(1 << 16, dtype=np.int64)
        self.length = np.zeros(1 << 16, dtype=np.int32)
        self.used = self.chars = 0

    def _rows(self, keys: list) -> np.ndarray:
        """Row of each key; unknown keys are encoded and put after the kept rows, where they stay until the next
        call at least."""
        index = self.index
        rows = np.fromiter(map(index.get, keys, repeat(-1)), dtype=np.int64, count=len(keys))
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return rows
        kept = len(index)
        fresh: dict = {}
        rows[missing] = [fresh.setdefault(keys[i], kept + len(fresh)) for i in missing.tolist()]
        ids, starts, lengths = self.encode_many(list(fresh))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used // 2 + len(ids), dtype=np.uint32)])
        if kept + len(fresh) > len(self.start):
            grow = kept // 2 + len(fresh)
            self.start = np.concatenate([self.start[:kept], np.zeros(grow, dtype=np.int64)])
            self.length = np.concatenate([self.length[:kept], np.zeros(grow, dtype=np.int32)])
        at = slice(kept, kept + len(fresh))
        self.flat[self.used: self.used + len(ids)] = ids
        self.start[at] = self.used + starts
        self.length[at] = lengths
        if kept < self.capacity and self.chars < 16 * self.capacity:
            index.update(fresh)
            self.used += len(ids)
            self.chars += sum(map(len, map(chunk_of, fresh)))
        return rows

    def encode(self, texts, block: int = 1 << 20) -> list[np.ndarray]:
        """Ids (uint32) of each text (list or Arrow array); a null text has none."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        texts = pc.fill_null(texts, "")
        odd = np.zeros(0, dtype=np.int64)
        plain = texts
        if self.spaced:
            match = pc.match_substring_regex(texts, _SLOW)
            odd = np.flatnonzero(match.to_numpy(zero_copy_only=False))
            if len(odd):
                plain = pc.if_else(match, "", texts)
            plain = pc.replace_substring_regex(plain, _STOP, rf"\1 {_BARE}\2\3")
        else:  # such tokenizers lower the case; capitals of ASCII may go at once where no mark can join a letter
            plain = pc.replace_substring(texts, "\n", " ")
            plain = pc.if_else(pc.match_substring_regex(plain, r"\p{M}"), plain, pc.ascii_lower(plain))
            # U+0130 is the one capital whose lower case ends with a mark, which joins what follows
            plain = pc.if_else(pc.match_substring(plain, "\u0130"), plain, pc.replace_substring_regex(plain, _STOP, r"\1 \2\3"))
        split = pc.split_pattern(plain, " ")
        ends = np.asarray(split.offsets, dtype=np.int64)
        words = split.flatten().dictionary_encode()
        known = words.dictionary.to_pylist()
        number = words.indices.to_numpy(zero_copy_only=False)
        if self.spaced:  # a text's first word has no space before it
            first = [(known[i],) for i in number[ends[:-1]].tolist()]
            known = [(w[1:],) if w[:1] == _BARE else w for w in known]
            rows = self._rows(known + first)
            codes = rows[: len(known)][number]
            codes[ends[:-1]] = rows[len(known):]
        else:
            codes = self._rows(known)[number]
        out = self._gather(codes, ends, block)
        for i in odd.tolist():
            runs = [(c,) for c in _RUNS.findall(texts[i].as_py())]
            part = [self._gather(self._rows(runs[a: a + block]), np.array([0, len(runs[a: a + block])]), block)[0] for a in range(0, len(runs), block)]
            out[i] = np.concatenate(part)
        return out

    def _gather(self, codes: np.ndarray, ends: np.ndarray, block: int) -> list[np.ndarray]:
        """Ids of the texts whose words are ``codes[ends[i]: ends[i + 1]]``, about ``block`` ids at a time."""
        n = self.length[codes].astype(np.int64)
        cum = np.concatenate([[0], np.cumsum(n)])
        bounds = cum[ends]
        out: list[np.ndarray] = []
        a = 0
        while a < len(ends) - 1:
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + block, side="right")) - 1)
            b = min(b, len(ends) - 1)
            x, y = ends[a], ends[b]
            ids = self.flat[ragged(self.start[codes[x:y]], n[x:y])]
            out += np.split(ids, bounds[a + 1: b] - bounds[a])
            a = b
        return out


_TABLES: dict = {}


def worker_table(key, make: Callable[[], PieceTable]) -> PieceTable:
    """One table for each Python worker and vocabulary; the worker keeps it for its later tasks."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]


def parted(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Arrays one after another, with the start and length of each."""
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    return np.concatenate([np.zeros(0, dtype=np.uint32), *ids]), np.cumsum(lengths) - lengths, lengths


def library_table(vocabulary: bytes, spaced: bool, capacity: int = 600_000) -> PieceTable:
    """Table over a vocabulary file of the ``tokenizers`` library (strings of special tokens in a text are
    ordinary text).

    New chunks with a space are given to the library many at a time, as one text.  Where every chunk has one id
    that tells its begin or end by the vocabulary, that id parts them; else a mark after each does.  Other chunks,
    and those that hold the mark, go alone.
    """
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_buffer(vocabulary)
    tok.encode_special_tokens = True
    mark = "\x01"
    sign = tok.encode(" " + mark, add_special_tokens=False).ids
    flag = np.zeros(tok.get_vocab_size(with_added_tokens=True), dtype=bool)  # ids that begin with a space, or end a word
    for t, i in tok.get_vocab(with_added_tokens=True).items():
        flag[i] = t.startswith("\u0120") if spaced else t.endswith("</w>")

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def joined(keys: list, between: str) -> np.ndarray:
        texts = [" " + f"{between} ".join(keys[a: a + 4096]) + between for a in range(0, len(keys), 4096)]
        return np.concatenate([np.zeros(0, dtype=np.uint32), *ids_of(texts)])

    def flagged(keys: list):
        """Many chunks as one text: every chunk has one id with the flag (its first, or its last)."""
        ids = joined(keys, "")
        at = np.flatnonzero(flag[ids])
        if len(at) != len(keys):
            return None
        starts = at if spaced else np.concatenate([[0], at[:-1] + 1])[: len(at)]
        ends = np.concatenate([at[1:], [len(ids)]])[: len(at)] if spaced else at + 1
        return ids, starts, ends - starts

    def marked(keys: list):
        """Many chunks as one text with a mark after each."""
        ids = joined(keys, " " + mark)
        ends = np.flatnonzero(ids == sign[0])
        if len(ends) != len(keys):
            raise ValueError("the tokenizer joins chunks across a space")
        starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
        return ids, starts, ends - starts

    def encode_many(keys: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        easy = np.array([type(k) is str and k != "" and mark not in k and len(sign) == 1 for k in keys], dtype=bool)
        sure = easy if spaced else np.array([e and k.isalpha() for e, k in zip(easy.tolist(), keys)], dtype=bool)
        starts, lengths = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        parts, total = [], 0
        for pick, how in ((sure, flagged), (easy & ~sure, marked), (~easy, lambda k: parted(ids_of([chunk_of(x) for x in k])))):
            chosen = [keys[i] for i in np.flatnonzero(pick).tolist()]
            if chosen:
                ids, at, n = how(chosen) or marked(chosen)
                parts.append(ids)
                starts[pick], lengths[pick] = total + at, n
                total += len(ids)
        return np.concatenate([np.zeros(0, dtype=np.uint32), *parts]), starts, lengths

    return PieceTable(encode_many, spaced, capacity)
