"""Alignment of two tokenizers on the same texts, and how often their ids stand together.

Inside a task everything is columns of Arrow: token lists are flattened with their parent indices, running sums
of token bytes less the sum before the text are end offsets, a hash join of the two sides on (text, end) gives
the cuts, and ``group_by`` counts the linked id pairs.  Spark merges the partial counts.  A second pass reads the
links that the first has written: pairs of many documents are looked up in a broadcast table of at most
``keep_pairs`` rows, all others are joined, so no count is left out whatever the number of pairs.

Rows: null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no
tokens (zeros, and '' for the digest); null ids and repeated rows stay as they are, each row counting as a document of
its own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import arrow_groups, id_text, ragged
from .pieces import parted, worker_table

LINKS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "pair array<long>, times array<long>")
RESULT = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "n_best long, count_sum long, pair array<long>, times array<long>")


# Texts that are not words between single spaces: a space at either end or before white space of any kind (then the
# byte-level pattern looks further), or the sign that the pieces have for a space.
_ODD = r"^ | $| [\s\x0b\x1c-\x1f\x{85}\p{Z}]|\x{2581}"


# ---------------------------------------------------------------- the two vocabularies

def _byte_level() -> dict[str, int]:
    """Signs of a byte-level vocabulary: visible Latin-1 characters are their own byte, the other bytes follow
    from U+0100 on in their order."""
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    hidden = sorted(set(range(256)) - set(seen))
    return {chr(b): b for b in seen} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Store:
    """Id arrays of words one after another, found by row."""

    def __init__(self):
        self.flat, self.start, self.length = np.zeros(1 << 16, dtype=np.uint32), np.zeros(1 << 12, dtype=np.int64), np.zeros(1 << 12, dtype=np.int32)

    def put(self, row: int, used: int, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Rows from ``row`` on; rows and ids that stood there are given up."""
        for name, least in (("flat", used + len(ids)), ("start", row + len(lengths)), ("length", row + len(lengths))):
            old = getattr(self, name)
            if least > len(old):
                setattr(self, name, np.concatenate([old, np.zeros(least - len(old) // 2, dtype=old.dtype)]))
        self.flat[used: used + len(ids)] = ids
        self.start[row: row + len(lengths)] = used + np.cumsum(lengths) - lengths
        self.length[row: row + len(lengths)] = lengths

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.length[rows].astype(np.int64)
        return self.flat[ragged(self.start[rows], n)], n


class Words:
    """Ids of both tokenizers for words between single spaces, each with the space before it.

    Neither joins across such a space: the byte-level pattern begins a new match there, and no piece holds a space
    after another character (else whole texts are encoded).  New words go to the libraries many at a time, as one text;
    the bytes of the tokens tell where each word ends.  The first ``capacity`` words stay."""

    def __init__(self, tok, model, bytes_a: pa.Array, bytes_b: pa.Array, capacity: int):
        self.tok, self.model, self.capacity = tok, model, capacity
        self.sizes = [np.asarray(pc.binary_length(b), dtype=np.int64) for b in (bytes_a, bytes_b)]
        self.apart = not any(b" " in p.lstrip(b" ") for p in bytes_b.to_pylist())
        self.index: dict[str, int] = {}
        self.stores, self.used = (Store(), Store()), [0, 0]

    def whole(self, texts: list[str]) -> tuple[list, list]:
        """Ids of space + text and of text."""
        a = self.tok.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in a], self.model.encode(texts, num_threads=1)

    def _new(self, words: list[str], size: np.ndarray, at_once: int = 1024) -> list[tuple[np.ndarray, np.ndarray]]:
        ends = np.cumsum(size + 1)
        lists = self.whole([" ".join(words[a: a + at_once]) for a in range(0, len(words), at_once)])
        out = []
        for side in (0, 1):
            ids = np.fromiter(chain.from_iterable(lists[side]), dtype=np.uint32)
            run = np.cumsum(self.sizes[side][ids])
            last = np.searchsorted(run, ends)
            if not len(ids) or last[-1] >= len(run) or not np.array_equal(run[last], ends):
                one = self.whole(words)[side]      # a word that is not given back byte by byte
                out.append((np.fromiter(chain.from_iterable(one), dtype=np.uint32), np.array(list(map(len, one)), dtype=np.int64)))
            else:
                out.append((ids, np.diff(last, prepend=-1)))
        return out

    def _rows(self, words: pa.Array) -> np.ndarray:
        known = words.to_pylist()
        rows = np.fromiter(map(self.index.get, known, repeat(-1)), dtype=np.int64, count=len(known))
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            fresh = [known[i] for i in missing.tolist()]
            at = len(self.index)
            got = self._new(fresh, np.asarray(pc.binary_length(words.take(pa.array(missing))), dtype=np.int64))
            rows[missing] = np.arange(at, at + len(fresh))
            for side, (ids, lengths) in enumerate(got):
                self.stores[side].put(at, self.used[side], ids, lengths)
            if at < self.capacity and sum(self.used) < 16 * self.capacity:
                self.index.update(zip(fresh, range(at, at + len(fresh))))
                self.used = [u + len(ids) for u, (ids, _) in zip(self.used, got)]
        return rows

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides of each text; an empty text may have some (of the space)."""
        odd = pc.match_substring_regex(texts, _ODD) if self.apart else pa.array([True] * len(texts))
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        words = split.flatten().dictionary_encode()
        rows = self._rows(words.dictionary)[words.indices.to_numpy(zero_copy_only=False)]
        ends = np.asarray(split.offsets, dtype=np.int64)
        out = []
        for store in self.stores:
            ids, n = store.get(rows)
            out.append(np.split(ids, np.concatenate([[0], np.cumsum(n)])[ends[1:-1]]))
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        for side, lists in enumerate(self.whole([texts[i].as_py() for i in at])):
            for i, ids in zip(at, lists):
                out[side][i] = np.array(ids, dtype=np.uint32)
        return tuple(out)


class Aligner:
    """Both encoders of a worker, the bytes of their tokens, and the signs of the digest."""

    def __init__(self, vocabulary: bytes, model: bytes, capacity: int):
        import json

        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        tok, pieces = Tokenizer.from_buffer(vocabulary), SentencePieceProcessor(model_proto=model)
        tok.encode_special_tokens = True         # their strings in a text are plain text
        sign = _byte_level()
        known = json.loads(vocabulary)
        size = 1 + max([*known["model"]["vocab"].values(), *[t["id"] for t in known.get("added_tokens", [])]])
        spelled = [b""] * size
        for token, i in known["model"]["vocab"].items():
            spelled[i] = bytes(sign[c] for c in token) if all(c in sign for c in token) else token.encode()
        for token in known.get("added_tokens", []):
            spelled[token["id"]] = token["content"].encode()
        other = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else b"" if pieces.is_control(i) or pieces.is_unknown(i)
                 else pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(pieces.get_piece_size())]
        self.bytes_a, self.bytes_b = pa.array(spelled, pa.large_binary()), pa.array(other, pa.large_binary())
        self.words = Words(tok, pieces, self.bytes_a, self.bytes_b, capacity)
        self.size_a, self.size_b = len(self.bytes_a), len(self.bytes_b)
        self.signs = pa.array([f"{i}{end}" for n in (self.size_a, self.size_b) for i in range(n) for end in (",", "|", ";", "")], pa.large_string())

    def tokens(self, texts: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of both sides as list arrays; empty lists where the bytes are not those of space + text."""
        texts = pc.fill_null(texts, "")
        spaced = pc.binary_join_element_wise("", texts, " ")
        some = np.asarray(pc.binary_length(texts)) > 0
        a, b = self.words.encode(texts)
        none = np.zeros(0, dtype=np.uint32)
        keep = some.copy()
        for ids, spelled in ((a, self.bytes_a), (b, self.bytes_b)):
            keep &= self._same(ids, spelled, spaced.cast(pa.large_binary()))
        return tuple(_lists([x if k else none for x, k in zip(ids, keep.tolist())]) for ids in (a, b))

    @staticmethod
    def _same(ids: list[np.ndarray], spelled: pa.Array, want: pa.Array) -> np.ndarray:
        flat, starts, lengths = parted(ids)
        got = spelled.take(pa.array(flat.astype(np.int64)))
        offsets, data = _buffers(got)
        have = offsets[np.concatenate([starts, [len(flat)]])]
        want_at, want_data = _buffers(want)
        if np.array_equal(have, want_at) and np.array_equal(data[: have[-1]], want_data[: want_at[-1]]):
            return np.ones(len(ids), dtype=bool)
        return np.array([np.array_equal(data[a:b], want_data[x:y])
                         for a, b, x, y in zip(have[:-1].tolist(), have[1:].tolist(), want_at[:-1].tolist(), want_at[1:].tolist())], dtype=bool)

    def align(self, texts: pa.Array) -> dict:
        """Counts, digest and distinct links (``pair`` = A id * size of B + B id, and ``times``) of each text."""
        lists = self.tokens(texts)
        n = len(texts)
        ids, text_of, end = zip(*[_ends(x, y) for x, y in zip(lists, (self.bytes_a, self.bytes_b))])
        cut_a, cut_b = _cuts(end)
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        groups = int(cut_a.sum())
        group_text = text_of[0][cut_a]
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        key, times = self._links(ids, group_a, group_b, in_a, in_b, group_text)
        width = self.size_a * self.size_b
        bounds = np.searchsorted(key, np.arange(n + 1, dtype=np.int64) * width)
        links = np.zeros(n, dtype=np.int64)
        np.add.at(links, group_text, in_a * in_b)
        return {"n_a": np.bincount(text_of[0], minlength=n), "n_b": np.bincount(text_of[1], minlength=n), "n_links": links,
                "n_groups": np.bincount(group_text, minlength=n), "digest": self._digests(ids, text_of, (cut_a, cut_b), (group_a, group_b), (in_a, in_b), n),
                "bounds": bounds, "pair": key % width, "times": times}

    def _links(self, ids, group_a, group_b, in_a, in_b, group_text, step: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
        """Keys (text, A id, B id) in order with the number of linked occurrences.  In groups of many
        tokens equal ids are counted first, so a long group costs its distinct ids; at most about ``step`` pairs are
        formed at once."""
        many = in_a * in_b > 4 * (in_a + in_b)
        ga, a, ca = _counted(group_a, ids[0], many)
        gb, b, cb = _counted(group_b, ids[1], many)
        per = np.bincount(gb, minlength=len(in_b))
        first = np.cumsum(per) - per
        done = np.cumsum(per[ga])
        parts, at = [], 0
        while at < len(ga):
            to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + step, side="right")))
            g = ga[at:to]
            right = ragged(first[g], per[g])
            left = np.repeat(np.arange(at, to), per[g])
            key = (group_text[ga[left]].astype(np.int64) * self.size_a + a[left]) * self.size_b + b[right]
            parts.append(_summed(key, ca[left] * cb[right]))
            at = to
        if not parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        total = parts[0] if len(parts) == 1 else _summed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        order = np.argsort(total[0])
        return total[0][order], total[1][order]

    def _digests(self, ids, text_of, cuts, groups, within, n: int) -> list[str]:
        """sha256 of ``a1,a2|b1;a3|b2,b3`` of each text, '' without tokens: the signs are put in order by one ``take``,
        whose data are the texts' strings one after another."""
        before_b = np.cumsum(within[1]) - within[1]
        upto_a = np.cumsum(within[0])
        code = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
        code[np.arange(len(ids[0])) + before_b[groups[0]]] = ids[0] * 4 + cuts[0]
        last = np.append(text_of[1][1:] != text_of[1][:-1], True)[: len(ids[1])]
        code[np.arange(len(ids[1])) + upto_a[groups[1]]] = (self.size_a + ids[1]) * 4 + np.where(last, 3, 2 * cuts[1])
        offsets, data = _buffers(self.signs.take(pa.array(code)))
        tokens = np.bincount(text_of[0], minlength=n) + np.bincount(text_of[1], minlength=n)
        at = offsets[np.concatenate([[0], np.cumsum(tokens)])]
        return [hashlib.sha256(data[x:y]).hexdigest() if y > x else "" for x, y in zip(at[:-1].tolist(), at[1:].tolist())]


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    flat, starts, lengths = parted(ids)
    ends = np.concatenate([starts, [len(flat)]])
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64)))


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a large string or binary array that starts at its buffer's begin."""
    _, at, data = values.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[values.offset: values.offset + len(values) + 1] if at else np.zeros(1, dtype=np.int64)
    return offsets, np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)


def _ends(lists: pa.ListArray, spelled: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flattened ids, the text of each, and the byte offset at which each ends: over the texts one after another, so
    an end is also the key of its text."""
    ids = pc.list_flatten(lists)
    size = pc.binary_length(spelled).take(ids)
    return ids.to_numpy(), pc.list_parent_indices(lists).to_numpy(), pc.cumulative_sum(size.cast(pa.int64())).to_numpy()


def _cuts(end) -> tuple[np.ndarray, np.ndarray]:
    """Whether a token of either side ends where a token of the other does: a hash join on the text's start plus
    the end in the text (both sides have the same bytes in every text)."""
    side = [pa.table({"end": e, f"at{i}": np.arange(len(e), dtype=np.int32)}) for i, e in enumerate(end)]
    both = side[0].join(side[1], keys="end", join_type="inner", use_threads=False)
    out = [np.zeros(len(e), dtype=bool) for e in end]
    for i in (0, 1):
        out[i][both.column(f"at{i}").to_numpy()] = True
    return tuple(out)


def _counted(group: np.ndarray, ids: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, occurrences) in order of groups; equal ids are put together in the groups of ``many`` only."""
    big = many[group]
    if not big.any():
        return group, ids, np.ones(len(ids), dtype=np.int64)
    t = pa.table({"g": group[big], "i": ids[big]}).group_by(["g", "i"], use_threads=False).aggregate([([], "count_all")])
    g = np.concatenate([group[~big], t.column("g").to_numpy()])
    order = np.argsort(g, kind="stable")
    i = np.concatenate([ids[~big], t.column("i").to_numpy()])
    c = np.concatenate([np.ones(int((~big).sum()), dtype=np.int64), t.column("count_all").to_numpy()])
    return g[order], i[order], c[order]


def _summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t = pa.table({"k": key, "v": value}).group_by("k", use_threads=False).aggregate([("v", "sum")])
    return t.column("k").to_numpy(), t.column("v_sum").to_numpy()


# ---------------------------------------------------------------- the passes

def links(docs: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 250_000) -> DataFrame:
    """First pass: one row for each document with its counts, digest and distinct links, and rows without ``row``
    that hold partial counts of documents for id pairs (``pair``, ``times``)."""
    spark = docs.sparkSession
    files = []
    for path in (vocabulary, model):     # vocabularies: a few MB whatever the input
        with open(path, "rb") as f:
            files.append(f.read())
    shared = spark.sparkContext.broadcast(tuple(files))
    names = [f.split()[0] for f in LINKS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        raw = shared.value
        aligner = worker_table(("align", hash(raw)), lambda: Aligner(*raw, capacity))
        count = PairCount()
        for batch in batches:
            where = pa.array(np.arange(len(batch)))
            for at, texts in arrow_groups(where, batch.column(2), 1 << 20):
                got = aligner.align(texts)
                n = len(texts)
                lists = [pa.ListArray.from_arrays(pa.array(got["bounds"].astype(np.int32)), pa.array(got[c])) for c in ("pair", "times")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), *[pa.array(got[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")],
                     pa.array(got["digest"], pa.string()) if n else pa.array([], pa.string()), *lists], names)
                yield from count.add(got["pair"], names)
        yield from count.flush(names)

    rows = id_text(docs, id_col, text_col).select(F.monotonically_increasing_id().alias("row"), F.col("_id").alias("doc_id"), "_text")
    return rows.mapInArrow(run, LINKS)


class PairCount:
    """Documents for each id pair, counted over the groups of a task; sent on when they are ``limit`` pairs."""

    def __init__(self, limit: int = 1 << 20):
        self.limit, self.parts, self.rows = limit, [], 0

    def add(self, pair: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
        self.parts.append(_summed(pair, np.ones(len(pair), dtype=np.int64)))
        self.rows += len(self.parts[-1][0])
        if self.rows > self.limit:
            self._merge()
            if self.rows > self.limit // 2:
                yield from self.flush(names)

    def _merge(self) -> None:
        self.parts = [_summed(*[np.concatenate([p[i] for p in self.parts]) for i in (0, 1)])]
        self.rows = len(self.parts[0][0])

    def flush(self, names: list[str], size: int = 1 << 16) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        self._merge()
        pair, n = self.parts[0]
        for a in range(0, len(pair), size):
            lists = [pa.array([x[a: a + size]], pa.list_(pa.int64())) for x in (pair, n)]
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64())] * 6 + [pa.array([None], pa.string()), *lists], names)
        self.parts, self.rows = [], 0


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of the same A id has more."""
    n = (found.where(F.col("row").isNull()).select(F.inline(F.arrays_zip("pair", "times")))
              .groupBy("pair").agg(F.sum("times").alias("n")))
    n = materialize(n, "pair-counts")
    top = n.groupBy(F.expr(f"pair div {size_b}").alias("a")).agg(F.max("n").alias("top"))      # at most one row for each id of A
    return n.join(F.broadcast(top), F.expr(f"pair div {size_b}") == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _least_kept(counts: DataFrame, keep_pairs: int) -> int:
    """The least power of two so that at most ``keep_pairs`` pairs have that count or more."""
    of = {r[0]: r[1] for r in counts.groupBy(F.floor(F.log2("n")).cast("int").alias("e")).agg(F.count(F.lit(1)).alias("c")).collect()}
    e, held = max(of, default=0) + 1, 0
    while e > 0 and held + of.get(e - 1, 0) <= keep_pairs:
        e -= 1
        held += of.get(e, 0)
    return 1 << e


def align(docs: DataFrame, vocabulary: str, model: str, id_col: str = "doc_id", text_col: str = "text",
          keep_pairs: int = 1 << 20, capacity: int = 250_000) -> DataFrame:
    """One row for each document: ``n_a``, ``n_b`` tokens, ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best``
    (links whose pair's count is the highest of its A id) and ``count_sum`` (counts over the links).

    ``keep_pairs`` bounds the broadcast table of pairs (17 bytes each)."""
    from sentencepiece import SentencePieceProcessor

    spark = docs.sparkSession
    size_b = SentencePieceProcessor(model_file=model).get_piece_size()
    found = materialize(links(docs, vocabulary, model, id_col, text_col, capacity), "links")
    counts = pair_counts(found, size_b)
    least = _least_kept(counts, keep_pairs)
    often = counts.where(F.col("n") >= least).toArrow()
    order = np.argsort(often.column("pair").to_numpy())
    table = spark.sparkContext.broadcast((often.column("pair").to_numpy()[order], often.column("n").to_numpy()[order],
                                          often.column("best").to_numpy()[order]))
    names = [f.split()[0] for f in RESULT.split(", ")]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = table.value
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("pair"))
            text_of = pc.list_parent_indices(lists).to_numpy()
            key = pc.list_flatten(lists).to_numpy()
            times = pc.list_flatten(batch.column(batch.schema.get_field_index("times"))).to_numpy()
            slot = np.minimum(np.searchsorted(pair, key), max(len(pair) - 1, 0))
            hit = pair[slot] == key if len(pair) else np.zeros(len(key), dtype=bool)
            sums = [np.zeros(len(batch), dtype=np.int64) for _ in range(2)]
            np.add.at(sums[0], text_of[hit], times[hit] * best[slot[hit]])
            np.add.at(sums[1], text_of[hit], times[hit] * n[slot[hit]])
            rest = np.bincount(text_of[~hit], minlength=len(batch))
            ends = pa.array(np.concatenate([[0], np.cumsum(rest)]).astype(np.int32))
            left = [pa.ListArray.from_arrays(ends, pa.array(x[~hit])) for x in (key, times)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(7)] + [pa.array(s) for s in sums] + left, names)

    seen = materialize(found.where(F.col("row").isNotNull()).mapInArrow(look_up, RESULT), "counted")
    rare = counts.where(F.col("n") < least)
    rest = (seen.select("row", F.inline(F.arrays_zip("pair", "times"))).join(rare, "pair")
                .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum")))
    return seen.join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
