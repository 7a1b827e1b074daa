"""Near-duplicate documents by BagMinHash over multisets of word shingles.

A text's shingles (five words; a shorter text is one shingle) with their counts form a multiset.  BagMinHash
gives signatures whose components agree with the probability of the multisets' Jaccard index
(sum of least counts over sum of greatest counts): every shingle carries a hierarchy of Poisson processes, one
for each weight interval [0, 1), [1, 2), [2, 4), [4, 8), … with the interval's length as its rate; a point of
it has a time, a signature component, and a weight drawn inside the interval, and takes part if that weight is
below the shingle's count.  A component holds the time of its earliest point.  The processes of a shingle are
seeded by its hash, so equal shingles bring equal points, and a count of n costs about log n processes.  Points
are made in ascending time and only up to a limit at which all components are expected to be filled; a text
with an empty component is run again with a longer limit.

Signatures are cut into bands; texts with an equal band are candidates.  Each band's texts are linked to its
least id only, and the components of those links are the groups to verify.  A group's texts meet in tiles of
bounded bytes (a large group is dealt over blocks, and every pair of blocks meets once), where an inverted
index counts the multiset overlap of all its pairs exactly; a tile returns one row for each text, with the
number of its links and a spanning forest of them.  No pair is ever written out.

Texts that are equal as bytes are one class from the start (by sha256), represented by their least id.

Rows: a text without a word (null, empty, white space) is compared with nothing; ids must not be null to be
compared: a null id is kept as its own row; rows that repeat an id are one document, of the text with the least sha256; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, shuffle_partitions
from .common import id_text, mix64, ragged, text_groups
from .components import components

WORD = re.compile(r"[^ \t\n\r\f\v]+")
U = np.uint64


class Shingler:
    """Hashes of a text's shingles; the hashes of known words are kept up to ``capacity`` of them."""

    def __init__(self, words: int = 5, capacity: int = 300_000):
        self.words, self.capacity, self.known = words, capacity, {}

    def word_hashes(self, words: list[str]) -> np.ndarray:
        known, out = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                h = int.from_bytes(hashlib.blake2b(w.encode("utf-8"), digest_size=8).digest(), "little")
                if len(known) < self.capacity:
                    known[w] = h
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def shingles(self, text: str | None) -> np.ndarray:
        """Hash of every shingle in text order (with repeats)."""
        h = self.word_hashes(WORD.findall(text or ""))
        if not len(h):
            return h
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for j in range(k):
            out = mix64(out * U(0x100000001B3) + h[j: len(h) - k + 1 + j])
        return out


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers above 0 and at most 1."""
    return ((x >> U(11)).astype(np.float64) + 1.0) * 2.0**-53


def bag_minhash(bags: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Signatures (rows of ``size`` times) of non-empty multisets, given as distinct hashes and counts."""
    n = len(bags)
    out = np.full((n, size), np.inf)
    key = np.concatenate([b[0] for b in bags])
    count = np.concatenate([b[1] for b in bags]).astype(np.float64)
    doc = np.repeat(np.arange(n), [len(b[0]) for b in bags])
    weight = np.array([b[1].sum() for b in bags], dtype=np.float64)
    limit = size * (np.log(size) + 5.0) / weight
    left = np.arange(n)
    while len(left):
        chosen = np.zeros(n, dtype=bool)
        chosen[left] = True
        mine = chosen[doc]
        _points(key[mine], count[mine], doc[mine], limit, out)
        left = left[np.isinf(out[left]).any(axis=1)]
        out[left] = np.inf
        limit[left] *= 2
    return out


def _points(key: np.ndarray, count: np.ndarray, doc: np.ndarray, limit: np.ndarray, out: np.ndarray) -> None:
    size = out.shape[1]
    flat = out.reshape(-1)
    level, low, length = 0, 0.0, 1.0
    while len(key):  # intervals of weight [0, 1), [1, 2), [2, 4), …
        seed = mix64(key + U((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        time, cap, owner, c = np.zeros(len(key)), limit[doc], doc, count
        step = 0
        while len(seed):
            step += 1
            x = mix64(seed + U(step * 0xD1B54A32D192ED03 & (2**64 - 1)))
            time = time - np.log(uniform(x)) / length
            go = time <= cap
            if not go.all():
                seed, time, cap, owner, c, x = seed[go], time[go], cap[go], owner[go], c[go], x[go]
            if not len(seed):
                break
            y = mix64(x ^ U(0xA0761D6478BD642F))
            part = (y >> U(32)) % U(size)
            hit = owner * size + part.astype(np.int64)
            at = time
            if level:  # the point's weight inside the interval
                inside = low + (y & U(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * length < c
                hit, at = hit[inside], time[inside]
            np.minimum.at(flat, hit, at)
        low, length, level = low + length, (1.0 if level == 0 else length * 2), level + 1
        more = count > low
        key, count, doc = key[more], count[more], doc[more]


def elements(shingles: np.ndarray) -> np.ndarray:
    """The multiset as a set: the k-th occurrence of a shingle is an element of its own."""
    key, count = np.unique(shingles, return_counts=True)
    nth = ragged(np.zeros(len(count), dtype=np.int64), count).astype(np.uint64)
    return mix64(np.repeat(key, count) + nth * U(0x9E3779B97F4A7C15))


def tile_links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exact overlap of sets of elements: all pairs inside ``left``, or between ``left`` and ``right``.

    Gives for each set (left, then right) its number of links, and a spanning forest as two arrays.
    """
    sets = left + (right or [])
    n, first = len(sets), len(left)
    size = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    if not len(owner):
        return np.zeros(n, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    by = np.argsort(code, kind="stable")
    posting = owner[by]                       # sets of each element, ascending
    many = np.bincount(code)
    begin = np.cumsum(many) - many
    ends = np.cumsum(size)
    links = np.zeros(n, dtype=np.int64)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    a, b = [], []
    for i in range(first):
        mine = code[ends[i] - size[i]: ends[i]]
        mine = mine[many[mine] > 1]
        if not len(mine):
            continue
        both = np.bincount(posting[ragged(begin[mine], many[mine])], minlength=n)
        other = slice(i + 1, n) if right is None else slice(first, n)
        c = both[other]
        hit = np.flatnonzero(c >= threshold * (size[i] + size[other] - c) - 1e-9) + other.start
        hit = hit[both[hit] > 0]
        links[i] += len(hit)
        links[hit] += 1
        for j in hit.tolist():
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(i)
                b.append(j)
    return links, np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def signatures(df: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """``_id, text_key`` (sha256 of the text)``, bytes, bands`` (array of hashes; empty without words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for b in batches:
            for ids, texts in text_groups(b.column(0), b.column(1)):
                raw = [(t or "").encode("utf-8") for t in texts]
                bags = [np.unique(shingler.shingles(t), return_counts=True) for t in texts]
                full = [i for i, (k, _) in enumerate(bags) if len(k)]
                out: list = [[]] * len(texts)
                if full:
                    sig = bag_minhash([bags[i] for i in full], bands * rows).view(np.uint64).reshape(len(full), bands, rows)
                    h = np.arange(1, bands + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15)
                    for r in range(rows):
                        h = mix64(h + sig[:, :, r])
                    for k, i in enumerate(full):
                        out[i] = h[k].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([hashlib.sha256(r).digest() for r in raw], pa.binary()), pa.array([len(r) for r in raw], pa.int64()), pa.array(out, pa.list_(pa.int64()))],
                                                 names=["_id", "text_key", "bytes", "bands"])

    return id_text(df, id_col, text_col).mapInArrow(run, "_id long, text_key binary, bytes long, bands array<long>")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, words: int = 5, bands: int = 36,
                    rows: int = 6, block_bytes: int = 8 << 20) -> DataFrame:
    """``id_col, rep_id, n_links, component_id, kept`` for every row: the least id with an equal text, the
    number of other different texts linked to it directly, the least id of the group, and whether the row's
    id is that."""
    spark = df.sparkSession
    sigs = materialize(signatures(df, id_col, text_col, words, bands, rows), "signatures")
    compared = sigs.where((F.size("bands") > 0) & F.col("_id").isNotNull())
    one = compared.groupBy("_id").agg(F.min("text_key").alias("text_key"))
    reps = materialize(one.groupBy("text_key").agg(F.min("_id").alias("rep")), "classes")
    marked = compared.select(F.col("_id").alias("rep"), "text_key", "bytes", "bands").join(reps, ["rep", "text_key"], "left_semi")
    banded = marked.select("rep", F.explode("bands").alias("band")).distinct()
    least = banded.groupBy("band").agg(F.min("rep").alias("low"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    groups = components(banded.join(least, "band").where("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")))
    groups = groups.select(F.col("node").alias("rep"), F.col("component").alias("grp"))
    sized = groups.join(marked.select("rep", "text_key", "bytes").distinct(), "rep")
    total = sized.groupBy("grp").agg(F.ceil(F.sum("bytes") / F.lit(block_bytes)).alias("blocks"))
    placed = sized.join(total, "grp").withColumn("block", F.pmod(F.xxhash64("rep"), F.greatest("blocks", F.lit(1))).cast("int"))
    placed = materialize(placed.select("grp", "rep", "text_key", "blocks", "block"), "groups")
    member = placed.select("rep", "text_key", "grp", "block", F.explode(F.sequence(F.lit(0), (F.greatest("blocks", F.lit(1)) - 1).cast("int"))).alias("other"))
    tiles = member.select("rep", "text_key", "grp", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).alias("second"))
    texts = id_text(df, id_col, text_col).select(F.col("_id").alias("rep"), F.col("_text"), F.sha2(F.col("_text").cast("binary"), 256).alias("_key"))
    # one shuffle of the texts at every size, so that its cost follows the input
    needed = texts.join(placed.select("rep", F.lower(F.hex("text_key")).alias("_key")).hint("merge"), ["rep", "_key"], "left_semi")
    needed = materialize(needed.dropDuplicates(["rep"]).select("rep", "_text"), "candidates")
    rows_in = tiles.join(needed, "rep").select("grp", "i", "j", "second", "rep", "_text")
    found = materialize(verify(rows_in, threshold, words), "verified")
    classes = components(found.where(F.col("parent").isNotNull()).select(F.col("rep").alias("a"), F.col("parent").alias("b")))
    links = found.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    least_of = reps.join(classes.select(F.col("node").alias("rep"), F.col("component")), "rep", "left").join(links, "rep", "left")
    least_of = least_of.select(F.col("text_key"), F.col("rep"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    of_id = one.join(least_of, "text_key").select("_id", "rep", "n_links", "component_id")
    return sigs.select("_id").join(of_id, "_id", "left").select(F.col("_id").alias(id_col), F.coalesce("rep", "_id").alias("rep_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                               F.coalesce("component_id", "_id").alias("component_id"), F.coalesce(F.col("_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def verify(rows: DataFrame, threshold: float, words: int) -> DataFrame:
    """``rep, n_links, parent`` of the texts in each tile ``(grp, i, j)``; a text of block j is ``second``."""
    n = 2 * shuffle_partitions(rows.sparkSession)
    dealt = rows.repartition(n, "grp", "i", "j").sortWithinPartitions("grp", "i", "j", "second", "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        key, reps, sets, first = None, [], [], 0

        def tile() -> Iterator[pa.RecordBatch]:
            if not reps:
                return
            inside = key[1] == key[2]
            links, a, b = tile_links(sets[:] if inside else sets[:first], None if inside else sets[first:], threshold)
            r = np.array(reps, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([r, r[a]]), pa.int64()), pa.array(np.concatenate([links, np.zeros(len(a), dtype=np.int64)]), pa.int64()),
                                              pa.array([None] * len(r) + r[b].tolist() if len(b) else [None] * len(r), pa.int64())], names=["rep", "n_links", "parent"])

        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(5)]
            for row, (grp, i, j, second, rep) in enumerate(zip(*cols)):
                if (grp, i, j) != key:
                    yield from tile()
                    key, reps, sets, first = (grp, i, j), [], [], 0
                reps.append(rep)
                sets.append(elements(shingler.shingles(batch.column(5)[row].as_py())))
                first += not second
        yield from tile()

    return dealt.mapInArrow(run, "rep long, n_links long, parent long")
