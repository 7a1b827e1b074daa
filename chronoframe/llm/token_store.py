"""Token ids in raw binary shards with a minimal perfect hash index over the document keys.

Layout of a store below one folder of a shared file system:

* ``payload/part-PPPPPP-SSSSS.bin``: ids only, little-endian unsigned 16-bit where the vocabulary allows it,
  else 32-bit; documents in ascending id order over the partitions P and their shards S;
* ``entries`` (Parquet): key, shard, offset and number of ids of each document, as written;
* ``index/bucket-BBBBBB.mph``: for the keys of one hash bucket a minimal perfect hash function (levels of bit
  arrays; a key's slot is the rank of its bit) and, by slot, a stored 32-bit fingerprint, shard, offset, length;
* ``store.json``: width of an id, bucket count.

A lookup hashes the key to its bucket, computes the slot, compares the fingerprint and reads the payload at
one place: constant time whatever the number of documents.  Keys are (id, occurrence): rows that repeat an id
are occurrences 0, 1, … in the order written (by text hash, then text), and a null id is a key of its own,
written first.  Null and empty texts hold the end id alone.  An empty table makes a store without shards.
Files are written under a task's own name and renamed, so a task that runs again leaves the same files.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.order import bucketed_position
from ..session import shuffle_partitions
from .common import arrow_groups, id_text, mix64
from .pieces import library_table, worker_table

SHARD_BITS = 20


def file_system(path: str):
    """File system and path of a URI or an absolute path, for driver and executors alike."""
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def _write(path: str, name: str, data: bytes) -> None:
    fs, root = file_system(path)
    fs.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
    with fs.open_output_stream(f"{root}/{name}") as out:
        out.write(data)


def shard_file(shard: int) -> str:
    return f"payload/part-{shard >> SHARD_BITS:06d}-{shard & ((1 << SHARD_BITS) - 1):05d}.bin"


# ---------------------------------------------------------------- minimal perfect hash

def key_hash(is_null: np.ndarray, ids: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    base = mix64(ids.astype(np.int64).view(np.uint64) + is_null.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    return mix64(base + mix64(occurrence.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D)))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix64(keys ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Levels of bit arrays: a key sits in the first level where no other key shares its place."""

    def __init__(self, bits: list[np.ndarray]):
        self.bits = bits
        self.base = np.concatenate([[0], np.cumsum([int(b.sum()) for b in bits])]).astype(np.int64)
        self.rank = [np.cumsum(b, dtype=np.int64) for b in bits]

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two document keys share a 64-bit hash")
        bits = []
        while len(keys):
            size = max(8, int(gamma * len(keys)))
            at = _place(keys, len(bits), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            keys = keys[~alone[at]]
        return cls(bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that is not in the set gets any slot, or −1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for level, b in enumerate(self.bits):
            at = _place(keys[todo], level, len(b))
            hit = b[at]
            out[todo[hit]] = self.base[level] + self.rank[level][at[hit]] - 1
            todo = todo[~hit]
        return out

    def to_bytes(self) -> bytes:
        head = json.dumps([len(b) for b in self.bits]).encode()
        return len(head).to_bytes(4, "little") + head + b"".join(np.packbits(b).tobytes() for b in self.bits)

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[PerfectHash, int]:
        """The function and the number of bytes it takes."""
        n = int.from_bytes(raw[:4], "little")
        at, bits = 4 + n, []
        for size in json.loads(raw[4: 4 + n]):
            use = -(-size // 8)
            bits.append(np.unpackbits(np.frombuffer(raw, np.uint8, use, at), count=size).astype(bool))
            at += use
        return cls(bits), at


RECORD = np.dtype([("mark", "<u4"), ("shard", "<i8"), ("offset", "<i8"), ("n_tokens", "<i8")])


class KeyIndex:
    """Index of one bucket: perfect hash function and records by slot."""

    def __init__(self, raw: bytes):
        self.function, at = PerfectHash.from_bytes(raw)
        self.records = np.frombuffer(raw, dtype=RECORD, offset=at)

    @staticmethod
    def pack(keys: np.ndarray, shard: np.ndarray, offset: np.ndarray, n_tokens: np.ndarray) -> bytes:
        f = PerfectHash.build(keys)
        records = np.zeros(len(keys), dtype=RECORD)
        slot = f.slots(keys)
        for name, values in (("mark", fingerprint(keys)), ("shard", shard), ("offset", offset), ("n_tokens", n_tokens)):
            records[name][slot] = values
        return f.to_bytes() + records.tobytes()

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each key is there (by its fingerprint), and the records of those that are."""
        slot = self.function.slots(keys)
        there = slot >= 0
        if len(self.records):
            there &= self.records["mark"][np.maximum(slot, 0)] == fingerprint(keys)
        return there, self.records[slot[there]]


# ---------------------------------------------------------------- writing

def write_store(df: DataFrame, path: str, vocabulary_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
                partitions: int | None = None, shard_bytes: int = 128 << 20, bucket_keys: int = 200_000) -> None:
    """Encode every text, append ``end_id`` and write the store to the new folder ``path``."""
    spark = df.sparkSession
    with open(vocabulary_path, "rb") as f:
        vocabulary = f.read()
    from tokenizers import Tokenizer
    top = max(end_id, Tokenizer.from_buffer(vocabulary).get_vocab_size(with_added_tokens=True) - 1)
    kind = "<u2" if top < 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(vocabulary)
    n = partitions or shuffle_partitions(spark)
    texts = (id_text(df, id_col, text_col).withColumn("_h", F.xxhash64("_text"))
             .repartitionByRange(n, "_id", "_h").sortWithinPartitions("_id", "_h", "_text").select("_id", "_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = shared.value
        table = worker_table(("bytes", hash(data)), lambda: library_table(data, True))
        fs, root = file_system(path)
        fs.create_dir(f"{root}/payload", recursive=True)
        context = TaskContext.get()
        shard, out, tmp, at = context.partitionId() << SHARD_BITS, None, "", 0
        width, end = int(kind[2]), np.array([end_id], dtype=kind).tobytes()
        for b in batches:
            for ids, group in arrow_groups(b.column(0), b.column(1)):
                rows: list[list] = [[], [], [], []]
                for doc, tokens in zip(ids.to_pylist(), table.encode(group)):
                    if out is None:
                        tmp, at = f"{root}/payload/_task-{context.taskAttemptId()}-{shard}", 0
                        out = fs.open_output_stream(tmp)
                    out.write(tokens.astype(kind).tobytes() + end)
                    for c, v in zip(rows, (doc, shard, at, len(tokens) + 1)):
                        c.append(v)
                    at += len(tokens) + 1
                    if at * width >= shard_bytes:
                        out.close()
                        fs.move(tmp, f"{root}/{shard_file(shard)}")
                        shard, out = shard + 1, None
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["_id", "shard", "offset", "n_tokens"])
        if out is not None:
            out.close()
            fs.move(tmp, f"{root}/{shard_file(shard)}")

    texts.mapInArrow(run, "_id long, shard long, offset long, n_tokens long").write.parquet(f"{path}/entries")

    entries = spark.read.parquet(f"{path}/entries").select(F.col("_id").isNull().alias("_null"), F.coalesce("_id", F.lit(0)).alias("_id"), "shard", "offset", "n_tokens")
    entries = bucketed_position(entries, F.col("shard"), ["offset"], ["_null", "_id"], "_occ")
    buckets = max(1, -(-spark.read.parquet(f"{path}/entries").count() // bucket_keys))
    keyed = (entries.withColumn("_bucket", _bucket(buckets)).repartition(min(buckets, max(n, 1)), "_bucket").sortWithinPartitions("_bucket")
             .select("_null", "_id", "_occ", "shard", "offset", "n_tokens", "_bucket"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, cols in _runs(batches):
            raw = KeyIndex.pack(key_hash(*cols[:3]), *cols[3:6])
            _write(path, f"index/bucket-{bucket:06d}.mph", raw)
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([len(cols[0])], pa.int64())], names=["bucket", "keys"])

    keyed.mapInArrow(index, "bucket long, keys long").write.parquet(f"{path}/buckets")
    _write(path, "store.json", json.dumps({"kind": kind, "buckets": buckets}).encode())


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("_null", "_id", "_occ"), F.lit(buckets))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Columns of each run of equal values in the last column (rows come sorted by it)."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]).tolist()
        for x, y in zip(cuts[:-1], cuts[1:]):
            if last is not None and key[x] != last:
                yield int(last), _columns(held)
                held = []
            held.append(b.slice(x, y - x))
            last = key[x]
    if held:
        yield int(last), _columns(held)


def _columns(held: list[pa.RecordBatch]) -> list[np.ndarray]:
    t = pa.Table.from_batches(held)
    return [c.to_numpy() for c in t.columns[:-1]]


# ---------------------------------------------------------------- reading

def _meta(path: str) -> dict:
    fs, root = file_system(path)
    with fs.open_input_stream(f"{root}/store.json") as f:
        return json.loads(f.read())


def lookup(keys: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Place of each row of ``keys``: ``id_col, occurrence, shard, offset, n_tokens`` (nulls after the second
    for a key that the store does not hold).  Rows that repeat an id ask for its occurrences 0, 1, …"""
    buckets = _meta(path)["buckets"]
    k = keys.select(F.col(f"`{id_col}`").cast("long").alias("_id")).select(F.col("_id").isNull().alias("_null"), F.coalesce("_id", F.lit(0)).alias("_id"))
    k = k.groupBy("_null", "_id").count().select("_null", "_id", F.explode(F.sequence(F.lit(0), F.col("count") - 1)).alias("_occ"))
    k = k.withColumn("_bucket", _bucket(buckets))
    k = k.repartition(min(buckets, shuffle_partitions(keys.sparkSession)), "_bucket").sortWithinPartitions("_bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        have, found = None, None
        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(cols[3])) + 1, [len(cols[3])]]).tolist()
            for x, y in zip(cuts[:-1], cuts[1:]):
                if x == y:
                    continue
                if cols[3][x] != have:
                    have = cols[3][x]
                    name = f"{root}/index/bucket-{have:06d}.mph"
                    found = None
                    if fs.get_file_info(name).is_file:
                        with fs.open_input_file(name) as f:
                            found = KeyIndex(f.read())
                null, ids, occ = (c[x:y] for c in cols[:3])
                there = np.zeros(y - x, dtype=bool)
                rec = np.zeros(0, dtype=RECORD)
                if found is not None:
                    there, rec = found.find(key_hash(null, ids, occ))
                full = np.zeros(y - x, dtype=RECORD)
                full[there] = rec
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=null), pa.array(occ, pa.int64())] + [pa.array(full[c].astype(np.int64), pa.int64(), mask=~there) for c in ("shard", "offset", "n_tokens")],
                                                 names=[id_col, "occurrence", "shard", "offset", "n_tokens"])

    return k.mapInArrow(run, f"`{id_col}` long, occurrence long, shard long, offset long, n_tokens long")


def read_ids(places: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """Rows of :func:`lookup` with ``ids`` (binary, little-endian unsigned 32-bit) read from the payload."""
    kind = _meta(path)["kind"]
    width = int(kind[2])
    names = [id_col, "occurrence", "shard", "offset", "n_tokens"]
    ordered = places.select(*names).where(F.col("shard").isNotNull()).repartition(F.col("shard")).sortWithinPartitions("shard", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        have, f = None, None
        for b in batches:
            shard, offset, count = (b.column(i).to_numpy() for i in (2, 3, 4))
            out, size, start = [], 0, 0
            for i in range(b.num_rows):
                if shard[i] != have:
                    have = shard[i]
                    f = fs.open_input_file(f"{root}/{shard_file(int(have))}")
                raw = f.read_at(int(count[i]) * width, int(offset[i]) * width)
                out.append(np.frombuffer(raw, dtype=kind).astype("<u4").tobytes())
                size += len(out[-1])
                if size > 1 << 22 or i == b.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*b.slice(start, i + 1 - start).columns, pa.array(out, pa.binary())], names=[*names, "ids"])
                    out, size, start = [], 0, i + 1

    return ordered.mapInArrow(run, f"`{id_col}` long, occurrence long, shard long, offset long, n_tokens long, ids binary")


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """Number of ids before each shard, from the entries (one row for each shard of some 100 MB)."""
    from pyspark.sql import Window

    sums = spark.read.parquet(f"{path}/entries").groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))
