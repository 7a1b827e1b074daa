"""File sources and sinks (S01–S11, S14, K01–K05): Spark readers with explicit schemas, path-derived
columns, partitioned writers and read-back.

Scratch output goes under the session's checkpoint folder (``spark.checkpoint.dir``), which a cluster
sets to a shared file system; nothing is written to a machine-local folder there.
"""

from __future__ import annotations

import fnmatch
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir, shuffle_partitions


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/io/{name}-{uuid.uuid4().hex[:12]}"


def read_csvs(spark: SparkSession, paths, schema: StructType | str | None = None, sep: str = ",",
              header: bool = True, suffix: str = "*.csv", timestamp_format: str | None = None,
              date_format: str | None = None, infer: bool = False) -> DataFrame:
    """CSV files from a path, a list of paths or a directory tree (recursive, filtered by
    ``suffix``), concatenated; an error when no file matches.  Pass a ``schema`` (inference reads the data
    once more and is for exploration only)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise FileNotFoundError("no input path given")
    r = (spark.read.option("header", header).option("sep", sep)
         .option("recursiveFileLookup", True).option("pathGlobFilter", suffix))
    if timestamp_format:
        r = r.option("timestampFormat", timestamp_format)
    if date_format:
        r = r.option("dateFormat", date_format)
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    df = r.csv(paths)
    if schema is not None and not _any_file(spark, paths, suffix):
        raise FileNotFoundError(f"no {suffix} file under {paths}")
    return df


def _any_file(spark: SparkSession, paths: Sequence[str], suffix: str) -> bool:
    """Whether a file matches, by Hadoop's lazy listing up to the first match (no list of all files)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for s in fs.globStatus(path) or []:
            if s.isFile():
                return True
            files = fs.listFiles(s.getPath(), True)
            while files.hasNext():
                if fnmatch.fnmatch(files.next().getPath().getName(), suffix):
                    return True
    return False


def read_json(spark: SparkSession, paths, schema: StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """JSON lines (or whole-file JSON documents with ``multiline``)."""
    r = spark.read.option("multiLine", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(paths)


def explode_results(df: DataFrame, col: str = "result", fields: Sequence[str] = ("box", "text")) -> DataFrame:
    """One row per element of the nested ``result`` array, with the chosen fields as columns."""
    keep = [c for c in df.columns if c != col]
    e = df.select(*keep, F.posexplode(col).alias("item_index", "_r"))
    return e.select(*keep, "item_index", *[F.col(f"_r.{f}").alias(f) for f in fields])


def with_path_parts(df: DataFrame, n: int, prefix: str = "dir", int_parts: Sequence[int] = (),
                    strip_key: bool = True) -> DataFrame:
    """The last ``n`` parent folders of each row's file as ``dir0 … dir{n−1}`` (``dir{n−1}`` is the
    nearest); the parts listed in ``int_parts`` are digit names cast to integers (``try_cast``).  With
    ``strip_key`` a Hive-style ``key=value`` folder gives its value.  The file path comes from the hidden
    ``_metadata`` column, so no extra pass over the files is needed."""
    parts = F.split(F.col("_metadata.file_path"), "/")
    cols = []
    for i in range(n):
        v = F.element_at(parts, -(n - i) - 1)
        if strip_key:
            v = F.regexp_replace(v, "^[^=]*=", "")
        cols.append((v.try_cast("long") if i in int_parts else v).alias(f"{prefix}{i}"))
    return df.select("*", *cols)


def label_from_path(paths: DataFrame, path_col: str = "path", name: str = "label", up: int = 1, strip_key: bool = True) -> DataFrame:
    """Class label = the folder ``up`` levels above a file; of ``key=value`` folders the value."""
    label = F.element_at(F.split(F.col(path_col), "/"), -1 - up)
    return paths.withColumn(name, F.regexp_replace(label, "^[^=]*=", "") if strip_key else label)


def date_range(lo: Column, hi: Column, step: str) -> Column:
    """Closed range ``[lo, hi]`` at ``step`` (e.g. ``'1 day'``, ``'15 minutes'``) as an array column."""
    return F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))


def write_samples(df: DataFrame, path: str, x_col: str, lag: int, mode: str = "append", batch: str | None = None) -> None:
    """Append sample rows partitioned by ``split``; the width of every sample must be ``lag``, or the write
    fails.  The check is part of the sample column itself: a column of its own would be pruned.

    With ``batch`` (letters, digits, ``_``, ``.``, ``-``) the rows replace the folder of that batch: writing a batch
    again, after a failure or by mistake, leaves its rows once, and other batches stay as they are.  A write that
    fails leaves the batch away until it is repeated.  A folder holds batches or plain appends, not both."""
    kind = dict(df.dtypes)[x_col]
    wrong = F.raise_error(F.concat(F.lit(f"sample width differs from {lag}: "), F.size(x_col).cast("string"))).cast(kind)
    checked = df.withColumn(x_col, F.when(F.size(x_col) == lag, F.col(x_col)).otherwise(wrong))
    if batch is not None:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"batch name {batch!r}")
        path, mode = f"{path.rstrip('/')}/batch={batch}", "overwrite"
    checked.write.mode(mode).option("partitionOverwriteMode", "static").partitionBy("split").parquet(path)


def load_samples(spark: SparkSession, path: str, split: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Persisted samples, optionally one split (partition pruning reads only that folder).  With ``schema`` a folder
    into which only empty tables have been written is an empty table; without it that is an error."""
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    return df.where(F.col("split") == split) if split else df


def write_by_segment(df: DataFrame, path: str, segment: str, fmt: str = "parquet") -> None:
    """One folder per segment value (Hive-style ``segment=value``)."""
    df.write.mode("overwrite").partitionBy(segment).format(fmt).save(path)


def sort_files(df: DataFrame, path: str, file_key: str, order: Sequence[str], fmt: str = "parquet") -> None:
    """Rewrite the rows of each ``file_key`` sorted by ``order``: one range partitioning by (key, order), so a
    large key is written by many tasks as files that follow one another, each sorted."""
    n = shuffle_partitions(df.sparkSession)
    (df.repartitionByRange(n, file_key, *order).sortWithinPartitions(file_key, *order)
       .write.mode("overwrite").partitionBy(file_key).format(fmt).save(path))


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header row."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines (nested structs and arrays kept)."""
    df.write.mode("overwrite").json(path)
