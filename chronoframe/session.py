"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "chronoframe", extra: dict | None = None) -> SparkSession:
    """Session with UTC time, AQE (coalesce + skew join) and no web UI."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint folder from the session (``spark.checkpoint.dir``).

    A cluster must name a shared folder; only a local-mode session without one (tests, the bench) gets
    a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is unset: name a shared folder (HDFS/S3/...) for checkpoints")
    base = os.environ.get("TMPDIR", "/tmp")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="chronoframe-ckpt-", dir=base))
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def materialize(df, name: str = "stage"):
    """Write ``df`` once as Parquet below the checkpoint folder and read it back – cuts the lineage like
    ``checkpoint()`` but computes the plan only once (a reliable RDD checkpoint of an uncached plan
    computes it twice).  The folder is on the shared file system named by ``spark.checkpoint.dir``."""
    import uuid
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    _STAGES.append((spark.sparkContext.applicationId, path))
    return spark.read.parquet(path)


_STAGES: list[tuple[str, str]] = []


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage folders that this application has written so far and give their number.  Call it when
    the results built on them have been written or are not needed any more."""
    app, jvm = spark.sparkContext.applicationId, spark.sparkContext._jvm
    mine = [p for a, p in _STAGES if a == app]
    for p in mine:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    _STAGES[:] = [(a, p) for a, p in _STAGES if a != app]
    return len(mine)
