"""The time-series sample builder and the gap-fill plan, as one lazy Catalyst plan each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import timeseries as ts_ops
from ..operators.frame import calendar_filter, narrow_types


@dataclass(frozen=True)
class SampleConfig:
    """Settings of one data set."""
    segment: str | None
    ts: str
    target: str
    resample_minutes: int = 60
    lag: int = 5
    ratios: tuple[float, float, float] = (0.7, 0.1, 0.2)
    calendar: dict = field(default_factory=dict)       # e.g. {"year": (2024, 2025), "hour": (0, 12)}
    value_map: dict | None = None                      # P18: segment text -> id, unknown dropped
    exact_on_grid: bool = False                        # W11: a value exactly on the grid wins over the bucket mean
    unique: bool = False                               # U02: whole rows once (over all columns of the table)
    narrow: bool = False                               # X23: numeric columns in their smallest types first
    normalize: bool = False                            # F06 fitted on train, applied to all splits
    block_steps: int = 1 << 14


def build_samples(df: DataFrame, cfg: SampleConfig) -> DataFrame:
    """Unique rows → prune → calendar filter → resample → complete lag samples → chronological split.

    Output: ``segment, ts, lag_<lag> … lag_1, y, split`` (one row per sample; with ``normalize`` the lag
    and target columns are min-max scaled with the train split's target range).  The target alone is
    resampled and lagged, so other columns never leave the scan.  One plan: the bucket mean (or W11's exact
    value on the grid), the segment windows, and the small position aggregate.
    """
    seg = cfg.segment
    x = df.distinct() if cfg.unique else df                   # U02
    x = x.select(*dict.fromkeys(c for c in [seg, cfg.ts, cfg.target] if c))                  # P04
    if cfg.narrow:
        x = narrow_types(x, [cfg.target])                     # X23
    if cfg.value_map is not None and seg:                     # P18 + P23
        m = F.create_map(*[F.lit(v) for kv in cfg.value_map.items() for v in kv])
        x = x.withColumn(seg, m[F.col(seg)]).where(F.col(seg).isNotNull())
    x = x.dropna(subset=[c for c in [seg, cfg.ts] if c])
    if cfg.calendar:                                          # P09
        x = calendar_filter(x, cfg.ts, cfg.calendar)
    resample = ts_ops.resample_grid if cfg.exact_on_grid else ts_ops.resample_mean
    b = resample(x, seg, cfg.ts, cfg.target, cfg.resample_minutes)                  # W11 / A09
    s = ts_ops.lag_features(b, seg, cfg.ts, cfg.target, cfg.lag, cfg.resample_minutes,  # W05
                            block_steps=cfg.block_steps)
    s = ts_ops.chrono_split(s, seg, cfg.ts, cfg.ratios)                               # W07
    if seg and seg != "segment":
        s = s.withColumnRenamed(seg, "segment")
    if cfg.normalize:
        lag_cols = [f"lag_{i}" for i in range(cfg.lag, 0, -1)]
        st = s.where(F.col("split") == "train").agg(F.min("y").alias("_lo"), F.max("y").alias("_hi"))
        s = s.crossJoin(F.broadcast(st))                      # one row: bounded broadcast
        rng = F.when(F.col("_hi") > F.col("_lo"), F.col("_hi") - F.col("_lo")).otherwise(F.lit(1.0))
        s = s.withColumns({c: (F.col(c) - F.col("_lo")) / rng for c in [*lag_cols, "y"]}).drop("_lo", "_hi")
    return s


def sample_arrays(samples: DataFrame, lag: int, segment_id: str = "segment") -> DataFrame:
    """Samples as arrays ``x`` of ``lag`` steps with the channels (segment id, value), oldest first; the
    segment must be a number (map it before, ``SampleConfig.value_map``)."""
    step = lambda i: F.array(F.col(segment_id).cast("double"), F.col(f"lag_{i}").cast("double"))
    return samples.select(segment_id, "ts", F.array(*[step(i) for i in range(lag, 0, -1)]).alias("x"), "y", "split")


def fill_missing(df: DataFrame, segment: str, ts: str, columns: Sequence[str], minutes: int,
                 strategy: str = "forward", calendar: dict | None = None) -> DataFrame:
    """Grid fill per segment (J02, off-grid rows kept) then a fill strategy per column."""
    strip = (lambda d: calendar_filter(d, ts, calendar)) if calendar else None
    g = ts_ops.fill_date(df.select(segment, ts, *columns), segment, ts, minutes, strip=strip)
    return ts_ops.fill_null(g, segment, ts, list(columns), strategy)
