"""Queries: time-series sample builder and series operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import datetime as dt
from ..operators import frame as fr
from ..operators import timeseries as ts_ops
from .catalog import r6, register, table
from ..sources.io import load_samples, scratch_path, write_samples
from .samples import SampleConfig, build_samples, fill_missing, sample_arrays

# ---------------------------------------------------------------------------------------------------
# T01 flagship: 6-hour means, complete 5-lag samples, chronological 70/10/20 split per event type
# ---------------------------------------------------------------------------------------------------


def samples_sql(minutes: int, lag: int, r0: float = 0.7, r1: float = 0.1) -> str:
    lag_cols = ",\n    ".join(f"lag(y, {i}) OVER w AS lag_{i}" for i in range(lag, 0, -1))
    out_cols = ", ".join(f"round(lag_{i}, 6) AS lag_{i}" for i in range(lag, 0, -1))
    a = f"floor(n * {r0}::DOUBLE)"
    b = f"floor(n * ({r0}::DOUBLE + {r1}::DOUBLE))"
    return f"""
WITH b AS (
  SELECT event_type AS segment, time_bucket(INTERVAL '{minutes} minutes', ts) AS ts, avg(value) AS y
  FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1, 2),
l AS (
  SELECT segment, ts, y,
    {lag_cols},
    lag(ts, {lag}) OVER w AS ts_first
  FROM b WINDOW w AS (PARTITION BY segment ORDER BY ts)),
s AS (SELECT * FROM l WHERE ts_first = ts - INTERVAL '{lag * minutes} minutes'),
p AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ts) - 1 AS pos,
             count(*) OVER (PARTITION BY segment) AS n FROM s)
SELECT segment, ts, {out_cols}, round(y, 6) AS y,
  CASE WHEN pos < {a} THEN 'train' WHEN pos < {b} THEN 'val' ELSE 'test' END AS split
FROM p WHERE {a} > 0 AND {b} > {a} AND n > {b}
"""


def ts_samples_df(spark, sf_dir, minutes=360, lag=5):
    cfg = SampleConfig(segment="event_type", ts="ts", target="value", resample_minutes=minutes, lag=lag)
    s = build_samples(table(spark, sf_dir, "events"), cfg)
    lag_cols = [f"lag_{i}" for i in range(lag, 0, -1)]
    return s.select("segment", "ts", *[r6(c).alias(c) for c in lag_cols], r6("y").alias("y"), "split")


@register("ts_samples", samples_sql(360, 5), ids="T01 P04 A09 W05 W07")
def q_ts_samples(spark, sf_dir):
    return ts_samples_df(spark, sf_dir, 360, 5)


@register("ts_samples_hourly", samples_sql(60, 5), ids="T01")
def q_ts_samples_hourly(spark, sf_dir):
    return ts_samples_df(spark, sf_dir, 60, 5)


_SCALED = ", ".join(f"round(({c} - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1 END, 5) AS {c}" for c in ("lag_5", "lag_4", "lag_3", "lag_2", "lag_1", "y"))


@register("ts_samples_scaled", f"""
WITH s AS ({samples_sql(60, 5).replace(", 6) AS", ", 12) AS")}), r AS (SELECT min(y) AS lo, max(y) AS hi FROM s WHERE split = 'train')
SELECT segment, ts, {_SCALED}, split FROM s, r""", ids="T01 F06 X16")
def q_ts_samples_scaled(spark, sf_dir):
    cfg = SampleConfig(segment="event_type", ts="ts", target="value", resample_minutes=60, lag=5, normalize=True)
    s = build_samples(table(spark, sf_dir, "events"), cfg)
    return s.select("segment", "ts", *[r6(f"lag_{i}", 5).alias(f"lag_{i}") for i in range(5, 0, -1)], r6("y", 5).alias("y"), "split")


# the daily series of order prices on a grid of two days: every second value stands exactly on the grid
PRIORITY_IDS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "4-NOT SPECIFIED": 4, "5-LOW": 5}
_GRID_SAMPLES_SQL = """
WITH o AS (SELECT DISTINCT * FROM (SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM orders UNION ALL
                                   SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM orders WHERE o_orderkey % 5 = 0)),
e AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END AS segment,
             o_orderdate AS ts, CAST(o_totalprice AS FLOAT) AS v, time_bucket(INTERVAL '2 days', o_orderdate, TIMESTAMP '1970-01-01') AS g FROM o),
b AS (SELECT segment, g AS ts, coalesce(avg(v) FILTER (WHERE ts = g), avg(v)) AS y FROM e GROUP BY segment, g),
l AS (SELECT segment, ts, y, lag(y, 3) OVER w AS lag_3, lag(y, 2) OVER w AS lag_2, lag(y, 1) OVER w AS lag_1, lag(ts, 3) OVER w AS t3
      FROM b WINDOW w AS (PARTITION BY segment ORDER BY ts)),
s AS (SELECT * FROM l WHERE t3 = ts - INTERVAL '6 days'),
p AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY ts) - 1 AS pos, count(*) OVER (PARTITION BY segment) AS n FROM s)
SELECT segment, ts, round(lag_3, 4) AS lag_3, round(lag_2, 4) AS lag_2, round(lag_1, 4) AS lag_1, round(y, 4) AS y,
  CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train' WHEN pos < floor(n * (0.7::DOUBLE + 0.1::DOUBLE)) THEN 'val' ELSE 'test' END AS split
FROM p WHERE floor(n * 0.7::DOUBLE) > 0 AND floor(n * (0.7::DOUBLE + 0.1::DOUBLE)) > floor(n * 0.7::DOUBLE) AND n > floor(n * (0.7::DOUBLE + 0.1::DOUBLE))"""


def _grid_samples(spark, sf_dir):
    """T01 with all its steps: repeated rows, id map, narrow types, exact values on the grid."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    o = o.unionAll(o.where(F.col("o_orderkey") % 5 == 0))
    cfg = SampleConfig(segment="o_orderpriority", ts="o_orderdate", target="o_totalprice", resample_minutes=2 * 1440, lag=3,
                       value_map=PRIORITY_IDS, exact_on_grid=True, unique=True, narrow=True)
    return build_samples(o, cfg).withColumnRenamed("o_orderdate", "ts")


@register("ts_samples_grid", _GRID_SAMPLES_SQL, ids="T01 U02 P18 P23 X23 W11 W05 W07")
def q_ts_samples_grid(spark, sf_dir):
    s = _grid_samples(spark, sf_dir)
    return s.select("segment", "ts", *[r6(c, 4).alias(c) for c in ("lag_3", "lag_2", "lag_1", "y")], "split")


@register("sample_arrays", f"""
WITH s AS ({_GRID_SAMPLES_SQL})
SELECT segment, ts, CAST(segment AS DOUBLE) AS id_first, lag_3 AS first, CAST(segment AS DOUBLE) AS id_last, lag_1 AS last,
       CAST(3 AS INTEGER) AS steps, CAST(2 AS INTEGER) AS channels, y FROM s WHERE split = 'train'""", ids="X22 K03 S14 T01")
def q_sample_arrays(spark, sf_dir):
    """Samples as (step, channel) arrays with the id channel, written by split and read back."""
    path = scratch_path(spark, "sample_arrays")
    write_samples(sample_arrays(_grid_samples(spark, sf_dir), 3), path, "x", 3)
    s, x = load_samples(spark, path, "train"), F.col("x")
    return s.select("segment", "ts", x[0][0].alias("id_first"), r6(x[0][1], 4).alias("first"), x[2][0].alias("id_last"), r6(x[2][1], 4).alias("last"),
                    F.size(x).alias("steps"), F.size(x[0]).alias("channels"), r6("y", 4).alias("y"))


@register("invalid_segments", """
WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT user_id, n FROM n WHERE NOT (floor(n * 0.7::DOUBLE) > 0 AND floor(n * (0.7::DOUBLE + 0.1::DOUBLE)) > floor(n * 0.7::DOUBLE)
                                    AND n > floor(n * (0.7::DOUBLE + 0.1::DOUBLE)))""", ids="K08")
def q_invalid_segments(spark, sf_dir):
    """Segments that a chronological split drops."""
    return ts_ops.invalid_segments(table(spark, sf_dir, "events"), "user_id")


@register("segment_report", f"""
WITH s AS ({samples_sql(360, 5)})
SELECT segment, CAST(count(*) FILTER (WHERE split = 'train') AS BIGINT) AS train,
       CAST(count(*) FILTER (WHERE split = 'val') AS BIGINT) AS val,
       CAST(count(*) FILTER (WHERE split = 'test') AS BIGINT) AS test
FROM s GROUP BY segment
""", ids="K08 A16")
def q_segment_report(spark, sf_dir):
    s = ts_samples_df(spark, sf_dir, 360, 5)
    p = s.groupBy("segment").pivot("split", ["train", "val", "test"]).count()
    return p.select("segment", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("train", "val", "test")])


# ---------------------------------------------------------------------------------------------------
# resampling
# ---------------------------------------------------------------------------------------------------

def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")


@register("resample_mean", """
SELECT event_type, time_bucket(INTERVAL '60 minutes', ts) AS ts, round(avg(value), 6) AS value,
       CAST(count(*) AS BIGINT) AS n
FROM events GROUP BY 1, 2
""", ids="A09")
def q_resample_mean(spark, sf_dir):
    ev = _events(spark, sf_dir)
    out = (ev.groupBy("event_type", dt.floor_ts("ts", 60).alias("ts"))
             .agg(F.avg("value").alias("value"), F.count(F.lit(1)).alias("n")))
    return out.select("event_type", "ts", r6("value").alias("value"), "n")


@register("floor_ts", """
SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS ts_15, time_bucket(INTERVAL '360 minutes', ts) AS ts_360
FROM events
""", ids="X08")
def q_floor_ts(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", dt.floor_ts("ts", 15).alias("ts_15"), dt.floor_ts("ts", 360).alias("ts_360"))


_DAILY_ORDERS_SQL = """
d AS (SELECT o_orderpriority AS seg, o_orderdate AS ts, avg(o_totalprice) AS v FROM orders GROUP BY 1, 2)"""


@register("resample_dense", f"""
WITH {_DAILY_ORDERS_SQL},
g AS (SELECT seg, unnest(generate_series(time_bucket(INTERVAL '2 days', min(ts), TIMESTAMP '1970-01-01'), max(ts),
                                          INTERVAL '2 days')) AS ts FROM d GROUP BY seg),
x AS (SELECT seg, ts, avg(v) AS xv FROM d WHERE ts = time_bucket(INTERVAL '2 days', ts, TIMESTAMP '1970-01-01') GROUP BY 1, 2),
m AS (SELECT seg, time_bucket(INTERVAL '2 days', ts, TIMESTAMP '1970-01-01') AS ts, avg(v) AS mv FROM d GROUP BY 1, 2)
SELECT g.seg, g.ts, round(coalesce(x.xv, m.mv), 6) AS v
FROM g LEFT JOIN x ON g.seg = x.seg AND g.ts = x.ts LEFT JOIN m ON g.seg = m.seg AND g.ts = m.ts
""", ids="W11 J05")
def q_resample_dense(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    d = o.groupBy(F.col("o_orderpriority").alias("seg"), F.col("o_orderdate").alias("ts")) \
         .agg(F.avg("o_totalprice").alias("v"))
    out = ts_ops.resample_dense(d, "seg", "ts", "v", 2 * 1440)
    return out.select("seg", "ts", r6("v").alias("v"))


@register("resample_dense_events", """
WITH g AS (SELECT event_type, unnest(generate_series(time_bucket(INTERVAL '60 minutes', min(ts)), max(ts),
                                                     INTERVAL '60 minutes')) AS ts FROM events GROUP BY 1),
m AS (SELECT event_type, time_bucket(INTERVAL '60 minutes', ts) AS ts, avg(value) AS mv FROM events GROUP BY 1, 2)
SELECT g.event_type, g.ts, round(m.mv, 6) AS value FROM g LEFT JOIN m USING (event_type, ts)
""", ids="W11")
def q_resample_dense_events(spark, sf_dir):
    out = ts_ops.resample_dense(_events(spark, sf_dir), "event_type", "ts", "value", 60)
    return out.select("event_type", "ts", r6("value").alias("value"))


# ---------------------------------------------------------------------------------------------------
# grid fill and fills
# ---------------------------------------------------------------------------------------------------

_GRID_SQL = """
g AS (SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL '60 minutes')) AS ts FROM events GROUP BY 1),
f AS (SELECT event_type, ts, e.event_id, e.value FROM (SELECT event_type, ts, event_id, value FROM events) e
      FULL OUTER JOIN g USING (event_type, ts))"""


@register("fill_date", f"""
WITH {_GRID_SQL}
SELECT event_type, ts, event_id, round(value, 6) AS value FROM f
""", ids="J02 S10")
def q_fill_date(spark, sf_dir):
    out = ts_ops.fill_date(_events(spark, sf_dir), "event_type", "ts", 60)
    return out.select("event_type", "ts", "event_id", r6("value").alias("value"))


@register("ffill", f"""
WITH {_GRID_SQL}
SELECT event_type, ts, round(last_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS value FROM f
""", ids="T02 J02 W02")
def q_ffill(spark, sf_dir):
    out = fill_missing(_events(spark, sf_dir), "event_type", "ts", ["value"], 60, "forward")
    return out.select("event_type", "ts", r6("value").alias("value"))


@register("bfill", f"""
WITH {_GRID_SQL}
SELECT event_type, ts, round(first_value(value IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts
       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 6) AS value FROM f
""", ids="T02 W03")
def q_bfill(spark, sf_dir):
    out = fill_missing(_events(spark, sf_dir), "event_type", "ts", ["value"], 60, "backward")
    return out.select("event_type", "ts", r6("value").alias("value"))


@register("fill_stat", f"""
WITH {_GRID_SQL}
SELECT event_type, ts, round(coalesce(value, avg(value) OVER (PARTITION BY event_type)), 6) AS value_mean,
       round(coalesce(value, min(value) OVER (PARTITION BY event_type)), 6) AS value_min,
       round(coalesce(value, max(value) OVER (PARTITION BY event_type)), 6) AS value_max FROM f
""", ids="W04")
def q_fill_stat(spark, sf_dir):
    g = ts_ops.fill_date(_events(spark, sf_dir), "event_type", "ts", 60)
    g = g.select("event_type", "ts", F.col("value").alias("value_mean"), F.col("value").alias("value_min"),
                 F.col("value").alias("value_max"))
    g = ts_ops.fill_null(g, "event_type", "ts", "value_mean", "mean")
    g = ts_ops.fill_null(g, "event_type", "ts", "value_min", "min")
    g = ts_ops.fill_null(g, "event_type", "ts", "value_max", "max")
    return g.select("event_type", "ts", *[r6(c).alias(c) for c in ("value_mean", "value_min", "value_max")])


_HOURLY_SQL = """
h AS (SELECT event_type, time_bucket(INTERVAL '60 minutes', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2)"""


def _hourly(spark, sf_dir):
    return ts_ops.resample_mean(_events(spark, sf_dir), "event_type", "ts", "value", 60)


@register("rolling_mean", f"""
WITH {_HOURLY_SQL},
r AS (SELECT event_type, ts, CASE WHEN count(value) OVER w = 5 THEN avg(value) OVER w END AS value_roll
      FROM h WINDOW w AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT event_type, ts, round(value_roll, 6) AS value_roll FROM r WHERE value_roll IS NOT NULL
""", ids="W01")
def q_rolling_mean(spark, sf_dir):
    out = ts_ops.rolling_mean(_hourly(spark, sf_dir), "event_type", "ts", "value", 5, name="value_roll", block_rows=64)
    return out.select("event_type", "ts", r6("value_roll").alias("value_roll"))


@register("time_shift_join", f"""
WITH {_HOURLY_SQL}
SELECT event_type, ts, round(value, 6) AS value,
  round(max(value) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTES PRECEDING AND INTERVAL 60 MINUTES PRECEDING), 6) AS lag_1,
  round(max(value) OVER (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 180 MINUTES PRECEDING AND INTERVAL 180 MINUTES PRECEDING), 6) AS lag_3
FROM h
""", ids="J04")
def q_time_shift_join(spark, sf_dir):
    h = _hourly(spark, sf_dir)
    out = ts_ops.lag_by_time(h, "event_type", "ts", "value", 1, 60, name="lag_1")
    out = ts_ops.lag_by_time(out, "event_type", "ts", "value", 3, 60, name="lag_3")
    return out.select("event_type", "ts", *[r6(c).alias(c) for c in ("value", "lag_1", "lag_3")])


@register("lag_features", f"""
WITH {_HOURLY_SQL},
l AS (SELECT event_type, ts, value, lag(value, 3) OVER w AS lag_3, lag(value, 2) OVER w AS lag_2,
             lag(value, 1) OVER w AS lag_1, lag(ts, 3) OVER w AS t3
      FROM h WINDOW w AS (PARTITION BY event_type ORDER BY ts))
SELECT event_type, ts, round(lag_3, 6) AS lag_3, round(lag_2, 6) AS lag_2, round(lag_1, 6) AS lag_1, round(value, 6) AS y
FROM l WHERE t3 = ts - INTERVAL '180 minutes'
""", ids="W05")
def q_lag_features(spark, sf_dir):
    # small blocks (64 buckets) so that block edges are exercised on the test data
    out = ts_ops.lag_features(_hourly(spark, sf_dir), "event_type", "ts", "value", 3, 60, block_steps=64)
    return out.select("event_type", "ts", *[r6(c).alias(c) for c in ("lag_3", "lag_2", "lag_1", "y")])


@register("combine_first", """
WITH a AS (SELECT o_orderpriority AS seg, o_orderdate AS ts, avg(o_totalprice) AS v FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 1, 2),
b AS (SELECT o_orderpriority AS seg, o_orderdate AS ts, max(o_totalprice) AS v FROM orders GROUP BY 1, 2)
SELECT seg, ts, round(coalesce(a.v, b.v), 6) AS v FROM a FULL OUTER JOIN b USING (seg, ts)
""", ids="J05")
def q_combine_first(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = o.where(F.col("o_orderstatus") == "F").groupBy(F.col("o_orderpriority").alias("seg"),
                                                        F.col("o_orderdate").alias("ts")).agg(F.avg("o_totalprice").alias("v"))
    b = o.groupBy(F.col("o_orderpriority").alias("seg"), F.col("o_orderdate").alias("ts")).agg(F.max("o_totalprice").alias("v"))
    out = ts_ops.combine_first(a, b, ["seg", "ts"], ["v"])
    return out.select("seg", "ts", r6("v").alias("v"))


@register("left_update", """
WITH u AS (SELECT l_orderkey, avg(l_extendedprice) AS upd FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT o_orderkey, round(coalesce(u.upd, o.o_totalprice), 6) AS o_totalprice
FROM orders o LEFT JOIN u ON o.o_orderkey = u.l_orderkey
""", ids="J03 P15")
def q_left_update(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R") \
        .select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("o_totalprice"))
    out = ts_ops.left_update(o, li, ["o_orderkey"], "o_totalprice")
    return out.select("o_orderkey", r6("o_totalprice").alias("o_totalprice"))


# ---------------------------------------------------------------------------------------------------
# splits in time, sliding samples, batches, EMA
# ---------------------------------------------------------------------------------------------------

@register("chrono_split", """
WITH p AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_id, event_type, CASE WHEN pos < floor(n * 0.7::DOUBLE) THEN 'train'
  WHEN pos < floor(n * (0.7::DOUBLE + 0.1::DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM p
""", ids="W07")
def q_chrono_split(spark, sf_dir):
    out = ts_ops.chrono_split(_events(spark, sf_dir), "event_type", "ts", (0.7, 0.1, 0.2), ties=["event_id"], block_rows=256)
    return out.select("event_id", "event_type", "split")


@register("chrono_split_flex", """
WITH p AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_id, event_type, CASE WHEN pos < floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'val' END AS split FROM p
""", ids="W08")
def q_chrono_split_flex(spark, sf_dir):
    out = ts_ops.chrono_split_flex(_events(spark, sf_dir), "event_type", "ts", (0.8, 0.2, 0.0), ties=["event_id"], block_rows=300)
    return out.select("event_id", "event_type", "split")


@register("chrono_split_cases", """
WITH p AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_id, 'train' AS all_train, CASE WHEN pos < floor(n * 0.6::DOUBLE) THEN 'train'
  WHEN pos < floor(n * (0.6::DOUBLE + 0.3::DOUBLE)) THEN 'val' ELSE 'test' END AS three FROM p
""", ids="W08")
def q_chrono_split_cases(spark, sf_dir):
    """The other two cases: everything is train; all three parts."""
    a = ts_ops.chrono_split_flex(_events(spark, sf_dir), "event_type", "ts", (1.0, 0.0, 0.0), name="all_train", ties=["event_id"])
    b = ts_ops.chrono_split_flex(_events(spark, sf_dir), "event_type", "ts", (0.6, 0.3, 0.1), name="three", ties=["event_id"])
    return a.select("event_id", "all_train").join(b.select("event_id", "three"), "event_id")


@register("sliding_samples", """
WITH g AS (SELECT event_type, unnest(generate_series(time_bucket(INTERVAL '60 minutes', min(ts)), max(ts),
                                                     INTERVAL '60 minutes')) AS ts FROM events GROUP BY 1),
m AS (SELECT event_type, time_bucket(INTERVAL '60 minutes', ts) AS ts, avg(value) AS v FROM events GROUP BY 1, 2),
d AS (SELECT g.event_type, g.ts, m.v FROM g LEFT JOIN m USING (event_type, ts)),
s AS (SELECT event_type, ts AS start, v AS x_0, lead(v, 1) OVER w AS x_1, lead(v, 2) OVER w AS x_2,
             lead(v, 4) OVER w AS y_0, lead(ts, 4) OVER w AS t_last
      FROM d WINDOW w AS (PARTITION BY event_type ORDER BY ts))
SELECT event_type, start, round(x_0, 6) AS x_0, round(x_1, 6) AS x_1, round(x_2, 6) AS x_2, round(y_0, 6) AS y_0
FROM s WHERE x_0 IS NOT NULL AND x_1 IS NOT NULL AND x_2 IS NOT NULL AND y_0 IS NOT NULL
""", ids="W06 W11")
def q_sliding_samples(spark, sf_dir):
    dense = ts_ops.resample_dense(_events(spark, sf_dir), "event_type", "ts", "value", 60)
    s = ts_ops.sliding_samples(dense, "event_type", "ts", ["value"], "value", lag=3, ahead=1, offset=2)
    return s.select("event_type", "start", *[r6(F.col("x")[i]["value"]).alias(f"x_{i}") for i in range(3)],
                    r6(F.col("y")[0]).alias("y_0"))


@register("batch_rows", """
WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CAST(floor(pos / 64) AS BIGINT) AS batch FROM p WHERE floor(pos / 64) < floor(n / 64)
""", ids="W12")
def q_batch_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    return ts_ops.batch_rows(o, ["o_orderkey"], 64, drop_last=True).select("o_orderkey", "batch")


@register("ema", """
WITH RECURSIVE d AS (SELECT event_type, time_bucket(INTERVAL '1 day', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts) - 1 AS t FROM d),
r AS (SELECT event_type, ts, t, value, value AS ema FROM n WHERE t = 0
      UNION ALL
      SELECT n.event_type, n.ts, n.t, n.value,
             least(1.0::DOUBLE - 1.0::DOUBLE / (n.t + 1), 0.9::DOUBLE) * r.ema
             + (1.0::DOUBLE - least(1.0::DOUBLE - 1.0::DOUBLE / (n.t + 1), 0.9::DOUBLE)) * n.value
      FROM r JOIN n ON n.event_type = r.event_type AND n.t = r.t + 1)
SELECT event_type, ts, round(value, 6) AS value, round(ema, 6) AS ema FROM r
""", ids="W13")
def q_ema(spark, sf_dir):
    d = ts_ops.resample_mean(_events(spark, sf_dir), "event_type", "ts", "value", 1440)
    out = ts_ops.ema(d, "event_type", "ts", "value", 0.9, block_rows=8)
    return out.select("event_type", "ts", r6("value").alias("value"), r6("ema").alias("ema"))


# ---------------------------------------------------------------------------------------------------
# calendar and date expressions
# ---------------------------------------------------------------------------------------------------

@register("calendar_filter", """
SELECT event_id, ts FROM events
WHERE day(ts) >= 3 AND day(ts) < 20 AND hour(ts) >= 6 AND hour(ts) < 18 AND year(ts) >= 2024
""", ids="P09 X02")
def q_calendar_filter(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    return fr.calendar_filter(ev, "ts", {"year": (2024, 0), "month": (0, 0), "day": (3, 20), "hour": (6, 18)})


@register("date_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
       CAST(isodow(ts) AS INTEGER) AS weekday FROM events
""", ids="X02 X03")
def q_date_parts(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    parts = dt.date_parts("ts")
    return ev.select("event_id", *[c.alias(k) for k, c in parts.items()], dt.iso_weekday("ts").alias("weekday"))


@register("cyclical", """
SELECT event_id,
  round(sin(2 * pi() * ((hour(ts) * 60 + minute(ts)) / 60.0) / 24.0), 6) AS day_sin,
  round(cos(2 * pi() * ((hour(ts) * 60 + minute(ts)) / 60.0) / 24.0), 6) AS day_cos,
  round(sin(2 * pi() * isodow(ts) / 7.0), 6) AS week_sin, round(cos(2 * pi() * isodow(ts) / 7.0), 6) AS week_cos,
  round(sin(2 * pi() * month(ts) / 12.0), 6) AS month_sin, round(cos(2 * pi() * month(ts) / 12.0), 6) AS month_cos
FROM events
""", ids="X06 X03")
def q_cyclical(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    enc = dt.cyclical("ts", 60)
    return ev.select("event_id", *[r6(c).alias(k) for k, c in enc.items()])


@register("time_encoder", """
SELECT event_id, round(sin(epoch(ts) * 2 * pi() / 86400.0), 6) AS day_sin,
       round(cos(epoch(ts) * 2 * pi() / 86400.0), 6) AS day_cos FROM events
""", ids="X07")
def q_time_encoder(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    out = ts_ops.time_encoder(ev, "ts")
    return out.select("event_id", *[r6(c).alias(c) for c in out.columns if c.endswith(("_sin", "_cos"))])


@register("time_id_to_ts", """
SELECT l_orderkey, l_linenumber, o_orderdate + to_minutes(CAST((l_linenumber - 1) * 60 + 30 AS BIGINT)) AS ts
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""", ids="X05")
def q_time_id_to_ts(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    j = li.join(o, "l_orderkey")
    out = ts_ops.time_id_to_datetime(j, "o_orderdate", "l_linenumber", 60, 30, name="ts")
    return out.select("l_orderkey", "l_linenumber", "ts")


@register("parse_dates", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS parsed,
       CAST(strptime(strftime(o_orderdate, '%Y/%m/%d') || ' 07:30', '%Y/%m/%d %H:%M') AS TIMESTAMP) AS parsed_hm
FROM orders
""", ids="X04 P12")
def q_parse_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    txt = F.date_format("o_orderdate", "yyyy-MM-dd")
    txt2 = F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit(" 07:30"))
    return o.select("o_orderkey", dt.parse_datetime(txt).alias("parsed"),
                    dt.parse_datetime(txt2, "%Y/%m/%d %H:%M").alias("parsed_hm"))
