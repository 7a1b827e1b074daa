"""Queries: file sources and sinks, generators, annotations, run reports.

Each round-trip query writes the driver table into a fresh folder below the checkpoint folder and
returns what Spark reads back, so the oracle is the original table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_or_raw
from ..operators.metrics import regression_aggs
from ..operators.vectors import poly_bounds
from ..sources import annotations as an
from ..sources import generators as gen
from ..sources import io
from .catalog import r6, register, table
from .q_timeseries import samples_sql, ts_samples_df

# ---------------------------------------------------------------------------------------------------
# CSV, TSV, JSON round trips
# ---------------------------------------------------------------------------------------------------


@register("csv_roundtrip", "SELECT * FROM supplier", ids="K01 S01 S02")
def q_csv_roundtrip(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    path = io.scratch_path(spark, "supplier_csv")
    io.write_csv(s, path)
    return io.read_csvs(spark, [path], schema=s.schema)


@register("scan_csv_dates", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders",
          ids="S02 X04")
def q_scan_csv_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"),
                                              "o_totalprice")
    path = io.scratch_path(spark, "orders_csv")
    io.write_csv(o, path)
    return io.read_csvs(spark, path, schema="o_orderkey long, o_orderdate date, o_totalprice double",
                        date_format="dd/MM/yyyy")


@register("scan_tsv", "SELECT * FROM part", ids="S03")
def q_scan_tsv(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    path = io.scratch_path(spark, "part_tsv")
    io.write_csv(p, path, sep="\t")
    return io.read_csvs(spark, path, schema=p.schema, sep="\t")


@register("scan_csv_headerless", """
SELECT s_suppkey AS _c0, s_name AS _c1, s_nationkey AS _c2, s_acctbal AS _c3 FROM supplier""", ids="S04")
def q_scan_csv_headerless(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    path = io.scratch_path(spark, "supplier_nohdr")
    s.write.mode("overwrite").option("header", False).csv(path)
    return io.read_csvs(spark, path, schema="_c0 long, _c1 string, _c2 int, _c3 double", header=False)


@register("scan_json", "SELECT * FROM nation", ids="S05 K02")
def q_scan_json(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    path = io.scratch_path(spark, "nation_json")
    io.write_json(n, path)
    return io.read_json(spark, path, schema=n.schema)


@register("json_roundtrip", """
SELECT r_regionkey, r_name, CAST(count(n_nationkey) AS INTEGER) AS nations, min(n_name) AS first_nation
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2""", ids="K02 S05")
def q_json_roundtrip(spark, sf_dir):
    """Nested records (region with its nations as an array of structs) survive JSON write and read."""
    r = table(spark, sf_dir, "region")
    n = table(spark, sf_dir, "nation")
    g = n.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
        F.collect_list(F.struct("n_nationkey", "n_name")).alias("nations"))
    nested = r.join(g, "r_regionkey", "left")
    path = io.scratch_path(spark, "region_nested")
    io.write_json(nested, path)
    back = io.read_json(spark, path, schema=nested.schema)
    return back.select("r_regionkey", "r_name", F.coalesce(F.size("nations"), F.lit(0)).cast("int").alias("nations"),
                       F.array_min(F.transform("nations", lambda s: s["n_name"])).alias("first_nation"))


# ---------------------------------------------------------------------------------------------------
# OCR results (S06) and box annotations
# ---------------------------------------------------------------------------------------------------

_OCR_SQL = """(SELECT 'img' || CAST(l_orderkey AS VARCHAR) AS image, l_returnflag || l_linestatus AS text,
  l_linenumber AS x0, CAST(l_quantity AS INTEGER) AS y0, l_linenumber + 10 AS x1, CAST(l_quantity AS INTEGER) + 5 AS y1
  FROM lineitem)"""


@register("json_explode", f"""
SELECT image, text, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM {_OCR_SQL} o""", ids="S06 X20 K02")
def q_json_explode(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("int")
    box = F.array(F.col("l_linenumber"), q, F.col("l_linenumber") + 10, q, F.col("l_linenumber") + 10, q + 5,
                  F.col("l_linenumber"), q + 5)
    docs = (li.groupBy(F.concat(F.lit("img"), F.col("l_orderkey").cast("string")).alias("image"))
              .agg(F.collect_list(F.struct(box.alias("box"), F.concat("l_returnflag", "l_linestatus").alias("text")))
                   .alias("result")))
    path = io.scratch_path(spark, "ocr_json")
    io.write_json(docs, path)
    back = io.read_json(spark, path, schema=docs.schema)
    e = io.explode_results(back, "result", ("box", "text"))
    b = e.select("image", "text", poly_bounds(F.col("box")).alias("b"))
    return b.select("image", "text", "b.xmin", "b.ymin", "b.xmax", "b.ymax")


_LINES_SQL = """(SELECT 'img' || CAST(l_orderkey AS VARCHAR) AS stem,
  CAST(l_linenumber % 3 AS VARCHAR) || ' 0.' || lpad(CAST(l_partkey % 100 AS VARCHAR), 2, '0')
  || ' 0.' || lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') || ' 0.' || lpad(CAST(CAST(l_quantity AS BIGINT) % 50 AS VARCHAR), 2, '0')
  || CASE WHEN l_linenumber = 7 THEN '' ELSE ' 0.' || lpad(CAST(l_orderkey % 40 AS VARCHAR), 2, '0') END AS line,
  l_linenumber AS line_no FROM lineitem)"""
_IMAGES_SQL = """(SELECT 'img' || CAST(o_orderkey AS VARCHAR) AS stem, 100 + o_orderkey % 500 AS height, 100 + o_custkey % 900 AS width
  FROM orders WHERE o_orderstatus <> 'P')"""


def _box_inputs(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    frac = lambda c: F.concat(F.lit(" 0."), F.lpad(c.cast("string"), 2, "0"))
    line = F.concat(
        (F.col("l_linenumber") % 3).cast("string"), frac(F.col("l_partkey") % 100), frac(F.col("l_suppkey") % 100),
        frac(F.col("l_quantity").cast("long") % 50),
        F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(frac(F.col("l_orderkey") % 40)))
    lines = li.select(F.concat(F.lit("img"), F.col("l_orderkey").cast("string")).alias("stem"), line.alias("line"),
                      F.col("l_linenumber").alias("line_no"))
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")     # these images have no size
    images = o.select(F.concat(F.lit("img"), F.col("o_orderkey").cast("string")).alias("stem"),
                      (F.lit(100) + F.col("o_orderkey") % 500).alias("height"),
                      (F.lit(100) + F.col("o_custkey") % 900).alias("width"))
    return lines, images


_BOX_SQL = f"""
WITH l AS {_LINES_SQL}, i AS {_IMAGES_SQL},
t AS (SELECT stem, line_no, string_split(trim(line), ' ') AS tok FROM l),
p AS (SELECT t.stem, line_no, len(tok) = 5 AS ok, TRY_CAST(tok[1] AS INTEGER) AS class_id, TRY_CAST(tok[2] AS DOUBLE) AS xc,
             TRY_CAST(tok[3] AS DOUBLE) AS yc, TRY_CAST(tok[4] AS DOUBLE) AS w, TRY_CAST(tok[5] AS DOUBLE) AS h,
             i.height, i.width FROM t LEFT JOIN i USING (stem)),
bad AS (SELECT DISTINCT stem FROM p WHERE NOT ok OR width IS NULL OR height IS NULL)"""


@register("yolo_to_abs", _BOX_SQL + """,
g AS (SELECT *, CAST(trunc(w * width) AS INTEGER) AS wa, CAST(trunc(h * height) AS INTEGER) AS ha FROM p WHERE stem NOT IN (SELECT stem FROM bad)),
b AS (SELECT *, CAST(trunc(xc * width - wa / 2) AS INTEGER) AS xmin, CAST(trunc(yc * height - ha / 2) AS INTEGER) AS ymin FROM g)
SELECT stem, line_no, class_id, xmin, ymin, xmin + wa AS xmax, ymin + ha AS ymax FROM b""", ids="S09 X19")
def q_yolo_to_abs(spark, sf_dir):
    lines, images = _box_inputs(spark, sf_dir)
    boxes, _ = an.yolo_to_abs(lines, images)
    return boxes.drop("poly")


@register("annotation_records", _BOX_SQL + """,
g AS (SELECT *, CAST(trunc(w * width) AS INTEGER) AS wa, CAST(trunc(h * height) AS INTEGER) AS ha FROM p WHERE stem NOT IN (SELECT stem FROM bad))
SELECT stem, any_value(height) AS height, any_value(width) AS width, CAST(count(*) AS INTEGER) AS annotations, CAST(sum(wa * ha) AS BIGINT) AS area,
       CAST(count(*) * 8 AS INTEGER) AS corners FROM g GROUP BY stem""", ids="S09")
def q_annotation_records(spark, sf_dir):
    """The nested record of each image, summed up."""
    lines, images = _box_inputs(spark, sf_dir)
    r = an.annotation_records(an.yolo_to_abs(lines, images)[0], images)
    area = F.aggregate("annotations", F.lit(0).cast("long"), lambda a, x: a + (x["bbox"][2] - x["bbox"][0]) * (x["bbox"][3] - x["bbox"][1]))
    corners = F.aggregate("annotations", F.lit(0), lambda a, x: a + F.size(x["segmentation"][0]))
    return r.select("stem", "height", "width", F.size("annotations").alias("annotations"), area.alias("area"), corners.alias("corners"))


@register("yolo_failed", _BOX_SQL + "\nSELECT stem FROM bad", ids="S09")
def q_yolo_failed(spark, sf_dir):
    lines, images = _box_inputs(spark, sf_dir)
    return an.yolo_to_abs(lines, images)[1]


# ---------------------------------------------------------------------------------------------------
# path-derived columns (S07, S08), partitioned writes (K04, K05), samples
# ---------------------------------------------------------------------------------------------------

def _events_by_type_and_day(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "event_type", F.dayofmonth("ts").alias("day"), "value")
    path = io.scratch_path(spark, "events_by_type")
    ev.write.mode("overwrite").partitionBy("event_type", "day").parquet(path)
    # read the leaf files without partition discovery: the folder names are data of their own
    return spark.read.option("recursiveFileLookup", True).parquet(path)


@register("path_parts", "SELECT event_id, event_type AS dir0, CAST(day(ts) AS BIGINT) AS dir1, value FROM events",
          ids="S07")
def q_path_parts(spark, sf_dir):
    raw = _events_by_type_and_day(spark, sf_dir)
    return io.with_path_parts(raw, 2, int_parts=[1]).select("event_id", "dir0", "dir1", "value")


@register("label_from_path", "SELECT event_type AS label, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1",
          ids="S08")
def q_label_from_path(spark, sf_dir):
    raw = _events_by_type_and_day(spark, sf_dir).select(F.col("_metadata.file_path").alias("path"))
    return io.label_from_path(raw, "path", up=2).groupBy("label").agg(F.count(F.lit(1)).alias("n"))     # <root>/event_type=x/day=d/file


@register("write_by_segment", "SELECT event_id, value, event_type FROM events", ids="K04")
def q_write_by_segment(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    path = io.scratch_path(spark, "events_by_segment")
    io.write_by_segment(ev, path, "event_type")
    return spark.read.parquet(path).select("event_id", "value", "event_type")


@register("sorted_rewrite", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag, CAST(0 AS BIGINT) AS unsorted_files FROM lineitem""",
          ids="K05 O01")
def q_sorted_rewrite(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    path = io.scratch_path(spark, "lineitem_sorted")
    io.sort_files(li, path, "l_returnflag", ["l_shipdate", "l_orderkey", "l_linenumber"])
    back = spark.read.parquet(path)
    # every written file must be sorted: each row is compared with the one before it in the file
    row = back.select(F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_r"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("_k"))
    nxt = row.select("_f", (F.col("_r") + 1).alias("_r"), F.col("_k").alias("_before"))
    unsorted = row.join(nxt, ["_f", "_r"]).where("_before > _k").agg(F.countDistinct("_f").alias("unsorted_files"))
    return back.crossJoin(unsorted)     # one-row side


@register("samples_roundtrip", f"SELECT * EXCLUDE (split) FROM ({samples_sql(60, 5)}) s WHERE split = 'train'",
          ids="K03 S14")
def q_samples_roundtrip(spark, sf_dir):
    lags = [f"lag_{i}" for i in range(5, 0, -1)]
    s = ts_samples_df(spark, sf_dir, 60, 5).select("segment", "ts", F.array(*lags).alias("x"), "y", "split")
    path = io.scratch_path(spark, "samples")
    io.write_samples(s, path, "x", 5)
    back = io.load_samples(spark, path, "train")
    return back.select("segment", "ts", *[F.element_at("x", i + 1).alias(c) for i, c in enumerate(lags)], "y")


@register("samples_batches", f"""
SELECT * EXCLUDE (split), CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'early' ELSE 'late' END AS batch FROM ({samples_sql(60, 5)}) s WHERE split = 'train'""", ids="K03 S14")
def q_samples_batches(spark, sf_dir):
    """Two batches, of which one is written twice: its rows are there once."""
    lags = [f"lag_{i}" for i in range(5, 0, -1)]
    s = ts_samples_df(spark, sf_dir, 60, 5).select("segment", "ts", F.array(*lags).alias("x"), "y", "split")
    early, path = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), io.scratch_path(spark, "batches")
    for batch, rows in (("early", early), ("late", ~early), ("early", early)):
        io.write_samples(s.where(rows), path, "x", 5, batch=batch)
    back = io.load_samples(spark, path, "train", s.withColumn("batch", F.lit("")).schema)
    return back.select("segment", "ts", *[F.element_at("x", i + 1).alias(c) for i, c in enumerate(lags)], "y", "batch")


# ---------------------------------------------------------------------------------------------------
# run report (M16): result CSVs in run folders → one table with case / lag / granularity
# ---------------------------------------------------------------------------------------------------

_RUN_SQL = """(SELECT 'case' || CASE l_linestatus WHEN 'O' THEN '1' ELSE '2' END || '_lag24_g60' AS run, model, y, p FROM (
  SELECT l_linestatus, m.model, l_extendedprice AS y,
         CASE m.model WHEN 'm1' THEN l_quantity * 1000 WHEN 'm2' THEN l_quantity * 950 + 500 ELSE l_extendedprice * 0.5 END AS p
  FROM lineitem, (VALUES ('m1'), ('m2'), ('baseline')) m(model)))"""


@register("run_report", f"""
WITH inv AS (SELECT 'case' || CASE l_linestatus WHEN 'O' THEN '1' ELSE '2' END || '_lag24_g60' AS run, count(DISTINCT l_returnflag) AS num FROM lineitem GROUP BY 1),
ep AS (SELECT 'case' || CASE l_linestatus WHEN 'O' THEN '1' ELSE '2' END || '_lag24_g60' AS run, count(DISTINCT l_linenumber) AS epochs FROM lineitem GROUP BY 1)
SELECT CAST(any_value(inv.num) AS BIGINT) AS Num, CASE WHEN model = 'm1' THEN CAST(any_value(ep.epochs) AS VARCHAR) ELSE '_' END AS Epochs,
       CASE WHEN count(*) // 60 > 0 THEN CAST(count(*) // 60 AS VARCHAR) || 'm' ELSE '' END || CASE WHEN count(*) % 60 > 0 THEN CAST(count(*) % 60 AS VARCHAR) || 's' ELSE '' END AS Time,
       CAST(round_even(avg((y - p) * (y - p)) / 1000000, 2) AS VARCHAR) AS MSE, CAST(round_even(avg(abs((y - p) / NULLIF(y, 0))), 4) AS VARCHAR) AS MAPE,
       CAST(round_even(avg(2 * abs(y - p) / NULLIF(abs(y) + abs(p), 0)), 4) AS VARCHAR) AS SMAPE,
       CAST(round_even(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 4) AS VARCHAR) AS R2,
       model AS Name, CAST(regexp_extract(run, 'case(\\d+)', 1) AS BIGINT) AS "case",
       CAST(regexp_extract(run, 'lag(\\d+)', 1) AS BIGINT) AS lag, CAST(regexp_extract(run, '_g(\\d+)', 1) AS BIGINT) AS granularity,
       CAST(round_even(avg(abs(y - p)), 2) AS VARCHAR) AS MAE, CAST(round_even(sqrt(avg((y - p) * (y - p))), 2) AS VARCHAR) AS RMSE
FROM {_RUN_SQL} r JOIN inv USING (run) JOIN ep USING (run) WHERE model NOT LIKE '%baseline%' GROUP BY run, model""", ids="M16 S07 P10 P11 U01")
def q_run_report(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    st = F.array(F.struct(F.lit("m1").alias("model"), (F.col("l_quantity") * 1000).alias("p")),
                 F.struct(F.lit("m2").alias("model"), (F.col("l_quantity") * 950 + 500).alias("p")),
                 F.struct(F.lit("baseline").alias("model"), (F.col("l_extendedprice") * 0.5).alias("p")))
    run = F.concat(F.lit("case"), F.when(F.col("l_linestatus") == "O", "1").otherwise("2"), F.lit("_lag24_g60"))
    preds = li.select(run.alias("run"), F.col("l_extendedprice").alias("y"), F.inline(st))
    aggs = regression_aggs("y", "p")
    aggs["mse"] = aggs["mse"] / 1e6                        # in millions
    scores = preds.groupBy("run", "model").agg(*[aggs[k].alias(k) for k in ("mae", "mse", "rmse", "mape", "smape", "r2")], F.count(F.lit(1)).alias("sec"))
    digits = {"mae": 2, "mse": 2, "rmse": 2, "mape": 4, "smape": 4, "r2": 4}
    names = [k.upper() for k in digits]
    minutes = F.concat(F.when(F.col("sec") >= 60, F.concat(F.floor(F.col("sec") / 60).cast("string"), F.lit("m"))).otherwise(F.lit("")),
                       F.when(F.col("sec") % 60 > 0, F.concat((F.col("sec") % 60).cast("string"), F.lit("s"))).otherwise(F.lit("")))
    results = scores.select("run", F.col("model").alias("Name"), minutes.alias("Time"), *[round_or_raw(k, d).alias(k.upper()) for k, d in digits.items()])
    path = io.scratch_path(spark, "runs")
    write = lambda df, name: df.write.mode("overwrite").partitionBy("run").option("header", True).csv(f"{path}/{name}")
    write(results, "results")
    # of each run also the segments it left out and, for models trained in epochs, a line per epoch
    write(li.select(run.alias("run"), F.col("l_returnflag").alias("segment")).distinct(), "invalid")
    write(li.select(run.alias("run"), F.lit("m1").alias("Name"), F.col("l_linenumber").alias("epoch")).distinct(), "logs")
    read = lambda name, schema: io.with_path_parts(io.read_csvs(spark, f"{path}/{name}", schema=schema), 1, prefix="run")
    res = read("results", "Name string, Time string, " + ", ".join(f"{n} string" for n in names)).where(~F.col("Name").contains("baseline"))
    num = read("invalid", "segment string").groupBy("run0").agg(F.count(F.lit(1)).alias("Num"))
    epochs = read("logs", "Name string, epoch int").groupBy("run0", "Name").agg(F.count(F.lit(1)).cast("string").alias("Epochs"))
    out = res.join(num, "run0", "left").join(epochs, ["run0", "Name"], "left")
    fact = lambda pat: F.regexp_extract("run0", pat, 1).cast("long")
    return out.select(fact(r"case(\d+)").alias("case"), F.coalesce("Num", F.lit(0)).alias("Num"), "Name", "Time", F.coalesce("Epochs", F.lit("_")).alias("Epochs"),
                      fact(r"lag(\d+)").alias("lag"), fact(r"_g(\d+)").alias("granularity"), *names)


# ---------------------------------------------------------------------------------------------------
# generators (S10–S13): sizes and bounds come from the tables
# ---------------------------------------------------------------------------------------------------

@register("date_range", """
SELECT o_orderpriority, CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 7 DAY)) AS TIMESTAMP) AS day
FROM orders GROUP BY o_orderpriority""", ids="S10")
def q_date_range(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    b = o.groupBy("o_orderpriority").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return b.select("o_orderpriority", F.explode(io.date_range(F.col("lo"), F.col("hi"), "7 DAYS")).alias("day"))


def _u_sql(seed, *parts) -> str:
    inner = " || '|' || ".join([f"'{seed}'", *[f"CAST({p} AS VARCHAR)" for p in parts]])
    return f"((CAST('0x' || substr(md5({inner}), 1, 13) AS BIGINT) + 0.5) / 4503599627370496::DOUBLE)"


@register("range_frame", f"""
SELECT id, round({_u_sql(3, 'id')}, 9) AS u FROM (SELECT row_number() OVER () - 1 AS id FROM orders)""", ids="S11")
def q_range_frame(spark, sf_dir):
    n = table(spark, sf_dir, "orders").count()        # one scalar: the frame grows with the table
    return gen.range_frame(spark, n, 3).select("id", F.round("u", 9).alias("u"))


@register("sample_dist", f"""
WITH u AS (SELECT o_orderkey, {_u_sql(9, 'o_orderkey')} AS u FROM orders)
SELECT o_orderkey, round(exp(ln(0.001) + u * (ln(100.0) - ln(0.001))), 6) AS loguniform,
       round(-2.0 * ln(1 - u), 6) AS exponential, CAST(ceil(ln(1 - u) / ln(1 - 0.3)) AS BIGINT) AS geometric,
       CAST(3 + floor(u * 7) AS BIGINT) AS randint, round(1 - pow(1 - u, 1 / 3.0), 6) AS beta_1_3, round(0.5 - sin(asin(1 - 2 * u) / 3), 6) AS beta_2_2 FROM u""", ids="S13")
def q_sample_dist(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    u = gen.hash_uniform(9, "o_orderkey")
    return o.select("o_orderkey", r6(gen.sample_dist(u, "loguniform", low=0.001, high=100.0)).alias("loguniform"),
                    r6(gen.sample_dist(u, "exponential", scale=2.0)).alias("exponential"),
                    gen.sample_dist(u, "geometric", p=0.3).alias("geometric"),
                    gen.sample_dist(u, "randint", low=3, high=10).alias("randint"),
                    r6(gen.sample_dist(u, "beta", a=1, b=3)).alias("beta_1_3"), r6(gen.sample_dist(u, "beta", a=2, b=2)).alias("beta_2_2"))


def _normal_sql(seed, *parts) -> str:
    return (f"(sqrt(-2.0 * ln({_u_sql(seed, *parts, repr('a'))})) * cos(2 * pi() * {_u_sql(seed, *parts, repr('b'))}))")


@register("make_blobs", f"""
WITH b AS (SELECT c_custkey, CAST(CAST('0x' || substr(md5('7c' || CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 3 AS INTEGER) AS blob
           FROM customer)
SELECT c_custkey, blob,
  round(-10.0 + 20.0 * {_u_sql(7, "'centre'", 'blob', 0)} + {_normal_sql(7, 'c_custkey', 0)}, 6) AS x0,
  round(-10.0 + 20.0 * {_u_sql(7, "'centre'", 'blob', 1)} + {_normal_sql(7, 'c_custkey', 1)}, 6) AS x1
FROM b""", ids="S12")
def q_make_blobs(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    b = gen.make_blobs(c, "c_custkey", 3, 2, 7)
    return b.select("c_custkey", "blob", r6("x0").alias("x0"), r6("x1").alias("x1"))
