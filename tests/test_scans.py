"""Fits, searches and positions scan their input once and never broadcast it; parts of training rows are bounded."""

import random

from pyspark.sql import functions as F

from chronoframe.operators import models as md
from chronoframe.operators import order, split
from chronoframe.operators import vectors as vx


def counted(spark, n=300):
    """Rows that count themselves whenever they are computed."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(n).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    df = df.withColumn("y", F.col("a") * 2 + F.col("b"))
    return df.mapInArrow(run, df.schema), seen


def test_models_read_their_rows_once(spark):
    held = lambda: set(spark.sparkContext._jsc.sc().getPersistentRDDs().keys().mkString(",").split(","))
    before = held()                # other tests' copies
    train, seen = counted(spark)
    test, tested = counted(spark)
    got = md.run_models(train, test, "y", ["a", "b"], ["LR", "DT"]).collect()
    assert {r["model"] for r in got} == {"LR", "DT"} and seen.value == tested.value == 300
    for fit in (lambda d: md.fit_tree(d, "y", ["a", "b"], depth=2), lambda d: md.fit_forest(d, "y", ["a", "b"], trees=2, depth=2),
                lambda d: md.fit_gbt(d, "y", ["a", "b"], rounds=2, depth=2)):
        df, seen = counted(spark)
        fit(df)
        assert seen.value == 300
    assert held() <= before | {""}


def test_parts_of_training_rows_are_bounded(spark):
    sizes = md.written_rows(spark.range(1000), ["id"], part_rows=100).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 200 and sum(r["count"] for r in sizes) == 1000
    assert md.written_rows(spark.range(0), ["id"]).count() == 0


def test_preparation_search_reads_its_rows_once(spark):
    from pyspark.ml.regression import LinearRegression
    df, seen = counted(spark)
    make = lambda: LinearRegression(featuresCol="features", labelCol="y")
    got = md.preparation_search(df, "id", "y", ["a", "b"], make, ["median", "most_frequent"], [1], lambda d: ["a", "b"])
    assert len(got) == 2 and seen.value == 300


def test_positions_never_broadcast_the_rows(spark):
    plan = order.hash_position(spark.range(50), "id", 1)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_tiles_of_neighbours_are_exact_with_ties_and_keep_floats(spark, monkeypatch):
    r = random.Random(4)
    vec = lambda: [float(r.randint(0, 3)), float(r.randint(0, 3))]
    train, query = [(i, i % 3, vec()) for i in range(200)], [(1000 + i, 0, vec()) for i in range(40)]
    make = lambda rows: spark.createDataFrame(rows, "i long, l long, v array<float>")
    kinds, top = [], vx._tile_top
    monkeypatch.setattr(vx, "_tile_top", lambda tiles, k, width: kinds.append(dict(tiles.dtypes)["x"]) or top(tiles, k, width))
    for sizes in ({}, {"block_rows": 16}, {"cell_rows": 32, "block_rows": 7}):
        got = {(x.i, x.l): x.share for x in vx.knn_class_share(make(train), make(query), "i", "v", "l", k=5, **sizes).collect()}
        for q, _, x in query:
            near = sorted((sum((a - b) ** 2 for a, b in zip(x, t)), i, lab) for i, lab, t in train)[:5]
            assert {lab: got.get((q, lab), 0) * 5 for lab in range(3)} == {lab: sum(n[2] == lab for n in near) for lab in range(3)}
    assert set(kinds) == {"array<float>"}


def test_a_split_without_positions_is_the_same_and_sorts_one_bucket(spark):
    r = random.Random(8)
    ids = [f"k{r.randint(0, 900)}" for _ in range(700)] + [None] * 9                  # ids may repeat or be null
    whole = spark.createDataFrame([(k, i) for i, k in enumerate(ids)], "k string, v int").repartition(5)
    for df, ratio, up in ((whole, 0.2, False), (whole, 0.003, True), (whole, 0.0, False), (whole, -0.5, False), (whole, 1.0, False), (whole.limit(1), 0.5, True), (whole.where("false"), 0.2, False)):
        got, want = (split.random_split_exact(df, "k", ratio, 3, up, with_pos=w).groupBy("k", "split").count() for w in (False, True))
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), (ratio, up)


def test_the_split_of_rows_without_a_key_moves_them_once(spark, tmp_path):
    """Shuffled rows of the query's split: the table once, then counts and one bucket."""
    from chronoframe.plans import q_models as qm
    rows = [(i // 3, i % 3, float(i % 50), float(i % 11) / 100, float(i % 9) / 100, float(i)) for i in range(4000)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_extendedprice double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    plans, keep = [], qm.materialize
    qm.materialize = lambda df, name: plans.append(df) or keep(df, name)
    try:
        train, test = qm._lineitem_split(spark, str(tmp_path))
    finally:
        qm.materialize = keep
    assert (train.count(), test.count()) == (3200, 800)
    plans[0].collect()
    final = plans[0]._jdf.queryExecution().executedPlan().toString()
    final = final[: final.index("Initial Plan")]
    assert final.count("- Exchange hashpartitioning(_deal") == 1 and "SortMergeJoin" not in final
