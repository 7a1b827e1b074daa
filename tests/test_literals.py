"""Literal checks: small inputs with values worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from chronoframe.functions import numeric as num
from chronoframe.functions import text as tx
from chronoframe.operators import metrics as mt


def test_accuracy_confusion_cost(spark):
    # the classification literals of the reference notebook: accuracy 0.6, confusion [[2,1,1],[1,2,0],[0,1,2]]
    y = [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    p = [0, 1, 0, 2, 1, 1, 0, 2, 1, 2]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    assert mt.accuracy(df, "y", "p").first()[0] == pytest.approx(0.6)
    assert mt.zero_one_cost(df, "y", "p").first()[0] == 4
    wide = mt.confusion_matrix(df, "y", "p", [0, 1, 2]).orderBy("actual").collect()
    assert [list(r)[1:] for r in wide] == [[2, 1, 1], [1, 2, 0], [0, 1, 2]]
    animals = spark.createDataFrame([("Cat", "Cat"), ("Dog", "Cat"), ("Cat", "Cat"), ("Cat", "Cat"), ("Cat", "Cat")],
                                    "y string, p string")
    assert mt.zero_one_cost(animals, "y", "p").first()[0] == 1


def test_regression_literals(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 2.3), (3.0, 3.7)], "y double, p double")
    r = mt.regression_metrics(df, "y", "p").first()
    assert r["mse"] == pytest.approx((0.01 + 0.09 + 0.49) / 3)
    assert r["rmse"] == pytest.approx(math.sqrt((0.01 + 0.09 + 0.49) / 3))
    assert r["mae"] == pytest.approx((0.1 + 0.3 + 0.7) / 3)


def test_iou_literal(spark):
    df = spark.createDataFrame([(50, 50, 90, 100, 70, 80, 120, 150)], "a int, b int, c int, d int, e int, f int, g int, h int")
    got = df.select(mt.iou("a", "b", "c", "d", "e", "f", "g", "h")).first()[0]
    assert got == pytest.approx(21 * 21 / (41 * 51 + 51 * 71 - 21 * 21))


def test_t_critical_values():
    assert mt.t_ppf(0.975, 10) == pytest.approx(2.228138851986274, rel=1e-9)
    assert mt.t_ppf(0.975, 1000) == pytest.approx(1.962339136, rel=1e-6)
    assert mt.z_critical(0.95) == pytest.approx(1.959963984540054)


def test_duration_text(spark):
    df = spark.createDataFrame([("1m30s",), ("45s",), ("2h0m5s",), ("junk",)], "t string")
    got = [r[0] for r in df.select(tx.parse_duration("t")).collect()]
    assert got == [90.0, 45.0, 7205.0, None]
    df2 = spark.createDataFrame([(0.0,), (3723.0,), (60.0,), (2.5,)], "s double")
    assert [r[0] for r in df2.select(tx.format_duration("s")).collect()] == ["0s", "1h2m3s", "1m", "2s"]


def test_replace_first_and_weights(spark):
    df = spark.createDataFrame([("a-b-c", "run_w3_x_w7_y.csv"), ("abc", "plain.csv")], "s string, f string")
    r = df.select(tx.replace_first("s", "-", "+").alias("r"), tx.weight_from_name("f").alias("w")).collect()
    assert [x["r"] for x in r] == ["a+b-c", "abc"]
    assert [x["w"] for x in r] == [7.0, 1.0]


def test_crc_and_md5_buckets_match_python(spark):
    import hashlib
    import zlib
    ids = [0, 1, 7, 123456789, -5]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    crc = [r[0] for r in df.select(F.crc32(num.id_le_bytes("id"))).collect()]
    assert crc == [zlib.crc32(i.to_bytes(8, "little", signed=True)) for i in ids]
    md5 = [r[0] for r in df.select(num.in_test_md5("id", 0.2)).collect()]
    assert md5 == [hashlib.md5(i.to_bytes(8, "little", signed=True)).digest()[-1] < 256 * 0.2 for i in ids]
