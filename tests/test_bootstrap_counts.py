"""Bootstrap counts against hashlib, over several blocks of draws."""

import hashlib

from chronoframe.operators import split as sp


def test_counts_are_those_of_the_hashed_draws(spark):
    rows, rounds = [(i // 2, float(i)) for i in range(90)], 7       # every id twice
    df = spark.createDataFrame(rows, "id long, x double")
    n = len(rows)
    at = lambda r, j: int(hashlib.md5(f"5{r}-{j}".encode()).hexdigest()[:12], 16) % n
    drawn = [[at(r, j) for j in range(n)] for r in range(rounds)]
    placed = sorted(range(45), key=lambda i: (hashlib.md5(f"5{i}".encode()).hexdigest(), i))
    want = {i: [sum(d.count(p) for p in (2 * k, 2 * k + 1)) for d in drawn] for k, i in enumerate(placed)}
    for block in (1, 50, 1 << 21):
        got = sp.bootstrap_counts(df, "id", rounds, 5, "w", block_draws=block).collect()
        assert sorted((r["id"], r["x"]) for r in got) == rows
        sums = {i: [sum(c) for c in zip(*(r["w"] for r in got if r["id"] == i))] for i in want}
        assert sums == want
    long = sp.bootstrap(df, "id", rounds, 5).collect()
    assert sum(r["weight"] for r in long) == n * rounds and min(r["weight"] for r in long) == 1
    assert len({(r["round"], r["x"]) for r in long}) == len(long)
    assert sp.bootstrap_counts(df.where("false"), "id", rounds, 5).count() == 0


def test_draws_cross_no_join(spark):
    """Draws go as blocks to their rows: the plan of ``bootstrap`` joins nothing and aggregates no row of a single draw."""
    df = spark.range(20).withColumnRenamed("id", "k")
    plan = sp.bootstrap(df, "k", 3, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan


def test_hashes_of_many_numbers_are_those_of_hashlib():
    from chronoframe.operators.md5 import hasher
    for prefix, lo, hi in (("42137-", 0, 1200), ("425-", 9990, 10020), ("é-", 99, 101), ("x" * 50, 99998, 100003), ("y" * 54, 7, 9), ("", 0, 20), ("1", 3, 3)):
        heads = [prefix, prefix + "7", prefix]
        for head, got in zip(heads, hasher()(heads, lo, hi)):
            assert got.tolist() == [int(hashlib.md5(f"{head}{j}".encode()).hexdigest()[:12], 16) for j in range(lo, hi)], (head, lo, hi)


def test_a_draw_makes_no_row_in_the_plan(spark):
    """The rows that reach the tasks of the draws are those tasks, not the draws, which were exploded and hashed as texts."""
    plan = sp.bootstrap_counts(spark.range(50).withColumnRenamed("id", "k"), "k", 40, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "md5(" not in plan


def test_counts_of_many_rounds_over_several_tasks_and_runs(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    got = sp.bootstrap_counts(df, "k", 120, "s", "w", block_draws=120 * 64).collect()
    at = [[int(hashlib.md5(f"s{r}-{j}".encode()).hexdigest()[:12], 16) % 500 for j in range(500)] for r in range(120)]
    placed = sorted(range(500), key=lambda i: hashlib.md5(f"s{i}".encode()).hexdigest())
    want = {k: [d.count(p) for d in at] for p, k in enumerate(placed)}
    assert {r["k"]: list(r["w"]) for r in got} == want
