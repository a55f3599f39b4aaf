"""Windows dealt by ranges: equal to plain windows, also on one hot key, whatever the number of ranges."""

import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from concordia.operators import sliced


@pytest.fixture(scope="module")
def rows(spark):
    random.seed(1)
    key = lambda: random.choice(["hot"] * 6 + ["a", "b", None])
    data = [(key(), random.choice([1, 2, 2, 2, 3, 5, None]), i, random.choice([None, 1, 2, 3])) for i in range(3000)]
    return spark.createDataFrame(data, "k string, x int, i int, v long").cache()


def same(got, want):
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(*got.columns).collect()))


@pytest.mark.parametrize("parts", [1, 7])
def test_ranks(rows, parts):
    w = Window.partitionBy("k").orderBy(F.desc_nulls_last("x"))
    same(sliced.ranks(rows, ["k"], ["-x"], "r", "d", parts), rows.withColumns({"r": F.rank().over(w).cast("long"), "d": F.dense_rank().over(w).cast("long")}))


@pytest.mark.parametrize("parts", [1, 7])
def test_row_numbers_and_sums(rows, parts):
    w = Window.partitionBy("k").orderBy(F.asc_nulls_last("x"), F.desc_nulls_last("i"))
    same(sliced.row_numbers(rows, ["k"], ["x", "-i"], "n", parts), rows.withColumn("n", F.row_number().over(w).cast("long")))
    same(sliced.running_sum(rows, ["k"], ["x", "-i"], "v", "s", parts), rows.withColumn("s", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))))


def test_equal_rows_get_different_numbers(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("x").alias("v"))
    assert sorted(r.n for r in sliced.row_numbers(df, ["k"], ["v"], "n", 5).collect()) == list(range(1, 501))


def test_a_hot_key_lies_in_many_ranges(rows):
    sizes = sliced.in_ranges(rows.where("k = 'hot'"), ["k"], ["i"], 8).groupBy(sliced._RANGE).count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 0.4 * sum(r["count"] for r in sizes)


def test_asof_join(spark):
    random.seed(2)
    key = lambda: random.choice(["hot"] * 5 + ["a", None])
    left = [(key(), random.choice([None, *range(60)]), i) for i in range(400)]
    right = [(key(), random.choice([None, *range(0, 60, 5)]), random.choice([None, 1, 2]), i % 50) for i in range(300)]
    want = []
    for k, t, i in left:
        fits = [(rt, -1 if a is None else a, b) for rk, rt, a, b in right if k is not None and t is not None and rk == k and rt is not None and rt <= t + 2]
        best = max(fits, default=None)
        want.append((k, t, i, None if best is None or best[1] < 0 else best[1], best and best[2]))
    a, b = spark.createDataFrame(left, "k string, t int, i int"), spark.createDataFrame(right, "k string, rt int, a int, b int")
    for parts in (1, 5, 16):
        got = sliced.asof_join(a, b, ["k"], "t", "rt", ["a", "b"], F.lit(2), parts=parts)
        assert Counter(map(tuple, got.collect())) == Counter(want)


def test_empty(spark):
    df = spark.createDataFrame([], "k string, x int")
    assert sliced.ranks(df, ["k"], ["x"], "r").count() == sliced.row_numbers(df, ["k"], ["x"], "r").count() == 0
    assert sliced.asof_join(df, df.withColumnRenamed("x", "y"), ["k"], "x", "y", ["y"]).count() == 0
