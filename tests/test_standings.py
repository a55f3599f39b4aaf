"""Standings after each month hold every result of every season, whatever its race id."""

import pyspark.sql.functions as F

from concordia.operators import metrics
from concordia.plans import base, serving  # noqa: F401


def test_standings_of_a_season(spark):
    rows = [(99_999, 1, "a", "x", 1, 5), (7, 1, "b", "y", 2, 3), (8, 2, "b", "z", 1, 3), (90_000, 3, "c", "x", 1, 1), (1, 3, "b", "y", None, 0)]
    r = spark.createDataFrame([(2001, "RACE", *x, float(p)) for *x, p in rows], "season int, session_type string, race_id long, round int, driver_id string, constructor_id string, position_number int, points double")
    got = {(x["round"], x.driver_id): (x.points, x.wins, x.teams, x.place) for x in metrics.standings_after_rounds(r, "round").collect()}
    assert got == {
        (1, "a"): (5, 1, "x", 1), (1, "b"): (3, 0, "y", 2),
        (2, "a"): (5, 1, "x", 2), (2, "b"): (6, 1, "y,z", 1),
        (3, "a"): (5, 1, "x", 2), (3, "b"): (6, 1, "y,z", 1), (3, "c"): (1, 1, "x", 3),
    }


def test_no_result_is_left_out(spark):
    folder = "/root/testdata/sf0.01"  # ids beyond 9000
    got = base.QUERIES["e03_e04_standings_by_month"](spark, folder)
    last = got.where("month = 12").agg(F.sum("points")).first()[0]
    want = base.results(base.Tables(spark, folder))
    ends = want.join(spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("race_id"), F.month("o_orderdate").alias("m")), "race_id")
    seasons = [x.season for x in ends.groupBy("season").agg(F.max("m").alias("m")).where("m = 12").collect()]
    assert last == want.where(F.col("season").isin(seasons)).agg(F.sum("points")).first()[0]
    assert {x.season for x in got.select("season").distinct().collect()} == {x.season for x in want.select("season").distinct().collect()}
