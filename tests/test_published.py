"""Published marts: pruning and joins without exchange; reads of databases in ranges; checks while data is written."""

import os

import pytest
from pyspark.sql import functions as F

from concordia.operators import quality
from concordia.plans import base
from concordia.sources import readers

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_join_without_exchange_and_prune_seasons(spark):
    t = base.Tables(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        r, l = base.results(t), base.laps(t)  # noqa: E741
        joined = r.where("season = 1995").join(l, "race_id")
        text = plan(joined)
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert "PartitionFilters: [isnotnull(season" in text and "season" in text.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        every, one = set(r.inputFiles()), set(r.where("season = 1995").inputFiles())
        assert one and all("season=1995" in f for f in one) and len(one) < len(every)
        assert joined.count() == base._results(t).where("season = 1995").join(base._laps(t), "race_id").count() > 0
        assert "Exchange" not in plan(base.QUERIES["s09_e07_e09_marts"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marts_are_made_once_and_again_when_files_change(spark, tmp_path):
    write = lambda n: spark.read.parquet(f"{FOLDER}/lineitem.parquet").limit(n).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "lineitem.parquet"))
    spark.read.parquet(f"{FOLDER}/orders.parquet").write.parquet(str(tmp_path / "orders.parquet"))
    write(100)
    t = base.Tables(spark, str(tmp_path))
    first = base.laps(t)
    assert set(first.inputFiles()) == set(base.laps(t).inputFiles())
    n = first.count()
    write(900)
    assert base.laps(t).count() > n


def test_buckets_of_marts_grow_with_rows(spark, tmp_path, monkeypatch):
    """A task reads one bucket, so a bucket holds a bounded number of rows; marts of one source still have as many buckets."""
    from concordia.plans import model

    assert [readers.buckets_for(n) for n in (0, 3_000_000, 36_000_000, 216_000_000)] == [8, 8, 90, 540]
    for name in ("lineitem", "orders"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    monkeypatch.setattr(readers, "BUCKET_ROWS", 250)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = base.Tables(spark, str(tmp_path))
        rows = t.lineitem.count()
        r, l = base.results(t), base.laps(t)  # noqa: E741
        for mart in (r, l):
            sizes = mart.groupBy(F.pmod(F.hash("race_id"), F.lit(-(-rows // 250))).alias("bucket")).count().agg(F.max("count")).first()[0]
            assert f"{-(-rows // 250)} out of {-(-rows // 250)}" in plan(mart.groupBy("race_id").count()) and sizes < 500
        assert r.count() == base._results(t).count() and l.count() == base._laps(t).count()
        assert "Exchange" not in plan(model.s09_e07_e09_marts(t))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_peers_of_a_race_are_found_without_exchange(spark):
    """Pairs of team-mates stay in their mart's buckets, and are those of the join."""
    from concordia.operators import joins, metrics

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        r = base.results(base.Tables(spark, FOLDER))
        assert "Exchange" not in plan(metrics.versus_best_peer(r))
        own, group = metrics.best_per_race(r), ["race_id", "season", "constructor_id"]
        pairs = joins.peers_of_teams(own, group, "driver_id", ["place", "shown", "points"])
        expected = joins.peer_pairs(own, group, "driver_id", ["place", "shown", "points"])
        assert pairs.columns == expected.columns and sorted(map(repr, pairs.collect())) == sorted(map(repr, expected.collect())) != []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = spark.createDataFrame([(1, "t", "a"), (1, "t", "b"), (1, "t", None), (1, None, "a"), (1, None, "b"), (None, "t", "a"), (None, "t", "b")], "race int, team string, driver string")
    assert sorted(map(tuple, joins.peers_of_teams(rows, ["race", "team"], "driver", []).collect())) == [(1, "t", "a", "b"), (1, "t", "b", "a")]


def test_codes_join_results_of_a_race_without_exchange(spark):
    from concordia.operators import serving
    from concordia.plans import published

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        t = base.Tables(spark, FOLDER)
        text = plan(serving.race_results(published._entered(t), published._drivers(t), published._constructors(t)))
        assert "Exchange hashpartitioning(race_id" not in text and "SortMergeJoin [race_id" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_reads_of_a_database_in_ranges(spark, tmp_path):
    url, driver = "jdbc:derby:memory:ranges;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.range(1, 101).selectExpr("if(id % 10 = 0, null, id) AS k", "id AS v").write.jdbc(url, "T", properties=driver)
    spark.range(0).write.jdbc(url, "E", properties=driver)
    df = readers.read_database(spark, url, "T", ('"k"', 4), **driver)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100 and df.where("k is null").count() == 10
    catalogue = "SELECT tablename FROM sys.systables WHERE tabletype = 'T'"
    counts = readers.copy_database(spark, url, str(tmp_path), catalogue=catalogue, bounds={"T": ('"k"', 4), "E": ('"id"', 3)}, **driver)
    assert counts == {"T": 100, "E": 0} and spark.read.parquet(str(tmp_path / "T")).count() == 100


def test_checked_write(spark, tmp_path):
    path = str(tmp_path / "t")
    good = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "k int, v int")
    rules, keys = {"small": F.col("v") < 5}, {"k": ["k"], "both": ["k", "v"]}
    assert quality.checked_write(good, path, rules, keys) == {"rows": 3, "small": 0, "k": 0, "both": 0}
    bad = spark.createDataFrame([(None, 4), (None, 4), (1, 1), (1, 2)], "k int, v int")
    with pytest.raises(quality.Rejected) as e:
        quality.checked_write(bad, path, rules, keys)
    assert e.value.card == {"rows": 4, "small": 4, "k": 2, "both": 1}
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3] and os.listdir(tmp_path) == ["t"]
    assert quality.checked_write(bad, path, rules, keys, {"small": 4, "k": 2, "both": 1})["rows"] == 4 and spark.read.parquet(path).count() == 4
    assert quality.checked_write(good.limit(0), str(tmp_path / "none"), rules, keys) == {"rows": 0, "small": 0, "k": 0, "both": 0}
