from pyspark.sql import functions as F

import pytest

from concordia.operators import joins, quality
from concordia.sources import flatten, merge, readers


def test_optional_source(spark, tmp_path):
    schema = "a bigint, b string"
    assert readers.optional_source(spark, str(tmp_path / "none" / "*.parquet"), schema).dtypes == [("a", "bigint"), ("b", "string")]
    spark.range(3).select(F.col("id").cast("int").alias("A")).write.parquet(str(tmp_path / "x"))
    got = readers.optional_source(spark, str(tmp_path / "x"), schema)
    assert got.dtypes == [("a", "bigint"), ("b", "string")] and got.count() == 3


def test_partitions_are_replaced_and_united_by_name(spark, tmp_path):
    path = str(tmp_path / "p")
    readers.write_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "season int, v string"), path, ["season"])
    readers.write_partitions(spark.createDataFrame([(2, "c", 1)], "season int, v string, extra int"), path, ["season"])
    got = readers.read_glob(spark, path)
    assert set(got.columns) == {"v", "extra"} and sorted(r.v for r in got.collect()) == ["a", "c"]


def test_write_if_changed(spark, tmp_path):
    path, df = str(tmp_path / "w"), spark.range(4)
    assert [readers.write_if_changed(df, path), readers.write_if_changed(df, path), readers.write_if_changed(df.union(df), path)] == [True, False, True]


def test_text_csv_seed_and_headers(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("Driver Id,lapTime\n1,\\N\n1,\\N\n2,x\n")
    df = readers.snake_case(readers.read_csv_text(spark, str(p)), {"Driver Id": "driverId"})
    assert df.columns == ["driver_id", "lap_time"] and [r.lap_time for r in df.orderBy("driver_id").collect()] == [None, None, "x"]
    out, gone = readers.without_repeats(df)
    assert out.count() == 2 and gone == 1
    assert readers.read_seed(spark, str(p), "a int, b string").dtypes == [("a", "int"), ("b", "string")]


def test_exports_and_layers(spark, tmp_path):
    assert readers.export_tables({"t": spark.range(5)}, str(tmp_path)) == {"t": 5}
    assert readers.publish(spark.range(2), "silver", "v", as_table=False).count() == 2 and spark.table("silver_v").count() == 2
    assert [r.id for r in readers.fixture(spark.range(5), F.col("id") > 2).collect()] == [3, 4]


def test_merge_never_loses_rows(spark):
    rows = lambda n, s: spark.createDataFrame([(p, s, k) for p, c in n.items() for k in range(c)], "part int, s string, k int")
    expected = spark.createDataFrame([(1, 10), (2, 10), (3, 10)], "part int, n int")
    out = merge.merge_by_coverage(rows({1: 10, 2: 3, 3: 2}, "bulk"), rows({1: 20, 2: 8, 3: 4}, "delta"), expected, ["part"], "n", rows({3: 9}, "old"))
    assert {(r.part, r.origin): r["count"] for r in out.groupBy("part", "origin").count().collect()} == {(1, "bulk"): 10, (2, "delta"): 8, (3, "previous"): 9}


def test_nested_documents(spark):
    doc = '{"season": "2024", "round": "1", "Laps": [{"number": "1", "Timings": [{"driverId": "a", "position": "1", "time": "1:30.5"}, {"driverId": "b", "position": "x", "time": null}]}]}'
    schema = "season string, round string, Laps array<struct<number: string, Timings: array<struct<driverId: string, position: string, time: string>>>>"
    df = spark.createDataFrame([(doc,), ("not json",)], "doc string")
    got = flatten.explode_lists(df, "doc", schema, {"season": "season", "round": "round"}, "Laps.Timings", {"driver": ("driverId", "string"), "position": ("position", "int"), "time": ("time", "string")})
    assert sorted(((r.season, r.lap, r.driver, r.position, r.time) for r in got.collect()), key=str) == [("2024", "1", "a", 1, "1:30.5"), ("2024", "1", "b", None, None)]


def test_message_feed(spark):
    rows = [('["00:10:01.500", {"Messages": [{"Category": "Flag", "Message": "RED"}]}]',), ('["00:11:00", {"Messages": {"1": {"Category": "Other", "Message": "x"}}}]',), ("broken",)]
    got = flatten.message_feed(spark.createDataFrame(rows, "line string"), "line", "struct<Category: string, Message: string>", [])
    assert sorted((r.session_ms, r.Category, r.Message) for r in got.collect()) == [(601500, "Flag", "RED"), (660000, "Other", "x")]


def test_dump_conversion(spark):
    f = spark.createDataFrame
    dump = {
        "season": f([(1, 2024)], "id long, year int"), "round": f([(10, 1, 3)], "id long, season_id long, number int"), "session": f([(100, 10, "R"), (101, 10, "Q1"), (102, 10, "Q2")], "id long, round_id long, type string"),
        "sessionentry": f([(1000, 100, 500, 1, True, 1, 25.0), (1001, 100, 501, 20, False, 11, 0.0), (1002, 101, 500, 4, True, 0, 0.0), (1003, 102, 500, 2, True, 0, 0.0)], "id long, session_id long, round_entry_id long, position int, is_classified boolean, status int, points double"),
        "roundentry": f([(500, 50, 44), (501, 51, 5)], "id long, team_driver_id long, car_number int"), "teamdriver": f([(50, 7, 70), (51, 8, 70)], "id long, driver_id long, team_id long"),
        "driver": f([(7, "ham"), (8, "vet")], "id long, reference string"), "team": f([(70, "red")], "id long, reference string"),
    }
    laps = f([(1000, 1, "1:31.0009"), (1000, 2, "1:30.5"), (1002, 1, "1:20"), (1003, 1, "1:19"), (1003, 2, None)], "session_entry_id long, number int, time string")
    entries = flatten.flat_entries(dump)
    got = {r.driver: r for r in flatten.flat_results(entries, laps, {11: "R"}).collect()}
    assert (got["ham"].position_text, got["ham"].fastest_lap, got["ham"].fastest_ms, got["vet"].position_text, got["ham"].season, got["ham"]["round"]) == ("1", 2, 90500, "R", 2024, 3)
    q = flatten.flat_qualifying(entries, laps).first()
    assert (q.q1_ms, q.q2_ms, q.q3_ms, q.position) == (80000, 79000, None, 2)
    assert flatten.flat_steps(entries, laps.where("session_entry_id = 1000")).where("ms = 91000").count() == 1


def test_asof_keeps_unmatched_rows_and_repeats(spark):
    left = spark.createDataFrame([(1, 5, "x"), (1, 5, "x"), (1, 0, "y"), (2, 9, "z"), (None, 9, "n"), (1, None, "t")], "k int, t int, name string")
    right = spark.createDataFrame([(1, 1, "a"), (1, 5, "b"), (1, 6, "c"), (None, 1, "q"), (1, None, "w")], "k int, rt int, v string")
    got = sorted((r.name, r.v) for r in joins.asof_join(left, right, ["k"], "t", "rt", ["v"]).collect())
    assert got == [("n", None), ("t", None), ("x", "b"), ("x", "b"), ("y", None), ("z", None)]


def test_overlaps_and_first_ends_at_ties(spark):
    e = spark.createDataFrame([(1, 1, "s"), (1, 1, "e"), (1, 3, "e"), (1, 4, "e"), (1, 9, "s")], "k int, sec int, kind string").withColumn("at", F.timestamp_seconds("sec"))
    got = {r.sec: r.ended_at for r in joins.first_end_after(e, ["k"], "at", F.col("kind") == "s", F.col("kind") == "e").collect()}
    assert got[1].second == 3 and got[9] is None


def test_guards(spark):
    with pytest.raises(ValueError):
        quality.assert_unique(spark.createDataFrame([(1,), (1,)], "a int"), ["a"])
    assert quality.wide_types(spark.sql("SELECT 1 AS a, CAST(1 AS DECIMAL(38, 0)) AS b")) == [("b", "decimal(38,0)")]
    card = quality.scorecard([quality.check(spark.range(10), "c", {"all": (F.lit(True), F.col("id") < 9)}, {"all": 95.0})])
    assert quality.failures_first(card).first().status == "FAIL"


def test_overlaps_by_brute_force(spark):
    import random

    rnd = random.Random(1)
    when = lambda: rnd.choice([None, *range(12)])
    spans = [(rnd.choice([1, 2, None]), when(), when(), i % 3) for i in range(120)]
    periods = [(rnd.choice([1, 2, 3, None]), when(), when()) for _ in range(6)]
    got = joins.overlaps(spark.createDataFrame(spans, "k int, a int, b int, v int"), spark.createDataFrame(periods, "k int, p int, q int"), ["k"], ("a", "b"), ("p", "q"), "hit").collect()
    want = [(k, a, b, v, any(k is not None and k == j and a is not None and b is not None and p is not None and p < b and (q if q is not None else b) > a for j, p, q in periods)) for k, a, b, v in spans]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rules_with_wildcards_and_nulls(spark):
    rows = spark.createDataFrame([(1, "x", 1), (1, None, 2), (1, None, 2), (2, "x", 3), (None, "x", 4)], "k int, a string, v int")
    rules = spark.createDataFrame([(1, "x", "first"), (1, None, "any"), (None, "x", "never")], "k int, ra string, name string").withColumn("n", F.when(F.col("name") == "first", 1).otherwise(2))
    got = joins.wildcard_rules(rows, rules, ["k"], {"ra": "a"}, ["n"]).collect()
    assert sorted((r.v, r.name) for r in got) == [(1, "first"), (2, "any"), (2, "any"), (3, None), (4, None)]


def test_dump_of_a_database(spark, tmp_path):
    """Every base table of a relational database (the one that Spark brings along)."""
    url, driver = "jdbc:derby:memory:dump;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    for name, df in {"A": spark.range(3), "B": spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")}.items():
        df.write.jdbc(url, name, properties=driver)
    catalogue = "SELECT tablename FROM sys.systables WHERE tabletype = 'T'"
    assert readers.copy_database(spark, url, str(tmp_path), catalogue=catalogue, **driver) == {"A": 3, "B": 2}
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "B")).collect())) == [(1, "x"), (2, None)]
    assert readers.copy_database(spark, url, str(tmp_path / "one"), ["A"], **driver) == {"A": 3}


def test_repeated_rows_count_in_comparisons(spark):
    a, b = (spark.createDataFrame([(x,) for x in v], "x int") for v in ([1, 1, 2, None], [1, 2, 2, None]))
    assert not quality.same_rows(a, b) and quality.same_rows(a, a) and not quality.same_rows(a, a.limit(3))
    assert sorted((r.side, r.x, r.n) for r in quality.rows_of_one_side(a, b).collect()) == [("only_left", 1, 1), ("only_right", 2, 1)]


def test_plain_projections(spark):
    from concordia.sources import staging

    names = {t: [c[3] for c in staging.projection("archive", t)] for t in staging.PROJECTIONS["archive"]}
    assert len(names["race_data"]) == 42 and {t: len(x) for t, x in names.items() if len(x) < 5} == {"constructors": 4, "engine_manufacturers": 3, "tyre_manufacturers": 3}
    columns = [c[0] for c in staging.projection("archive", "races")]
    df = spark.createDataFrame([(1, *["x"] * (len(columns) - 1))], ", ".join(f"`{c}` {'long' if c == 'id' else 'string'}" for c in columns))
    r = staging.project(df.withColumns({"sprint_race_date": F.lit(None).cast("date"), "drivers_championship_decider": F.lit("1"), "extra": F.lit(0)}), "archive", "races").first()
    assert (r.race_id, r.has_sprint, r.drivers_championship_decider, r.constructors_championship_decider, r.season) == (1, False, True, None, "x") and "extra" not in r
    messages = spark.createDataFrame([("2024", "1", "2024-03-02 15:00:00", "61000", "3", "Flag", "RED", "Track", None, "44x", "m", "s")], ", ".join(f"`{c[0]}` string" for c in staging.projection("timing", "race_control_messages")))
    m = staging.project(messages, "timing", "race_control_messages").first()
    assert (m.season, m.session_time_ms, m.lap_number, m.driver_number, str(m.message_utc)) == (2024, 61000, 3, None, "2024-03-02 15:00:00")
    q = staging.project(spark.createDataFrame([("2024", "5", "ham", "red", 44, "2", "80000", "x", None, "api")], "season string, round string, driver_ref string, constructor_ref string, car_number int, position string, q1_ms string, q2_ms string, q3_ms string, origin string"), "dump", "qualifying").first()
    assert (q.driver_number, q.position, q.q1_ms, q.q2_ms, q.q3_ms) == ("44", 2, 80000, None, None)
