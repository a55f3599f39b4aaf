from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.functions import names as N
from concordia.sources import staging


def one(spark, *columns):
    return list(spark.range(1).select(*columns).first())


def test_durations(spark):
    cases = {"1:39.019": 99019, "1:02:03.5": 3723500, "42.414": 42414, "2:03:04.567": 7384567, " 1:39.019 ": 99019, "1:39.0195": 99020, "+1.5": 1500, "-": None, "": None, "DNF": None, "1:3a.2": None, None: None}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", C.duration_ms("t").alias("ms")).collect()
    assert {r.t: r.ms for r in rows} == cases
    exact = {"1:39.0195": 99019, "2 days 00:00:01.5": 172801500, "1 day 0:00:01": 86401000, "0.9999": 999, "x": None, None: None}
    rows = spark.createDataFrame([(t,) for t in exact], "t string").select("t", C.duration_ms_exact("t").alias("ms")).collect()
    assert {r.t: r.ms for r in rows} == exact


def test_names(spark):
    cases = {"Sébastien Buemi": "sebastien buemi", "Carlos Sainz Jr.": "carlos sainz", "Jean-Éric Vergne": "jean eric vergne", "Kimi Räikkönen": "kimi raikkonen", "Łukasz Øre ß": "ukasz re", None: None}
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", N.normalized_name("t").alias("n")).collect()
    assert {r.t: r.n for r in rows} == cases


def test_unknowns_stay_unknown(spark):
    null = F.lit(None).cast("int")
    assert one(spark, C.same(null, null).alias("a"), C.same(null, F.lit(1)).alias("b"), C.within(null, F.lit(1), 1).alias("c"), C.match_flag(F.lit(1), null).alias("d"), C.percent(F.lit(1), F.lit(0)).alias("e")) == [True, False, None, None, None]


def test_json_numbers(spark):
    rows = spark.createDataFrame([(t,) for t in ("1.5", '"+1 LAP"', "[1, 2]", "", "nan{", None)], "t string").select(C.json_number("t").alias("v")).collect()
    assert [r.v for r in rows] == [1.5, None, None, None, None, None]


def test_local_dates(spark):
    start = C.utc_timestamp(F.lit("2024-03-02T23:30:00+00:00"))
    assert [str(x) for x in one(spark, C.local_date(start, F.lit("03:00:00")).alias("a"), C.local_date(start, F.lit("-08:00:00")).alias("b"))] == ["2024-03-03", "2024-03-02"]


def test_validation_status(spark):
    rows = [(90000, 90001, None, 5), (90000, None, None, 5), (None, 90000, None, 5), (90000, 95000, None, 1), (90000, 90700, 99000, 5), (90000, 310000, None, 5), (90000, 95000, 96000, 5)]
    df = spark.createDataFrame(rows, "v int, a int, b int, lap int")
    got = df.select(C.validation_status("v", [F.col("a"), F.col("b")], F.col("lap") == 1).alias("s"), C.confirmed_by("v", {"a": F.col("a"), "b": F.col("b")}).alias("by")).collect()
    assert [r.s for r in got] == ["confirmed", "single_source", "single_source", "timing_convention", "timing_convention", "timing_convention", "disputed"]
    assert got[0].by == ["a"] and got[6].by == []


def test_message_events(spark):
    rows = [("RED FLAG - RACE SUSPENDED", None, "Other", None, "red_flag"), ("x", "RED", "Flag", "Track", "red_flag"), ("VSC DEPLOYED", None, "SafetyCar", None, "vsc_deployed"), ("VIRTUAL SAFETY CAR ENDING", None, None, None, "vsc_ending"), ("SAFETY CAR DEPLOYED", None, None, None, "safety_car_deployed"), ("SAFETY CAR IN THIS LAP", None, None, None, "safety_car_in"), ("TRACK CLEAR", "CLEAR", "Flag", "Track", "track_clear"), ("CLEAR IN SECTOR", "CLEAR", "Flag", "Sector", None), ("CHEQUERED FLAG", "CHEQUERED", "Flag", "Track", "chequered_flag"), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "message string, flag string, category string, scope string, want string")
    assert [r.e for r in df.select(staging.message_event().alias("e")).collect()] == [r[4] for r in rows]


def test_chart_laps(spark):
    head = "season, round, car_number, driver_name, lap, rank, time, gap, interval, tyre, tyre_age, status, lap_time, sector_1, sector_2, sector_3".split(", ")
    rows = [("2024", "1", "44", "A", "Grid", "1", "-", "-", "-", "-", "-", "", "-", "-", "-", "-"), ("2024", "1", "44", "A", "3", "2", "4:01.500", "+1 Lap", "+0.5", "us", "4", "Pit, Virtual Safety Car", "1:20.1", "30.1", "-", "DNF")]
    got = staging.chart_laps(spark.createDataFrame(rows, ", ".join(f"{h} string" for h in head))).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.lap_number, r.position, r.race_time_ms, r.gap_to_leader_ms, r.gap_to_leader_laps, r.interval_ms, r.tyre_compound, r.lap_time_ms, r.sector_1_ms, r.sector_3_ms) == (3, 2, 241500, None, 1, 500, "ULTRASOFT", 80100, 30100, None)
    assert (r.is_pit_in_lap, r.is_safety_car, r.is_virtual_safety_car, r.is_red_flag) == (True, False, True, False)


def test_event_feed_staging(spark):
    sessions = spark.createDataFrame([(1, 9, 2024, "Race", "Race", "2024-03-02T23:30:00+00:00", None, "03:00:00", 5, "c", "BHR", "Bahrain", "S", None)], staging.EVENT_SCHEMAS["sessions"])
    r = staging.event_sessions(sessions).first()
    assert str(r.local_date) == "2024-03-03" and r.is_cancelled is False and r.date_end_utc is None
    results = spark.createDataFrame([(1, 44, '"RT"', 50, True, None, None, "[1, 2]", "+1 LAP", 0.0), (1, 1, "1.0", 57, None, None, None, "5504.742", "0", 26.0)], staging.EVENT_SCHEMAS["session_result"])
    assert [(r.position, r.time_ms, r.is_dnf) for r in staging.event_results(results).orderBy("driver_number").collect()] == [(1, 5504742, False), (None, None, True)]


def test_search_keeps_digits_and_marks(spark):
    rows = ["Ana", "Car 42", "#7 José", None]
    df = spark.createDataFrame([(r,) for r in rows], "n string")
    found = lambda w: [r.n for r in df.where(N.name_contains("n", w)).collect()]
    assert (found("42"), found("#"), found("jose"), found("JOSÉ"), found("")) == (["Car 42"], ["#7 José"], ["#7 José"], ["#7 José"], ["Ana", "Car 42", "#7 José"])
