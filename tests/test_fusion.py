"""Scenarios of corrections, numbering, feeds, votes and cascades with rows given and expected."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from concordia.functions.columns import no_texts
from concordia.operators import codes, corrections, feed, fusion, linkage, metrics, offsets, quality
from concordia.sources import staging

LAP = "race_id long, driver_id string, driver_number string, lap_number int, position int, lap_time_ms long, race_time_ms long, gap_to_leader_ms long, is_red_flag boolean"


def laps(spark, rows):
    """(race, driver, lap, position, time[, red])"""
    return spark.createDataFrame([(r, d, d[1:], n, p, t, t * n if t else None, None, bool(rest and rest[0])) for r, d, n, p, t, *rest in rows], LAP)


def fused(spark, s1=(), s2=(), s3=(), s4=(), numbering=(), sheet=(), official=(), reliability=(), uncut=None):
    out = fusion.fuse(
        laps(spark, s1), laps(spark, s2), laps(spark, s3), laps(spark, s4), spark.createDataFrame(list(numbering), "race_id long, numbering_status string, applied_lap_shift int"),
        spark.createDataFrame(list(sheet), "race_id long, driver_id string, lap_number int, original_value long, corrected_value long"), spark.createDataFrame(list(official), "race_id long, driver_id string, official_laps int"),
        spark.createDataFrame(list(reliability), "race_id long, is_reliable boolean, is_replaced boolean"), uncut,
    )
    return {(r.race_id, r.driver_id, r.lap_number): r for r in out.collect()}


def test_vote_replaces_a_time_that_two_sources_deny(spark):
    got = fused(spark, s1=[(1, "d1", 1, 1, 95000), (1, "d1", 2, 1, 99000), (1, "d1", 3, 1, 90000)], s2=[(1, "d1", 2, 1, 90000), (1, "d1", 3, 1, 90500)], s3=[(1, "d1", 2, 1, 90001), (1, "d1", 3, 1, 90500)])
    voted, kept = got[1, "d1", 2], got[1, "d1", 3]
    assert (voted.lap_time_ms, voted.original_lap_time_ms, voted.validation_status, voted.corrections, voted.confirmed_by, voted.source) == (90000, 99000, "corrected", ["lap_time_ms:majority"], [], "s1")
    assert (kept.lap_time_ms, kept.validation_status) == (90000, "timing_convention")  # differs by less than a second
    assert got[1, "d1", 1].validation_status == "single_source"


def test_position_votes_are_withheld_where_they_would_collide(spark):
    s1 = [(1, "d1", 2, 1, 90000), (1, "d2", 2, 2, 91000), (1, "d3", 2, 4, 92000)]
    got = fused(spark, s1=s1, s2=[(1, "d1", 2, 2, 90000), (1, "d3", 2, 3, 92000)], s3=[(1, "d1", 2, 2, 90000), (1, "d3", 2, 3, 92000)])
    assert [got[1, d, 2].position for d in ("d1", "d2", "d3")] == [1, 2, 4]  # the whole lap is withheld
    got = fused(spark, s1=s1, s2=[(1, "d3", 2, 3, 92000)], s3=[(1, "d3", 2, 3, 92000)])
    assert [got[1, d, 2].position for d in ("d1", "d2", "d3")] == [1, 2, 3] and got[1, "d3", 2].corrections == ["position:majority"]


def test_sheet_applies_to_the_reviewed_value_only_and_positions_follow(spark):
    s1 = [(1, "d1", 1, 1, 90000), (1, "d2", 1, 2, 91000)]
    hit = fused(spark, s1=s1, sheet=[(1, "d1", 1, 90000, 92000)])
    assert (hit[1, "d1", 1].lap_time_ms, hit[1, "d1", 1].race_time_ms, hit[1, "d1", 1].position, hit[1, "d2", 1].position, hit[1, "d2", 1].gap_to_leader_ms) == (92000, 92000, 2, 1, 0)
    assert hit[1, "d1", 1].corrections == ["lap_time_ms:sheet", "position:recalculated"] and hit[1, "d1", 1].validation_status == "corrected"
    missed = fused(spark, s1=s1, sheet=[(1, "d1", 1, 89999, 92000)])
    assert missed[1, "d1", 1].lap_time_ms == 90000 and missed[1, "d1", 1].position == 1


def test_sheet_wins_over_the_vote(spark):
    got = fused(spark, s1=[(1, "d1", 2, 1, 99000)], s2=[(1, "d1", 2, 1, 90000)], s3=[(1, "d1", 2, 1, 90000)], sheet=[(1, "d1", 2, 99000, 95000)])[1, "d1", 2]
    assert (got.lap_time_ms, got.validation_status, got.corrections, got.confirmed_by) == (95000, "corrected", ["lap_time_ms:sheet", "lap_time_ms:majority"], [])


def test_one_source_alone_never_votes(spark):
    got = fused(spark, s3=[(1, "d1", 2, 3, 90000)], s4=[(1, "d1", 2, 1, 95000)])
    assert (got[1, "d1", 2].source, got[1, "d1", 2].position, got[1, "d1", 2].corrections) == ("s4", 1, [])


def test_fillers_are_judged_by_the_trusted_feed(spark):
    got = fused(spark, s1=[(1, "d1", 1, 1, 90000)], s3=[(1, "d1", 2, 1, 91000)], s4=[(1, "d1", 2, 1, 91000)], official=[(1, "d1", 5)])
    assert (got[1, "d1", 2].source, got[1, "d1", 2].validation_status, got[1, "d1", 2].confirmed_by, got[1, "d1", 2].lap_numbering_status) == ("s3", "confirmed", ["s4"], "not_applicable")
    assert got[1, "d1", 1].lap_numbering_status == "no_evidence"


def test_sums_of_sectors_and_timed_places_are_tagged(spark):
    s4 = laps(spark, [(1, "d1", 1, 1, 90000), (1, "d1", 2, 1, 91000)]).withColumns({"is_lap_time_from_sectors": F.col("lap_number") == 2, "position_status": F.when(F.col("lap_number") == 2, "timing_only").otherwise("agreed")})
    got = {r.lap_number: r for r in fusion.as_base(s4).collect()}
    assert (got[1].corrections, got[1].original_lap_time_ms, got[2].corrections, got[2].original_lap_time_ms) == ([], 90000, ["lap_time_ms:sectors", "position:timing"], None)
    out = fusion.vote_base(fusion.as_base(laps(spark, [(1, "d1", 2, 1, 91000)])), None, None, {"s4": s4}, "s3", ["s4"]).first()
    assert (out.confirmed_by, out.validation_status) == (["s4:sectors"], "confirmed")


def test_shift_and_status_of_numbering(spark):
    got = fused(spark, s1=[(1, "d1", 3, 1, 90000)], s2=[(1, "d1", 2, 1, 90000)], numbering=[(1, "renumbered", -1)])
    assert got[1, "d1", 2].confirmed_by == ["s2"] and got[1, "d1", 2].lap_numbering_status == "renumbered"


def test_cascade_of_bases_and_holes(spark):
    s2 = [(1, "d9", 1, 3, 90000), (2, "d1", 1, 1, 90000), (1, "d8", 1, 4, 90000)]
    s3 = [(2, "d1", 2, 1, 91000), (2, "d1", 3, 1, 91000), (4, "d1", 1, 1, 93000), (3, "d1", 1, 1, 95000)]
    s4 = [(3, "d1", 1, 1, 94000), (4, "d1", 1, 1, 99000)]
    official = [(1, "d9", 5), (1, "d8", 0), (2, "d1", 2), (3, "d1", 5), (4, "d1", 5)]
    got = fused(spark, s1=[(1, "d1", 1, 1, 90000)], s2=s2, s3=s3, s4=s4, official=official, reliability=[(4, True, True)])
    assert {k: r.source for k, r in got.items()} == {(1, "d1", 1): "s1", (1, "d9", 1): "s2", (2, "d1", 1): "s2", (2, "d1", 2): "s3", (3, "d1", 1): "s4", (4, "d1", 1): "s3"}
    assert got[2, "d1", 2].validation_status == "single_source"


def test_unreliable_feeds_do_not_judge(spark):
    s1, s4 = [(1, "d1", 2, 1, 90000)], [(1, "d1", 2, 1, 90000)]
    assert fused(spark, s1=s1, s4=s4)[1, "d1", 2].confirmed_by == ["s4"]
    assert fused(spark, s1=s1, s4=s4, reliability=[(1, False, False)])[1, "d1", 2].confirmed_by == []


def test_laps_after_the_official_end_go_unless_the_race_counts_back(spark):
    s1 = [(1, "d1", n, 1, 90000) for n in (1, 2, 3)]
    assert sorted(fused(spark, s1=s1, official=[(1, "d1", 2)])) == [(1, "d1", 1), (1, "d1", 2)]
    back = fusion.count_back_groups([laps(spark, s1)], spark.createDataFrame([(1, "d1", 2)], "race_id long, driver_id string, official_laps int"), spark.createDataFrame([(1, "d1")], "race_id long, driver_id string"))
    assert len(fused(spark, s1=s1, official=[(1, "d1", 2)], uncut=back)) == 3


def test_suspensions(spark):
    rows = [(1, f"d{k}", n, k, 90000) for k in range(1, 5) for n in range(1, 9)]
    long = {(1, "d1", 5): 900000, (1, "d2", 8): 900000}
    rows = [(r, d, n, p, long.get((r, d, n), t), d == "d3" and n == 3) for r, d, n, p, t in rows]
    got = fused(spark, s1=rows)
    assert got[1, "d1", 5].is_red_flag and got[1, "d1", 5].corrections == ["is_red_flag:suspension"]
    assert not got[1, "d2", 8].is_red_flag and got[1, "d3", 3].corrections == []


def test_completeness_statuses(spark):
    found = spark.createDataFrame([(1, n) for n in (1, 2, 3)] + [(2, n) for n in (1, 2)] + [(3, 1), (3, 9), (6, 1), (7, 1)], "unit long, lap_number int")
    official = spark.createDataFrame([(1, 3, False, False), (2, 3, False, False), (3, 3, False, False), (4, 3, False, False), (5, 0, False, False), (6, 3, True, False), (7, 3, False, True)], "unit long, official_laps int, is_shared boolean, is_disqualified boolean")
    got = {r.unit: (r.status, r.missing) for r in fusion.completeness(found, official, ["unit"]).collect()}
    assert got == {1: ("ok", 0), 2: ("missing_laps", 1), 3: ("extra_laps", 2), 4: ("no_laps", 3), 5: ("ok", 0), 6: ("shared_car", 2), 7: ("disqualified", 2)}


def test_offset_statuses(spark):
    e = [(1, k, o) for k in ("fastest", "stop") for o in (0, 0, 0)] + [(2, k, 1) for k in ("fastest", "stop") for _ in range(3)] + [(3, "fastest", 0)] * 3 + [(3, "stop", -1)] * 3 + [(4, "fastest", 1)] * 3 + [(4, "stop", 2)] * 3 + [(5, "fastest", 0)] * 2
    e += [(6, "fastest", o) for o in (2, 2, 2, 1)] + [(7, "fastest", 1)] * 3
    limits = spark.createDataFrame([(i, 6, 5) for i in range(1, 7)] + [(7, 9, 5)], "race_id long, last_step int, official_last int")
    got = {r.race_id: (r.status, r.applied_shift) for r in offsets.offset_status(spark.createDataFrame(e, "race_id long, evidence string, step_offset int"), "race_id", limits).collect()}
    assert got == {1: ("consistent", 0), 2: ("renumbered", -1), 3: ("pit_lap_convention", 0), 4: ("inconsistent", 0), 6: ("inconsistent", 0), 7: ("inconsistent", 0)}


def test_link_levels(spark):
    reg = spark.createDataFrame([(1, "a", "44", "Ana Bo", "Bo"), (1, "b", "5", "Cy Bo", "Bo"), (1, "c", "7", "Di Ek", "Ek"), (1, "d", "8", "Ed Fu", "Fu")], "race int, id string, num string, full_name string, surname string")
    rec = spark.createDataFrame([(1, "44", "Aná Bo"), (1, "5", "X Bo"), (1, "9", "Cy Bo"), (1, "9", "D. Ek"), (1, "8", "Zed"), (1, "9", "Q Bo"), (1, None, "Ana Bo")], "race int, number string, name string")
    got = {(r.number, r.name): (r.id, r.match_level) for r in linkage.link_records(rec, reg, ["race"], "number", "name", "id", "num", "full_name", "surname").collect()}
    assert got == {("44", "Aná Bo"): ("a", 1), ("5", "X Bo"): ("b", 2), ("9", "Cy Bo"): ("b", 3), ("9", "D. Ek"): ("c", 4), ("8", "Zed"): ("d", 5), ("9", "Q Bo"): (None, None), (None, "Ana Bo"): ("a", 3)}


def test_realignment_keeps_the_label_on_ties(spark):
    official = spark.createDataFrame([(2020, 1, "44", 50), (2020, 1, "5", 49), (2020, 2, "44", 60), (2020, 2, "5", 59)], "season int, round int, num string, laps int")
    moved = spark.createDataFrame([(2020, 1, "44", 60), (2020, 1, "5", 59)], official.schema)
    r = linkage.align_batches(moved, official, ["season"], "round", ["num", "laps"]).first()
    assert (r.aligned, r.is_realigned, r.match_pct) == (2, True, 100.0)
    tie = spark.createDataFrame([(2020, 2, "44", 50), (2020, 2, "5", 59)], official.schema)
    assert not linkage.align_batches(tie, official, ["season"], "round", ["num", "laps"]).first().is_realigned


def test_feed_builder(spark):
    t0 = datetime(2024, 3, 2, 15)
    at = lambda s: t0 + timedelta(seconds=s)
    lap = "session_key long, driver_number int, lap_number int, date_start_utc timestamp, lap_time_ms long, sector_1_ms long, sector_2_ms long, sector_3_ms long, is_pit_out_lap boolean"
    rows = [(1, 44, 1, None, None, 30000, 30000, 30000, False), (1, 44, 2, at(90), 90000, None, None, None, False), (1, 44, 3, at(180), None, None, None, None, True), (1, 5, 1, at(0), 91000, None, None, None, False), (1, 5, 2, at(91), 90000, None, None, None, False)]
    position = [(1, 44, at(0), 2), (1, 44, at(90.3), 1), (1, 5, at(0), 1), (1, 5, at(95), 2)]
    stints = [(1, 44, 1, 1, 2, "SOFT", 3), (1, 44, 2, 3, None, "HARD", 0)]
    messages = [(1, at(100), "SafetyCar", None, None, "SAFETY CAR DEPLOYED"), (1, at(120), "Flag", "CLEAR", "Track", "TRACK CLEAR"), (1, at(85), "Flag", "RED", "Track", "RED FLAG")]
    frame = lambda r, s: spark.createDataFrame(r, s)
    kinds = staging.message_event()
    out = feed.build_laps(
        frame(rows, lap), frame(position, "session_key long, driver_number int, date_utc timestamp, position int"), frame(stints, "session_key long, driver_number int, stint int, lap_start int, lap_end int, tyre_compound string, tyre_age_at_start int"),
        frame([(1, 5, 2)], "session_key long, driver_number int, lap_number int"), frame(messages, "session_key long, message_utc timestamp, category string, flag string, scope string, message string"), kinds,
    )
    got = {(r.driver_number, r.lap_number): r for r in out.collect()}
    assert sorted(got) == [(5, 1), (5, 2), (44, 1), (44, 2)]  # an open lap has no end
    one = got[44, 1]
    assert (one.lap_start, one.lap_time_ms, one.is_lap_time_from_sectors, one.position, one.position_status, one.is_red_flag) == (t0, 90000, True, 1, "agreed", True)  # within the tolerance
    assert (got[44, 2].tyre_compound, got[44, 2].tyre_age_laps, got[44, 2].is_pit_in_lap, got[44, 2].is_safety_car, got[44, 2].is_red_flag) == ("SOFT", 5, True, True, False)
    assert got[5, 2].is_pit_in_lap and not got[5, 1].is_pit_in_lap and got[5, 1].tyre_compound is None


def test_feed_deals_its_inputs_once(spark):
    """One exchange of rows; the same laps as the module's steps one after another, with null keys, ties and open periods."""
    import __spark_entry__

    text = __spark_entry__.queries()["r08_feed_laps"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(session_key" in text
    t0 = datetime(2024, 3, 2, 15)
    at = lambda s: t0 + timedelta(seconds=s)
    frame = lambda r, s: spark.createDataFrame(r, s)
    own = frame([(s, d, n, at(90 * n + 3 * (d or 0)) if n != 3 else None, 90000 if n != 5 else None, None, None, None, n == 4) for s in (1, 2, None) for d in (1, 2, None) for n in (1, 2, 3, 4, 5)] + [(1, 1, None, at(500), 90000, None, None, None, True)], "session_key long, driver_number int, lap_number int, date_start_utc timestamp, lap_time_ms long, sector_1_ms long, sector_2_ms long, sector_3_ms long, is_pit_out_lap boolean")
    position = frame([(s, d, at(k), p) for s in (1, None) for d in (1, None) for k, p in ((183.5, 3), (183.5, 1), (273.4, None), (400, 2))] + [(1, 2, None, 9), (1, 2, at(186.5), 4)], "session_key long, driver_number int, date_utc timestamp, position int")
    stint = frame([(s, d, k, a, b, f"T{k}", 2) for s in (1, None) for d in (1, None) for k, a, b in ((1, 1, 3), (2, 2, None), (3, 4, 4), (None, 5, 5), (4, None, 9), (5, 4, 2))], "session_key long, driver_number int, stint int, lap_start int, lap_end int, tyre_compound string, tyre_age_at_start int")
    pit = frame([(1, 1, 2), (1, 1, 2), (1, None, 3), (None, 1, 1), (1, 2, None)], "session_key long, driver_number int, lap_number long")
    sc, clear, red = ("SafetyCar", None, None, "SAFETY CAR DEPLOYED"), ("Flag", "CLEAR", "Track", "TRACK CLEAR"), ("Flag", "RED", "Track", "RED FLAG")
    messages = frame([(s, k if k is None else at(k), *m) for s in (1, None) for k, m in ((183, sc), (200, clear), (None, sc), (186, red), (None, red), (460, ("SafetyCar", None, None, "VSC DEPLOYED")))] + [(2, at(93), *red), (2, at(183), *sc)], "session_key long, message_utc timestamp, category string, flag string, scope string, message string")
    got = feed.build_laps(own, position, stint, pit, messages, staging.message_event(), rows=3_500_000)
    assert ", 7), REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString() and dict(got.dtypes)["lap_number"] == "int"

    from concordia.operators.joins import asof_join, overlaps

    row = [*feed.UNIT, "lap_number"]
    want = feed.stints(feed.positions(feed.lap_ends(own), position), stint).join(pit.distinct().withColumn("_pit", F.lit(True)), row, "left")
    want = want.withColumn("is_pit_in_lap", F.coalesce("_pit", F.lit(False)) | F.coalesce("_next_out", F.lit(False)))
    found = feed.periods(messages, staging.message_event())
    for kind, name in (("sc", "is_safety_car"), ("vsc", "is_virtual_safety_car")):
        want = overlaps(want, found.where(F.col("kind") == kind), ["session_key"], ("lap_start", "lap_end"), ("started_at", "ended_at"), name)
    reds = messages.where("flag = 'RED'").select("session_key", "message_utc", F.col("message_utc").alias("_red"))
    want = asof_join(want, reds, ["session_key"], "lap_end", "message_utc", ["_red"]).withColumn("is_red_flag", F.coalesce(F.col("_red") > F.col("lap_start"), F.lit(False)))
    rows = lambda df: sorted((str(tuple(r)) for r in df.select(*sorted(got.columns)).collect()))
    assert rows(got) == rows(want) and len(rows(got)) > 30
    assert {r.is_safety_car for r in got.collect()} == {r.is_red_flag for r in got.collect()} == {r.is_pit_in_lap for r in got.collect()} == {True, False}


def test_sessions_match_by_nearest_date(spark):
    from datetime import date

    sessions = spark.createDataFrame([(1, 9, 2024, "Race", date(2024, 3, 3), "Bahrain", None), (2, 9, 2024, "Qualifying", date(2024, 3, 1), "Bahrain", False), (3, 8, 2024, "Race", date(2024, 5, 5), "Italy", True)], "session_key long, meeting_key long, season int, session_name string, local_date date, country_name string, is_cancelled boolean")
    races = spark.createDataFrame([(100, 2024, date(2024, 3, 2), "Bahrain GP", "Bahrain"), (101, 2024, date(2024, 3, 9), "X", "Y")], "race_id long, season int, race_date date, name string, country string")
    got = {r.session_key: (r.race_id, r.is_name_consistent) for r in feed.match_sessions(sessions, races, ["name", "country"]).collect()}
    assert got == {1: (100, True), 2: (100, True)}


def test_two_layers_of_corrections(spark):
    base = spark.createDataFrame([(1, "R", "a", "1", 5), (1, "R", "b", "2", None), (2, "R", "a", "1", 5)], "race_id long, kind string, driver string, num string, points int")
    rules = spark.createDataFrame([(1, 1, None, "1", "z"), (2, 1, "Q", None, "q")], "rule int, race_id long, match_kind string, match_num string, set_driver string")
    out = corrections.apply_row_rules(base, rules, ["race_id"], {"match_kind": "kind", "match_num": "num"}, {"set_driver": "driver"}, ["rule"])
    assert sorted((r.race_id, r.num, r.driver, r.original_driver, r.is_corrected) for r in out.collect()) == [(1, "1", "z", "a", True), (1, "2", "b", "b", False), (2, "1", "a", "a", False)]
    cells = spark.createDataFrame([(1, "1", "points", "5", "7", "set"), (1, "2", "points", None, "9", "flag"), (2, "1", "points", "6", "8", "set")], "race_id long, num string, column_name string, original_value string, corrected_value string, action string")
    two = corrections.apply_cell_overrides(out, cells, ["race_id", "num"], {"points": "int"})
    assert sorted((r.race_id, r.num, r.points, r.overridden_columns, r.disputed_columns) for r in two.collect()) == [(1, "1", 7, ["points"], []), (1, "2", None, [], ["points"]), (2, "1", 5, [], [])]


def test_peers_and_shared_units(spark):
    rows = [(1, 2020, "RACE", "a", "t", 1, "1", 1, 10.0), (1, 2020, "RACE", "b", "t", 3, "3", 3, 5.0), (1, 2020, "RACE", "c", "t", None, "DNF", 9, 0.0), (1, 2020, "RACE", "x", "u", 2, "2", 2, 8.0)]
    r = spark.createDataFrame(rows, "race_id long, season int, session_type string, driver_id string, constructor_id string, position_number int, position_text string, position_display_order int, points double")
    h2h = {(x.driver_id, x.peer_driver_id): (x.duels, x.won, x.lost, x.won_pct) for x in metrics.head_to_head(r).collect()}
    assert h2h["a", "b"] == (1, 1, 0, 100.0) and h2h["a", "c"] == (0, 0, 0, None) and ("x", "a") not in h2h
    assert quality.asymmetric(metrics.head_to_head(r), ["season", "constructor_id"], "driver_id", "peer_driver_id", {"won": "lost"}).count() == 0
    best = {x.driver_id: (x.peer_driver_id, x.is_ahead, x.peers) for x in metrics.versus_best_peer(r).collect()}
    assert best == {"a": ("b", True, 2), "b": ("a", False, 2), "c": ("a", None, 2)}
    shared = spark.createDataFrame([(1, "t", "a", "b"), (1, "t", "b", "a")], "race_id long, constructor_id string, driver_id string, peer_driver_id string")
    assert {x.driver_id: x.peer_driver_id for x in metrics.versus_best_peer(r, shared).collect()} == {"a": "c", "b": "c", "c": "a"}


def test_unique_codes(spark):
    df = spark.createDataFrame([(1, "s1", "VER", "Max"), (1, "s2", "VER", "Jos"), (1, "s3", "HAM", "Lewis"), (1, "s4", "VER", "Juan"), (2, "s1", "VER", "Max")], "race int, id string, code string, name string")
    got = {(r.race, r.id): r.unique_code for r in codes.unique_codes(df, ["race"], "id", "code", "name").collect()}
    assert got[1, "s3"] == "HAM" and got[2, "s1"] == "VER" and len({v for k, v in got.items() if k[0] == 1}) == 4
    assert (got[1, "s1"], got[1, "s2"], got[1, "s4"]) == ("MVE", "JVE", "JVER")


def test_codes_of_starters_of_ids_and_of_many(spark):
    rows = [(1, "gerhard-berger", "BER", "Gerhard", True), (1, "allen-berg", "BER", "Allen", False), (2, "carlos-sainz-jr", None, "Çarlos", True), (2, "x-sai", None, None, True), (2, "y-sai", "sai", "7", True), (2, "42", None, "9", None)]
    rows += [(3, f"d{i:04}", "AAA", "Ada", True) for i in range(1200)]
    df = spark.createDataFrame(rows, "race int, id string, code string, name string, ran boolean")
    got = {(r.race, r.id): r.unique_code for r in codes.unique_codes(df, ["race"], "id", "code", "name", "ran").collect()}
    assert (got[1, "gerhard-berger"], got[1, "allen-berg"]) == ("BER", "ABE")
    assert (got[2, "carlos-sainz-jr"], got[2, "x-sai"], got[2, "y-sai"], got[2, "42"]) == ("CSA", "XSA", "XSAI", "42")
    many = [got[3, f"d{i:04}"] for i in range(1200)]
    assert many[:4] == ["AAA", "AAAA", "AAA2", "AAA3"] and len(set(many)) == 1200


def test_completeness_deals_units_once(spark):
    """One exchange, as many tasks as the rows need; null units and repeated official rows as a full join has them."""
    found = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", 5), ("b", 1), (None, 1), ("d", None)], "unit string, lap_number int")
    official = spark.createDataFrame([("a", 2, None, None), ("a", 4, None, False), ("b", 3, True, None), ("c", 0, None, None), (None, 2, None, None), ("e", None, None, None)], "unit string, official_laps int, is_shared boolean, is_disqualified boolean")
    out = fusion.completeness(found, official, ["unit"], 4_000_000)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Exchange hashpartitioning(unit" in text and ", 8), REPARTITION_BY_NUM" in text
    got = {r.unit: (r.official_laps, r.laps_found, r.last_lap, r.status, r.missing) for r in out.collect()}
    assert got["a"] == (4, 3, 5, "missing_laps", 2) and got["b"][3] == "shared_car" and got["c"][3] == "ok" and got["e"][3] == "ok"
    assert got[None] == (2, 1, 1, "missing_laps", 2) and got["d"] == (None, 0, None, "ok", 0)


def test_fusion_deals_its_sources_once(spark):
    """One exchange of rows, whatever sources are read; as many tasks as the rows need."""
    import __spark_entry__

    text = __spark_entry__.queries()["r11_fuse"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(race_id" in text
    none = laps(spark, [])
    frame = lambda s: spark.createDataFrame([], s)
    out = fusion.fuse(none, none, none, none, frame("race_id long, numbering_status string, applied_lap_shift int"), frame("race_id long, driver_id string, lap_number int, original_value long, corrected_value long"), frame("race_id long, driver_id string, official_laps int"), frame("race_id long, is_reliable boolean, is_replaced boolean"), rows=7_000_000)
    assert ", 7), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString() and out.count() == 0


def test_fusion_matches_known_keys_only(spark):
    s1 = [(1, "d1", 2, 1, 90000), (1, "d1", 2, 1, 95000)]  # a repeated lap stays, each time with its own review
    s2 = [(None, "d1", 2, 1, 90000), (1, "d2", None, 1, 90000), (1, "d1", 2, 1, 95000)]
    official = [(1, "d2", 5), (None, "d1", 5)]
    frames = [laps(spark, [(r, d, n or 0, p, t) for r, d, n, p, t in rows]).withColumn("lap_number", F.when(F.col("lap_number") > 0, F.col("lap_number"))) for rows in (s1, s2, s2, [(None, "d1", 2, 1, 90000)])]
    sheet = spark.createDataFrame([(1, "d1", 2, 90000, 91000), (1, "d1", 2, 95000, 96000), (None, "d1", 2, 90000, 99000)], "race_id long, driver_id string, lap_number int, original_value long, corrected_value long")
    out = fusion.fuse(*frames, spark.createDataFrame([], "race_id long, numbering_status string, applied_lap_shift int"), sheet, spark.createDataFrame(official, "race_id long, driver_id string, official_laps int"), spark.createDataFrame([], "race_id long, is_reliable boolean, is_replaced boolean"))
    got = sorted(((r.race_id, r.driver_id, r.lap_number, r.source, r.lap_time_ms, r.validation_status, tuple(r.confirmed_by)) for r in out.collect()), key=str)
    assert got == sorted([
        (1, "d1", 2, "s1", 91000, "corrected", ()), (1, "d1", 2, "s1", 96000, "corrected", ("s2", "s3")), (1, "d2", None, "s2", 90000, "single_source", ()),
        *[(None, "d1", 2, name, 90000, "single_source", ()) for name in ("s2", "s3", "s4")],  # no race: in no other source, so all stay
    ], key=str)


def test_gate(spark):
    import pytest

    card = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "check_id string, status string")
    assert [r.check_id for r in quality.gate(card).collect()] == ["b"]
    with pytest.raises(ValueError):
        quality.assert_gate(card)
    assert quality.assert_gate(card.where("status = 'PASS'")).count() == 1


def test_empty_inputs(spark):
    assert fused(spark) == {}
    empty = laps(spark, []).withColumns({"corrections": no_texts()})
    assert fusion.flag_suspensions(empty).count() == 0
