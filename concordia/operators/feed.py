"""Steps from an event feed: lap ends, positions as of the end, stints, pit entries and neutralised periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.columns import epoch_ms, ms_interval
from concordia.operators.joins import asof_join, first_end_after, interval_join, nearest_date
from concordia.operators.windows import pick_first

UNIT = ["session_key", "driver_number"]


def lap_ends(laps: DataFrame) -> DataFrame:
    """lap_start (given, or for lap 1 the session's first known start of a lap 1), lap_end (the next lap's start if its
    number follows, else start + time); laps without an end go. lap_time_ms falls back to the sum of all sectors."""
    return _lap_ends(laps, UNIT).where("lap_end is not null")


def _lap_ends(laps: DataFrame, unit: list[str]) -> DataFrame:
    start = Window.partitionBy("session_key").orderBy(*unit[1:], "lap_number").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = Window.partitionBy(*unit).orderBy("lap_number")
    first = F.min(F.when(F.col("lap_number") == 1, F.col("date_start_utc"))).over(start)
    out = laps.withColumn("lap_start", F.coalesce("date_start_utc", F.when(F.col("lap_number") == 1, first)))
    sectors = F.col("sector_1_ms") + F.col("sector_2_ms") + F.col("sector_3_ms")
    out = out.withColumns({"is_lap_time_from_sectors": F.col("lap_time_ms").isNull() & sectors.isNotNull(), "lap_time_ms": F.coalesce("lap_time_ms", sectors)})
    follows = F.lead("lap_number").over(own) == F.col("lap_number") + 1
    end = F.coalesce(F.when(follows, F.lead("date_start_utc").over(own)), F.col("lap_start") + ms_interval("lap_time_ms"))
    return out.withColumns({"lap_end": end, "_next_out": F.when(follows, F.lead("is_pit_out_lap").over(own))})


def positions(laps: DataFrame, position: DataFrame, tolerance_ms: int = 500) -> DataFrame:
    """position_from_feed (as of the lap's end + tolerance), position_by_timing, the published position, how they agree and
    the gap to the first end of the lap. Laps without an end have no timing."""
    at = asof_join(laps, position.withColumnRenamed("position", "position_from_feed"), UNIT, "lap_end", "date_utc", ["position_from_feed"], F.expr(f"interval {tolerance_ms / 1000} seconds"))
    return _placed(at, ["session_key", "lap_number"])


def _placed(at: DataFrame, same: list[str]) -> DataFrame:
    lap = Window.partitionBy(*same)
    rank = F.when(F.col("lap_end").isNotNull(), F.rank().over(lap.orderBy(F.col("lap_end").asc_nulls_last())))
    end = epoch_ms("lap_end")
    at = at.withColumns({"position_by_timing": rank, "gap_to_leader_ms": end - F.min(end).over(lap)})
    feed, timing = F.col("position_from_feed"), F.col("position_by_timing")
    status = F.when(feed.isNull(), "timing_only").when(timing.isNull(), "position_only").when(feed == timing, "agreed").otherwise("disputed")
    return at.withColumns({"position": F.coalesce(feed, timing), "position_status": status})


def stints(laps: DataFrame, stint: DataFrame) -> DataFrame:
    """The latest stint that holds the lap; its compound, and the tyre's age at the end of the lap."""
    row = [*UNIT, "lap_number"]
    held = interval_join(laps.select(*row), stint.where("lap_start is not null"), UNIT, "lap_number", "lap_start", "lap_end")
    held = pick_first(held, row, [F.desc("stint"), F.desc("lap_start")])
    age = F.col("tyre_age_at_start") + F.col("lap_number") - F.col("lap_start") + 1
    return laps.join(held.select(*row, "stint", "tyre_compound", age.alias("tyre_age_laps")), row, "left")


#: Neutralised periods: kind -> the event that begins one, the events that end it. Names are those of `staging.message_event`.
PERIODS = {"sc": ("safety_car_deployed", ["track_clear"]), "vsc": ("vsc_deployed", ["vsc_ending", "track_clear"])}


def periods(messages: DataFrame, classify: Column) -> DataFrame:
    """Neutralised periods of each session: kind (sc, vsc), start and the first later end. `classify` names each message's
    event, as `staging.message_event` does."""
    events = messages.withColumn("event", classify)
    out = None
    for kind, (begin, ends) in PERIODS.items():
        own = first_end_after(events, ["session_key"], "message_utc", F.col("event") == begin, F.col("event").isin(*ends), "ended_at")
        own = own.select("session_key", F.lit(kind).alias("kind"), F.col("message_utc").alias("started_at"), "ended_at")
        out = own if out is None else out.unionByName(own)
    return out


def build_laps(laps: DataFrame, position: DataFrame, stint: DataFrame, pit: DataFrame, messages: DataFrame, classify: Column, tolerance_ms: int = 500, rows: int | None = None) -> DataFrame:
    """The feed's laps with positions, tyres, pit entries and flags: what the steps of this module give one after another.

    All inputs are stacked and dealt once, by session; what they tell of a lap is found by windows within the session. A
    unit's stints are one array, so they must fit a row. rows: those of all inputs, if known; a task then has some 500,000."""
    own = lambda *keys: [F.col(k).try_cast(laps.schema[k].dataType).alias(k) for k in keys]
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    tyres = F.struct("stint", "lap_start", "lap_end", "tyre_compound", "tyre_age_at_start")
    found = periods(messages, classify)
    red = messages.withColumn("event", classify).where("event = 'red_flag'")
    of = {
        "position": position.where("date_utc is not null").select(*own(*UNIT), F.col("date_utc").alias("_at"), F.col("position").alias("_place")),
        "stint": stint.where("lap_start is not null").select(*own(*UNIT), tyres.alias("_stint")),
        "pit": pit.select(*own(*UNIT, "lap_number")),
        "red": red.where("message_utc is not null").select(*own("session_key"), F.col("message_utc").alias("_at")),
    } | {kind: found.where((F.col("kind") == kind) & F.col("started_at").isNotNull()).select(*own("session_key"), F.col("started_at").alias("_at"), F.col("ended_at").alias("_until")) for kind in PERIODS}
    stack = laps.withColumn("_of", F.lit("lap"))
    for name, df in of.items():
        stack = stack.unionByName(df.withColumn("_of", F.lit(name)), allowMissingColumns=True)
    parts = max(int(laps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // 500_000)) if rows else None
    out = stack.repartition(parts, "session_key") if parts else stack.repartition("session_key")
    is_of = lambda name: F.col("_of") == name
    out = _lap_ends(out, [*UNIT, "_of"]).where(~is_of("lap") | F.col("lap_end").isNotNull())

    has_session, n = F.col("session_key").isNotNull(), F.col("lap_number")
    has_unit = has_session & F.col("driver_number").isNotNull()
    out = out.withColumns({"_pit": has_unit & n.isNotNull() & F.max(is_of("pit")).over(Window.partitionBy(*UNIT, "lap_number")), "_stints": F.collect_list("_stint").over(Window.partitionBy(*UNIT))})
    holds = lambda s: (s["lap_start"] <= n) & (s["lap_end"].isNull() | (s["lap_end"] >= n))
    out = out.withColumn("_stint", F.when(has_unit & is_of("lap"), F.array_max(F.filter("_stints", holds)))).drop("_stints")
    out = out.withColumns({c: F.col(f"_stint.{c}") for c in ("stint", "tyre_compound")} | {"tyre_age_laps": F.col("_stint.tyre_age_at_start") + n - F.col("_stint.lap_start") + 1})
    out = out.withColumn("is_pit_in_lap", F.col("_pit") | F.coalesce("_next_out", F.lit(False))).drop("_pit", "_next_out", "_stint")

    out = out.where(~is_of("stint") & ~is_of("pit")).withColumn("_us", F.when(is_of("lap"), us("lap_end") + tolerance_ms * 1000).otherwise(us("_at")))
    upto = Window.partitionBy(*UNIT).orderBy("_us").rangeBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(is_of("position"), F.struct("_us", "_place"))).over(upto)
    out = out.withColumn("_last", last).withColumn("position_from_feed", F.when(has_unit, F.col("_last._place"))).where(~is_of("position")).drop("_last", "_place")
    out = _placed(out, ["session_key", "lap_number", "_of"])

    out = out.withColumn("_us", F.when(is_of("lap"), us("lap_end")).otherwise(us("_at")))
    session = Window.partitionBy("session_key").orderBy("_us")
    before, upto = session.rangeBetween(Window.unboundedPreceding, -1), session.rangeBetween(Window.unboundedPreceding, 0)
    start, yes = F.col("lap_start"), lambda c: F.coalesce(has_session & c, F.lit(False))
    flags = {}
    for kind, name in (("sc", "is_safety_car"), ("vsc", "is_virtual_safety_car")):
        goes_on = F.max(is_of(kind) & F.col("_until").isNull()).over(before)
        flags[name] = yes((F.max(F.when(is_of(kind), F.col("_until"))).over(before) > start) | (goes_on & (F.col("lap_end") > start)))
    # A red flag within (start, end]: the last one up to the end is after the start.
    flags["is_red_flag"] = yes(F.max(F.when(is_of("red"), F.col("_at"))).over(upto) > start)
    return out.withColumns(flags).where(is_of("lap")).drop("_of", "_at", "_until", "_us")


def match_sessions(sessions: DataFrame, races: DataFrame, names: list[str], race_session: str = "Race") -> DataFrame:
    """Sessions with race_id: race sessions by season and nearest date within a day, siblings through their meeting.

    is_name_consistent: whether the session's country is one of the race's `names`. Cancelled sessions go."""
    live = sessions.where("not coalesce(is_cancelled, false)")
    found = nearest_date(live.where(F.col("session_name") == race_session), races, ["season"], "session_key", "local_date", "race_date", ["race_id"])
    by_meeting = found.groupBy("meeting_key").agg(F.min("race_id").alias("race_id"))
    out = live.join(by_meeting, "meeting_key").join(races.select("race_id", *names), "race_id")
    from concordia.functions.names import normalized_name

    return out.withColumn("is_name_consistent", F.exists(F.array(*[normalized_name(n) for n in names]), lambda n: n == normalized_name("country_name"))).drop(*names)
