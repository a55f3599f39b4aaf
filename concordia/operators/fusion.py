"""Fusion of overlapping sources of the same steps into one trusted series, with provenance on each row.

Rows are steps (laps) of a unit (car and driver) in a group (race): race_id, driver_id, lap_number,
lap_time_ms, race_time_ms, position. Single steps join on these keys; the whole fusion deals its rows
once, by group, and looks at them by windows. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.columns import no_texts, validation_status
from concordia.operators.windows import join_null_safe

KEYS = ["race_id", "driver_id", "lap_number"]


@dataclass(frozen=True)
class Knobs:
    """The thresholds of the fusion, in milliseconds, laps, rows and percent."""

    tolerance: int = 1
    vote_least: int = 1000
    convention: int = 1000
    longest: int = 300_000
    suspension_ms: int = 400_000
    suspension_times: float = 3.0
    suspension_laps: int = 3
    suspension_units: int = 3


def apply_shift(laps: DataFrame, numbering: DataFrame) -> DataFrame:
    """Lap numbers moved by the group's applied_lap_shift (none: 0), and the group's status, or no_evidence."""
    shift = F.coalesce("applied_lap_shift", F.lit(0))
    moved = laps.join(numbering.select("race_id", "applied_lap_shift", "numbering_status"), "race_id", "left")
    moved = moved.withColumn("lap_number", F.col("lap_number") + shift).drop("applied_lap_shift")
    return moved.withColumn("lap_numbering_status", F.coalesce("numbering_status", F.lit("no_evidence"))).drop("numbering_status")


def recompute(laps: DataFrame, groups: DataFrame) -> DataFrame:
    """In the given groups (race_id): race_time_ms moves by the running sum of corrected_lap_time_ms - lap_time_ms, the gap
    to the leader follows, and recalculated_position is the place by that time. Other groups keep their own values."""
    touched = groups.select("race_id").distinct().withColumn("_touched", F.lit(True))
    return _recomputed(laps.join(touched, "race_id", "left").withColumn("_touched", F.coalesce("_touched", F.lit(False))), ["race_id", "lap_number"])


def _recomputed(laps: DataFrame, lap: list[str]) -> DataFrame:
    """`recompute` of rows whose `_touched` says whether their group is given; places and gaps are those of equal `lap`."""
    delta = F.coalesce(F.col("corrected_lap_time_ms") - F.col("lap_time_ms"), F.lit(0))
    so_far = Window.partitionBy("race_id", "driver_id").orderBy("lap_number").rowsBetween(Window.unboundedPreceding, 0)
    out = laps.withColumn("_moved", F.sum(delta).over(so_far))
    out = out.withColumn("race_time_ms", F.col("race_time_ms") + F.when(F.col("_touched"), F.col("_moved")).otherwise(0))
    same = Window.partitionBy(*lap)
    place = F.when(F.col("race_time_ms").isNotNull(), F.rank().over(same.orderBy(F.col("race_time_ms").asc_nulls_last())))
    out = out.withColumn("gap_to_leader_ms", F.when(F.col("_touched"), F.col("race_time_ms") - F.min("race_time_ms").over(same)).otherwise(F.col("gap_to_leader_ms")))
    return out.withColumn("recalculated_position", F.when(F.col("_touched"), place)).drop("_moved", "_touched")


def vote(value: Column, a: Column, b: Column, lap: Column, knobs: Knobs = Knobs(), take: Column | None = None) -> Column:
    """The majority's value, or null: two other sources within the tolerance that differ from value by vote_least."""
    wins = (lap > 1) & (F.abs(a - b) <= knobs.tolerance) & (F.abs(a - value) >= knobs.vote_least)
    return F.when(wins, a if take is None else take)


def position_votes(laps: DataFrame, current: str, a: str, b: str) -> DataFrame:
    """Adds voted_position: that of two agreeing sources where it differs from a known current one, else null."""
    wins = (F.col(a) == F.col(b)) & (F.col(a) != F.col(current))
    return laps.withColumn("voted_position", F.when(wins, F.col(a)))


def vote_conflicts(laps: DataFrame, keys: list[str], voted: str, current: str) -> DataFrame:
    """The distinct keys whose votes, if applied, would give one value to two rows at least one of which is a vote."""
    result = F.coalesce(F.col(voted), F.col(current))
    found = laps.withColumn("_result", result).where("_result is not null").groupBy(*keys, "_result").agg(F.count("*").alias("_n"), F.bool_or(F.col(voted).isNotNull()).alias("_voted"))
    return found.where("_n > 1 and _voted").select(*keys).distinct()


def withhold_conflicts(laps: DataFrame, keys: list[str], voted: str, current: str) -> DataFrame:
    """laps with `is_withheld` and the vote removed where it conflicts within its keys."""
    bad = vote_conflicts(laps, keys, voted, current).withColumn("_bad", F.lit(True))
    out = laps.join(bad, keys, "left")
    held = F.coalesce("_bad", F.lit(False)) & F.col(voted).isNotNull()
    return out.withColumn("is_withheld", held).withColumn(voted, F.when(~held, F.col(voted))).drop("_bad")


def compare_sources(base: DataFrame, others: dict[str, DataFrame]) -> DataFrame:
    """base with <name>_time, <name>_position and <name>_sectors (its time is a sum of sectors) of each other source: left
    joins on one partitioning."""
    out = base
    for name, df in others.items():
        summed = F.coalesce("is_lap_time_from_sectors", F.lit(False)) if "is_lap_time_from_sectors" in df.columns else F.lit(False)
        out = out.join(df.select(*KEYS, F.col("lap_time_ms").alias(f"{name}_time"), F.col("position").alias(f"{name}_position"), summed.alias(f"{name}_sectors")), KEYS, "left")
    return out


def as_base(laps: DataFrame) -> DataFrame:
    """A source's own rows as a base: nothing corrected, numbering not applicable. A time summed from sectors isn't an
    original, and is tagged; so is a place that stems from timing alone."""
    has = lambda c, test: test if c in laps.columns else F.lit(False)
    summed = F.coalesce(has("is_lap_time_from_sectors", F.col("is_lap_time_from_sectors")), F.lit(False))
    timed = F.coalesce(has("position_status", F.col("position_status") == "timing_only"), F.lit(False))
    tags = F.array_compact(F.array(F.when(summed, F.lit("lap_time_ms:sectors")), F.when(timed, F.lit("position:timing"))))
    return laps.withColumns({"original_lap_time_ms": F.when(~summed, F.col("lap_time_ms")), "corrections": tags, "lap_numbering_status": F.lit("not_applicable")})


def vote_base(base: DataFrame, first: str | None, second: str | None, others: dict[str, DataFrame], source: str, judges: list[str], knobs: Knobs = Knobs()) -> DataFrame:
    """One base source after its votes: times and positions of `first` win where `second` agrees (None: nobody votes); a
    corrected_lap_time_ms of base wins over a vote. Then each row's own time is judged by all `judges`.

    base needs original_lap_time_ms, corrections and lap_numbering_status; it may have recalculated_position, which then
    stands for position."""
    wide = compare_sources(base, others).withColumn("source", F.lit(source))
    out = _judged(wide, first, second, judges, lambda df: withhold_conflicts(df, ["race_id", "lap_number"], "voted_position", "position"), knobs)
    return out.drop(*[f"{n}_{c}" for n in others for c in ("time", "position", "sectors")])


def _judged(wide: DataFrame, first: str | None, second: str | None, judges: list[str], withhold: Callable[[DataFrame], DataFrame], knobs: Knobs) -> DataFrame:
    """Votes and verdicts of rows that have the other sources' columns beside their own (see `vote_base`); withhold takes
    back voted_position where votes conflict, and adds is_withheld."""
    none = F.lit(None).cast("long")
    fixed = F.col("corrected_lap_time_ms") if "corrected_lap_time_ms" in wide.columns else none
    again = F.col("recalculated_position") if "recalculated_position" in wide.columns else none
    wide = wide.withColumns({"_fixed": fixed, "_again": F.when(again != F.col("position"), again), "position": F.coalesce(again, "position")})
    if first is None:
        wide = wide.withColumns({"_time": none, "voted_position": none.cast(wide.schema["position"].dataType)})
    else:
        wide = wide.withColumn("_time", vote(F.col("lap_time_ms"), F.col(f"{first}_time"), F.col(f"{second}_time"), F.col("lap_number"), knobs))
        wide = withhold(position_votes(wide, "position", f"{first}_position", f"{second}_position"))
    marks = {"_time": "lap_time_ms:majority", "_again": "position:recalculated", "voted_position": "position:majority"}
    tags = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(tag)) for c, tag in marks.items()]))
    times = {n: F.col(f"{n}_time") for n in judges}
    changed = F.col("_fixed").isNotNull() | F.col("_time").isNotNull()
    status = F.when(changed, "corrected").otherwise(validation_status("lap_time_ms", list(times.values()), F.col("lap_number") == 1, knobs.tolerance, knobs.convention, knobs.longest))
    agree = F.array_compact(F.array(*[F.when(F.abs(F.col("lap_time_ms") - c) <= knobs.tolerance, F.when(F.col(f"{n}_sectors"), f"{n}:sectors").otherwise(n)) for n, c in times.items()]))
    wide = wide.withColumns({"validation_status": status, "confirmed_by": agree, "corrections": F.concat("corrections", tags)})
    wide = wide.withColumns({"lap_time_ms": F.coalesce("_fixed", "_time", "lap_time_ms"), "position": F.coalesce("voted_position", "position")})
    return wide.drop("_time", "_fixed", "_again", "voted_position", "is_withheld", "corrected_lap_time_ms", "recalculated_position")


def fill_holes(fused: DataFrame, backup: DataFrame, official: DataFrame) -> DataFrame:
    """Rows of the backup for units that fused has, at laps that it hasn't, up to the unit's official_laps."""
    units = fused.select("race_id", "driver_id").distinct()
    holes = backup.join(units, ["race_id", "driver_id"], "left_semi").join(fused.select(*KEYS), KEYS, "left_anti")
    holes = holes.join(official, ["race_id", "driver_id"]).where(F.col("lap_number") <= F.col("official_laps")).drop("official_laps")
    return fused.unionByName(holes, allowMissingColumns=True)


def flag_suspensions(laps: DataFrame, flag: str = "is_red_flag", knobs: Knobs = Knobs()) -> DataFrame:
    """Long laps in the context of a suspension get the flag, and its tag if they hadn't it.

    Long: above the larger of suspension_ms and suspension_times x the group's median. Context: suspension_units units
    long on that lap, or a flag of any unit on the lap or the suspension_laps before it. A lap without a race or a number
    has no context and stays as it is."""
    median = laps.groupBy("race_id").agg(F.median("lap_time_ms").alias("_median"))
    most = F.greatest(F.lit(float(knobs.suspension_ms)), knobs.suspension_times * F.col("_median"))
    out = join_null_safe(laps, median, ["race_id"]).withColumn("_long", F.coalesce(F.col("lap_time_ms") > most, F.lit(False)))
    by_lap = out.groupBy("race_id", "lap_number").agg(F.count_if("_long").alias("_n"), F.coalesce(F.bool_or(flag), F.lit(False)).alias("_flag"))
    recent = Window.partitionBy("race_id").orderBy(F.col("lap_number").cast("long")).rangeBetween(-knobs.suspension_laps, 0)
    by_lap = by_lap.withColumn("_near", F.bool_or("_flag").over(recent))
    by_lap = by_lap.where("race_id is not null and lap_number is not null")
    out = out.join(by_lap.select("race_id", "lap_number", "_n", "_near"), ["race_id", "lap_number"], "left")
    return _flagged(out, F.col("_n").isNotNull(), flag, knobs).drop("_median", "_long", "_n", "_near")


def _flagged(laps: DataFrame, known: Column, flag: str, knobs: Knobs) -> DataFrame:
    """The flag and its tag on long laps (`_long`) of a known lap with `_n` long ones or a flag `_near`."""
    hit = known & F.col("_long") & ((F.col("_n") >= knobs.suspension_units) | F.col("_near"))
    new = hit & ~F.coalesce(F.col(flag), F.lit(False))
    out = laps.withColumn("corrections", F.when(new, F.array_append("corrections", F.lit(f"{flag}:suspension"))).otherwise(F.col("corrections")))
    return out.withColumn(flag, F.when(hit, True).otherwise(F.col(flag)))


def _flagged_by_race(laps: DataFrame, flag: str, knobs: Knobs) -> DataFrame:
    """`flag_suspensions` of rows that lie together by race already: windows within the race, nothing is dealt anew."""
    race, lap = Window.partitionBy("race_id"), Window.partitionBy("race_id", "lap_number")
    recent = race.orderBy(F.col("lap_number").cast("long")).rangeBetween(-knobs.suspension_laps, 0)
    most = F.greatest(F.lit(float(knobs.suspension_ms)), knobs.suspension_times * F.median("lap_time_ms").over(race))
    out = laps.withColumn("_long", F.coalesce(F.col("lap_time_ms") > most, F.lit(False)))
    out = out.withColumns({"_n": F.count_if("_long").over(lap), "_near": F.coalesce(F.bool_or(flag).over(recent), F.lit(False))})
    return _flagged(out, F.col("race_id").isNotNull() & F.col("lap_number").isNotNull(), flag, knobs).drop("_long", "_n", "_near")


def cut_after_end(laps: DataFrame, official: DataFrame, uncut: DataFrame | None = None) -> DataFrame:
    """Drops laps beyond the unit's official_laps; without a bound, or in `uncut` groups, all stay."""
    out = laps.join(official, ["race_id", "driver_id"], "left")
    keep = ~F.coalesce(F.col("lap_number") > F.col("official_laps"), F.lit(False))
    if uncut is not None:
        out = out.join(uncut.select("race_id").distinct().withColumn("_uncut", F.lit(True)), "race_id", "left")
        keep = keep | F.coalesce("_uncut", F.lit(False))
    return out.where(keep).drop("official_laps", "_uncut")


def count_back_groups(sources: list[DataFrame], official: DataFrame, winners: DataFrame) -> DataFrame:
    """Groups in which some source shows the winner (race_id, driver_id) beyond the official total."""
    all_laps = sources[0].select(*KEYS)
    for s in sources[1:]:
        all_laps = all_laps.unionByName(s.select(*KEYS))
    last = all_laps.join(winners, ["race_id", "driver_id"], "left_semi").groupBy("race_id", "driver_id").agg(F.max("lap_number").alias("_last"))
    return last.join(official, ["race_id", "driver_id"]).where(F.col("_last") > F.col("official_laps")).select("race_id").distinct()


def _withheld_by_race(laps: DataFrame) -> DataFrame:
    """`withhold_conflicts` of voted_position within source, race and lap, of rows that lie together by race already."""
    lap = ["race_id", "lap_number", "source"]
    same = Window.partitionBy(*lap, "_result")
    out = laps.withColumn("_result", F.coalesce("voted_position", "position"))
    out = out.withColumn("_bad", F.col("_result").isNotNull() & (F.count("*").over(same) > 1) & F.bool_or(F.col("voted_position").isNotNull()).over(same))
    out = out.withColumn("_bad", F.bool_or("_bad").over(Window.partitionBy(*lap)) & F.col("race_id").isNotNull() & F.col("lap_number").isNotNull())
    held = F.col("_bad") & F.col("voted_position").isNotNull()
    return out.withColumn("is_withheld", held).withColumn("voted_position", F.when(~held, F.col("voted_position"))).drop("_result", "_bad")


#: Per base the sources that vote on its rows (the first's values win where the second agrees), and those that judge them.
VOTERS = {"s1": ("s2", "s3"), "s2": ("s3", "s4")}
JUDGES = {"s1": ["s2", "s3", "s4"], "s2": ["s3", "s4"], "s4": ["s3"], "s3": ["s4"]}


def fuse(s1: DataFrame, s2: DataFrame, s3: DataFrame, s4: DataFrame, numbering: DataFrame, sheet: DataFrame, official: DataFrame, reliability: DataFrame, uncut: DataFrame | None = None, knobs: Knobs = Knobs(), rows: int | None = None) -> DataFrame:
    """Four sources to one series: s1 (shifted, corrected by the sheet, voted by s2 and s3); groups without s1, and units
    that it lacks, from s2 (voted by s4 and s3); groups with neither from s4 unless reliability replaces it, then s3; holes
    filled from s3; suspensions flagged; laps after the official end dropped unless the group counts back.

    sheet: race_id, driver_id, lap_number, original_value, corrected_value. official: race_id, driver_id,
    official_laps. reliability: race_id, is_reliable, is_replaced.

    All are stacked and dealt once, by race; what they tell of each other they tell by windows within the race. A source
    has one row for a lap of a unit, the sheet one for a reviewed value, official one for a unit: of repeats the largest
    counts, but repeated rows of a base all stay. rows: those of all sources, if known; a task then has some 1,000,000."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    trust = reliability.groupBy("race_id").agg(F.bool_or(~F.col("is_reliable")).alias("_doubted"), F.bool_or("is_replaced").alias("_replaced"))
    bound = official.select("race_id", "driver_id", "official_laps")
    if uncut is not None:
        bound = bound.join(uncut.select("race_id").distinct().withColumn("_uncut", F.lit(True)), "race_id", "left")
    of = {"s1": apply_shift(s1, numbering), "s2": s2, "s3": s3, "s4": s4.join(trust, "race_id", "left"), "sheet": sheet.select(*KEYS, F.col("original_value").alias("lap_time_ms"), "corrected_value"), "official": bound}
    stack = None
    for name, df in of.items():
        one = df.withColumn("source", F.lit(name))
        stack = one if stack is None else stack.unionByName(one, allowMissingColumns=True)
    parts = max(int(s1.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // 1_000_000)) if rows else None
    out = stack.repartition(parts, "race_id") if parts else stack.repartition("race_id")

    # One sort by race, unit, lap and time serves the windows of all four.
    order = ["driver_id", "lap_number", "lap_time_ms"]
    race = Window.partitionBy("race_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    unit, step, value = Window.partitionBy("race_id", "driver_id"), Window.partitionBy(*KEYS), Window.partitionBy(*KEYS, "lap_time_ms")
    is_of = lambda name: F.col("source") == name
    has_race, has_unit = F.col("race_id").isNotNull(), F.col("race_id").isNotNull() & F.col("driver_id").isNotNull()
    has_step = has_unit & F.col("lap_number").isNotNull()
    live = is_of("s4") & ~yes(F.col("_replaced"))
    out = out.withColumns({f"_in_{n}": has_race & F.max(test).over(race) for n, test in (("s1", is_of("s1")), ("s2", is_of("s2")), ("s4", live), ("sheet", is_of("sheet")))})
    told = {"_unit_s1": has_unit & F.max(is_of("s1")).over(unit), "official_laps": F.when(has_unit, F.max("official_laps").over(unit))}
    out = out.withColumns(told | ({"_uncut": has_unit & yes(F.max("_uncut").over(unit))} if uncut is not None else {}))
    absent = ~F.col("_unit_s1") & (~F.col("_in_s1") | yes(F.col("official_laps") > 0))
    neither = ~F.col("_in_s1") & ~F.col("_in_s2")
    out = out.withColumn("_base", is_of("s1") | (is_of("s2") & absent) | (live & neither))
    out = out.withColumn("_unit_base", has_unit & F.max("_base").over(unit))
    sectors = yes(F.col("is_lap_time_from_sectors")) if "is_lap_time_from_sectors" in out.columns else F.lit(False)
    side = F.struct(F.col("lap_time_ms").alias("time"), "position", sectors.alias("sectors"))
    known = {"s2": is_of("s2"), "s3": is_of("s3"), "s4": is_of("s4") & ~yes(F.col("_doubted"))}
    out = out.withColumns({f"_{n}": F.when(has_step, F.max(F.when(test, side)).over(step)) for n, test in known.items()} | {"_step_base": has_step & F.max("_base").over(step)})
    out = out.withColumn("corrected_lap_time_ms", F.when(is_of("s1") & has_step & F.col("lap_time_ms").isNotNull(), F.max("corrected_value").over(value)))
    hole = F.col("_unit_base") & ~F.col("_step_base") & yes(F.col("lap_number") <= F.col("official_laps"))
    out = out.where(F.col("_base") | (is_of("s3") & (hole | (neither & ~F.col("_in_s4")))))

    wide = {}
    for n in known:
        judged = F.col("source").isin(*[base for base, by in JUDGES.items() if n in by])
        wide |= {f"{n}_{c}": F.when(judged, F.col(f"_{n}.{c}")) for c in ("time", "position", "sectors")}
    for i, name in enumerate(("_first", "_second")):
        for c in ("time", "position"):
            wide[f"{name}_{c}"] = F.coalesce(*[F.when(is_of(base), F.col(f"_{by[i]}.{c}")) for base, by in VOTERS.items()])
    first = is_of("s1")
    own = {"original_lap_time_ms": F.col("lap_time_ms"), "corrections": F.when(F.col("corrected_lap_time_ms").isNotNull(), F.array(F.lit("lap_time_ms:sheet"))).otherwise(no_texts()), "lap_numbering_status": F.col("_numbering")}
    out = as_base(out.withColumns(wide).withColumnRenamed("lap_numbering_status", "_numbering"))
    out = out.withColumns({c: F.when(first, v).otherwise(F.col(c)) for c, v in own.items()} | {"_touched": first & F.col("_in_sheet")})
    out = _judged(_recomputed(out, ["race_id", "lap_number", "source"]), "_first", "_second", list(known), _withheld_by_race, knobs)
    out = _flagged_by_race(out, "is_red_flag", knobs)
    after = yes(F.col("lap_number") > F.col("official_laps"))
    out = out.where(~after if uncut is None else ~after | F.col("_uncut"))
    helpers = ["_doubted", "_replaced", "_uncut", "_in_s1", "_in_s2", "_in_s4", "_in_sheet", "_unit_s1", "_base", "_unit_base", "_step_base", "_numbering", "_s2", "_s3", "_s4"]
    return out.drop("corrected_value", "official_laps", *helpers, *wide)


def completeness(laps: DataFrame, official: DataFrame, keys: list[str], rows: int | None = None) -> DataFrame:
    """Laps found against the official number, by unit, six statuses.

    official: keys, official_laps, is_shared, is_disqualified. In order: shared_car, disqualified, ok (none and 0
    official), no_laps, extra_laps (no official number, or the last is more than 1 beyond), missing_laps, ok.
    rows: those of both tables, if known; units are then dealt so that a task has some 500,000 of them. Both tables are
    stacked and dealt once. Units with a null key are one unit, which no official number bounds."""
    both = laps.select(*keys, "lap_number").unionByName(official.select(*keys, "official_laps", "is_shared", "is_disqualified"), allowMissingColumns=True)
    parts = max(int(laps.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // 500_000)) if rows else None
    dealt = both.repartition(parts, *keys) if parts else both.repartition(*keys)
    yes = lambda c: F.bool_or(F.coalesce(c, F.lit(False))).alias(c)
    each = dealt.groupBy(*keys, "lap_number").agg(F.max("official_laps").alias("official_laps"), yes("is_shared"), yes("is_disqualified"))
    known = F.forall(F.array(*[F.col(k).isNotNull() for k in keys]), lambda x: x)
    each = each.withColumn("_bound", F.when(known, F.max("official_laps").over(Window.partitionBy(*keys))))
    found = each.groupBy(*keys).agg(
        F.max("official_laps").alias("official_laps"), F.bool_or("is_shared").alias("is_shared"), F.bool_or("is_disqualified").alias("is_disqualified"),
        F.count("lap_number").alias("laps_found"), F.max("lap_number").alias("last_lap"), F.count_if(F.col("lap_number").between(1, F.col("_bound"))).alias("laps_in_range"),
    )
    n, of = F.col("laps_found"), F.col("official_laps")
    status = (
        F.when(F.col("is_shared"), "shared_car").when(F.col("is_disqualified"), "disqualified").when((n == 0) & (F.coalesce(of, F.lit(0)) == 0), "ok")
        .when(n == 0, "no_laps").when(of.isNull() | (F.col("last_lap") - of > 1), "extra_laps").when(F.col("laps_in_range") < of, "missing_laps").otherwise("ok")
    )
    return found.select(*keys, "official_laps", "laps_found", "last_lap", status.alias("status"), F.greatest(of - F.col("laps_in_range"), F.lit(0)).alias("missing"), F.greatest(F.col("last_lap") - of, F.lit(0)).alias("excess"))


def pass_types(passes: DataFrame, stops: DataFrame, offsets: DataFrame, results: DataFrame) -> DataFrame:
    """Pit-lane passes by what they were, in order: pit_stop (an official stop at the lap less the group's offset),
    unclassified (the group has no stops), red_flag, retirement (not classified and at or after the official end),
    safety_car, penalty_or_other.

    offsets: race_id, status, second_offset; the offset counts if inconsistent or pit_lap_convention. results:
    race_id, driver_id, official_laps, is_classified. passes carry is_red_flag, is_safety_car, corrections."""
    shift = F.when(F.col("status").isin("inconsistent", "pit_lap_convention"), F.coalesce("second_offset", F.lit(0))).otherwise(0)
    p = passes.join(offsets.select("race_id", shift.alias("_shift")), "race_id", "left").withColumn("_lap", F.col("lap_number") - F.coalesce("_shift", F.lit(0)))
    official = stops.select("race_id", "driver_id", F.col("lap_number").alias("_lap")).distinct().withColumn("_stop", F.lit(True))
    p = p.join(official, ["race_id", "driver_id", "_lap"], "left").join(stops.select("race_id").distinct().withColumn("_known", F.lit(True)), "race_id", "left").join(results, ["race_id", "driver_id"], "left")
    red = F.col("is_red_flag") & ~F.array_contains("corrections", "is_red_flag:suspension")
    kind = (
        F.when(F.col("_stop"), "pit_stop").when(F.col("_known").isNull(), "unclassified").when(red, "red_flag")
        .when(~F.col("is_classified") & (F.col("lap_number") >= F.col("official_laps")), "retirement").when(F.col("is_safety_car"), "safety_car").otherwise("penalty_or_other")
    )
    return p.select(*passes.columns, kind.alias("pass_type"))
