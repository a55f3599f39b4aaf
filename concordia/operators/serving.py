"""What a reader of the published model asks for: tables of a race, profiles, rankings. Functions from tables to a table;
without a race or driver given they answer for all of them at once."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.columns import in_optional
from concordia.operators.aggregates import count_where
from concordia.operators.codes import unique_codes
from concordia.operators.joins import broadcast_if_small
from concordia.operators.metrics import NOT_STARTED
from concordia.operators.windows import pick_first


def race_codes(results: DataFrame, drivers: DataFrame) -> DataFrame:
    """race_id, driver_id, driver_code: one code for all sessions of a race; who drove a lap or had a grid place started."""
    entrants = results.groupBy("race_id", "driver_id").agg(F.bool_or((F.col("laps") > 0) | F.col("grid_position").isNotNull()).alias("_started"))
    known = drivers.select("driver_id", "abbreviation", "first_name")
    return unique_codes(entrants.join(broadcast_if_small(known), "driver_id"), ["race_id"], "driver_id", "abbreviation", "first_name", "_started").withColumnRenamed("unique_code", "driver_code")


def _named(df: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    named = lambda d, key, name: broadcast_if_small(d.select(key, F.col("name").alias(name)))
    return df.join(named(drivers, "driver_id", "driver_name"), "driver_id").join(named(constructors, "constructor_id", "constructor_name"), "constructor_id")


def race_results(results: DataFrame, drivers: DataFrame, constructors: DataFrame, session: str = "RACE") -> DataFrame:
    """Results of a session with names and codes. A race's codes join as one map, so results bucketed by race stay there."""
    own = _named(results.where(F.col("session_type") == session), drivers, constructors)
    codes = race_codes(results, drivers).groupBy("race_id").agg(F.map_from_entries(F.collect_list(F.struct("driver_id", "driver_code"))).alias("_codes"))
    return own.join(codes, "race_id", "left").withColumn("driver_code", F.try_element_at("_codes", F.col("driver_id"))).drop("_codes")


def race_detail(races: DataFrame, results: DataFrame, drivers: DataFrame) -> DataFrame:
    """Races (as `marts.race_dimension` gives them) with their winner (the first shown, null without one) and
    has_sprint_qualifying."""
    won = results.where((F.col("session_type") == "RACE") & (F.col("position_number") == 1))
    first = won.groupBy("race_id").agg(F.min_by("driver_id", F.struct("position_display_order", "driver_id")).alias("winner_id"))
    named = broadcast_if_small(drivers.select(F.col("driver_id").alias("winner_id"), F.col("name").alias("winner_name")))
    out = races.join(first, "race_id", "left").join(named, "winner_id", "left")
    return out.withColumn("has_sprint_qualifying", F.col("sprint_qualifying_format").isNotNull())


def qualifying_table(entries: DataFrame, drivers: DataFrame, constructors: DataFrame, session: str = "QUALIFYING") -> DataFrame:
    """Qualifying rows (as `marts.qualifying_facts` gives them) of a session with names."""
    return _named(entries.where(F.col("session_type") == session), drivers, constructors)


def mean_gap(entries: DataFrame, by: str) -> DataFrame:
    """Race, `by` (driver or team), the mean percentage gap to the best time over rows that have one, and their number n."""
    return entries.where(F.col("gap_to_pole_pct").isNotNull()).groupBy("race_id", by).agg(F.avg("gap_to_pole_pct").alias("mean_gap_pct"), F.count("*").alias("n"))


def laps_table(laps: DataFrame, units: Iterable[str] | None = None) -> DataFrame:
    """Published laps without those beyond the official end, of some drivers or all; the relative compound, else the own
    one. Order by lap_number, position (nulls last), driver_id, driver_number."""
    compound = F.coalesce("tyre_compound_relative", F.nullif(F.col("tyre_compound"), F.lit("")))
    return laps.where(~F.col("is_incomplete_lap") & in_optional("driver_id", units)).withColumn("compound", compound)


def driver_results(results: DataFrame, races: DataFrame, season: int | None = None) -> DataFrame:
    """Results race by race with round and name, sprints after the race of a round."""
    known = races.select("race_id", "season", "round", "grand_prix_name")
    return results.drop("season").join(known, "race_id").where(in_optional("season", season)).withColumn("session", F.lower("session_type"))


def constructor_seasons(results: DataFrame, standings: DataFrame, drivers: DataFrame) -> DataFrame:
    """Constructor and season: wins, drivers (id and name, by id) and the last standing of the season.

    standings: constructor_id, season, round, position_number, points, championship_won."""
    win = (F.col("session_type") == "RACE") & (F.col("position_number") == 1)
    by_race = results.groupBy("constructor_id", "season", "race_id").agg(F.bool_or(win).alias("won"))
    wins = by_race.groupBy("constructor_id", "season").agg(count_where(F.col("won")).alias("wins"))
    named = results.select("constructor_id", "season", "driver_id").distinct().join(drivers.select("driver_id", "name"), "driver_id")
    who = named.groupBy("constructor_id", "season").agg(F.array_sort(F.collect_set(F.struct(F.col("driver_id").alias("id"), "name"))).alias("drivers"))
    last = pick_first(standings, ["constructor_id", "season"], [F.desc("round")]).select("constructor_id", "season", F.col("position_number").alias("championship_position"), "points", F.coalesce("championship_won", F.lit(False)).alias("is_champion"))
    out = wins.join(who, ["constructor_id", "season"]).join(last, ["constructor_id", "season"], "left")
    return out.withColumn("is_champion", F.coalesce("is_champion", F.lit(False)))


#: What rankings may be ordered by.
CRITERIA = ["entries", "starts", "wins", "podiums", "pole_positions", "fastest_laps", "points", "championships"]


def totals(results: DataFrame, standings: DataFrame, entity: str = "driver_id", season_from: int | None = None, season_to: int | None = None) -> DataFrame:
    """Every entity with a race in the seasons and its CRITERIA. standings: entity, season, is_final, championship_won."""
    within = lambda df: df.where((F.col("season") >= season_from if season_from is not None else F.lit(True)) & (F.col("season") <= season_to if season_to is not None else F.lit(True)))
    race, place = F.col("session_type") == "RACE", F.col("position_number")
    tests = {"entries": race, "starts": race & ~F.coalesce(F.col("position_text").isin(*NOT_STARTED), F.lit(False)), "wins": race & (place == 1), "podiums": race & (place <= 3), "pole_positions": race & F.col("is_pole"), "fastest_laps": race & F.col("is_fastest_lap")}
    by_race = within(results).groupBy(entity, "race_id").agg(*[F.bool_or(t).alias(n) for n, t in tests.items()], F.sum("points").alias("points"))
    out = by_race.groupBy(entity).agg(*[count_where(F.col(n)).alias(n) for n in tests], F.coalesce(F.round(F.sum("points"), 2), F.lit(0.0)).alias("points")).where("entries > 0")
    titles = within(standings).where("is_final and championship_won").groupBy(entity).agg(F.count("*").alias("championships"))
    return out.join(titles, entity, "left").withColumn("championships", F.coalesce("championships", F.lit(0).cast("long")))


def ranking(table: DataFrame, order_by: str, entity: str = "driver_id", limit: int = 50) -> DataFrame:
    """The first `limit` of a `totals` table with their rank: by the criterion, then wins, podiums and the entity."""
    if order_by not in CRITERIA:
        raise ValueError(f"order_by is one of {CRITERIA}")
    order = [F.desc_nulls_last(order_by), F.desc("wins"), F.desc("podiums"), F.asc(entity)]
    return table.orderBy(*order).limit(limit).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def quality_list(card: DataFrame) -> DataFrame:
    """A scorecard with match_pct and its place in the list: failures, then passes, then the rest, by check_id."""
    rank = F.when(F.col("status") == "FAIL", 0).when(F.col("status") == "PASS", 1).otherwise(2)
    pct: Column = F.round(100.0 * F.col("matched") / F.col("compared"), 2)
    return card.select("*", pct.alias("match_pct"), rank.alias("list_group")).orderBy("list_group", "check_id")


def latest_completed(races: DataFrame) -> DataFrame:
    """The completed race of the latest date (then the largest id): one row, or none."""
    return races.where("is_completed").orderBy(F.desc("race_date"), F.desc("race_id")).limit(1)
