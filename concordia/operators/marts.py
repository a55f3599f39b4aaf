"""Dimensions and facts of the published model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.operators.joins import broadcast_if_small, prefer_source
from concordia.operators.windows import percent_to_best, pick_first, sequence_number


def with_dimension(df: DataFrame, dimension: DataFrame, key: str, on: str, columns: dict[str, str]) -> DataFrame:
    """df with columns (name -> dimension column) of the dimension row whose `on` is df's key; a role of the dimension."""
    side = dimension.select(F.col(on).alias("_on"), *[F.col(c).alias(n) for n, c in columns.items()])
    return df.join(broadcast_if_small(side), F.col(key) == F.col("_on"), "left").drop("_on")


def driver_dimension(drivers: DataFrame, countries: DataFrame) -> DataFrame:
    """Drivers with the names of two countries: that of birth and that of nationality."""
    out = with_dimension(drivers, countries, "country_of_birth_country_id", "country_id", {"country_of_birth_name": "country_name"})
    out = with_dimension(out, countries, "nationality_country_id", "country_id", {"nationality_country": "country_name", "nationality_demonym": "demonym", "nationality_alpha2": "alpha2_code"})
    return out.drop("country_of_birth_country_id", "nationality_country_id")


def place_dimension(members: DataFrame, countries: DataFrame, columns: list[str], suffix: str) -> DataFrame:
    """Constructors, engine or tyre manufacturers: some columns, and country, demonym and alpha2 code of their country, named by
    suffix; nulls where the country is null or unknown."""
    names = {f"{n}_{suffix}": c for n, c in (("country", "country_name"), ("demonym", "demonym"), ("alpha2", "alpha2_code"))}
    return with_dimension(members, countries, "country_id", "country_id", names).select(*columns, *names)


def standing_facts(standings: DataFrame, entity: str) -> DataFrame:
    """The championship after each race as staged; a row without a race or an entity is no standing, and of rows that repeat
    race and entity (a shared place is listed once for each) all stay."""
    return standings.where(F.col("race_id").isNotNull() & F.col(entity).isNotNull())


def telemetry_facts(samples: DataFrame, races: DataFrame, numbers: DataFrame) -> DataFrame:
    """Samples by (season, round, driver_number) with race_id and driver_id instead of season and round. Samples of unknown
    races go; those of a number that no driver of the race had keep a null driver.

    Races are one row for each (season, round), numbers one for each race and number."""
    known = samples.join(races.select("season", "round", "race_id"), ["season", "round"])
    drivers = numbers.select("race_id", "driver_number", "driver_id")
    return known.join(drivers, ["race_id", "driver_number"], "left").select("race_id", "driver_id", *[c for c in samples.columns if c not in ("season", "round")])


def race_dimension(races: DataFrame, entries: DataFrame, circuits: DataFrame, grands_prix: DataFrame, countries: DataFrame) -> DataFrame:
    """Races with is_completed (any race result), has_sprint (planned or run), is_season_final_race and place names."""
    kinds = entries.groupBy("race_id").agg(F.bool_or(F.col("session_type") == "RACE_RESULT").alias("_done"), F.bool_or(F.col("session_type") == "SPRINT_RACE_RESULT").alias("_sprint"))
    out = races.join(kinds, "race_id", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    out = out.withColumns({"is_completed": yes("_done"), "has_sprint": yes("has_sprint") | yes("_sprint"), "is_season_final_race": F.col("round") == F.max("round").over(Window.partitionBy("season"))}).drop("_done", "_sprint")
    out = with_dimension(out, circuits, "circuit_id", "circuit_id", {"circuit_name": "name", "circuit_full_name": "full_name", "circuit_place_name": "place_name", "circuit_latitude": "latitude", "circuit_longitude": "longitude", "_circuit_country": "country_id"})
    out = with_dimension(out, countries, "_circuit_country", "country_id", {"circuit_country": "country_name", "circuit_alpha2": "alpha2_code"})
    out = with_dimension(out, grands_prix, "grand_prix_id", "grand_prix_id", {"grand_prix_name": "name", "grand_prix_full_name": "full_name", "grand_prix_short_name": "short_name", "_gp_country": "country_id"})
    return with_dimension(out, countries, "_gp_country", "country_id", {"grand_prix_country": "country_name"}).drop("_circuit_country", "_gp_country")


def session_facts(entries: DataFrame, sessions: dict[str, str], columns: dict[str, str], flags: dict[str, str], zeros: dict[str, str]) -> DataFrame:
    """Rows of some session types (source type -> published name): columns renamed, flags false and numbers 0 where null,
    is_win and is_podium from the position."""
    kind = F.create_map(*[F.lit(x) for kv in sessions.items() for x in kv])
    place = F.col("position_number")
    return entries.where(F.col("session_type").isin(*sessions)).select(
        "race_id", F.try_element_at(kind, "session_type").alias("session_type"), *[F.col(c).alias(n) for c, n in columns.items()], *[F.coalesce(F.col(c), F.lit(False)).alias(n) for c, n in flags.items()], *[F.coalesce(F.col(c), F.lit(0)).alias(n) for c, n in zeros.items()],
        F.coalesce(place == 1, F.lit(False)).alias("is_win"), F.coalesce(place <= 3, F.lit(False)).alias("is_podium"),
    )


def qualifying_facts(entries: DataFrame) -> DataFrame:
    """Qualifying rows with the best of their parts (else the time) and the percentage gap to the session's best."""
    best = F.coalesce(F.least("q1_ms", "q2_ms", "q3_ms"), "time_ms")
    out = entries.withColumn("best_time_ms", best).withColumn("is_pole", F.coalesce(F.col("position_number") == 1, F.lit(False)))
    return percent_to_best(out, ["race_id", "session_type"], "best_time_ms", "gap_to_pole_pct")


def stop_facts(entries: DataFrame, business: list[str], order: str) -> DataFrame:
    """Stops without rows that repeat all business columns."""
    return pick_first(entries, business, [F.col(order).asc_nulls_last()])


def lap_facts(laps: DataFrame, completeness: DataFrame) -> DataFrame:
    """Published laps with the quality marks of their unit."""
    marks = completeness.select("race_id", "driver_id", "official_laps", "status")
    beyond = (F.col("lap_number") > F.col("official_laps")) & ~F.col("status").isin("shared_car", "disqualified")
    out = laps.join(marks, ["race_id", "driver_id"], "left")
    return out.select(*laps.columns, F.coalesce(beyond, F.lit(False)).alias("is_incomplete_lap"), F.coalesce("status", F.lit("unmatched_driver")).alias("quality_status"))


def one_source_log(first: DataFrame, second: DataFrame, order: list[str], sequence: str) -> DataFrame:
    """Samples or messages from one source for each race (the first if it has the race), numbered in order."""
    both = prefer_source(first, second, ["race_id"])
    return sequence_number(both, ["race_id"], [F.asc_nulls_last(o) for o in order], sequence)
