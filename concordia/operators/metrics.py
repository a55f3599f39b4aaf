"""Career, season and peer metrics over results: race_id, season, session_type, driver_id, constructor_id, driver_number,
position_number, position_text, position_display_order, points, is_pole, is_fastest_lap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.columns import percent
from concordia.operators.aggregates import count_where, distinct_where
from concordia.operators.joins import peers_of_teams

#: Position texts of entries that did not start. Fixed values.
NOT_STARTED = ["DNQ", "DNPQ", "DNP", "EX", "DNS"]


def _race() -> F.col:
    return F.col("session_type") == "RACE"


def driver_career(results: DataFrame, digits: int = 2) -> DataFrame:
    """One row by driver: entries, starts, wins, podiums, poles, fastest laps, slams, points and rates. In two steps, by
    race and then all, so that no distinct counts expand the rows."""
    race, place = _race(), F.col("position_number")
    win, pole, fast = race & (place == 1), race & F.col("is_pole"), race & F.col("is_fastest_lap")
    started = race & ~F.coalesce(F.col("position_text").isin(*NOT_STARTED), F.lit(False))
    tests = {"entries": race, "starts": started, "wins": win, "podiums": race & (place <= 3), "poles": pole, "fastest_laps": fast, "slams": win & pole & fast}
    by_race = results.groupBy("driver_id", "race_id").agg(*[F.bool_or(test).alias(n) for n, test in tests.items()], F.sum("points").alias("points"), F.min("season").alias("first_season"), F.max("season").alias("last_season"))
    out = by_race.groupBy("driver_id").agg(*[count_where(F.col(n)).alias(n) for n in tests], F.sum("points").alias("points"), F.min("first_season").alias("first_season"), F.max("last_season").alias("last_season"))
    return out.withColumns({"win_pct": percent("wins", "starts", digits), "podium_pct": percent("podiums", "starts", digits)})


def constructor_career(results: DataFrame, era: int) -> DataFrame:
    """One row by constructor in two steps (by race, then all): wins, one-twos, podiums of cars and of races, points in all
    and from the season `era` on."""
    race, place = _race(), F.col("position_number")
    by_race = results.groupBy("constructor_id", "race_id", "season").agg(
        F.bool_or(race & (place == 1)).alias("won"), F.bool_or(race & (place == 2)).alias("second"), F.count_if(race & (place <= 3)).alias("cars"),
        F.bool_or(race).alias("raced"), F.sum("points").alias("points"),
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return by_race.groupBy("constructor_id").agg(
        count_where(yes("raced")).alias("entries"), count_where(yes("won")).alias("wins"), count_where(yes("won") & yes("second")).alias("one_twos"), count_where(F.col("cars") > 0).alias("podium_races"),
        F.sum("cars").alias("podiums"), F.sum("points").alias("points"), F.sum(F.when(F.col("season") >= era, F.col("points"))).alias("points_since_era"),
    )


def driver_season(results: DataFrame) -> DataFrame:
    """One row by season and driver; the main team is that of most races, then points, then the smaller id."""
    race, place = _race(), F.col("position_number")
    base = results.groupBy("season", "driver_id", "constructor_id", "race_id").agg(F.bool_or(race).alias("raced"), F.bool_or(race & (place == 1)).alias("won"), F.sum("points").alias("points"), F.min(F.when(race, place)).alias("best"))
    team = base.groupBy("season", "driver_id", "constructor_id").agg(count_where(F.col("raced")).alias("n"), F.sum("points").alias("p"))
    order = F.struct((-F.col("n")).alias("n"), (-F.coalesce("p", F.lit(0))).alias("p"), F.col("constructor_id").isNull().alias("none"), "constructor_id")
    main = team.groupBy("season", "driver_id").agg(F.min_by("constructor_id", order).alias("main_team"), F.count("constructor_id").alias("teams"), F.sum("p").alias("points"))
    by_race = base.groupBy("season", "driver_id", "race_id").agg(F.bool_or("raced").alias("raced"), F.bool_or("won").alias("won"), F.min("best").alias("best"))
    out = by_race.groupBy("season", "driver_id").agg(count_where(F.col("raced")).alias("entries"), count_where(F.col("won")).alias("wins"), F.min("best").alias("best"))
    return out.join(main, ["season", "driver_id"])


def best_per_race(results: DataFrame, session: str = "RACE") -> DataFrame:
    """One row by race, team and driver, however many cars it shared: best place and points, for peer comparisons."""
    return results.where(F.col("session_type") == session).groupBy("race_id", "season", "constructor_id", "driver_id").agg(F.min("position_number").alias("place"), F.min("position_display_order").alias("shown"), F.sum("points").alias("points"))


def head_to_head(results: DataFrame) -> DataFrame:
    """Ordered pairs of team-mates by season: races together, duels (both classified), won, lost, share won."""
    own = best_per_race(results)
    pairs = peers_of_teams(own, ["race_id", "season", "constructor_id"], "driver_id", ["place", "points"])
    both = F.col("place").isNotNull() & F.col("peer_place").isNotNull()
    out = pairs.groupBy("season", "constructor_id", "driver_id", "peer_driver_id").agg(F.count("*").alias("races"), count_where(both).alias("duels"), count_where(both & (F.col("place") < F.col("peer_place"))).alias("won"), count_where(both & (F.col("place") > F.col("peer_place"))).alias("lost"), F.sum("points").alias("points"), F.sum("peer_points").alias("peer_points"))
    return out.withColumn("won_pct", percent("won", "duels", 1))


def versus_best_peer(results: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """By race, team and driver the best team-mate (points, then display order, then id) and the outcome; pairs that shared
    a unit (race_id, constructor_id, driver_id, peer_driver_id) are left out."""
    pairs = peers_of_teams(best_per_race(results), ["race_id", "season", "constructor_id"], "driver_id", ["place", "shown", "points"])
    if shared is not None:
        pairs = pairs.join(shared, ["race_id", "constructor_id", "driver_id", "peer_driver_id"], "left_anti")
    peer = ["peer_points", "peer_shown", "peer_driver_id", "peer_place"]
    order = F.struct(F.col("peer_points").isNull().alias("a"), (-F.col("peer_points")).alias("b"), F.col("peer_shown").isNull().alias("c"), "peer_shown", "peer_driver_id")
    best = pairs.groupBy("race_id", "season", "constructor_id", "driver_id", "place", "shown", "points").agg(F.count("*").alias("peers"), F.min_by(F.struct(*peer), order).alias("_best"))
    best = best.select("*", "_best.*").drop("_best")
    both = F.col("place").isNotNull() & F.col("peer_place").isNotNull()
    return best.withColumn("is_ahead", F.when(both, F.col("place") < F.col("peer_place")))


def versus_peers_season(best_peer: DataFrame) -> DataFrame:
    """By season and driver: races with a peer, duels, ahead, own points and the best peers'."""
    return best_peer.groupBy("season", "driver_id").agg(F.count("*").alias("races"), F.count("is_ahead").alias("duels"), count_where(F.col("is_ahead")).alias("ahead"), F.sum("points").alias("points"), F.sum("peer_points").alias("peer_points"))


def career_duels(seasons: DataFrame) -> DataFrame:
    """`versus_peers_season` summed over all seasons of a driver: races, duels, ahead, points and the peers', seasons and the
    share of duels won in percent (null without duels)."""
    sums = [F.sum(c).alias(c) for c in ("races", "duels", "ahead", "points", "peer_points")]
    out = seasons.groupBy("driver_id").agg(F.count("*").alias("seasons"), *sums)
    return out.withColumn("ahead_pct", F.when(F.col("duels") > 0, F.round(100.0 * F.col("ahead") / F.col("duels"), 1)))


def standings_after_rounds(results: DataFrame, round_col: str, entity: str = "driver_id", member: str = "constructor_id") -> DataFrame:
    """By season, round and driver (or another entity) who has appeared so far: points, wins and teams up to that round, and the place in it.

    A race lies in one round. Rounds are those of the season's results; a driver stays listed in rounds without an own result."""
    win = _race() & (F.col("position_number") == 1)
    by_round = results.groupBy("season", round_col, entity).agg(F.sum("points").alias("_points"), distinct_where(win, "race_id").alias("_wins"), F.collect_set(member).alias("_teams"))
    grid = results.select("season", round_col).distinct().join(results.groupBy("season", entity).agg(F.min(round_col).alias("_first")), "season").where(F.col(round_col) >= F.col("_first")).drop("_first")
    so_far = Window.partitionBy("season", entity).orderBy(round_col).rowsBetween(Window.unboundedPreceding, 0)
    out = grid.join(by_round, ["season", round_col, entity], "left").select(
        "season", round_col, entity, F.sum("_points").over(so_far).alias("points"), F.sum("_wins").over(so_far).alias("wins"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_teams").over(so_far)))), ",").alias("teams"),
    )
    return out.withColumn("place", F.rank().over(Window.partitionBy("season", round_col).orderBy(F.desc("points"))))
