"""Serving and quality of the published model on series derived from the given tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.operators import codes, fusion, marts, metrics, quality, serving
from concordia.operators import windows as W
from concordia.plans.base import LAPS_SQL, RESULTS_SQL, codes_sql, laps, query, results
from concordia.plans.composite import _SOURCES, _sources

_R = "session_type = 'RACE'"

# Drivers, constructors and codes

_DRIVERS_SQL = """drivers AS (SELECT DISTINCT 'd' || k AS driver_id, CASE WHEN k % 5 <> 0 THEN ['VER', 'HAM', 'MSC'][k % 3 + 1] END AS abbreviation, CASE WHEN k % 4 = 0 THEN NULL WHEN k % 2 = 0 THEN 'Éric' ELSE 'Ana' END AS first_name, 'N ' || k AS name FROM (SELECT s_suppkey % 40 AS k FROM supplier)),
constructors AS (SELECT DISTINCT 'c' || (s_suppkey % 8) AS constructor_id, 'T ' || (s_suppkey % 8) AS name FROM supplier)"""


def _drivers(t):
    k = F.col("s_suppkey") % 40
    abbreviation = F.when(k % 5 != 0, F.element_at(F.array(*map(F.lit, ("VER", "HAM", "MSC"))), (k % 3 + 1).cast("int")))
    return t.supplier.select(F.concat(F.lit("d"), k).alias("driver_id"), abbreviation.alias("abbreviation"), F.when(k % 4 == 0, None).when(k % 2 == 0, "Éric").otherwise("Ana").alias("first_name"), F.concat(F.lit("N "), k).alias("name")).distinct()


def _constructors(t):
    k = F.col("s_suppkey") % 8
    return t.supplier.select(F.concat(F.lit("c"), k).alias("constructor_id"), F.concat(F.lit("T "), k).alias("name")).distinct()


def _entered(t):
    """Results with laps and grid places."""
    return results(t).withColumns({"laps": F.when(F.col("points") > 25, 5), "grid_position": F.when(F.col("is_pole"), 1)})


_LETTERS = "translate(CAST({} AS VARCHAR), '0123456789', 'abcdefghij')"


@query(f"""WITH RECURSIVE {codes_sql(f'''SELECT g, 'ab' || {_LETTERS.format('k')} || '-mor' || {_LETTERS.format('k % 7')} || CASE WHEN k % 10 = 0 THEN '-jr' ELSE '' END AS id, CASE WHEN k % 5 <> 0 THEN ['ver', 'HAM', 'MSC'][k % 3 + 1] END AS code, CASE WHEN k % 4 = 0 THEN NULL WHEN k % 2 = 0 THEN 'Éric' ELSE '7 Óscar' END AS name, ran
  FROM (SELECT l_orderkey // 16 AS g, l_suppkey % 40 AS k, bool_or(l_quantity > 45) AS ran FROM lineitem GROUP BY ALL)''')} SELECT g AS race_id, id AS driver_id, chosen AS unique_code FROM codes""")
def r36_codes_of_races(t):
    k = F.col("l_suppkey") % 40
    letters = lambda c: F.translate(c.cast("string"), "0123456789", "abcdefghij")
    entity = F.concat(F.lit("ab"), letters(k), F.lit("-mor"), letters(k % 7), F.when(k % 10 == 0, "-jr").otherwise(""))
    code = F.when(k % 5 != 0, F.element_at(F.array(*map(F.lit, ("ver", "HAM", "MSC"))), (k % 3 + 1).cast("int")))
    name = F.when(k % 4 == 0, None).when(k % 2 == 0, "Éric").otherwise("7 Óscar")
    rows = t.lineitem.select(F.floor(F.col("l_orderkey") / 16).alias("race_id"), entity.alias("driver_id"), code.alias("code"), name.alias("name"), (F.col("l_quantity") > 45).alias("ran"))
    return codes.unique_codes(rows, ["race_id"], "driver_id", "code", "name", "ran")


# Tables of a race, for all races


@query(f"""WITH RECURSIVE {RESULTS_SQL}, {_DRIVERS_SQL}, {codes_sql("SELECT race_id AS g, driver_id AS id, any_value(abbreviation) AS code, any_value(first_name) AS name, coalesce(bool_or(points > 25 OR is_pole), false) AS ran FROM results JOIN drivers USING (driver_id) GROUP BY ALL")}
SELECT race_id, position_display_order, driver_id, d.name AS driver_name, c.name AS constructor_name, position_text, points, chosen AS driver_code FROM results r JOIN drivers d USING (driver_id) JOIN constructors c USING (constructor_id) LEFT JOIN codes ON g = race_id AND id = driver_id WHERE {_R}""")
def e07_race_results(t):
    out = serving.race_results(_entered(t), _drivers(t), _constructors(t))
    return out.select("race_id", "position_display_order", "driver_id", "driver_name", "constructor_name", "position_text", "points", "driver_code").orderBy("race_id", "position_display_order")


@query(f"""WITH {RESULTS_SQL}, {_DRIVERS_SQL}, w AS (SELECT race_id, driver_id, row_number() OVER (PARTITION BY race_id ORDER BY position_display_order, driver_id) AS rn FROM results WHERE {_R} AND position_number = 1)
SELECT o_orderkey AS race_id, CAST(year(o_orderdate) AS INT) AS season, o_custkey % 3 = 0 AS has_sprint_qualifying, driver_id AS winner_id, name AS winner_name FROM orders LEFT JOIN w ON race_id = o_orderkey AND rn = 1 LEFT JOIN drivers USING (driver_id)""")
def e06_race_detail(t):
    races = t.orders.select(F.col("o_orderkey").alias("race_id"), F.year("o_orderdate").alias("season"), F.when(F.col("o_custkey") % 3 == 0, "SHOOTOUT").alias("sprint_qualifying_format"))
    return serving.race_detail(races, results(t), _drivers(t)).drop("sprint_qualifying_format")


_QUALI_SQL = f"""{RESULTS_SQL}, {_DRIVERS_SQL}, q AS (SELECT *, CAST(60000 + points * 100 AS BIGINT) AS q1, CASE WHEN is_pole THEN CAST(59000 + points * 100 AS BIGINT) END AS q2 FROM results WHERE {_R}),
g AS (SELECT *, least(q1, q2) AS best, round(100 * (least(q1, q2) / min(least(q1, q2)) OVER (PARTITION BY race_id) - 1), 3) AS gap FROM q)"""


def _qualified(t):
    q1 = (60_000 + F.col("points") * 100).cast("long")
    r = results(t).where(_R).withColumns({"session_type": F.lit("QUALIFYING"), "q1_ms": q1, "q2_ms": F.when(F.col("is_pole"), q1 - 1000), "q3_ms": F.lit(None).cast("long"), "time_ms": F.lit(None).cast("long")})
    return marts.qualifying_facts(r)


@query(f"WITH {_QUALI_SQL} SELECT race_id, position_display_order, driver_id, d.name AS driver_name, c.name AS constructor_name, q1 AS q1_ms, q2 AS q2_ms, best AS best_time_ms, CAST(round(gap * 1000) AS BIGINT) AS gap_thousandths FROM g JOIN drivers d USING (driver_id) JOIN constructors c USING (constructor_id)")
def e08_qualifying(t):
    out = serving.qualifying_table(_qualified(t), _drivers(t), _constructors(t))
    return out.select("race_id", "position_display_order", "driver_id", "driver_name", "constructor_name", "q1_ms", "q2_ms", "best_time_ms", F.round(F.col("gap_to_pole_pct") * 1000).cast("long").alias("gap_thousandths"))


@query(f"WITH {_QUALI_SQL} SELECT race_id, constructor_id, CAST(round(avg(gap) * 1000 * count(*)) AS BIGINT) AS mean_thousandths_by_n, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY ALL")
def a21_mean_gap(t):
    return serving.mean_gap(_qualified(t), "constructor_id").select("race_id", "constructor_id", F.round(F.col("mean_gap_pct") * 1000 * F.col("n")).cast("long").alias("mean_thousandths_by_n"), "n")


@query(f"""WITH {LAPS_SQL} SELECT race_id, driver_id, lap_number, CASE WHEN lap_number % 5 <> 0 THEN nullif(CASE WHEN place = 1 THEN '' ELSE 'C' || place END, '') ELSE 'SOFT' END AS compound FROM laps WHERE lap_number <= 5""")
def e09_laps(t):
    place = F.col("place")
    x = laps(t).withColumns({"tyre_compound": F.when(place == 1, "").otherwise(F.concat(F.lit("C"), place)), "tyre_compound_relative": F.when(F.col("lap_number") % 5 == 0, "SOFT"), "is_incomplete_lap": F.col("lap_number") > 5})
    return serving.laps_table(x).select("race_id", "driver_id", "lap_number", "compound").orderBy("lap_number", F.asc_nulls_last("place"), "driver_id")


@query(f"""WITH {LAPS_SQL}, stops AS (SELECT race_id, driver_id, lap_number, CAST(lap_time_ms % 9000 AS BIGINT) AS duration_ms FROM laps WHERE place = 1), known AS (SELECT DISTINCT race_id FROM stops)
SELECT race_id, driver_id, lap_number, row_number() OVER (PARTITION BY race_id, driver_id ORDER BY lap_number) AS stop, duration_ms, 'stop' AS kind FROM stops
UNION ALL SELECT race_id, driver_id, lap_number, NULL, NULL, CASE WHEN place = 1 THEN 'pit_stop' WHEN race_id NOT IN (SELECT race_id FROM known) THEN 'unclassified' ELSE 'penalty_or_other' END FROM laps WHERE place <= 2""")
def e11_stops_and_passes(t):
    x = laps(t)
    rows = x.where("place = 1").select("race_id", "driver_id", "lap_number", (F.col("lap_time_ms") % 9000).alias("duration_ms"))
    stops = marts.stop_facts(rows.union(rows), ["race_id", "driver_id", "lap_number"], "duration_ms")
    stops = W.sequence_number(stops, ["race_id", "driver_id"], ["lap_number"], "stop").withColumn("kind", F.lit("stop"))
    races = x.select("race_id").distinct().select("race_id", F.lit("consistent").alias("status"), F.lit(0).alias("second_offset"))
    ended = x.select("race_id", "driver_id").distinct().select("race_id", "driver_id", F.lit(7).alias("official_laps"), F.lit(True).alias("is_classified"))
    passes = x.where("place <= 2").select("race_id", "driver_id", "lap_number", F.lit(False).alias("is_red_flag"), F.lit(False).alias("is_safety_car"), C.no_texts().alias("corrections"))
    typed = fusion.pass_types(passes, rows, races, ended).select("race_id", "driver_id", "lap_number", F.lit(None).cast("int").alias("stop"), F.lit(None).cast("long").alias("duration_ms"), F.col("pass_type").alias("kind"))
    return stops.select(*typed.columns).unionByName(typed)


@query("SELECT user_id AS race_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS seq, event_id, value > 50 AS is_raining FROM events WHERE event_type = 'view'")
def e12_weather(t):
    samples = t.events.where("event_type = 'view'").select(F.col("user_id").alias("race_id"), "event_id", "ts", (F.col("value") > 50).alias("is_raining"))
    return marts.one_source_log(samples, samples.where("false"), ["ts", "event_id"], "seq").select("race_id", "seq", "event_id", "is_raining")


# Profiles and rankings


_MONTHS_SQL = "d AS (SELECT r.*, CAST(month(o_orderdate) AS INT) AS month FROM results r JOIN orders ON race_id = o_orderkey), months AS (SELECT DISTINCT season, month FROM d)"


def _by_month(t):
    return results(t).join(t.orders.select(F.col("o_orderkey").alias("race_id"), F.month("o_orderdate").alias("month")), "race_id")


@query(f"""WITH {RESULTS_SQL}, {_MONTHS_SQL} SELECT m.season, m.month, constructor_id, sum(points) AS points, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins, rank() OVER (PARTITION BY m.season, m.month ORDER BY sum(points) DESC) AS place
FROM months m JOIN d ON d.season = m.season AND d.month <= m.month GROUP BY m.season, m.month, constructor_id""")
def e04_constructor_standings(t):
    return metrics.standings_after_rounds(_by_month(t), "month", "constructor_id", "driver_number").drop("teams")


@query(f"""WITH {RESULTS_SQL} SELECT race_id, season, CAST(race_id % 20 AS INT) AS round, 'GP ' || (race_id % 20) AS grand_prix_name, driver_id, constructor_id, position_display_order, lower(session_type) AS session, position_text, points FROM results""")
def e14_driver_results(t):
    r = results(t)
    n = F.col("race_id") % 20
    races = r.select("race_id", "season").distinct().select("race_id", "season", n.cast("int").alias("round"), F.concat(F.lit("GP "), n).alias("grand_prix_name"))
    return serving.driver_results(r, races).select("race_id", "season", "round", "grand_prix_name", "driver_id", "constructor_id", "position_display_order", "session", "position_text", "points")


@query(f"""WITH {RESULTS_SQL}, {_DRIVERS_SQL}, {_MONTHS_SQL}, w AS (SELECT constructor_id, season, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins, array_to_string(list_sort(list(DISTINCT driver_id || ':' || d2.name)), ',') AS drivers FROM results JOIN drivers d2 USING (driver_id) GROUP BY ALL),
p AS (SELECT season, month, constructor_id, sum(points) AS points FROM d GROUP BY ALL), s AS (SELECT *, rank() OVER (PARTITION BY season, month ORDER BY points DESC) AS pos FROM p), f AS (SELECT *, row_number() OVER (PARTITION BY constructor_id, season ORDER BY month DESC) AS rn FROM s)
SELECT w.constructor_id, w.season, w.wins, w.drivers, pos AS championship_position, points, coalesce(pos = 1, false) AS is_champion FROM w LEFT JOIN f ON f.constructor_id = w.constructor_id AND f.season = w.season AND rn = 1""")
def e16_constructor_seasons(t):
    monthly = _by_month(t).groupBy("season", F.col("month").alias("round"), "constructor_id").agg(F.sum("points").alias("points"))
    standings = W.ranked(monthly, ["season", "round"], [F.desc("points")], "position_number").withColumn("championship_won", F.when(F.col("position_number") == 1, True))
    out = serving.constructor_seasons(results(t), standings, _drivers(t))
    return out.withColumn("drivers", F.array_join(F.array_sort(F.transform("drivers", lambda d: F.concat(d.id, F.lit(":"), d["name"]))), ","))


_TOTALS_SQL = f"""{RESULTS_SQL}, y AS (SELECT season, driver_id, sum(points) AS p FROM results GROUP BY ALL), champ AS (SELECT season, driver_id, rank() OVER (PARTITION BY season ORDER BY p DESC) = 1 AS won FROM y),
tot AS (SELECT driver_id, count(DISTINCT race_id) FILTER (WHERE {_R}) AS entries, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_text NOT IN ('DNQ', 'DNPQ', 'DNP', 'EX', 'DNS')) AS starts, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number <= 3) AS podiums,
  count(DISTINCT race_id) FILTER (WHERE {_R} AND is_pole) AS pole_positions, count(DISTINCT race_id) FILTER (WHERE {_R} AND is_fastest_lap) AS fastest_laps, round(sum(points), 2) AS points, (SELECT count(*) FROM champ WHERE won AND champ.driver_id = r.driver_id AND season BETWEEN 1990 AND 2010) AS championships FROM results r WHERE season BETWEEN 1990 AND 2010 GROUP BY driver_id)"""


@query(f"WITH {_TOTALS_SQL} " + " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS criterion, row_number() OVER (ORDER BY {c} DESC, wins DESC, podiums DESC, driver_id) AS rank, driver_id, CAST({c} AS DOUBLE) AS value FROM tot) WHERE rank <= 15" for c in serving.CRITERIA))
def e18_rankings(t):
    r = results(t)
    champion = W.ranked(r.groupBy("season", "driver_id").agg(F.sum("points").alias("p")), ["season"], [F.desc("p")], "n")
    standings = champion.select("season", "driver_id", F.lit(True).alias("is_final"), (F.col("n") == 1).alias("championship_won"))
    table = serving.totals(r, standings, season_from=1990, season_to=2010)
    out = None
    for c in serving.CRITERIA:
        one = serving.ranking(table, c, limit=15).select(F.lit(c).alias("criterion"), "rank", "driver_id", F.col(c).cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH r AS (SELECT o_orderkey, o_orderdate, o_orderstatus = 'F' AS done FROM orders) SELECT o_orderkey AS race_id, CAST(o_orderdate AS DATE) AS race_date FROM r WHERE done ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def e20_latest_completed(t):
    races = t.orders.select(F.col("o_orderkey").alias("race_id"), F.to_date("o_orderdate").alias("race_date"), (F.col("o_orderstatus") == "F").alias("is_completed"))
    return serving.latest_completed(races).select("race_id", "race_date")


# Comparisons and the scorecard

_TWO_SQL = f"""{RESULTS_SQL}, own AS (SELECT race_id, position_display_order AS k, position_number AS position, points, CAST(60000 + points * 100 AS BIGINT) AS q1, CASE WHEN is_pole THEN CAST(points * 10 AS BIGINT) END AS stop FROM results WHERE {_R}),
oth AS (SELECT race_id, k, CASE WHEN (race_id + k) % 7 = 0 THEN position + 1 ELSE position END AS position, CASE WHEN (race_id + k) % 9 = 0 THEN points + 0.5 ELSE points END AS points, q1 + (race_id + k) % 3 AS q1, CASE WHEN (race_id + k) % 4 <> 0 THEN stop END AS stop FROM own WHERE (race_id + k) % 11 <> 0 UNION ALL SELECT race_id, k + 100, position, points, q1, stop FROM own WHERE (race_id + k) % 13 = 0)"""


def _two(t):
    own = results(t).where(_R).select("race_id", F.col("position_display_order").alias("k"), F.col("position_number").alias("position"), "points", (60_000 + F.col("points") * 100).cast("long").alias("q1"), F.when(F.col("is_pole"), (F.col("points") * 10).cast("long")).alias("stop"))
    m = F.col("race_id") + F.col("k")
    moved = F.when(m % 7 == 0, F.col("position") + 1).otherwise(F.col("position"))
    other = own.where(m % 11 != 0).select("race_id", "k", moved.alias("position"), F.when(m % 9 == 0, F.col("points") + 0.5).otherwise(F.col("points")).alias("points"), (F.col("q1") + m % 3).alias("q1"), F.when(m % 4 != 0, F.col("stop")).alias("stop"))
    extra = own.where(m % 13 == 0).withColumn("k", F.col("k") + 100)
    return own, other.unionByName(extra)


_FLAG = "CASE WHEN own.{0} IS NOT NULL AND oth.{0} IS NOT NULL THEN {1} END AS {0}_matches"


@query(f"""WITH {_TWO_SQL} SELECT race_id, k, own.race_id IS NOT NULL AS in_left, oth.race_id IS NOT NULL AS in_right, {_FLAG.format('position', 'own.position = oth.position')}, {_FLAG.format('points', 'own.points = oth.points')}, {_FLAG.format('q1', 'abs(own.q1 - oth.q1) <= 1')}, {_FLAG.format('stop', 'abs(own.stop - oth.stop) <= 1')} FROM own FULL JOIN oth USING (race_id, k)""")
def q02_result_comparison(t):
    out = quality.compare_rows(*_two(t), ["race_id", "k"], {"position": None, "points": None, "q1": 1, "stop": 1})
    return out.select("race_id", "k", "in_left", "in_right", "position_matches", "points_matches", "q1_matches", "stop_matches")


_LAP_PAIRS = {"a_b": ("a", "b"), "a_c": ("a", "c"), "b_c": ("b", "c")}
_THRESHOLDS = {"position": 80.0, "points": 95.0, "q1": 60.0, "stop": None}


def _check_sql(name: str, field: str, threshold, by: str | None, source: str) -> str:
    label = f"'{name}:{field}'" + (f" || ':' || {by}" if by else "")
    test = f"{field}_matches" if field != "presence" else "(in_left AND in_right)"
    limit = "CAST(NULL AS DOUBLE)" if threshold is None else f"CAST({threshold} AS DOUBLE)"
    return f"SELECT {label} AS check_id, count(*) FILTER (WHERE {test} IS NOT NULL) AS compared, count(*) FILTER (WHERE {test}) AS matched, {limit} AS threshold FROM {source}" + (f" GROUP BY {by}" if by else "")


_CARD_SQL = f"""WITH {_SOURCES}, {_TWO_SQL.replace(RESULTS_SQL + ', ', RESULTS_SQL + ', ')}, cmp AS (SELECT race_id, race_id % 4 AS g, own.race_id IS NOT NULL AS in_left, oth.race_id IS NOT NULL AS in_right, {_FLAG.format('position', 'own.position = oth.position')}, {_FLAG.format('points', 'own.points = oth.points')}, {_FLAG.format('q1', 'abs(own.q1 - oth.q1) <= 1')}, {_FLAG.format('stop', 'abs(own.stop - oth.stop) <= 1')} FROM own FULL JOIN oth USING (race_id, k)),
{', '.join(f"l_{n} AS (SELECT x.race_id IS NOT NULL AS in_left, y.race_id IS NOT NULL AS in_right, abs(x.v - y.v) <= 1 AS time_matches, x.p = y.p AS position_matches FROM {x} x FULL JOIN {y} y USING (race_id, driver_id, lap_number))" for n, (x, y) in _LAP_PAIRS.items())},
s AS ({' UNION ALL '.join([_check_sql('results', f, _THRESHOLDS.get(f), 'g', 'cmp') for f in (*_THRESHOLDS, 'presence')] + [_check_sql(f'laps_{n}', f, h, None, f'l_{n}') for n in _LAP_PAIRS for f, h in (('time', 70.0), ('position', 99.0), ('presence', None))])}),
card AS (SELECT *, CASE WHEN threshold IS NULL THEN 'INFO' WHEN compared = 0 THEN 'NO_DATA' WHEN 100.0 * matched / compared >= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM s)"""


def _card(t):
    """29 checks: results, qualifying times and stops of two sources by group of races, and the laps of three sources in pairs."""
    compared = quality.compare_rows(*_two(t), ["race_id", "k"], {"position": None, "points": None, "q1": 1, "stop": 1}).withColumn("g", F.col("race_id") % 4)
    checks = [quality.comparison_checks(compared, "results", _THRESHOLDS, ["g"])]
    sources = dict(zip("abc", _sources(t)))
    for name, (x, y) in _LAP_PAIRS.items():
        two = [sources[s].withColumnRenamed("lap_time_ms", "time") for s in (x, y)]
        checks.append(quality.comparison_checks(quality.compare_rows(*two, ["race_id", "driver_id", "lap_number"], {"time": 1, "position": None}), f"laps_{name}", {"time": 70.0, "position": 99.0}))
    return quality.scorecard(checks)


@query(f"{_CARD_SQL} SELECT check_id, compared, matched, threshold, status FROM card")
def q04_scorecard_of_comparisons(t):
    return _card(t).select("check_id", "compared", "matched", "threshold", "status")


@query(f"{_CARD_SQL} SELECT check_id FROM card WHERE status = 'FAIL'")
def q15_threshold_gate(t):
    return quality.gate(_card(t)).select("check_id")


@query(f"{_CARD_SQL} SELECT check_id, status, CASE status WHEN 'FAIL' THEN 0 WHEN 'PASS' THEN 1 ELSE 2 END AS list_group FROM card")
def e20_t06_quality_list(t):
    return serving.quality_list(_card(t)).select("check_id", "status", "list_group")


@query(f"""WITH {LAPS_SQL}, stops AS (SELECT race_id, driver_id, lap_number + 5 * CAST(race_id % 9 = 0 AS INT) AS lap_number FROM laps WHERE place = 1) SELECT s.race_id, s.driver_id, s.lap_number, l.lap_time_ms % 3 <> 0 AS is_pit_in_match FROM stops s LEFT JOIN laps l USING (race_id, driver_id, lap_number)""")
def q03_stops_in_pit_laps(t):
    x = laps(t).withColumn("is_pit_in_lap", F.col("lap_time_ms") % 3 != 0)
    stops = x.where("place = 1").select("race_id", "driver_id", (F.col("lap_number") + F.when(F.col("race_id") % 9 == 0, 5).otherwise(0)).alias("lap_number"))
    return quality.stops_in_pit_laps(stops, x, ["race_id", "driver_id", "lap_number"])


@query(f"""WITH {_SOURCES}, v AS (SELECT a.*, CASE WHEN b.p = c.p AND b.p <> a.p THEN b.p END AS vote FROM a LEFT JOIN b USING (race_id, driver_id, lap_number) LEFT JOIN c USING (race_id, driver_id, lap_number)),
bad AS (SELECT DISTINCT race_id, lap_number FROM v GROUP BY race_id, lap_number, coalesce(vote, p) HAVING count(*) > 1 AND bool_or(vote IS NOT NULL)) SELECT race_id, driver_id, lap_number FROM v SEMI JOIN bad USING (race_id, lap_number) WHERE vote IS NOT NULL""")
def q03_withheld_votes(t):
    a, b, c = _sources(t)
    wide = fusion.position_votes(fusion.compare_sources(a, {"b": b, "c": c}), "position", "b_position", "c_position")
    return fusion.withhold_conflicts(wide, ["race_id", "lap_number"], "voted_position", "position").where("is_withheld").select("race_id", "driver_id", "lap_number")


@query(f"""WITH {LAPS_SQL}, m AS (SELECT o_orderkey // 4 + CAST(o_orderkey % 40 = 0 AS INT) * 1000000000 AS race_id, o_orderkey AS message_id, CAST(o_custkey % 11 AS INT) AS lap_number, o_custkey % 100 AS "at" FROM orders WHERE o_orderkey % 3 = 0), l AS (SELECT *, place = 1 AND lap_number % 2 = 0 AS red FROM laps)
SELECT message_id, CASE WHEN m.race_id NOT IN (SELECT race_id FROM laps) THEN 'no_laps' WHEN m.at < m.race_id % 30 THEN 'pre_start' WHEN m.lap_number - 1 > (SELECT max(lap_number) FROM laps WHERE laps.race_id = m.race_id) THEN 'after_end' ELSE 'race' END AS phase,
  EXISTS (SELECT 1 FROM l WHERE l.race_id = m.race_id AND red AND l.lap_number BETWEEN m.lap_number - 1 AND m.lap_number + 1) AS is_lap_flagged FROM m""")
def q03_flag_phases(t):
    k = F.col("o_orderkey")
    race = F.floor(k / 4) + F.when(k % 40 == 0, 1_000_000_000).otherwise(0)
    messages = t.orders.where("o_orderkey % 3 = 0").select(race.alias("race_id"), k.alias("message_id"), (F.col("o_custkey") % 11).cast("int").alias("lap_number"), (F.col("o_custkey") % 100).alias("at"))
    x = laps(t).withColumn("is_red_flag", (F.col("place") == 1) & (F.col("lap_number") % 2 == 0)).withColumn("lap_number", F.col("lap_number").cast("int"))
    starts = x.select("race_id", (F.col("race_id") % 30).alias("at")).distinct()
    return quality.flag_phases(messages, x, starts, "at").select("message_id", "phase", "is_lap_flagged")


@query("""SELECT 'overrides:applied:' || decision AS check_id, compared, matched, CASE WHEN matched = compared THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT 'D' || (o_orderkey % 6) AS decision, count(*) AS compared, count(*) FILTER (WHERE o_orderkey % 12 <> 5) AS matched FROM orders WHERE o_orderkey % 6 > 1 GROUP BY 1)""")
def q05_applied_rates(t):
    k = F.col("o_orderkey")
    lines = t.orders.where("o_orderkey % 6 > 1").select("o_orderkey", F.lit("status").alias("column_name"), F.when(k % 2 == 0, "set").otherwise("flag").alias("action"), F.concat(F.lit("D"), k % 6).alias("decision"))
    marked = F.when(k % 12 != 5, F.array(F.lit("status"), F.lit("points"))).otherwise(F.array(F.lit("points")))
    rows = t.orders.select("o_orderkey", F.when(k % 2 == 0, marked).otherwise(C.no_texts()).alias("overridden_columns"), F.when(k % 2 == 1, marked).otherwise(C.no_texts()).alias("disputed_columns"))
    return quality.scorecard([quality.applied_rates(lines, rows, ["o_orderkey"])]).select("check_id", "compared", "matched", "status")


# Consistency of the marts


@query(f"""WITH {RESULTS_SQL}, r AS (SELECT * FROM results WHERE {_R}), y AS (SELECT driver_id, min(season) AS a, max(season) AS b FROM r GROUP BY 1)
SELECT 'driver_season' AS model, driver_id, season FROM (SELECT DISTINCT driver_id, season FROM r WHERE driver_id IN ('d3', 'd5') AND season % 2 = 0) UNION ALL SELECT 'driver_career', driver_id, a FROM y WHERE driver_id = 'd4' UNION ALL SELECT 'driver_career', driver_id, a + 1 FROM y WHERE driver_id = 'd6'""")
def q08_coverage(t):
    r = results(t).where(_R)
    season = metrics.driver_season(r).where("not (driver_id in ('d3', 'd5') and season % 2 = 0)")
    moved = F.when(F.col("driver_id") == "d6", 1).otherwise(0)
    career = metrics.driver_career(r).withColumns({"first_season": F.col("first_season") + moved, "last_season": F.col("last_season") + F.when(F.col("driver_id") == "d4", 1).otherwise(0)})
    return quality.coverage_gaps(r, season, ["driver_id", "season"], "driver_season").unionByName(quality.wrong_ranges(r, career, "driver_id", "season", "first_season", "last_season", "driver_career").withColumnRenamed("first_season", "season"))


# Teams of two, so that a driver's season has one pair; seasons of every second driver are wrong in even years.
_PEERS_SQL = f"""{RESULTS_SQL}, two AS (SELECT * REPLACE (constructor_id || '-' || (CAST(substr(driver_id, 2) AS INT) // 8 % 2) AS driver_id) FROM results), best AS (SELECT race_id, season, constructor_id, driver_id, min(position_number) AS place, min(position_display_order) AS shown, sum(points) AS points FROM two WHERE {_R} GROUP BY ALL),
pairs AS (SELECT a.*, b.driver_id AS peer, b.points AS pp, row_number() OVER (PARTITION BY a.race_id, a.constructor_id, a.driver_id ORDER BY b.points DESC NULLS LAST, b.shown NULLS LAST, b.driver_id) AS rn FROM best a JOIN best b ON a.race_id = b.race_id AND a.season = b.season AND a.constructor_id = b.constructor_id AND a.driver_id <> b.driver_id),
h2h AS (SELECT season, driver_id, peer, constructor_id, count(*) AS races, sum(points) AS points, sum(pp) AS peer_points FROM pairs GROUP BY ALL), sum_ AS (SELECT season, driver_id, count(*) AS races, sum(points) + CASE WHEN ends_with(driver_id, '-1') AND season % 2 = 0 THEN 1000000 ELSE 0 END AS points, sum(pp) AS peer_points FROM pairs WHERE rn = 1 GROUP BY season, driver_id)"""


def _teams_of_two(t):
    seat = F.floor(F.substring("driver_id", 2, 9).cast("int") / 8) % 2
    return results(t).withColumn("driver_id", F.concat("constructor_id", F.lit("-"), seat))


def _season_of_peers(t):
    wrong = F.when(F.col("driver_id").endswith("-1") & (F.col("season") % 2 == 0), 1_000_000).otherwise(0)
    return metrics.versus_peers_season(metrics.versus_best_peer(_teams_of_two(t))).withColumn("points", F.col("points") + wrong)


@query(f"""WITH {_PEERS_SQL}, one AS (SELECT season, driver_id, any_value(races) AS races, any_value(points) AS points, any_value(peer_points) AS peer_points FROM h2h GROUP BY ALL HAVING count(*) = 1)
SELECT season, driver_id, o.races, s.races AS other_races, o.points, s.points AS other_points, o.peer_points, s.peer_points AS other_peer_points FROM one o LEFT JOIN sum_ s USING (season, driver_id) WHERE s.driver_id IS NULL OR abs(o.races - s.races) > 0.005 OR abs(o.points - s.points) > 0.005 OR abs(o.peer_points - s.peer_points) > 0.005""")
def q11_pairs_match_seasons(t):
    pairs = quality.single_pairs(metrics.head_to_head(_teams_of_two(t)), ["season", "driver_id"], "peer_driver_id", ["races", "points", "peer_points"])
    return quality.disagreements(pairs, _season_of_peers(t), ["season", "driver_id"], ["races", "points", "peer_points"])


@query(f"WITH {_PEERS_SQL}, w AS (SELECT season, driver_id, sum(points) AS whole FROM two GROUP BY ALL) SELECT season, driver_id, points, whole FROM sum_ LEFT JOIN w USING (season, driver_id) WHERE whole IS NULL OR points > whole + 0.005")
def q11_seasons_within_results(t):
    whole = _teams_of_two(t).groupBy("season", "driver_id").agg(F.sum("points").alias("points"))
    return quality.beyond(_season_of_peers(t), whole, ["season", "driver_id"], "points")


@query(f"WITH {RESULTS_SQL}, w AS (SELECT season, driver_id, sum(points) AS points FROM results GROUP BY ALL) SELECT season, driver_id, points, points + 1 AS other_points FROM w WHERE driver_id = 'd8' AND season > 1994")
def q11_standings_match_results(t):
    own = results(t).groupBy("season", "driver_id").agg(F.sum("points").alias("points"))
    official = own.withColumn("points", F.col("points") + F.when((F.col("driver_id") == "d8") & (F.col("season") > 1994), 1).otherwise(0))
    return quality.disagreements(own, official, ["season", "driver_id"], ["points"], 0.01, "inner")


@query("""WITH places AS (SELECT n_name AS name, r_name AS region, (SELECT count(*) FROM nation m WHERE m.n_regionkey = n.n_regionkey) AS nations FROM nation n JOIN region ON n_regionkey = r_regionkey),
cases(name, region, nations) AS (VALUES ('FRANCE', 'EUROPE', 5), ('JAPAN', 'ASIA', 5), ('KENYA', 'EUROPE', 5), ('PERU', 'AMERICA', 6), ('ATLANTIS', 'EUROPE', 5)),
cell AS (SELECT name, 'region' AS column_name, region AS expected FROM cases UNION ALL SELECT name, 'nations', CAST(nations AS VARCHAR) FROM cases), own AS (SELECT name, 'region' AS column_name, region AS actual FROM places UNION ALL SELECT name, 'nations', CAST(nations AS VARCHAR) FROM places)
SELECT name, column_name, expected, actual FROM cell LEFT JOIN own USING (name, column_name) WHERE expected IS DISTINCT FROM actual""")
def q12_reference_cases(t):
    size = Window.partitionBy("n_regionkey")
    places = t.nation.withColumn("nations", F.count("*").over(size)).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("name"), F.col("r_name").alias("region"), "nations")
    cases = [("FRANCE", "EUROPE", 5), ("JAPAN", "ASIA", 5), ("KENYA", "EUROPE", 5), ("PERU", "AMERICA", 6), ("ATLANTIS", "EUROPE", 5)]
    return quality.reference_cases(places, t.spark.createDataFrame(cases, "name string, region string, nations int"), ["name"])


@query(f"""WITH {RESULTS_SQL}, r AS (SELECT race_id, position_display_order AS k, CASE WHEN (race_id + position_display_order) % 50 = 0 THEN '3' ELSE position_text END AS txt, position_number AS num FROM results)
SELECT race_id, k, txt FROM r WHERE (CASE WHEN regexp_full_match(txt, '[0-9]+') THEN CAST(txt AS BIGINT) END) IS DISTINCT FROM num""")
def q14_texts_and_numbers(t):
    k = F.col("position_display_order")
    r = results(t).select("race_id", k.alias("k"), F.when((F.col("race_id") + k) % 50 == 0, "3").otherwise(F.col("position_text")).alias("txt"), F.col("position_number").alias("num"))
    return quality.text_contradicts_number(r, "txt", "num").drop("num")


@query("""SELECT 'order_totals' AS table_name, 'total' AS column_name, 'decimal(38,0)' AS type, (SELECT count(DISTINCT o_custkey) FROM orders) AS n UNION ALL SELECT 'part_sizes', 'span', 'decimal(25,2)', (SELECT count(*) FROM part)""")
def q18_wide_types(t):
    tables = {
        "order_totals": t.orders.groupBy("o_custkey").agg(F.sum(F.col("o_orderkey").cast("decimal(28,0)")).alias("total"), F.count("*").alias("n")), "part_sizes": t.part.select("p_partkey", F.col("p_size").cast("decimal(25,2)").alias("span")), "customers": t.customer.select("c_custkey", "c_name"),
    }
    out = None
    for name, df in tables.items():
        for column, kind in quality.wide_types(df):
            one = df.agg(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), F.lit(kind).alias("type"), F.count("*").alias("n"))
            out = one if out is None else out.unionByName(one)
    return out
