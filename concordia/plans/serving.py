"""Metrics, serving queries and statistics on the given tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.functions.names import name_contains
from concordia.operators import aggregates as A
from concordia.operators import metrics, sliced, stats
from concordia.operators import windows as W
from concordia.plans.base import RESULTS_SQL, cents, query, results

_STARTED = "session_type = 'RACE' AND position_text NOT IN ('DNQ', 'DNPQ', 'DNP', 'EX', 'DNS')"
_R = "session_type = 'RACE'"


@query(f"""WITH {RESULTS_SQL}, c AS (SELECT driver_id, count(DISTINCT race_id) FILTER (WHERE {_R}) AS entries, count(DISTINCT race_id) FILTER (WHERE {_STARTED}) AS starts, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins,
  count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number <= 3) AS podiums, count(DISTINCT race_id) FILTER (WHERE {_R} AND is_pole) AS poles, count(DISTINCT race_id) FILTER (WHERE {_R} AND is_fastest_lap) AS fastest_laps,
  count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1 AND is_pole AND is_fastest_lap) AS slams, sum(points) AS points, min(season) AS first_season, max(season) AS last_season FROM results GROUP BY 1)
SELECT * FROM c""")
def m01_driver_career(t):
    return metrics.driver_career(results(t)).drop("win_pct", "podium_pct")


@query(f"""WITH {RESULTS_SQL}, r AS (SELECT constructor_id, race_id, season, bool_or({_R} AND position_number = 1) AS won, bool_or({_R} AND position_number = 2) AS second, count(*) FILTER (WHERE {_R} AND position_number <= 3) AS cars, bool_or({_R}) AS raced, sum(points) AS points FROM results GROUP BY ALL)
SELECT constructor_id, count(*) FILTER (WHERE raced) AS entries, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE won AND second) AS one_twos, count(*) FILTER (WHERE cars > 0) AS podium_races, CAST(sum(cars) AS BIGINT) AS podiums, sum(points) AS points, sum(points) FILTER (WHERE season >= 1998) AS points_since_era FROM r GROUP BY 1""")
def m02_constructor_career(t):
    return metrics.constructor_career(results(t), 1998)


@query(f"""WITH {RESULTS_SQL}, tm AS (SELECT season, driver_id, constructor_id, count(DISTINCT race_id) FILTER (WHERE {_R}) AS n, sum(points) AS p FROM results GROUP BY ALL), main AS (SELECT *, row_number() OVER (PARTITION BY season, driver_id ORDER BY n DESC, p DESC, constructor_id) AS rn FROM tm),
s AS (SELECT season, driver_id, count(DISTINCT race_id) FILTER (WHERE {_R}) AS entries, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins, sum(points) AS points, count(DISTINCT constructor_id) AS teams, min(position_number) FILTER (WHERE {_R}) AS best FROM results GROUP BY ALL)
SELECT s.*, main.constructor_id AS main_team FROM s JOIN main USING (season, driver_id) WHERE rn = 1""")
def m03_driver_season(t):
    return metrics.driver_season(results(t))


_BEST = f"best AS (SELECT race_id, season, constructor_id, driver_id, min(position_number) AS place, min(position_display_order) AS shown, sum(points) AS points FROM results WHERE {_R} GROUP BY ALL)"


@query(f"""WITH {RESULTS_SQL}, {_BEST} SELECT a.season, a.constructor_id, a.driver_id, b.driver_id AS peer_driver_id, count(*) AS races, count(*) FILTER (WHERE a.place IS NOT NULL AND b.place IS NOT NULL) AS duels,
  count(*) FILTER (WHERE a.place < b.place) AS won, count(*) FILTER (WHERE a.place > b.place) AS lost, sum(a.points) AS points, sum(b.points) AS peer_points FROM best a JOIN best b ON a.race_id = b.race_id AND a.season = b.season AND a.constructor_id = b.constructor_id AND a.driver_id <> b.driver_id GROUP BY ALL""")
def m04_head_to_head(t):
    return metrics.head_to_head(results(t)).drop("won_pct")


_PEER = f"""{_BEST}, pairs AS (SELECT a.*, b.driver_id AS peer_driver_id, b.place AS peer_place, b.points AS peer_points, count(*) OVER (PARTITION BY a.race_id, a.constructor_id, a.driver_id) AS peers, row_number() OVER (PARTITION BY a.race_id, a.constructor_id, a.driver_id ORDER BY b.points DESC NULLS LAST, b.shown NULLS LAST, b.driver_id) AS rn
  FROM best a JOIN best b ON a.race_id = b.race_id AND a.season = b.season AND a.constructor_id = b.constructor_id AND a.driver_id <> b.driver_id),
  peer AS (SELECT *, CASE WHEN place IS NOT NULL AND peer_place IS NOT NULL THEN place < peer_place END AS is_ahead FROM pairs WHERE rn = 1)"""


@query(f"WITH {RESULTS_SQL}, {_PEER} SELECT race_id, constructor_id, driver_id, peer_driver_id, peers, is_ahead FROM peer")
def m05_versus_best_peer(t):
    return metrics.versus_best_peer(results(t)).select("race_id", "constructor_id", "driver_id", "peer_driver_id", "peers", "is_ahead")


@query(f"WITH {RESULTS_SQL}, {_PEER} SELECT season, driver_id, count(*) AS races, count(is_ahead) AS duels, count(*) FILTER (WHERE is_ahead) AS ahead, sum(points) AS points, sum(peer_points) AS peer_points FROM peer GROUP BY ALL")
def m06_versus_peers_season(t):
    return metrics.versus_peers_season(metrics.versus_best_peer(results(t)))


# Serving queries


@query(f"""WITH {RESULTS_SQL}, p AS (SELECT season, driver_id, sum(points) AS points FROM results GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, driver_id) AS rn FROM p)
SELECT r.season, count(DISTINCT race_id) AS races, any_value(c.driver_id) AS champion FROM results r JOIN c ON c.season = r.season AND rn = 1 GROUP BY r.season""")
def e01_seasons(t):
    r = results(t)
    champion = W.pick_first(r.groupBy("season", "driver_id").agg(F.sum("points").alias("points")), ["season"], [F.desc("points"), "driver_id"])
    named = champion.select("season", F.struct(F.col("driver_id").alias("id"), "points").alias("who"))
    return r.groupBy("season").agg(F.count_distinct("race_id").alias("races")).join(named, "season").select("season", "races", F.col("who.id").alias("champion"))


@query(f"""WITH {RESULTS_SQL}, w AS (SELECT race_id, driver_id, row_number() OVER (PARTITION BY race_id ORDER BY position_display_order, driver_id) AS rn FROM results WHERE {_R} AND position_number = 1)
SELECT o_orderkey AS race_id, driver_id AS winner FROM orders LEFT JOIN w ON race_id = o_orderkey AND rn = 1 WHERE year(o_orderdate) = 1999""")
def e02_e06_calendar_with_winners(t):
    wins = results(t).where("session_type = 'RACE' and position_number = 1")
    win = W.pick_first(wins, ["race_id"], ["position_display_order", "driver_id"]).select("race_id", F.col("driver_id").alias("winner"))
    return t.orders.where(F.year("o_orderdate") == 1999).select(F.col("o_orderkey").alias("race_id")).join(win, "race_id", "left")


@query(f"""WITH {RESULTS_SQL} SELECT season, driver_id, sum(points) AS points, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins, array_to_string(list_sort(list(DISTINCT constructor_id)), ',') AS teams, rank() OVER (PARTITION BY season ORDER BY sum(points) DESC) AS place FROM results GROUP BY season, driver_id""")
def e03_e04_standings_after(t):
    """After the last round of every season."""
    win = (F.col("session_type") == "RACE") & (F.col("position_number") == 1)
    by_race = results(t).groupBy("season", "driver_id", "race_id").agg(F.sum("points").alias("points"), F.bool_or(win).alias("won"), F.collect_set("constructor_id").alias("teams"))
    out = by_race.groupBy("season", "driver_id").agg(F.sum("points").alias("points"), A.count_where(F.col("won")).alias("wins"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("teams")))), ",").alias("teams"))
    return sliced.ranks(out, ["season"], ["-points"], "place").withColumn("place", F.col("place").cast("int"))


@query(f"""WITH {RESULTS_SQL}, d AS (SELECT r.*, CAST(month(o_orderdate) AS INT) AS month FROM results r JOIN orders ON race_id = o_orderkey), months AS (SELECT DISTINCT season, month FROM d)
SELECT m.season, m.month, driver_id, sum(points) AS points, count(DISTINCT race_id) FILTER (WHERE {_R} AND position_number = 1) AS wins, array_to_string(list_sort(list(DISTINCT constructor_id)), ',') AS teams, rank() OVER (PARTITION BY m.season, m.month ORDER BY sum(points) DESC) AS place
FROM months m JOIN d ON d.season = m.season AND d.month <= m.month GROUP BY m.season, m.month, driver_id""")
def e03_e04_standings_by_month(t):
    day = t.orders.select(F.col("o_orderkey").alias("race_id"), F.month("o_orderdate").alias("month"))
    return metrics.standings_after_rounds(results(t).join(day, "race_id"), "month")


@query(f"""WITH {RESULTS_SQL}, y AS (SELECT season, driver_id, sum(points) AS points FROM results GROUP BY ALL), c AS (SELECT season, driver_id, sum(points) OVER (PARTITION BY driver_id ORDER BY season) AS total FROM y),
top AS (SELECT driver_id FROM c WHERE season = (SELECT max(season) FROM c) ORDER BY total DESC NULLS LAST, driver_id LIMIT 8) SELECT season, driver_id, total FROM c WHERE driver_id IN (SELECT driver_id FROM top)""")
def e05_w16_progression(t):
    y = results(t).groupBy("season", "driver_id").agg(F.sum("points").alias("points"))
    c = W.running_sum(y, ["driver_id"], ["season"], F.col("points"), "total")
    return W.leaders_history(c, "driver_id", "season", "total", 8).select("season", "driver_id", "total")


@query(f"""WITH {RESULTS_SQL} SELECT race_id, driver_id, position_text, points FROM results WHERE {_R}""")
def p07_p13_race_rows(t):
    wanted = {"race_id": None, "session_type": "RACE", "driver_id": None}
    test = F.lit(True)
    for c, w in wanted.items():
        test = test & C.in_optional(c, w)
    return results(t).where(test).select("race_id", "driver_id", "position_text", "points").orderBy(F.asc_nulls_last("position_text"), "driver_id")


@query("""SELECT user_id, stint, min(event_type) AS kind, count(*) AS n, min(nth) AS first_step, max(nth) AS last_step FROM (SELECT *, CAST(1 + sum(CASE WHEN event_type <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY nth) AS BIGINT) AS stint FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)) GROUP BY ALL""")
def e10_stints(t):
    order = ["ts", "event_id"]
    e = W.sequence_number(t.events, ["user_id"], order, "nth").withColumn("prev", W.previous(F.col("event_type"), ["user_id"], order))
    e = W.islands(e, ["user_id"], order, F.col("event_type") != F.col("prev"), "island")
    return e.groupBy("user_id", (F.col("island") + 1).alias("stint")).agg(F.min("event_type").alias("kind"), F.count("*").alias("n"), F.min("nth").alias("first_step"), F.max("nth").alias("last_step"))


@query("""SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('error', 'signup')""")
def e12_optional_filters(t):
    kinds, user, flag = ["error", "signup"], None, None
    return t.events.where(C.in_optional("event_type", kinds) & C.in_optional("user_id", user) & C.in_optional("props", flag)).select("event_id", "user_id", "event_type", "value").orderBy("ts", "event_id")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sample, CAST(list_position([9, 3, 14], user_id) AS INT) AS asked FROM events")
def e13_traces(t):
    """Every user's samples in order; the place of users that were asked for."""
    asked = F.array(*[F.lit(i).cast("long") for i in (9, 3, 14)])
    place = F.nullif(F.array_position(asked, F.col("user_id")), F.lit(0)).cast("int")
    return W.sequence_number(t.events, ["user_id"], ["ts", "event_id"], "sample").select("user_id", "event_id", "sample", place.alias("asked"))


@query("SELECT c_custkey, c_name, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders FROM customer WHERE contains(lower(c_name), 'customer') ORDER BY c_custkey LIMIT 50 OFFSET 100")
def e14_e16_search(t):
    page = W.top(t.customer.where(name_contains("c_name", "Cústomer")), [F.col("c_custkey")], 50, 100).select("c_custkey", "c_name")
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return page.join(n, "c_custkey", "left").select("c_custkey", "c_name", F.coalesce("n", F.lit(0).cast("long")).alias("orders"))


@query(f"""WITH {RESULTS_SQL}, {_PEER} SELECT season, driver_id, array_to_string(list_sort(list(DISTINCT peer_driver_id || ':' || constructor_id)), ',') AS mates FROM peer GROUP BY ALL""")
def e15_teammates(t):
    p = metrics.versus_best_peer(results(t))
    mates = F.array_sort(F.collect_set(F.struct(F.col("peer_driver_id").alias("id"), F.col("constructor_id").alias("team"))))
    return p.groupBy("season", "driver_id").agg(F.array_join(F.array_sort(F.transform(mates, lambda m: F.concat(m.id, F.lit(":"), m.team))), ",").alias("mates"))


@query(f"""WITH {RESULTS_SQL} SELECT driver_id, wins, rank() OVER (ORDER BY wins DESC) AS place FROM (SELECT driver_id, count(DISTINCT race_id) AS wins FROM results WHERE {_R} AND position_number = 1 AND season BETWEEN 1990 AND 2010 GROUP BY 1 ORDER BY wins DESC, driver_id LIMIT 15)""")
def e17_e18_records(t):
    r = results(t).where("session_type = 'RACE' and position_number = 1 and season between 1990 and 2010")
    top = W.top(r.groupBy("driver_id").agg(F.count_distinct("race_id").alias("wins")), [F.desc_nulls_last("wins"), F.col("driver_id")], 15)
    return top.withColumn("place", F.rank().over(Window.orderBy(F.desc("wins"))))


@query("""SELECT n_name, count(*) AS n, count(DISTINCT year(o_orderdate)) AS years, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day, array_to_string(list_sort(list(DISTINCT c_mktsegment)), ',') AS segments
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def e19_e20_places(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    n = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t.orders.join(c, "o_custkey").join(F.broadcast(n) if n.count() <= 1000 else n, "c_nationkey").groupBy("n_name").agg(F.count("*").alias("n"), F.count_distinct(F.year("o_orderdate")).alias("years"), F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"), F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"))


# Statistics


@query("""WITH u AS (SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, l_quantity AS v FROM lineitem WHERE l_linenumber > 1 AND l_returnflag <> 'R'), m AS (SELECT l_suppkey AS k, median(v) AS m FROM u GROUP BY 1) SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber FROM u JOIN m ON k = l_suppkey WHERE v <= 1.5 * m""")
def v01_representative(t):
    return stats.representative(t.lineitem, ["l_suppkey"], "l_quantity", "l_linenumber", F.col("l_returnflag") == "R").select("l_suppkey", "l_orderkey", "l_partkey", "l_linenumber")


@query("""WITH q AS (SELECT l_suppkey AS k, count(*) AS n, quantile_cont(l_quantity, 0.25) AS q1, median(l_quantity) AS median, quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem GROUP BY 1 HAVING count(*) >= 5)
SELECT k AS l_suppkey, n, q1, median, q3, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem JOIN q ON l_suppkey = k WHERE l_quantity BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""")
def v02_box(t):
    return stats.box(t.lineitem, ["l_suppkey"], "l_quantity")


@query("""WITH s AS (SELECT l_returnflag AS k, count(*) AS n, greatest(1.06 * stddev(l_quantity) * pow(count(*), -0.2), 2.0) AS h, min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1),
g AS (SELECT k, n, h, i, lo + i * (hi - lo) / 59 AS x FROM s, range(60) r(i)) SELECT k AS l_returnflag, CAST(i AS INT) AS point, CAST(round(1e6 * sum(exp(-0.5 * ((x - l_quantity) / h) ** 2)) / (any_value(n) * any_value(h) * 2.5066282746310002)) AS BIGINT) AS millionths FROM g JOIN lineitem ON l_returnflag = k GROUP BY k, i""")
def v03_density(t):
    return stats.density(t.lineitem, ["l_returnflag"], "l_quantity", least_width=2.0).select("l_returnflag", "point", F.round(F.col("density") * 1e6).cast("long").alias("millionths"))


@query("""SELECT l_orderkey, array_to_string([coalesce(CAST(m[CAST(i AS INT)] AS VARCHAR), '-') FOR i IN range(1, 8)], ',') AS series FROM (SELECT l_orderkey, map_from_entries(list((l_linenumber, q))) AS m FROM (SELECT l_orderkey, l_linenumber, min(CAST(l_quantity AS INT)) AS q FROM lineitem GROUP BY ALL) GROUP BY 1)""")
def v04_dense_series(t):
    q = t.lineitem.withColumn("q", F.col("l_quantity").cast("int"))
    return stats.dense_series(q, ["l_orderkey"], "l_linenumber", "q", 7).select("l_orderkey", F.array_join("q", ",", "-").alias("series"))


@query("""SELECT l_orderkey, count(*) FILTER (WHERE p = 1) AS led, min(p) AS best, arg_min(p, l_linenumber) AS first_position, arg_max(p, l_linenumber) AS last_position FROM (SELECT l_orderkey, l_linenumber, min(CAST(l_suppkey % 5 + 1 AS INT)) AS p FROM lineitem GROUP BY ALL) GROUP BY 1""")
def v05_led(t):
    p = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min((F.col("l_suppkey") % 5 + 1).cast("int")).alias("p"))
    return stats.led(p, ["l_orderkey"], "p", "l_linenumber")


@query("SELECT user_id, max(value) AS top, min(value) AS low, 100.0 * CAST(count(*) FILTER (WHERE value >= 20) AS DOUBLE) / count(*) AS full_pct FROM events GROUP BY 1")
def v06_trace_summary(t):
    return stats.trace_summary(t.events, ["user_id"], "value", "value", 20)


@query("SELECT o_orderpriority, " + ", ".join(f"count(*) FILTER (WHERE year(o_orderdate) = {y}) AS y{y}" for y in range(1995, 2002)) + " FROM orders GROUP BY 1")
def v07_progression(t):
    n = t.orders.groupBy("o_orderpriority", F.concat(F.lit("y"), F.year("o_orderdate")).alias("y")).agg(F.count("*").alias("n"))
    return stats.progression(n, "o_orderpriority", "y", "n", [f"y{y}" for y in range(1995, 2002)])


@query("SELECT CAST(year(o_orderdate) // 10 * 10 AS INT) AS decade, count(*) AS n, CAST(sum(o_orderkey % 7) AS BIGINT) AS total, arg_min(o_orderkey, (CAST(round(o_totalprice * 100) AS BIGINT), o_orderkey)) AS cheapest FROM orders GROUP BY 1")
def v08_v09_decade_totals(t):
    return t.orders.groupBy(stats.decade(F.year("o_orderdate")).alias("decade")).agg(F.count("*").alias("n"), F.sum(F.col("o_orderkey") % 7).alias("total"), F.min_by("o_orderkey", F.struct(cents("o_totalprice"), "o_orderkey")).alias("cheapest"))
