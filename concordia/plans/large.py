"""Operators for keys that hold most rows, and for null keys, on the given tables."""

from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.operators import codes, fusion, sliced, stats, windows
from concordia.operators import joins as J
from concordia.plans.base import LAPS_SQL, RESULTS_SQL, cents, laps, query, results
from concordia.sources import merge

# Keys that hold a half or a fifth of all rows


@query("""WITH s AS (SELECT event_id AS span_id, event_id % 2 AS g, ts AS a, ts + to_seconds(floor(value * 10)) AS b FROM events WHERE event_type = 'signup')
SELECT e.event_id, span_id FROM events e JOIN s ON e.event_id % 2 = g AND ts >= a AND ts <= b WHERE event_type = 'click'""")
def j08_r08_intervals_of_hot_keys(t):
    e = t.events.withColumn("g", F.col("event_id") % 2)
    spans = e.where("event_type = 'signup'").select("g", F.col("event_id").alias("span_id"), F.col("ts").alias("a"), (F.col("ts") + F.make_dt_interval(secs=F.floor(F.col("value") * 10))).alias("b"))
    return J.interval_join(e.where("event_type = 'click'").select("g", "event_id", "ts"), spans, ["g"], "ts", "a", "b").select("event_id", "span_id")


@query("""WITH r AS (SELECT event_id % 2 AS g, date_trunc('hour', ts) AS at, max(event_id) AS last_id FROM events WHERE event_type <> 'purchase' GROUP BY ALL)
SELECT p.event_id, r.last_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN r ON p.event_id % 2 = r.g AND p.ts + INTERVAL 10 MINUTE >= r.at""")
def j07_asof_of_hot_keys(t):
    """Many right rows have one time, to the hour: the largest id counts."""
    e = t.events.withColumn("g", F.col("event_id") % 2)
    right = e.where("event_type <> 'purchase'").select("g", F.date_trunc("hour", "ts").alias("at"), F.col("event_id").alias("last_id"))
    left = e.where("event_type = 'purchase'").select("g", "ts", "event_id")
    return sliced.asof_join(left, right, ["g"], "ts", "at", ["last_id"], F.expr("interval 10 minutes")).select("event_id", "last_id")


@query("SELECT event_id, CAST(sum(event_id % 100) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM events")
def w08_w09_running_of_hot_keys(t):
    e = t.events.select("event_id", "event_type", "ts", (F.col("event_id") % 100).alias("v"))
    summed = sliced.running_sum(e, ["event_type"], ["ts", "event_id"], "v", "running")
    return sliced.row_numbers(summed, ["event_type"], ["ts", "event_id"], "nth").select("event_id", "running", "nth")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, rank() OVER w AS place, dense_rank() OVER w AS dense_place, row_number() OVER (w2) AS nth FROM lineitem
WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_quantity DESC), w2 AS (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)""")
def w07_w18_ranks_of_hot_keys(t):
    ranked = sliced.ranks(t.lineitem, ["l_returnflag"], ["-l_quantity"], "place", "dense_place")
    order = ["-l_quantity", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return sliced.row_numbers(ranked, ["l_returnflag"], order, "nth").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "place", "dense_place", "nth")


@query(f"""WITH {RESULTS_SQL}, y AS (SELECT season, driver_id, count(DISTINCT race_id) FILTER (WHERE session_type = 'RACE' AND position_number = 1) AS wins FROM results GROUP BY ALL)
SELECT season, driver_id, wins, rank() OVER (ORDER BY wins DESC) AS place, rank() OVER (PARTITION BY season ORDER BY wins DESC) AS season_place FROM y""")
def e17_w07_records_of_all_seasons(t):
    """One ranking over all seasons of all drivers, and one by season."""
    won = F.when((F.col("session_type") == "RACE") & (F.col("position_number") == 1), F.col("race_id"))
    y = results(t).groupBy("season", "driver_id").agg(F.count_distinct(won).alias("wins"))
    return sliced.ranks(sliced.ranks(y, [], ["-wins"], "place"), ["season"], ["-wins"], "season_place")


@query("""SELECT l_returnflag, count(*) AS n, round(quantile_cont(c, 0.5), 3) AS q50, round(quantile_cont(c, 0.9), 3) AS q90, round(quantile_cont(c, 0.99), 3) AS q99
FROM (SELECT l_returnflag, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS DOUBLE) AS c FROM lineitem) GROUP BY 1""")
def a11_quantiles_of_hot_keys(t):
    q = stats.exact_quantiles(t.lineitem.withColumn("c", cents("l_extendedprice")), ["l_returnflag"], "c", {"q50": 0.5, "q90": 0.9, "q99": 0.99})
    return q.select("l_returnflag", "n", *[F.round(c, 3).alias(c) for c in ("q50", "q90", "q99")])


@query("""WITH u AS (SELECT o_orderpriority AS p, o_orderkey AS rule, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS m1, CASE WHEN o_orderkey % 3 <> 1 THEN o_orderstatus END AS m2 FROM orders WHERE o_orderkey % 4 = 0),
f AS (SELECT o_orderkey, rule, row_number() OVER (PARTITION BY o_orderkey ORDER BY rule) AS rn FROM orders JOIN u ON o_orderpriority = p AND (m1 IS NULL OR m1 = o_custkey) AND (m2 IS NULL OR m2 = o_orderstatus))
SELECT o_orderkey, rule FROM orders LEFT JOIN (SELECT o_orderkey AS k, rule FROM f WHERE rn = 1) ON k = o_orderkey""")
def j17_many_rules_of_a_key(t):
    """A quarter of all orders are rules, under five keys."""
    o, k = t.orders, F.col("o_orderkey")
    rules = o.where("o_orderkey % 4 = 0").select("o_orderpriority", k.alias("rule"), F.when(k % 3 != 0, F.col("o_custkey")).alias("m1"), F.when(k % 3 != 1, F.col("o_orderstatus")).alias("m2"))
    return J.wildcard_rules(o, rules, ["o_orderpriority"], {"m1": "o_custkey", "m2": "o_orderstatus"}, ["rule"]).select("o_orderkey", "rule")


# Null keys: rows stay, as under the windows that these operators replace

_FLAG = "CASE WHEN l_orderkey % 5 <> 0 THEN l_returnflag END"


@query(f"""WITH x AS (SELECT l_orderkey % 50 AS g, {_FLAG} AS flag, CASE WHEN l_orderkey % 7 <> 0 THEN l_linestatus || l_linenumber END AS v, count(*) AS rows FROM lineitem GROUP BY ALL),
n AS (SELECT g, flag, count(DISTINCT v) AS statuses FROM x GROUP BY ALL) SELECT x.g, x.flag, x.v, rows, CAST(statuses AS INT) AS statuses FROM x JOIN n ON x.g IS NOT DISTINCT FROM n.g AND x.flag IS NOT DISTINCT FROM n.flag""")
def w11_null_keys(t):
    k = F.col("l_orderkey")
    x = t.lineitem.groupBy((k % 50).alias("g"), F.when(k % 5 != 0, F.col("l_returnflag")).alias("flag"), F.when(k % 7 != 0, F.concat("l_linestatus", "l_linenumber")).alias("v")).agg(F.count("*").alias("rows"))
    return windows.distinct_count_over(x, ["g", "flag"], "v", "statuses").select("g", "flag", "v", "rows", "statuses")


@query("""WITH x AS (SELECT DISTINCT l_orderkey AS g, CASE WHEN l_suppkey % 6 <> 0 THEN l_suppkey % 12 END AS e, CASE WHEN l_linenumber <> 3 THEN CAST(l_linenumber AS VARCHAR) END AS u FROM lineitem),
n AS (SELECT g, e, count(DISTINCT u) + max(CAST(u IS NULL AS INT)) AS k FROM x GROUP BY ALL), r AS (SELECT l_orderkey AS g, CASE WHEN l_suppkey % 6 <> 0 THEN l_suppkey % 12 END AS e, CAST(l_linenumber AS VARCHAR) AS u, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem WHERE l_linenumber <> 2),
ex AS (SELECT g, e, u, min(c) AS c FROM r GROUP BY ALL), an AS (SELECT g, e, min(c) AS c FROM r GROUP BY ALL)
SELECT x.g AS l_orderkey, CASE WHEN k > 1 AND x.u IS NOT NULL THEN x.e || '_' || x.u ELSE CAST(x.e AS VARCHAR) END AS unit_key, x.u AS unit, CASE WHEN x.u IS NULL OR (ex.c IS NULL AND k = 1) THEN an.c ELSE ex.c END AS result
FROM x JOIN n ON n.g = x.g AND n.e IS NOT DISTINCT FROM x.e LEFT JOIN ex ON ex.g = x.g AND ex.e IS NOT DISTINCT FROM x.e AND ex.u = x.u LEFT JOIN an ON an.g = x.g AND an.e IS NOT DISTINCT FROM x.e""")
def r37_unit_results(t):
    k = F.col("l_suppkey")
    unit = F.col("l_linenumber").cast("string")
    rows = t.lineitem.select("l_orderkey", F.when(k % 6 != 0, k % 12).alias("e"), F.when(F.col("l_linenumber") != 3, unit).alias("unit"))
    found = t.lineitem.where("l_linenumber <> 2").select("l_orderkey", F.when(k % 6 != 0, k % 12).alias("e"), unit.alias("unit"), cents("l_extendedprice").alias("result"))
    return codes.unit_results(rows, found, ["l_orderkey"], "e", "unit", ["result"], ["result"]).select("l_orderkey", "unit_key", "unit", "result")


@query(f"""WITH {LAPS_SQL}, x AS (SELECT CASE WHEN race_id % 11 <> 0 THEN race_id END AS race_id, driver_id, CASE WHEN lap_number <> 5 THEN lap_number END AS lap_number, lap_time_ms, race_id % 10 = 1 AND place = 2 AS red FROM laps),
m AS (SELECT race_id, median(lap_time_ms) AS m FROM x GROUP BY 1), z AS (SELECT x.*, lap_time_ms > greatest(400000, 3 * m) AS is_long FROM x JOIN m ON x.race_id IS NOT DISTINCT FROM m.race_id),
y AS (SELECT race_id, lap_number, count(*) FILTER (WHERE is_long) AS n, bool_or(red) AS f FROM z GROUP BY ALL)
SELECT z.race_id, driver_id, z.lap_number, lap_time_ms, coalesce(red OR is_long AND (n >= 3 OR EXISTS (SELECT 1 FROM y q WHERE q.race_id = z.race_id AND q.f AND q.lap_number BETWEEN z.lap_number - 3 AND z.lap_number)), red) AS is_red_flag
FROM z LEFT JOIN y ON y.race_id = z.race_id AND y.lap_number = z.lap_number""")
def r16_laps_without_race_or_number(t):
    x = laps(t).withColumns({"is_red_flag": (F.col("race_id") % 10 == 1) & (F.col("place") == 2), "corrections": C.no_texts()})
    x = x.withColumns({"race_id": F.when(F.col("race_id") % 11 != 0, F.col("race_id")), "lap_number": F.when(F.col("lap_number") != 5, F.col("lap_number"))})
    return fusion.flag_suspensions(x).select("race_id", "driver_id", "lap_number", "lap_time_ms", "is_red_flag")


_FEEDS = """o AS (SELECT o_orderkey, CASE WHEN o_custkey % 50 <> 7 THEN o_custkey % 50 END AS part FROM orders), bulk AS (SELECT * FROM o WHERE o_orderkey % 10 <> 0 OR part < 5), delta AS (SELECT * FROM o WHERE o_orderkey % 10 <> 1), prev AS (SELECT * FROM o WHERE part % 3 = 0 AND part <> 9),
e AS (SELECT part, count(*) AS expected FROM o GROUP BY 1), nb AS (SELECT part, count(*) AS n FROM bulk GROUP BY 1), nd AS (SELECT part, count(*) AS n FROM delta GROUP BY 1), np AS (SELECT part, count(*) AS n FROM prev GROUP BY 1),
w AS (SELECT e.part, expected, coalesce(nb.n, 0) AS b, coalesce(nd.n, 0) AS d, coalesce(np.n, 0) AS p, CASE WHEN coalesce(nb.n, 0) >= 0.95 * expected THEN 'bulk' WHEN coalesce(nd.n, 0) > coalesce(nb.n, 0) THEN 'delta' ELSE 'bulk' END AS own
  FROM e LEFT JOIN nb ON nb.part IS NOT DISTINCT FROM e.part LEFT JOIN nd ON nd.part IS NOT DISTINCT FROM e.part LEFT JOIN np ON np.part IS NOT DISTINCT FROM e.part),
x AS (SELECT *, CASE WHEN CASE own WHEN 'bulk' THEN b ELSE d END < p THEN 'previous' ELSE own END AS origin FROM w), z AS (SELECT *, CASE origin WHEN 'bulk' THEN b WHEN 'delta' THEN d ELSE p END AS rows FROM x)"""


def _feeds(t):
    part = F.col("o_custkey") % 50
    o = t.orders.select("o_orderkey", F.when(part != 7, part).alias("part"), "o_custkey")
    return o, o.where("o_orderkey % 10 <> 0 or part < 5"), o.where("o_orderkey % 10 <> 1"), o.where("part % 3 = 0 and part <> 9")


@query(f"""WITH {_FEEDS} SELECT part, expected, b AS bulk_rows, d AS delta_rows, p AS previous_rows, rows, origin, CASE WHEN rows < 0.95 * expected THEN 'gap' WHEN p = 0 THEN 'new' WHEN rows > p THEN 'grown' ELSE 'kept' END AS action FROM z""")
def r31_merge_log(t):
    """One partition is null."""
    o, bulk, delta, previous = _feeds(t)
    expected = o.groupBy("part").agg(F.count("*").alias("expected"))
    merged = merge.merge_by_coverage(bulk, delta, expected, ["part"], "expected", previous)
    log = merge.merge_log(bulk, delta, expected, ["part"], "expected", previous, merged)
    counts = ["bulk_rows", "delta_rows", "previous_rows"]
    return log.select("part", "expected", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "rows", "origin", "action")


@query("""WITH d AS (SELECT c_custkey AS k, 'bulk' AS origin, c_nationkey AS nation FROM customer WHERE c_custkey % 5 <> 0), f AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT k AS o_custkey, origin, nation, 'member' AS kind FROM d UNION ALL SELECT c_custkey, 'api', c_nationkey, 'member' FROM customer JOIN f ON f.k = c_custkey WHERE c_custkey % 5 = 0 AND c_custkey % 10 <> 0
UNION ALL SELECT f.k, NULL, NULL, 'unknown' FROM f WHERE k NOT IN (SELECT k FROM d) AND k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)""")
def r31_new_members(t):
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    bulk = c.where("o_custkey % 5 <> 0").select("o_custkey", F.lit("bulk").alias("origin"), "nation")
    feed = c.where("o_custkey % 10 <> 0").withColumn("origin", F.lit("api"))
    whole, unknown = merge.with_new_members(bulk, [t.orders.where("o_orderkey % 2 = 0"), t.orders.where("o_orderkey % 2 = 1")], feed, "o_custkey")
    both = whole.withColumn("kind", F.lit("member")).unionByName(unknown.withColumn("kind", F.lit("unknown")), allowMissingColumns=True)
    return both.select("o_custkey", "origin", "nation", "kind")
