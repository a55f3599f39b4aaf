"""Landed feeds to staging, and nested documents to rows, on feeds that are written from the given tables."""

from pyspark.sql import functions as F

from concordia.functions.names import name_contains
from concordia.operators import aggregates as A
from concordia.operators import marts, quality
from concordia.plans.base import RESULTS_SQL, query, results
from concordia.sources import flatten, merge, staging

# Plain projections: every source column of a table is text that depends on the row and the column's place.

_TEXT = "CASE (k + {j}) % 5 WHEN 0 THEN NULL WHEN 1 THEN 'x' || (k % 90) ELSE CAST((k * 7 + {j}) % 2 AS VARCHAR) END"
_NONE = "'-'"
_AS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "string": "VARCHAR"}


def _stamp(kind: str | None) -> bool:
    return kind in ("date", "timestamp")


def _expected(feed: str, table: str) -> str:
    cells = []
    for j, (_, kind, present, _) in enumerate(staging.projection(feed, table)):
        raw = f"CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN 'soon' ELSE '2024-01-' || lpad(CAST(1 + k % 28 AS VARCHAR), 2, '0') END" if _stamp(kind) else _TEXT.format(j=j)
        cells.append(f"CAST({raw} IS NOT NULL AS VARCHAR)" if present else f"CAST(try_cast({raw} AS {_AS[kind]}) AS VARCHAR)" if kind else raw)
    return f"SELECT '{table}' AS model, k, concat_ws('|', {', '.join(f'coalesce({c}, {_NONE})' for c in cells)}) AS cells FROM o"


def _landed(t, feed: str):
    k = F.col("o_orderkey")
    out = None
    for table in staging.PROJECTIONS[feed]:
        columns = []
        for j, (source, kind, _, _) in enumerate(staging.projection(feed, table)):
            if _stamp(kind):
                raw = F.when(k % 3 == 1, "soon").when(k % 3 == 2, F.concat(F.lit("2024-01-"), F.lpad((1 + k % 28).cast("string"), 2, "0")))
            else:
                raw = F.when((k + j) % 5 == 1, F.concat(F.lit("x"), k % 90)).when((k + j) % 5 > 1, ((k * 7 + j) % 2).cast("string"))
            columns.append(raw.alias(source))
        staged = staging.project(t.orders.select(*columns), feed, table)
        cells = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in staged.columns])
        one = staged.select(F.lit(table).alias("model"), cells.alias("cells"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("model", "cells").agg(F.count("*").alias("n"))


def _register(feed: str) -> None:
    sql = f"WITH o AS (SELECT o_orderkey AS k FROM orders), rows_ AS ({' UNION ALL '.join(_expected(feed, table) for table in staging.PROJECTIONS[feed])}) SELECT model, cells, count(*) AS n FROM rows_ GROUP BY model, cells"

    def run(t):
        return _landed(t, feed)

    run.__name__ = f"p01_staging_of_{feed}"
    query(sql)(run)


for _feed in staging.PROJECTIONS:
    _register(_feed)


@query("""SELECT o_orderkey AS session_key, CAST(o_custkey AS INT) AS driver_number, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey % 60 AS INT) END AS position, o_orderkey % 3 = 0 AS is_dnf, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 5000 * 1000 + 500 END AS time_ms FROM orders""")
def p01_staging_of_event_results(t):
    k = F.col("o_orderkey")
    place = F.when(k % 4 == 0, '"RT"').otherwise(F.concat(F.lit('"'), (k % 60).cast("string"), F.lit('.0"')))
    taken = F.when(k % 2 == 0, F.concat((k % 5000).cast("string"), F.lit(".5"))).otherwise("[1, 2]")
    raw = t.orders.select(k.alias("session_key"), F.col("o_custkey").alias("driver_number"), place.alias("position"), F.lit(5).cast("long").alias("number_of_laps"), F.when(k % 3 == 0, True).alias("dnf"), F.lit(None).cast("boolean").alias("dns"), F.lit(False).alias("dsq"), taken.alias("duration"), F.lit("+1 LAP").alias("gap_to_leader"), F.lit(1.0).alias("points"))
    return staging.event_results(raw).select("session_key", "driver_number", "position", "is_dnf", "time_ms")


@query("""SELECT o_orderkey AS session_key, CAST(o_orderdate + to_hours(CASE WHEN o_orderkey % 2 = 0 THEN 3 ELSE -8 END) + INTERVAL 22 HOUR AS DATE) AS local_date, o_orderkey % 9 = 0 AS is_cancelled, CAST(year(o_orderdate) AS INT) AS season FROM orders""")
def p01_staging_of_event_sessions(t):
    k = F.col("o_orderkey")
    start = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T22:00:00+00:00"))
    text = lambda v: F.lit(v)
    raw = t.orders.select(
        k.alias("session_key"), F.col("o_custkey").alias("meeting_key"), F.year("o_orderdate").cast("long").alias("year"), text("Race").alias("session_name"), text("Race").alias("session_type"), start.alias("date_start"), text(None).cast("string").alias("date_end"), F.when(k % 2 == 0, "03:00:00").otherwise("-08:00:00").alias("gmt_offset"),
        F.lit(1).cast("long").alias("circuit_key"), *[text("c").alias(c) for c in ("circuit_short_name", "country_code", "country_name", "location")], F.when(k % 9 == 0, True).alias("is_cancelled"),
    )
    return staging.event_sessions(raw).select("session_key", "local_date", "is_cancelled", "season")


@query("""SELECT o_orderkey AS k, kind, CASE kind WHEN 'pit' THEN CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 60 * 1000 + 250 ELSE o_orderkey % 30 * 1000 END WHEN 'stint' THEN CASE WHEN o_orderkey % 3 <> 0 THEN 1 END WHEN 'weather' THEN CAST(o_orderkey % 3 > 0 AS BIGINT) WHEN 'meeting' THEN CAST(o_orderkey % 5 = 0 AS BIGINT) WHEN 'position' THEN o_orderkey % 20 WHEN 'lap' THEN o_orderkey % 90 * 1000 + 125 END AS value
FROM orders, (VALUES ('pit'), ('stint'), ('weather'), ('meeting'), ('position'), ('lap')) v(kind)""")
def p01_staging_of_event_rows(t):
    k = F.col("o_orderkey")
    schema = lambda name: {c.split()[0]: c.split()[1] for c in staging.EVENT_SCHEMAS[name].split(", ")}

    def raw(name, **given):
        return t.orders.select(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in schema(name).items()])

    key = {"session_key": k, "driver_number": F.lit(1)}
    pits = staging.event_pits(raw("pit", **key, lane_duration=F.when(k % 2 == 0, k % 60 + 0.25), pit_duration=(k % 30).cast("double"))).select("session_key", F.lit("pit").alias("kind"), F.col("lane_time_ms").alias("value"))
    stints = staging.event_stints(raw("stints", **key, compound=F.when(k % 3 == 0, "test_unknown").otherwise("soft"))).select("session_key", F.lit("stint").alias("kind"), F.when(F.col("tyre_compound") == "SOFT", 1).alias("value"))
    weather = staging.event_weather(raw("weather", session_key=k, rainfall=k % 3)).select("session_key", F.lit("weather").alias("kind"), F.col("is_raining").cast("int").alias("value"))
    meetings = staging.event_meetings(raw("meetings", meeting_key=k, is_cancelled=F.when(k % 5 == 0, True))).select(F.col("meeting_key").alias("session_key"), F.lit("meeting").alias("kind"), F.col("is_cancelled").cast("int").alias("value"))
    places = staging.event_positions(raw("position", **key, position=k % 20)).select("session_key", F.lit("position").alias("kind"), F.col("position").alias("value"))
    lap_rows = staging.event_laps(raw("laps", **key, lap_duration=k % 90 + 0.125)).select("session_key", F.lit("lap").alias("kind"), F.col("lap_time_ms").alias("value"))
    out = pits
    for df in (stints, weather, meetings, places, lap_rows):
        out = out.unionByName(df)
    return out.select(F.col("session_key").alias("k"), "kind", F.col("value").cast("long").alias("value"))


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 8 WHEN 0 THEN 'red_flag' WHEN 1 THEN 'vsc_deployed' WHEN 2 THEN 'vsc_ending' WHEN 3 THEN 'safety_car_deployed' WHEN 4 THEN 'safety_car_in' WHEN 5 THEN 'track_clear' WHEN 6 THEN 'chequered_flag' END AS event FROM orders""")
def p01_staging_of_messages(t):
    k = F.col("o_orderkey")
    pick = lambda *values: F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (k % 8 + 1).cast("int"))
    raw = t.orders.select(
        k.alias("session_key"), F.lit("2024-01-01T00:00:00+00:00").alias("date"), F.lit(1).cast("long").alias("lap_number"), pick("Flag", "SafetyCar", "SafetyCar", "SafetyCar", "SafetyCar", "Flag", "Flag", "Other").alias("category"), pick("RED", None, None, None, None, "GREEN", "CHEQUERED", None).alias("flag"),
        pick("Track", None, None, None, None, "Track", "Track", None).alias("scope"), F.lit(None).cast("double").alias("sector"), F.lit(None).cast("double").alias("driver_number"), pick("x", "VSC DEPLOYED", "VIRTUAL SAFETY CAR ENDING", "SAFETY CAR DEPLOYED", "SAFETY CAR IN THIS LAP", "x", "x", "x").alias("message"),
    )
    return staging.event_messages(raw).select(F.col("session_key").alias("k"), staging.message_event().alias("event"))


# Nested documents and dumps


@query("""SELECT o_orderkey AS k, 60000 + o_orderkey % 1000 AS session_ms, 'Flag' AS category, 'm' || i AS message FROM orders, range(2) r(i) WHERE o_orderkey % 3 = 0 OR i = 0""")
def r25_message_feed(t):
    k = F.col("o_orderkey")
    time = F.concat(F.lit("00:01:00."), F.lpad((k % 1000).cast("string"), 3, "0"))
    one = lambda i: F.to_json(F.struct(F.lit("Flag").alias("Category"), F.lit(f"m{i}").alias("Message")))
    listed, mapped = F.concat(F.lit('{"Messages": ['), one(0), F.lit(","), one(1), F.lit("]}")), F.concat(F.lit('{"Messages": {"7": '), one(0), F.lit("}}"))
    lines = t.orders.select(k.alias("k"), F.concat(F.lit('["'), time, F.lit('", '), F.when(k % 3 == 0, listed).otherwise(mapped), F.lit("]")).alias("line"))
    out = flatten.message_feed(lines, "line", "struct<Category: string, Message: string>", ["k"])
    return out.select("k", "session_ms", F.col("Category").alias("category"), F.col("Message").alias("message"))


@query("""SELECT c_custkey AS k, '{"a":' || c_nationkey || ',"b":["' || c_mktsegment || '"]}' AS nested, '[1,' || c_nationkey || ']' AS listed, c_name AS plain FROM customer""")
def r26_stable_columns(t):
    wide = t.customer.select(F.col("c_custkey").alias("k"), F.struct(F.col("c_nationkey").alias("a"), F.array("c_mktsegment").alias("b")).alias("nested"), F.array(F.lit(1).cast("long"), F.col("c_nationkey").cast("long")).alias("listed"), F.col("c_name").alias("plain"))
    return flatten.stable_columns(wide)


@query("""SELECT CAST(year(o_orderdate) AS INT) AS season, o_custkey % 20 AS round, 'r' || (o_custkey % 40) AS driver, l_linenumber AS number, 60000 + l_orderkey % 9000 AS ms FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def r30_dump_steps(t):
    k = F.col("o_custkey")
    entries = t.orders.select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("season"), (k % 20).alias("round"), F.lit("R").alias("type"), F.concat(F.lit("r"), k % 40).alias("driver"))
    ms = F.col("l_orderkey") % 9000
    steps = t.lineitem.select(F.col("l_orderkey").alias("session_entry_id"), F.col("l_linenumber").alias("number"), F.format_string("1:%02d.%03d", F.floor(ms / 1000), ms % 1000).alias("time"))
    return flatten.flat_steps(entries, steps).select("season", "round", "driver", "number", "ms")


@query("""WITH n AS (SELECT CAST(year(o_orderdate) AS INT) AS season, CAST(month(o_orderdate) AS INT) AS part, count(*) AS expected, count(*) FILTER (WHERE o_orderstatus <> 'P' OR month(o_orderdate) % 2 = 0) AS n FROM orders GROUP BY ALL) SELECT season, part, expected, n FROM n WHERE n >= 0.97 * expected ORDER BY season DESC, part DESC LIMIT 1""")
def r32_newest_covered(t):
    part = t.orders.select(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("part"), "o_orderstatus")
    expected = part.groupBy("season", "part").agg(F.count("*").alias("expected"))
    found = part.where((F.col("o_orderstatus") != "P") | (F.col("part") % 2 == 0))
    return merge.newest_covered(A.coverage(found, expected, ["season", "part"], "expected", 0.97), ["season", "part"]).select("season", "part", "expected", "n")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL")
def r34_guarded(t):
    one = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return quality.assert_unique(one, ["l_orderkey", "l_linenumber"])


# Dimensions and facts


@query("""SELECT c_custkey AS driver_id, b.n_name AS country_of_birth_name, n.n_name AS nationality_country, lower(substr(n.n_name, 1, 2)) AS nationality_alpha2 FROM customer JOIN nation n ON c_nationkey = n.n_nationkey LEFT JOIN nation b ON c_custkey % 30 = b.n_nationkey""")
def r21_driver_dimension(t):
    drivers = t.customer.select(F.col("c_custkey").alias("driver_id"), (F.col("c_custkey") % 30).alias("country_of_birth_country_id"), F.col("c_nationkey").alias("nationality_country_id"))
    countries = t.nation.select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country_name"), F.lit("d").alias("demonym"), F.lower(F.substring("n_name", 1, 2)).alias("alpha2_code"))
    return marts.driver_dimension(drivers, countries).drop("nationality_demonym")


@query("""WITH e AS (SELECT l_orderkey AS race_id, bool_or(l_returnflag = 'R') AS done, bool_or(l_returnflag = 'A') AS sprint FROM lineitem GROUP BY 1), r AS (SELECT o_orderkey AS race_id, CAST(year(o_orderdate) AS INT) AS season, CAST(month(o_orderdate) AS INT) AS round, o_custkey % 25 AS place, o_orderkey % 10 = 0 AS planned FROM orders)
SELECT r.race_id, coalesce(done, false) AS is_completed, planned OR coalesce(sprint, false) AS has_sprint, round = max(round) OVER (PARTITION BY season) AS is_season_final_race, 'c' || place AS circuit_name, n_name AS circuit_country, 'g' || (place % 5) AS grand_prix_name FROM r LEFT JOIN e USING (race_id) LEFT JOIN nation ON place = n_nationkey""")
def r21_race_dimension(t):
    place = F.col("o_custkey") % 25
    races = t.orders.select(F.col("o_orderkey").alias("race_id"), F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round"), place.alias("circuit_id"), (place % 5).alias("grand_prix_id"), (F.col("o_orderkey") % 10 == 0).alias("has_sprint"))
    kinds = F.when(F.col("l_returnflag") == "R", "RACE_RESULT").when(F.col("l_returnflag") == "A", "SPRINT_RACE_RESULT").otherwise("WARM_UP")
    entries = t.lineitem.select(F.col("l_orderkey").alias("race_id"), kinds.alias("session_type"))
    n = F.col("n_nationkey")
    circuits = t.nation.select(n.alias("circuit_id"), F.concat(F.lit("c"), n).alias("name"), *[F.lit("x").alias(c) for c in ("full_name", "place_name", "latitude", "longitude")], n.alias("country_id"))
    prix = t.nation.where("n_nationkey < 5").select(n.alias("grand_prix_id"), F.concat(F.lit("g"), n).alias("name"), F.lit("x").alias("full_name"), F.lit("x").alias("short_name"), n.alias("country_id"))
    countries = t.nation.select(n.alias("country_id"), F.col("n_name").alias("country_name"), F.lit("a").alias("alpha2_code"))
    return marts.race_dimension(races, entries, circuits, prix, countries).select("race_id", "is_completed", "has_sprint", "is_season_final_race", "circuit_name", "circuit_country", "grand_prix_name")


@query(f"""WITH {RESULTS_SQL} SELECT race_id, position_display_order AS shown, lower(session_type) AS session_type, coalesce(CASE WHEN points > 5 THEN is_pole END, false) AS is_pole, coalesce(CASE WHEN points > 10 THEN points END, 0) AS points, coalesce(position_number = 1, false) AS is_win, coalesce(position_number <= 3, false) AS is_podium FROM results WHERE session_type IN ('RACE', 'SPRINT')""")
def r22_race_facts(t):
    r = results(t).withColumns({"pole": F.when(F.col("points") > 5, F.col("is_pole")), "scored": F.when(F.col("points") > 10, F.col("points"))})
    return marts.session_facts(r, {"RACE": "race", "SPRINT": "sprint"}, {"position_display_order": "shown"}, {"pole": "is_pole"}, {"scored": "points"})


@query("SELECT l_orderkey, l_suppkey, l_quantity, min(l_linenumber) AS l_linenumber FROM lineitem GROUP BY ALL")
def r22_stop_facts(t):
    rows = t.lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_linenumber")
    return marts.stop_facts(rows.union(rows), ["l_orderkey", "l_suppkey", "l_quantity"], "l_linenumber")


# Small ones


@query("""SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment || ':' || (c_custkey % 3))), ',') AS pairs, count(DISTINCT (c_mktsegment, c_custkey % 3)) AS n FROM customer GROUP BY 1""")
def a13_distinct_structs(t):
    pairs = F.array_sort(F.collect_set(F.struct(F.col("c_mktsegment").alias("id"), (F.col("c_custkey") % 3).alias("team"))))
    out = t.customer.groupBy("c_nationkey").agg(pairs.alias("p"))
    return out.select("c_nationkey", F.array_join(F.transform("p", lambda s: F.concat(s.id, F.lit(":"), s.team)), ",").alias("pairs"), F.size("p").cast("long").alias("n"))


@query("SELECT c_custkey FROM customer WHERE contains(c_name, '42') UNION ALL SELECT -c_custkey FROM customer WHERE contains(c_name, '#')")
def p14_search_of_digits_and_marks(t):
    return t.customer.where(name_contains("c_name", "42")).select("c_custkey").unionByName(t.customer.where(name_contains("c_name", "#")).select((-F.col("c_custkey")).alias("c_custkey")))


@query("""WITH a AS (SELECT l_orderkey AS k, l_linenumber % 3 AS v FROM lineitem), b AS (SELECT l_orderkey AS k, CASE WHEN l_orderkey % 50 = 0 THEN 9 ELSE l_linenumber % 3 END AS v FROM lineitem) SELECT 'only_left' AS side, k, v, count(*) AS n FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL UNION ALL SELECT 'only_right', k, v, count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""")
def u06_rows_of_one_side(t):
    a = t.lineitem.select(F.col("l_orderkey").alias("k"), (F.col("l_linenumber") % 3).alias("v"))
    b = a.withColumn("v", F.when(F.col("k") % 50 == 0, 9).otherwise(F.col("v")))
    return quality.rows_of_one_side(a, b)
