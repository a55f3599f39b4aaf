"""The whole event-feed lap builder and the whole fusion of four sources, on series derived from the given tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.operators import feed, fusion
from concordia.plans.base import LAPS_SQL, laps, query
from concordia.sources import staging

# Event feed: sessions are races, cars the drivers' numbers; times are milliseconds after the session's start.

_T0 = 1_704_067_200_000  # 2024-01-01 in milliseconds


def _utc(ms):
    return F.timestamp_millis(ms)


_FEED_SQL = f"""{LAPS_SQL}, x AS (SELECT race_id AS s, CAST(substr(driver_id, 2) AS INT) AS d, lap_number AS n, lap_time_ms AS ms, place, {_T0} + race_id % 1000 * 10000000 AS t0 FROM laps WHERE lap_time_ms % 13 <> 0),
l AS (SELECT *, CASE WHEN n = 1 AND d % 2 = 1 THEN NULL ELSE t0 + (n - 1) * 100000 + d * 700 + ms % 900 END AS begin, CASE WHEN ms % 11 <> 0 THEN ms END AS given, CASE WHEN s % 3 <> 0 THEN 92000 + ms % 50 END AS sectors, (s + n + d) % 9 = 0 AS pit_out FROM x),
e AS (SELECT *, coalesce(begin, CASE WHEN n = 1 THEN min(begin) FILTER (WHERE n = 1) OVER (PARTITION BY s) END) AS lap_start, lead(n) OVER w AS next_n, lead(begin) OVER w AS next_begin, lead(pit_out) OVER w AS next_out FROM l WINDOW w AS (PARTITION BY s, d ORDER BY n)),
f AS (SELECT *, coalesce(given, sectors) AS lap_time_ms, given IS NULL AND sectors IS NOT NULL AS from_sectors, coalesce(CASE WHEN next_n = n + 1 THEN next_begin END, lap_start + coalesce(given, sectors)) AS lap_end, coalesce(next_n = n + 1 AND next_out, false) AS out_next FROM e),
g AS (SELECT * FROM f WHERE lap_end IS NOT NULL),
pos AS (SELECT s, d, t0 + (n - 1) * 100000 + d * 700 + ms % 900 + 250 AS t, place FROM x WHERE d <> 2),
p AS (SELECT g.*, pos.place AS feed, rank() OVER (PARTITION BY g.s, g.n ORDER BY lap_end) AS timing, lap_end - min(lap_end) OVER (PARTITION BY g.s, g.n) AS gap FROM g ASOF LEFT JOIN pos ON g.s = pos.s AND g.d = pos.d AND g.lap_end + 500 >= pos.t),
stint(k, a, b, compound) AS (VALUES (1, 1, 4, 'SOFT'), (2, 4, NULL, 'HARD')),
msg AS (SELECT DISTINCT s, t0 FROM x),
per AS (SELECT s, 'sc' AS kind, t0 + 150000 AS a, t0 + 250000 AS b FROM msg WHERE s % 2 = 0 UNION ALL SELECT s, 'vsc', t0 + 300000, t0 + 350000 FROM msg WHERE s % 3 = 0 UNION ALL SELECT s, 'sc', t0 + 500000, NULL FROM msg WHERE s % 7 = 0),
red AS (SELECT s, t0 + 420000 AS t FROM msg WHERE s % 5 = 0)"""


@query(f"""WITH {_FEED_SQL}
SELECT s AS session_key, d AS driver_number, n AS lap_number, lap_start, lap_end, lap_time_ms, from_sectors AS is_from_sectors, coalesce(feed, timing) AS position, timing AS position_by_timing, CASE WHEN feed IS NULL THEN 'timing_only' WHEN feed = timing THEN 'agreed' ELSE 'disputed' END AS position_status, gap AS gap_ms,
  (SELECT max(k) FROM stint WHERE n BETWEEN a AND coalesce(b, n)) AS stint, (SELECT arg_max(compound, k) FROM stint WHERE n BETWEEN a AND coalesce(b, n)) AS compound, (SELECT arg_max(s % 5 + n - a + 1, k) FROM stint WHERE n BETWEEN a AND coalesce(b, n)) AS tyre_age,
  out_next OR place = 1 AND n % 3 = 0 AS is_pit_in, EXISTS (SELECT 1 FROM per WHERE per.s = p.s AND kind = 'sc' AND a < lap_end AND coalesce(b, lap_end) > lap_start) AS is_sc, EXISTS (SELECT 1 FROM per WHERE per.s = p.s AND kind = 'vsc' AND a < lap_end AND coalesce(b, lap_end) > lap_start) AS is_vsc,
  EXISTS (SELECT 1 FROM red WHERE red.s = p.s AND t > lap_start AND t <= lap_end) AS is_red FROM p""")
def r08_feed_laps(t):
    x = laps(t).where("lap_time_ms % 13 <> 0").select(F.col("race_id").alias("session_key"), F.substring("driver_id", 2, 9).cast("int").alias("driver_number"), F.col("lap_number").cast("int").alias("lap_number"), F.col("lap_time_ms").alias("ms"), "place")
    x = x.withColumn("t0", F.lit(_T0).cast("long") + F.col("session_key") % 1000 * 10_000_000)
    d, n, ms, s, t0 = (F.col(c) for c in ("driver_number", "lap_number", "ms", "session_key", "t0"))
    begin = t0 + (n - 1) * 100_000 + d * 700 + ms % 900
    third = F.when(s % 3 != 0, 30_000 + ms % 50)
    own = x.select("session_key", "driver_number", "lap_number", F.when(~((n == 1) & (d % 2 == 1)), _utc(begin)).alias("date_start_utc"), F.when(ms % 11 != 0, ms).alias("lap_time_ms"), *[F.lit(31_000).cast("long").alias(f"sector_{i}_ms") for i in (1, 2)], third.cast("long").alias("sector_3_ms"), ((s + n + d) % 9 == 0).alias("is_pit_out_lap"))
    position = x.where("driver_number <> 2").select("session_key", "driver_number", _utc(begin + 250).alias("date_utc"), F.col("place").alias("position"))
    row = lambda k, a, b, kind: F.struct(F.lit(k).alias("stint"), F.lit(a).alias("lap_start"), F.lit(b).cast("int").alias("lap_end"), F.lit(kind).alias("tyre_compound"))
    stint = x.select("session_key", "driver_number").distinct().select("session_key", "driver_number", (s % 5).cast("int").alias("tyre_age_at_start"), F.inline(F.array(row(1, 1, 4, "SOFT"), row(2, 4, None, "HARD"))))
    pit = x.where("place = 1 and lap_number % 3 = 0").select("session_key", "driver_number", "lap_number")
    said = lambda when, after, category, flag, scope, text: F.when(when, F.struct((t0 + after).alias("ms"), F.lit(category).alias("category"), F.lit(flag).cast("string").alias("flag"), F.lit(scope).cast("string").alias("scope"), F.lit(text).alias("message")))
    log = F.array_compact(F.array(
        said(s % 2 == 0, 150_000, "SafetyCar", None, None, "SAFETY CAR DEPLOYED"), said(s % 2 == 0, 250_000, "Flag", "CLEAR", "Track", "TRACK CLEAR"), said(s % 3 == 0, 300_000, "SafetyCar", None, None, "VSC DEPLOYED"),
        said(s % 3 == 0, 350_000, "SafetyCar", None, None, "VSC ENDING"), said(s % 5 == 0, 420_000, "Flag", "RED", "Track", "RED FLAG"), said(s % 7 == 0, 500_000, "SafetyCar", None, None, "SAFETY CAR DEPLOYED"),
    ))
    messages = x.select("session_key", "t0").distinct().select("session_key", F.inline(log)).withColumn("message_utc", _utc(F.col("ms")))
    out = feed.build_laps(own, position, stint, pit, messages, staging.message_event(), rows=3 * laps(t).count())
    return out.select(
        "session_key", "driver_number", "lap_number", C.epoch_ms("lap_start").alias("lap_start"), C.epoch_ms("lap_end").alias("lap_end"), "lap_time_ms", F.col("is_lap_time_from_sectors").alias("is_from_sectors"), "position", "position_by_timing", "position_status", F.col("gap_to_leader_ms").alias("gap_ms"),
        "stint", F.col("tyre_compound").alias("compound"), F.col("tyre_age_laps").alias("tyre_age"), F.col("is_pit_in_lap").alias("is_pit_in"), F.col("is_safety_car").alias("is_sc"), F.col("is_virtual_safety_car").alias("is_vsc"), F.col("is_red_flag").alias("is_red"),
    )


# Fusion of four sources

_ROW = "race_id, driver_id, lap_number"
_FOUR_SQL = f"""{LAPS_SQL}, x AS (SELECT *, CAST(sum(lap_time_ms) OVER (PARTITION BY race_id, driver_id ORDER BY lap_number) AS BIGINT) AS total, race_id % 10 = 1 AND place = 2 AS red, (race_id + lap_number) % 6 AS k, CASE WHEN lap_number % 3 = 0 THEN place % 4 + 1 ELSE place END AS moved FROM laps),
s1 AS (SELECT race_id, driver_id, lap_number + CASE WHEN race_id % 6 = 5 THEN -1 ELSE 0 END AS lap_number, lap_time_ms AS v, total, place AS p, red, CASE race_id % 6 WHEN 5 THEN 'renumbered' WHEN 4 THEN 'consistent' ELSE 'no_evidence' END AS numbering FROM x WHERE race_id % 7 > 1 AND NOT (driver_id = 'd3' AND race_id % 3 = 0)),
s2 AS (SELECT {_ROW}, lap_time_ms + CASE k WHEN 1 THEN 1 WHEN 2 THEN 1500 WHEN 3 THEN 5000 ELSE 0 END AS v, moved AS p, red FROM x WHERE race_id % 7 <> 1 AND lap_number < 7),
s3 AS (SELECT {_ROW}, lap_time_ms + CASE k WHEN 2 THEN 1500 WHEN 3 THEN 9000 ELSE 0 END AS v, moved AS p, red FROM x WHERE race_id % 5 <> 0),
s4 AS (SELECT {_ROW}, lap_time_ms + CASE k WHEN 1 THEN 1 WHEN 2 THEN 1500 WHEN 4 THEN 1500 ELSE 0 END AS v, place AS p, red FROM x WHERE race_id % 4 <> 0),
trusted AS (SELECT * FROM s4 WHERE race_id % 4 <> 1), sheet AS (SELECT {_ROW}, v + race_id % 2 AS original_value, v + 3000 AS corrected_value FROM s1 WHERE (race_id * 3 + lap_number) % 17 = 0),
official AS (SELECT DISTINCT race_id, driver_id, CASE WHEN driver_id = 'd2' AND race_id % 11 = 0 THEN 0 ELSE 5 + race_id % 3 END AS official_laps FROM x)"""


def _sources(t):
    each = Window.partitionBy("race_id", "driver_id").orderBy("lap_number").rowsBetween(Window.unboundedPreceding, 0)
    r, n = F.col("race_id"), F.col("lap_number")
    x = laps(t).withColumn("total", F.sum("lap_time_ms").over(each))
    k, moved = (r + n) % 6, F.when(n % 3 == 0, F.col("place") % 4 + 1).otherwise(F.col("place"))
    red = (r % 10 == 1) & (F.col("place") == 2)

    def one(where, add, place, total=F.lit(None).cast("long")):
        return x.where(where).select("race_id", "driver_id", "lap_number", (F.col("lap_time_ms") + add).alias("lap_time_ms"), total.alias("race_time_ms"), place.alias("position"), F.lit(None).cast("long").alias("gap_to_leader_ms"), red.alias("is_red_flag"))

    s1 = one((r % 7 > 1) & ~((F.col("driver_id") == "d3") & (r % 3 == 0)), F.lit(0), F.col("place"), F.col("total"))
    s2 = one((r % 7 != 1) & (n < 7), F.when(k == 1, 1).when(k == 2, 1500).when(k == 3, 5000).otherwise(0), moved)
    s3 = one(r % 5 != 0, F.when(k == 2, 1500).when(k == 3, 9000).otherwise(0), moved)
    s4 = one(r % 4 != 0, F.when(k == 1, 1).when((k == 2) | (k == 4), 1500).otherwise(0), F.col("place"))
    races = x.select("race_id").distinct()
    numbering = races.where("race_id % 6 in (4, 5)").select("race_id", F.when(r % 6 == 5, -1).otherwise(0).alias("applied_lap_shift"), F.when(r % 6 == 5, "renumbered").otherwise("consistent").alias("numbering_status"))
    shifted = s1.withColumn("lap_number", n - F.when(r % 6 == 5, 1).otherwise(0)).where((r * 3 + n) % 17 == 0)
    sheet = shifted.select("race_id", "driver_id", "lap_number", (F.col("lap_time_ms") + r % 2).alias("original_value"), (F.col("lap_time_ms") + 3000).alias("corrected_value"))
    official = x.select("race_id", "driver_id").distinct().withColumn("official_laps", F.when((F.col("driver_id") == "d2") & (r % 11 == 0), 0).otherwise(5 + r % 3))
    reliability = races.select("race_id", (r % 4 != 1).alias("is_reliable"), (r % 8 == 1).alias("is_replaced"))
    return s1, s2, s3, s4, numbering, sheet, official, reliability, races.where("race_id % 9 = 0")


def _vote_sql(name: str, base: str, source: str, others: dict[str, str], voters: tuple[str, str] | None) -> str:
    """CTEs of one base: rows with v (own time), fixed, cur (current place), again (recalculated), numbering, red."""
    joins = " ".join(f"LEFT JOIN (SELECT {_ROW}, v AS {n}v, p AS {n}p FROM {table}) USING ({_ROW})" for n, table in others.items())
    time, place = "CAST(NULL AS BIGINT)", "CAST(NULL AS BIGINT)"
    if voters:
        a, b = voters
        time = f"CASE WHEN lap_number > 1 AND abs({a}v - {b}v) <= 1 AND abs({a}v - v) >= 1000 THEN {a}v END"
        place = f"CASE WHEN {a}p = {b}p AND {a}p <> cur THEN {a}p END"
    gaps = ", ".join(f"abs({n}v - v)" for n in others)
    near, known = (f"least({gaps})" if len(others) > 1 else gaps), ", ".join(f"{n}v" for n in others)
    agree = ", ".join(f"CASE WHEN abs(v - {n}v) <= 1 THEN '{n}' END" for n in others)
    return f"""{name}_w AS (SELECT *, {time} AS vt, {place} AS vp FROM {base} {joins}),
{name}_bad AS (SELECT DISTINCT race_id, lap_number, true AS bad FROM {name}_w WHERE coalesce(vp, cur) IS NOT NULL GROUP BY race_id, lap_number, coalesce(vp, cur) HAVING count(*) > 1 AND bool_or(vp IS NOT NULL)),
{name} AS (SELECT {_ROW}, coalesce(fixed, vt, v) AS lap_time_ms, coalesce(CASE WHEN bad IS NULL THEN vp END, cur) AS position, '{source}' AS source, v AS original, numbering, red,
  CASE WHEN fixed IS NOT NULL OR vt IS NOT NULL THEN 'corrected' WHEN {near} <= 1 THEN 'confirmed' WHEN v IS NULL OR coalesce({known}) IS NULL THEN 'single_source' WHEN lap_number = 1 OR {near} < 1000 OR greatest(v, {known}) > 300000 THEN 'timing_convention' ELSE 'disputed' END AS status,
  [y FOR y IN [{agree}] IF y IS NOT NULL] AS agree, [y FOR y IN [CASE WHEN fixed IS NOT NULL THEN 'lap_time_ms:sheet' END, CASE WHEN vt IS NOT NULL THEN 'lap_time_ms:majority' END, CASE WHEN again <> own THEN 'position:recalculated' END, CASE WHEN bad IS NULL AND vp IS NOT NULL THEN 'position:majority' END] IF y IS NOT NULL] AS tags
  FROM {name}_w LEFT JOIN {name}_bad USING (race_id, lap_number))"""


def _plain_sql(name: str, select: str) -> str:
    return f"{name} AS (SELECT *, CAST(NULL AS BIGINT) AS fixed, p AS cur, p AS own, CAST(NULL AS BIGINT) AS again, 'not_applicable' AS numbering FROM ({select}))"


_FUSE_SQL = f"""WITH {_FOUR_SQL},
c0 AS (SELECT s1.*, CASE WHEN v = original_value THEN corrected_value END AS fixed, race_id IN (SELECT race_id FROM sheet) AS touched FROM s1 LEFT JOIN sheet USING ({_ROW})),
c1 AS (SELECT *, total + sum(coalesce(fixed - v, 0)) OVER (PARTITION BY race_id, driver_id ORDER BY lap_number) AS so_far FROM c0), c2 AS (SELECT *, CASE WHEN touched THEN rank() OVER (PARTITION BY race_id, lap_number ORDER BY so_far) END AS again FROM c1),
c3 AS (SELECT {_ROW}, v, fixed, coalesce(again, p) AS cur, p AS own, again, numbering, red FROM c2),
{_vote_sql("first", "c3", "s1", {"s2": "s2", "s3": "s3", "s4": "trusted"}, ("s2", "s3"))},
{_plain_sql("d0", "SELECT * FROM s2 ANTI JOIN s1 USING (race_id, driver_id) WHERE race_id NOT IN (SELECT race_id FROM s1) OR (race_id, driver_id) IN (SELECT race_id, driver_id FROM official WHERE official_laps > 0)")},
{_vote_sql("second", "d0", "s2", {"s3": "s3", "s4": "trusted"}, ("s3", "s4"))},
{_plain_sql("e0", "SELECT * FROM s4 WHERE race_id % 8 <> 1 AND race_id NOT IN (SELECT race_id FROM s1) AND race_id NOT IN (SELECT race_id FROM s2)")},
{_vote_sql("third", "e0", "s4", {"s3": "s3"}, None)},
{_plain_sql("g0", "SELECT * FROM s3")}, {_vote_sql("by_s4", "g0", "s3", {"s4": "trusted"}, None)},
base AS (SELECT * FROM first UNION ALL SELECT * FROM second UNION ALL SELECT * FROM third),
holes AS (SELECT by_s4.* FROM by_s4 JOIN official USING (race_id, driver_id) SEMI JOIN base USING (race_id, driver_id) ANTI JOIN base USING ({_ROW}) WHERE lap_number <= official_laps),
alone AS (SELECT * FROM by_s4 WHERE race_id NOT IN (SELECT race_id FROM s1) AND race_id NOT IN (SELECT race_id FROM s2) AND race_id NOT IN (SELECT race_id FROM s4 WHERE race_id % 8 <> 1)),
fused AS (SELECT * FROM base UNION ALL SELECT * FROM holes UNION ALL SELECT * FROM alone),
med AS (SELECT race_id, greatest(400000.0, 3.0 * median(lap_time_ms)) AS most FROM fused GROUP BY 1), long AS (SELECT fused.*, lap_time_ms > most AS is_long FROM fused JOIN med USING (race_id)),
lapwise AS (SELECT race_id, lap_number, count(*) FILTER (WHERE is_long) AS units, coalesce(bool_or(red), false) AS any_red FROM long GROUP BY ALL),
near AS (SELECT a.race_id, a.lap_number, a.units >= 3 OR bool_or(b.any_red) AS suspended FROM lapwise a JOIN lapwise b ON a.race_id = b.race_id AND b.lap_number BETWEEN a.lap_number - 3 AND a.lap_number GROUP BY a.race_id, a.lap_number, a.units),
flagged AS (SELECT *, red OR is_long AND suspended AS is_red_flag, is_long AND suspended AND NOT red AS new FROM long JOIN near USING (race_id, lap_number))
SELECT {_ROW}, lap_time_ms, position, source, original AS original_lap_time_ms, numbering AS lap_numbering_status, status AS validation_status, array_to_string(agree, ',') AS confirmed_by, array_to_string(CASE WHEN new THEN list_append(tags, 'is_red_flag:suspension') ELSE tags END, ',') AS corrections, is_red_flag
FROM flagged LEFT JOIN official USING (race_id, driver_id) WHERE NOT coalesce(lap_number > official_laps, false) OR race_id % 9 = 0"""


@query(_FUSE_SQL)
def r11_fuse(t):
    out = fusion.fuse(*_sources(t), rows=4 * laps(t).count())
    return out.select(*fusion.KEYS, "lap_time_ms", F.col("position").cast("long").alias("position"), "source", "original_lap_time_ms", "lap_numbering_status", "validation_status", F.array_join("confirmed_by", ",").alias("confirmed_by"), F.array_join("corrections", ",").alias("corrections"), "is_red_flag")
