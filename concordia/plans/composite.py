"""Corrections, linkage, fusion, feeds, merges and quality rules on the given tables."""

from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.operators import codes, corrections, feed, fusion, linkage, marts, offsets, quality
from concordia.operators import joins as J
from concordia.plans.base import LAPS_SQL, RESULTS_SQL, codes_sql, laps, query, results
from concordia.sources import flatten, merge, readers

# Corrections


@query("""WITH rules AS (SELECT r.o_custkey AS rule_id, r.o_custkey, CASE WHEN r.o_custkey % 2 = 0 THEN 'F' END AS match_status, CASE WHEN r.o_custkey % 3 = 0 THEN '1-URGENT' END AS match_priority, 'X' AS set_status FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 4 = 0) r),
one AS (SELECT o_orderkey, o_orderstatus AS was, coalesce(set_status, o_orderstatus) AS status, set_status IS NOT NULL AS is_corrected FROM orders o LEFT JOIN rules u ON o.o_custkey = u.o_custkey AND (match_status IS NULL OR match_status = o_orderstatus) AND (match_priority IS NULL OR match_priority = o_orderpriority)),
cells AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE 'P' END AS reviewed, CASE WHEN o_orderkey % 2 = 0 THEN 'set' ELSE 'flag' END AS action FROM orders WHERE o_orderkey % 5 = 0)
SELECT one.o_orderkey, CASE WHEN action = 'set' AND reviewed = status THEN 'Z' ELSE status END AS o_orderstatus, was AS original_o_orderstatus, is_corrected,
  CASE WHEN action = 'set' AND reviewed = status THEN 'o_orderstatus' ELSE '' END AS overridden, CASE WHEN action = 'flag' AND reviewed = status THEN 'o_orderstatus' ELSE '' END AS disputed FROM one LEFT JOIN cells USING (o_orderkey)""")
def r01_j17_j18_guarded_corrections(t):
    rules = t.orders.select("o_custkey").where("o_custkey % 4 = 0").distinct().select(
        "o_custkey", F.col("o_custkey").alias("rule_id"), F.when(F.col("o_custkey") % 2 == 0, "F").alias("match_status"), F.when(F.col("o_custkey") % 3 == 0, "1-URGENT").alias("match_priority"), F.lit("X").alias("set_status")
    )
    cells = t.orders.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("o_orderstatus").alias("column_name"), F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise("P").alias("original_value"), F.lit("Z").alias("corrected_value"), F.when(F.col("o_orderkey") % 2 == 0, "set").otherwise("flag").alias("action"))
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    one = corrections.apply_row_rules(base, rules, ["o_custkey"], {"match_status": "o_orderstatus", "match_priority": "o_orderpriority"}, {"set_status": "o_orderstatus"}, ["rule_id"])
    two = corrections.apply_cell_overrides(one, cells, ["o_orderkey"], {"o_orderstatus": "string"})
    return two.select("o_orderkey", "o_orderstatus", "original_o_orderstatus", "is_corrected", F.array_join("overridden_columns", ",").alias("overridden"), F.array_join("disputed_columns", ",").alias("disputed"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0 AND o_orderstatus <> CASE WHEN o_orderkey % 7 = 0 THEN 'O' ELSE 'P' END")
def q13_stale_corrections(t):
    sheet = t.orders.where("o_orderkey % 5 = 0").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, "O").otherwise("P").alias("original_value"))
    return corrections.stale_corrections(t.orders, sheet, ["o_orderkey"], "o_orderstatus").select("o_orderkey")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN 'no row' WHEN o_orderstatus <> 'O' THEN 'value changed' ELSE 'ok' END AS outcome FROM orders WHERE o_orderkey % 3 = 0""")
def r35_build_overrides(t):
    key = F.when(F.col("o_orderkey") % 9 == 0, -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))
    evidence = t.orders.where("o_orderkey % 3 = 0").select(key.alias("o_orderkey"), F.lit("o_orderstatus").alias("column_name"), F.lit("O").alias("old_value"), F.lit("F").alias("new_value"), F.lit("R1").alias("decision"))
    good, errors = corrections.build_overrides(evidence, t.orders, ["o_orderkey"], ["o_custkey"], ["o_orderstatus"])
    both = good.select("o_orderkey", F.lit("ok").alias("outcome")).unionByName(errors.select("o_orderkey", F.col("reason").alias("outcome")))
    return both.select(F.when(F.col("o_orderkey") < 0, -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey")).alias("o_orderkey"), "outcome")


# Linkage


@query("""WITH reg AS (SELECT s_nationkey AS g, s_suppkey AS id, CAST(s_suppkey % 10 AS VARCHAR) AS num, 'anna k' || translate(CAST(s_suppkey % 6 AS VARCHAR), '0123456789', 'abcdefghij') || ' ' || 'mu' || translate(CAST(s_suppkey % 7 AS VARCHAR), '0123456789', 'abcdefghij') AS full_name, 'mu' || translate(CAST(s_suppkey % 7 AS VARCHAR), '0123456789', 'abcdefghij') AS surname FROM supplier),
rec AS (SELECT DISTINCT c_nationkey AS g, CAST(c_custkey % 10 AS VARCHAR) AS num, 'anna k' || translate(CAST(c_custkey % 4 AS VARCHAR), '0123456789', 'abcdefghij') || ' ' || 'mu' || translate(CAST(c_custkey % 9 AS VARCHAR), '0123456789', 'abcdefghij') AS name FROM customer),
bearers AS (SELECT g, surname, count(DISTINCT id) AS n FROM reg GROUP BY ALL),
cand AS (SELECT rec.g, rec.num, rec.name, reg.id, reg.num AS rnum, CASE WHEN rec.num = reg.num AND name = full_name THEN 1 WHEN rec.num = reg.num AND ends_with(name, ' ' || reg.surname) THEN 2 WHEN name = full_name THEN 3 WHEN ends_with(name, ' ' || reg.surname) AND bearers.n = 1 THEN 4 WHEN rec.num = reg.num THEN 5 END AS level
  FROM rec JOIN reg ON rec.g = reg.g JOIN bearers ON bearers.g = reg.g AND bearers.surname = reg.surname),
best AS (SELECT *, row_number() OVER (PARTITION BY g, num, name ORDER BY level, id, rnum) AS rn FROM cand WHERE level IS NOT NULL)
SELECT rec.g AS nation, rec.num AS number, rec.name, best.id AS entity, CAST(best.level AS INT) AS match_level FROM rec LEFT JOIN best ON rn = 1 AND rec.g = best.g AND rec.num = best.num AND rec.name = best.name""")
def r03_j06_link_records(t):
    letters = lambda c: F.translate(c.cast("string"), "0123456789", "abcdefghij")
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    name = F.concat(F.lit("Ánna-K"), letters(k % 4), F.lit(" Mu"), letters(k % 9))
    records = t.customer.select(F.col("c_nationkey").alias("nation"), (k % 10).cast("string").alias("number"), name.alias("name")).distinct()
    surname = F.concat(F.lit("Mü"), letters(s % 7))
    registry = t.supplier.select(F.col("s_nationkey").alias("nation"), s.alias("entity"), (s % 10).cast("string").alias("reg_number"), F.concat(F.lit("anna k"), letters(s % 6), F.lit(" "), surname).alias("reg_name"), surname.alias("surname"))
    from concordia.functions.names import normalized_name

    linked = linkage.link_records(records, registry, ["nation"], "number", "name", "entity", "reg_number", "reg_name", "surname")
    return linked.select("nation", "number", normalized_name("name").alias("name"), "entity", "match_level")


@query("""WITH off AS (SELECT o_custkey % 20 AS scope, year(o_orderdate) AS y, month(o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL),
bat AS (SELECT scope, CASE WHEN y % 3 = 0 THEN y + 1 ELSE y END AS label, m, n FROM off WHERE y % 3 <> 1),
sc AS (SELECT bat.scope, bat.label, off.y AS aligned, count(*) AS score FROM bat JOIN off ON bat.scope = off.scope AND bat.m = off.m AND bat.n = off.n GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY scope, label ORDER BY score DESC, aligned = label DESC, aligned) AS rn FROM sc)
SELECT scope, CAST(label AS INT) AS label, CAST(aligned AS INT) AS aligned, score, (SELECT count(*) FROM bat b WHERE b.scope = best.scope AND b.label = best.label) AS total, aligned <> label AS is_realigned FROM best WHERE rn = 1""")
def r04_align_batches(t):
    official = t.orders.groupBy((F.col("o_custkey") % 20).alias("scope"), F.year("o_orderdate").alias("label"), F.month("o_orderdate").alias("m")).agg(F.count("*").alias("n"))
    batches = official.where("label % 3 <> 1").withColumn("label", F.when(F.col("label") % 3 == 0, F.col("label") + 1).otherwise(F.col("label")))
    return linkage.align_batches(batches, official, ["scope"], "label", ["m", "n"]).select("scope", "label", "aligned", "score", "total", "is_realigned")


@query("""SELECT l_partkey AS ref, arg_max(l_suppkey, (n, l_suppkey)) AS entity, max(n) AS shared FROM (SELECT l_partkey, l_suppkey, count(*) AS n FROM lineitem WHERE (l_partkey + l_suppkey) % 3 = 0 GROUP BY ALL) GROUP BY 1""")
def r05_map_ids(t):
    confirmed = (F.col("ref") + F.col("entity")) % 3 == 0
    seen = t.lineitem.select(F.col("l_partkey").alias("ref"), F.col("l_suppkey").alias("s_suppkey"))
    registry = t.supplier.select("s_suppkey", F.col("s_suppkey").alias("entity"))
    return linkage.map_ids(seen, registry, ["s_suppkey"], "ref", "entity", confirmed)


@query("SELECT DISTINCT l_orderkey AS race_id, l_linenumber AS number, l_suppkey AS driver FROM lineitem WHERE l_returnflag IN ('A', 'N')")
def r02_bridge(t):
    e = t.lineitem.select(F.col("l_orderkey").alias("race_id"), F.col("l_linenumber").alias("number"), F.col("l_suppkey").alias("driver"), "l_returnflag")
    return linkage.bridge(e, ["race_id", "number"], "driver", ["A", "N"], "l_returnflag")


@query("""WITH c AS (SELECT p_partkey % 7 AS g, p_size // 10 AS a, p_type AS r, length(p_type) AS o, count(*) AS n FROM part GROUP BY ALL),
b AS (SELECT g, a, arg_max(r, (n, -o, r)) AS r, arg_max(o, (n, -o, r)) AS o, max(n) AS n, CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY ALL), u AS (SELECT *, coalesce(o > lag(o) OVER (PARTITION BY g ORDER BY a), true) AS up FROM b)
SELECT g, a, o, n, total, bool_and(up) OVER (PARTITION BY g) AS is_consistent FROM u""")
def r17_equivalences(t):
    p = t.part.select((F.col("p_partkey") % 7).alias("g"), F.floor(F.col("p_size") / 10).cast("int").alias("a"), F.col("p_type").alias("r"), F.length("p_type").cast("long").alias("o"))
    return linkage.equivalences(p, ["g"], "a", "r", "o").select("g", "a", "o", "n", "total", "is_consistent")


# Numbering, reliability, fusion


@query(f"""WITH {LAPS_SQL}, ev AS (SELECT race_id, 'fastest' AS evidence, CASE WHEN race_id % 3 = 0 THEN 0 WHEN race_id % 3 = 1 THEN 1 ELSE lap_number % 2 END AS o FROM laps WHERE lap_number % 2 = 1
  UNION ALL SELECT race_id, 'stop', CASE WHEN race_id % 3 = 0 THEN -(race_id % 2) WHEN race_id % 5 = 0 THEN 0 ELSE 1 END FROM laps WHERE lap_number % 2 = 0),
c AS (SELECT race_id, evidence, o, count(*) AS n FROM ev GROUP BY ALL), k AS (SELECT race_id, evidence, CAST(sum(n) AS BIGINT) AS n, arg_max(o, (n, -abs(o), -o)) AS top, max(n) / sum(n) AS share FROM c GROUP BY ALL HAVING sum(n) >= 3),
p AS (SELECT race_id, max(top) FILTER (WHERE evidence = 'fastest') AS f, max(top) FILTER (WHERE evidence = 'stop') AS s, max(share) FILTER (WHERE evidence = 'stop') AS ss, count(DISTINCT top) AS d, min(top) AS common, min(share) AS least FROM k GROUP BY 1),
l AS (SELECT race_id, max(lap_number) AS last_step, 6 AS official_last FROM laps GROUP BY 1)
SELECT race_id, CAST(f AS BIGINT) AS first_offset, CAST(s AS BIGINT) AS second_offset, status, CAST(CASE WHEN status = 'renumbered' THEN -common ELSE 0 END AS BIGINT) AS applied_shift FROM (SELECT *, CASE WHEN d = 1 AND least >= 0.8 AND common = 0 THEN 'consistent' WHEN coalesce(f, 0) = 0 AND s = -1 AND ss >= 0.8 THEN 'pit_lap_convention'
  WHEN d = 1 AND least >= 0.8 AND last_step - common <= official_last THEN 'renumbered' ELSE 'inconsistent' END AS status FROM p JOIN l USING (race_id))""")
def r06_offset_status(t):
    x = laps(t)
    g = F.col("race_id")
    fast = F.when(g % 3 == 0, 0).when(g % 3 == 1, 1).otherwise(F.col("lap_number") % 2).cast("long")
    stop = F.when(g % 3 == 0, -(g % 2)).when(g % 5 == 0, 0).otherwise(1).cast("long")
    evidence = x.where("lap_number % 2 = 1").select("race_id", F.lit("fastest").alias("evidence"), fast.alias("step_offset")).unionByName(x.where("lap_number % 2 = 0").select("race_id", F.lit("stop").alias("evidence"), stop.alias("step_offset")))
    limits = x.groupBy("race_id").agg(F.max("lap_number").alias("last_step")).withColumn("official_last", F.lit(6))
    return offsets.offset_status(evidence, "race_id", limits).withColumn("applied_shift", F.col("applied_shift").cast("long"))


_SOURCES = f"""{LAPS_SQL}, a AS (SELECT race_id, driver_id, lap_number, lap_time_ms AS v, place AS p FROM laps WHERE race_id % 13 <> 0),
b AS (SELECT race_id, driver_id, lap_number, lap_time_ms + CASE (race_id + lap_number) % 6 WHEN 1 THEN 1 WHEN 2 THEN 1500 WHEN 3 THEN 5000 ELSE 0 END AS v, CASE WHEN lap_number % 3 = 0 THEN place % 4 + 1 ELSE place END AS p FROM laps WHERE lap_number < 7),
c AS (SELECT race_id, driver_id, lap_number, lap_time_ms + CASE (race_id + lap_number) % 6 WHEN 2 THEN 1500 WHEN 3 THEN 9000 ELSE 0 END AS v, CASE WHEN lap_number % 3 = 0 THEN place % 4 + 1 ELSE place END AS p FROM laps WHERE race_id % 5 <> 0)"""


def _sources(t):
    x = laps(t)
    k = (F.col("race_id") + F.col("lap_number")) % 6
    moved = F.when(F.col("lap_number") % 3 == 0, F.col("place") % 4 + 1).otherwise(F.col("place"))
    one = lambda df, add, place: df.select("race_id", "driver_id", "lap_number", (F.col("lap_time_ms") + add).alias("lap_time_ms"), place.alias("position"))
    a = one(x.where("race_id % 13 <> 0"), F.lit(0), F.col("place"))
    b = one(x.where("lap_number < 7"), F.when(k == 1, 1).when(k == 2, 1500).when(k == 3, 5000).otherwise(0), moved)
    c = one(x.where("race_id % 5 <> 0"), F.when(k == 2, 1500).when(k == 3, 9000).otherwise(0), moved)
    return a, b, c


@query(f"""WITH {_SOURCES}, j AS (SELECT a.*, b.v AS bv, b.p AS bp, c.v AS cv, c.p AS cp FROM a LEFT JOIN b USING (race_id, driver_id, lap_number) LEFT JOIN c USING (race_id, driver_id, lap_number)),
v AS (SELECT *, CASE WHEN lap_number > 1 AND abs(bv - cv) <= 1 AND abs(bv - v) >= 1000 THEN bv END AS vt, CASE WHEN bp = cp AND bp IS DISTINCT FROM p THEN bp END AS vp FROM j),
bad AS (SELECT DISTINCT race_id, lap_number FROM v WHERE coalesce(vp, p) IS NOT NULL GROUP BY race_id, lap_number, coalesce(vp, p) HAVING count(*) > 1 AND bool_or(vp IS NOT NULL))
SELECT race_id, driver_id, lap_number, coalesce(vt, v) AS lap_time_ms, CASE WHEN vp IS NOT NULL AND bad.race_id IS NULL THEN vp ELSE p END AS position, CASE WHEN vt IS NOT NULL THEN 'corrected' WHEN abs(bv - v) <= 1 OR abs(cv - v) <= 1 THEN 'confirmed' WHEN bv IS NULL AND cv IS NULL THEN 'single_source'
  WHEN lap_number = 1 OR least(abs(bv - v), abs(cv - v)) < 1000 OR greatest(v, bv, cv) > 300000 THEN 'timing_convention' ELSE 'disputed' END AS validation_status,
  (CASE WHEN vt IS NOT NULL THEN 'lap_time_ms:majority' ELSE '' END) || (CASE WHEN vt IS NOT NULL AND vp IS NOT NULL AND bad.race_id IS NULL THEN ',' ELSE '' END) || (CASE WHEN vp IS NOT NULL AND bad.race_id IS NULL THEN 'position:majority' ELSE '' END) AS corrections
FROM v LEFT JOIN bad USING (race_id, lap_number)""")
def r11_r14_j24_majority_vote(t):
    a, b, c = _sources(t)
    base = a.withColumns({"corrections": C.no_texts(), "original_lap_time_ms": F.col("lap_time_ms")})
    out = fusion.vote_base(base, "b", "c", {"b": b, "c": c}, "a", ["b", "c"])
    return out.select("race_id", "driver_id", "lap_number", "lap_time_ms", "position", "validation_status", F.array_join("corrections", ",").alias("corrections"))


@query(f"""WITH {_SOURCES}, f AS (SELECT race_id, driver_id, lap_number, v, 'b' AS source FROM b), u AS (SELECT DISTINCT race_id, driver_id FROM f)
SELECT race_id, driver_id, lap_number, v AS lap_time_ms, source FROM f UNION ALL SELECT race_id, driver_id, lap_number, v, 'c' FROM c SEMI JOIN u USING (race_id, driver_id) ANTI JOIN f USING (race_id, driver_id, lap_number) WHERE lap_number <= 6 + race_id % 2""")
def r11_fill_holes(t):
    _, b, c = _sources(t)
    official = laps(t).select("race_id", "driver_id", (6 + F.col("race_id") % 2).alias("official_laps")).distinct()
    out = fusion.fill_holes(b.withColumn("source", F.lit("b")), c.withColumn("source", F.lit("c")), official)
    return out.select("race_id", "driver_id", "lap_number", "lap_time_ms", "source")


@query(f"""WITH {LAPS_SQL}, m AS (SELECT race_id, median(lap_time_ms) AS m FROM laps GROUP BY 1), x AS (SELECT *, race_id % 10 = 1 AND place = 2 AS red, lap_time_ms > greatest(400000, 3 * m) AS is_long FROM laps JOIN m USING (race_id)),
y AS (SELECT race_id, lap_number, count(*) FILTER (WHERE is_long) AS n, bool_or(red) AS f FROM x GROUP BY ALL)
SELECT race_id, driver_id, x.lap_number, red OR is_long AND (y.n >= 3 OR EXISTS (SELECT 1 FROM y z WHERE z.race_id = x.race_id AND z.f AND z.lap_number BETWEEN x.lap_number - 3 AND x.lap_number)) AS is_red_flag FROM x JOIN y USING (race_id, lap_number)""")
def r16_flag_suspensions(t):
    x = laps(t).withColumns({"is_red_flag": (F.col("race_id") % 10 == 1) & (F.col("place") == 2), "corrections": C.no_texts()})
    return fusion.flag_suspensions(x).select("race_id", "driver_id", "lap_number", "is_red_flag")


@query(f"""WITH {LAPS_SQL}, bound AS (SELECT DISTINCT race_id, driver_id, 5 AS official_laps FROM laps WHERE race_id % 4 <> 0), w AS (SELECT race_id FROM laps WHERE driver_id = 'd1' AND race_id % 7 = 0 GROUP BY race_id HAVING max(lap_number) > 5)
SELECT race_id, driver_id, lap_number FROM laps LEFT JOIN bound USING (race_id, driver_id) WHERE NOT coalesce(lap_number > official_laps, false) OR race_id IN (SELECT race_id FROM w)""")
def p16_r15_cut_after_end(t):
    x = laps(t)
    bound = x.where("race_id % 4 <> 0").select("race_id", "driver_id").distinct().withColumn("official_laps", F.lit(5))
    winners = x.where("driver_id = 'd1' and race_id % 7 = 0").select("race_id", "driver_id").distinct()
    limit = winners.withColumn("official_laps", F.lit(5))
    return fusion.cut_after_end(x, bound, fusion.count_back_groups([x], limit, winners)).select("race_id", "driver_id", "lap_number")


@query("""WITH found AS (SELECT l_orderkey AS k, l_linenumber AS n FROM lineitem WHERE l_orderkey % 9 <> 0), official AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey % 8 END AS o, o_orderkey % 31 = 0 AS sh, o_orderkey % 37 = 0 AS dq FROM orders),
j AS (SELECT coalesce(f.k, o.k) AS k, max(o) AS o, coalesce(bool_or(sh), false) AS sh, coalesce(bool_or(dq), false) AS dq, count(DISTINCT n) AS laps_found, max(n) AS last_lap, count(DISTINCT CASE WHEN n BETWEEN 1 AND o THEN n END) AS inr FROM found f FULL JOIN official o ON f.k = o.k GROUP BY 1)
SELECT k AS unit_id, laps_found, last_lap, CASE WHEN sh THEN 'shared_car' WHEN dq THEN 'disqualified' WHEN laps_found = 0 AND coalesce(o, 0) = 0 THEN 'ok' WHEN laps_found = 0 THEN 'no_laps' WHEN o IS NULL OR last_lap - o > 1 THEN 'extra_laps' WHEN inr < o THEN 'missing_laps' ELSE 'ok' END AS status FROM j""")
def r18_completeness(t):
    found = t.lineitem.where("l_orderkey % 9 <> 0").select(F.col("l_orderkey").alias("unit_id"), F.col("l_linenumber").alias("lap_number"))
    k = F.col("o_orderkey")
    official = t.orders.select(k.alias("unit_id"), F.when(k % 8 != 0, k % 8).alias("official_laps"), (k % 31 == 0).alias("is_shared"), (k % 37 == 0).alias("is_disqualified"))
    return fusion.completeness(found, official, ["unit_id"], t.lineitem.count() + t.orders.count()).select("unit_id", "laps_found", "last_lap", "status")


@query(f"""WITH {LAPS_SQL}, stops AS (SELECT DISTINCT race_id, driver_id, lap_number - CASE WHEN race_id % 6 = 1 THEN 1 ELSE 0 END AS lap FROM laps WHERE place = 1 AND race_id % 5 <> 0), known AS (SELECT DISTINCT race_id FROM stops)
SELECT race_id, driver_id, lap_number, CASE WHEN s.lap IS NOT NULL THEN 'pit_stop' WHEN k.race_id IS NULL THEN 'unclassified' WHEN place = 2 AND race_id % 2 = 0 THEN 'red_flag' WHEN driver_id = 'd3' AND lap_number >= 5 THEN 'retirement' WHEN place = 3 THEN 'safety_car' ELSE 'penalty_or_other' END AS pass_type
FROM laps LEFT JOIN (SELECT race_id AS r, driver_id AS d, lap FROM stops) s ON s.r = race_id AND s.d = driver_id AND s.lap = lap_number - CASE WHEN race_id % 6 = 1 THEN 1 ELSE 0 END LEFT JOIN known k USING (race_id)""")
def r20_pass_types(t):
    x = laps(t)
    moved = F.when(F.col("race_id") % 6 == 1, 1).otherwise(0)
    stops = x.where("place = 1 and race_id % 5 <> 0").select("race_id", "driver_id", (F.col("lap_number") - moved).alias("lap_number"))
    shift = x.select("race_id").distinct().select("race_id", F.when(F.col("race_id") % 6 == 1, "pit_lap_convention").otherwise("consistent").alias("status"), F.lit(1).alias("second_offset"))
    results = x.select("race_id", "driver_id").distinct().select("race_id", "driver_id", F.lit(5).alias("official_laps"), (F.col("driver_id") != "d3").alias("is_classified"))
    passes = x.select("race_id", "driver_id", "lap_number", ((F.col("place") == 2) & (F.col("race_id") % 2 == 0)).alias("is_red_flag"), (F.col("place") == 3).alias("is_safety_car"), C.no_texts().alias("corrections"))
    return fusion.pass_types(passes, stops, shift, results).select("race_id", "driver_id", "lap_number", "pass_type")


@query(f"""WITH {_SOURCES}, off AS (SELECT race_id, count(*) AS official_rows FROM laps GROUP BY 1), cmp AS (SELECT b.race_id, count(*) AS compared, count(*) FILTER (WHERE abs(b.v - a.v) <= 1) AS matched FROM b JOIN a USING (race_id, driver_id, lap_number) WHERE lap_number > 1 GROUP BY 1
  UNION ALL SELECT b.race_id, count(*), count(*) FILTER (WHERE abs(b.v - c.v) <= 1) FROM b JOIN c USING (race_id, driver_id, lap_number) WHERE lap_number > 1 AND b.race_id NOT IN (SELECT race_id FROM a) GROUP BY 1)
SELECT DISTINCT b.race_id, compared, coalesce(round(100.0 * matched / compared, 2) >= 90, true) AS is_reliable FROM b LEFT JOIN cmp USING (race_id)""")
def r10_reliability(t):
    a, b, c = _sources(t)
    official = laps(t).groupBy("race_id").agg(F.count("*").alias("official_rows"))
    return offsets.reliability(b, [("s1", a), ("s3", c)], c, official, "race_id", ["driver_id", "lap_number"], "lap_time_ms", "lap_number").select("race_id", "compared", "is_reliable")


# Feeds and nested documents


@query("""SELECT event_id, greatest(ts, ts) AS lap_start, coalesce(CASE WHEN (lead(n) OVER w) = n + 1 THEN lead(ts) OVER w END, ts + to_milliseconds(CAST(floor(value * 1000) AS BIGINT))) AS lap_end FROM
  (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) + event_id % 2 AS BIGINT) AS n FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY n, event_id)""")
def r08_w01_lap_ends(t):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) + F.col("event_id") % 2
    e = t.events.withColumn("n", n)
    w = Window.partitionBy("user_id").orderBy("n", "event_id")
    end = F.coalesce(F.when(F.lead("n").over(w) == F.col("n") + 1, F.lead("ts").over(w)), F.col("ts") + C.ms_interval(F.floor(F.col("value") * 1000)))
    return e.select("event_id", F.col("ts").alias("lap_start"), end.alias("lap_end"))


@query("""SELECT conv_id, turn, role, length(text) AS n FROM conversations""")
def r24_r25_flatten(t):
    docs = t.conversations.groupBy("conv_id").agg(F.to_json(F.array_sort(F.collect_list(F.struct("turn", "role", "text")))).alias("doc"))
    return flatten.explode_json(docs, "doc", "array<struct<turn: bigint, role: string, text: string>>", ["conv_id"]).select("conv_id", "turn", "role", F.length("text").cast("long").alias("n"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(user_id AS DOUBLE) END AS number, event_id % 3 = 2 AS is_list FROM events")
def r26_stable_types(t):
    mixed = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.col("user_id").alias("v")))).when(F.col("event_id") % 3 == 1, F.lit('{"v":"+1 LAP"}')).otherwise(F.lit('{"v":[1,2]}'))
    text = flatten.as_json_text(F.get_json_object(mixed, "$.v"))
    return t.events.select("event_id", C.json_number(text).alias("number"), text.startswith("[").alias("is_list"))


# Merges and diffs


@query("""WITH bulk AS (SELECT o_orderkey, o_custkey % 50 AS part, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 0 OR o_custkey % 50 < 5), delta AS (SELECT o_orderkey, o_custkey % 50 AS part, 'new' AS s FROM orders WHERE o_orderkey % 10 <> 1),
e AS (SELECT o_custkey % 50 AS part, count(*) AS expected FROM orders GROUP BY 1), nb AS (SELECT part, count(*) AS n FROM bulk GROUP BY 1), nd AS (SELECT part, count(*) AS n FROM delta GROUP BY 1),
o AS (SELECT part, CASE WHEN coalesce(nb.n, 0) >= 0.95 * expected THEN 'bulk' WHEN coalesce(nd.n, 0) > coalesce(nb.n, 0) THEN 'delta' ELSE 'bulk' END AS origin FROM e LEFT JOIN nb USING (part) LEFT JOIN nd USING (part))
SELECT o_orderkey, part, s, origin FROM bulk JOIN o USING (part) WHERE origin = 'bulk' UNION ALL SELECT o_orderkey, part, s, origin FROM delta JOIN o USING (part) WHERE origin = 'delta'""")
def r31_r32_coverage_merge(t):
    o = t.orders.select("o_orderkey", (F.col("o_custkey") % 50).alias("part"), F.col("o_orderstatus").alias("s"))
    expected = o.groupBy("part").agg(F.count("*").alias("expected"))
    bulk, delta = o.where("o_orderkey % 10 <> 0 or part < 5"), o.where("o_orderkey % 10 <> 1").withColumn("s", F.lit("new"))
    return merge.merge_by_coverage(bulk, delta, expected, ["part"], "expected")


@query("""SELECT coalesce(a.k, b.k) AS o_orderkey, CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' ELSE 'different' END AS kind, CASE WHEN a.k IS NULL OR b.k IS NULL THEN '' ELSE 'o_orderstatus' END AS changed
FROM (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderkey % 10 <> 0) a FULL JOIN (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS s FROM orders WHERE o_orderkey % 11 <> 0) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL OR a.s <> b.s""")
def r33_diff(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", "o_custkey")
    changed = o.where("o_orderkey % 11 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "Z").otherwise(F.col("o_orderstatus")))
    return quality.diff(o.where("o_orderkey % 10 <> 0"), changed, ["o_orderkey"]).select("o_orderkey", "kind", F.array_join("changed", ",").alias("changed"))


@query("""WITH o AS (SELECT CAST(o_custkey % 10 AS INT) AS part, o_orderkey AS k, o_orderstatus AS s FROM orders), a AS (SELECT part, string_agg(k || s, ',' ORDER BY k, s) AS rows FROM o WHERE part <> 9 GROUP BY 1),
b AS (SELECT part, string_agg(k || CASE WHEN part = 7 THEN lower(s) ELSE s END, ',' ORDER BY k, s) AS rows FROM o WHERE part <> 3 GROUP BY 1)
SELECT coalesce(a.part, b.part) AS part, CASE WHEN b.part IS NULL THEN 'lost' WHEN a.part IS NULL THEN 'added' ELSE 'changed' END AS kind FROM a FULL JOIN b ON a.part = b.part WHERE a.rows IS DISTINCT FROM b.rows""")
def r39_manifest_diff(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 10).cast("int").alias("part"))
    old = o.where("part <> 9")
    new = o.where("part <> 3").withColumn("o_orderstatus", F.when(F.col("part") == 7, F.lower("o_orderstatus")).otherwise(F.col("o_orderstatus")))
    return quality.manifest_diff(quality.manifest(old, ["part"]), quality.manifest(new, ["part"]), ["part"]).select("part", "kind")


@query("SELECT CAST(year(o_orderdate) AS INT) AS season, max(month(o_orderdate)) AS last_month, count(DISTINCT month(o_orderdate)) AS months FROM orders GROUP BY 1")
def r38_s12_loaded_summary(t):
    return merge.loaded_summary(t.orders.select(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("m")), "season", "m").select("season", F.col("last_part").cast("long").alias("last_month"), F.col("parts").alias("months"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate + INTERVAL 6 HOUR <= TIMESTAMP '2000-01-01' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) AND o_custkey % 10 <> 0")
def s12_s13_pending(t):
    calendar = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    loaded, gaps = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), t.orders.where("o_custkey % 10 = 0").select("o_orderkey")
    return readers.pending(calendar, loaded, gaps, ["o_orderkey"], "o_orderdate", "2000-01-01 00:00:00").select("o_orderkey")


@query(f"""WITH RECURSIVE {codes_sql("SELECT s_nationkey AS g, s_suppkey AS id, substr(s_name, 1, 3) AS code, ['A', 'B', 'C', 'D', 'E'][s_suppkey % 5 + 1] || 'nn' AS name, true AS ran FROM supplier")} SELECT g AS s_nationkey, id AS s_suppkey, chosen AS unique_code FROM codes""")
def r36_unique_codes(t):
    s = t.supplier.select("s_nationkey", "s_suppkey", F.substring("s_name", 1, 3).alias("code"), F.concat(F.element_at(F.array(*map(F.lit, "ABCDE")), (F.col("s_suppkey") % 5 + 1).cast("int")), F.lit("nn")).alias("name"))
    return codes.unique_codes(s, ["s_nationkey"], "s_suppkey", "code", "name")


@query("""SELECT l_orderkey, l_suppkey, l_partkey, l_linenumber, CASE WHEN n > 1 THEN l_suppkey || '_' || l_linenumber ELSE CAST(l_suppkey AS VARCHAR) END AS unit_key FROM lineitem JOIN
  (SELECT l_orderkey AS k, l_suppkey AS s, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY ALL) ON k = l_orderkey AND s = l_suppkey""")
def r37_unit_keys(t):
    return codes.unit_keys(t.lineitem.select("l_orderkey", F.col("l_suppkey"), "l_partkey", "l_linenumber"), ["l_orderkey"], "l_suppkey", "l_linenumber").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", F.col("unit_key").cast("string").alias("unit_key"))


# Quality


@query("""SELECT 'repeated' AS rule, count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) UNION ALL SELECT 'orphan', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))
UNION ALL SELECT 'outside', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F') UNION ALL SELECT 'blank', count(*) FROM pages WHERE trim(split_part(url, '#', 2)) = '' UNION ALL SELECT 'not_single', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) <> 1)""")
def q06_q08_q09_r34_rules(t):
    anchors = t.pages.select(F.element_at(F.concat(F.split("url", "#"), F.array(F.lit(""))), 2).alias("anchor"))
    found = {
        "repeated": quality.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"]), "orphan": quality.orphans(t.lineitem.select("l_orderkey").distinct(), "l_orderkey", t.orders.where("o_orderstatus <> 'P'"), "o_orderkey"),
        "outside": quality.outside(t.orders, "o_orderstatus", ["O", "F"]), "blank": quality.blanks(anchors, "anchor"), "not_single": quality.not_single(t.orders, ["o_custkey"], "o_orderstatus"),
    }
    out = None
    for rule, df in found.items():
        one = df.agg(F.lit(rule).alias("rule"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH {_SOURCES}, x AS (SELECT race_id % 3 AS g, b.v IS NOT NULL AND c.v IS NOT NULL AS cmp, abs(b.v - c.v) <= 1 AS ok, b.p = c.p AS pok FROM b FULL JOIN c USING (race_id, driver_id, lap_number)),
s AS (SELECT 'laps:time:' || g AS check_id, count(*) FILTER (WHERE cmp) AS compared, count(*) FILTER (WHERE cmp AND ok) AS matched, 70.0::DOUBLE AS threshold FROM x GROUP BY g UNION ALL SELECT 'laps:position:' || g, count(*) FILTER (WHERE cmp), count(*) FILTER (WHERE cmp AND pok), NULL FROM x GROUP BY g UNION ALL SELECT 'none:x', 0, 0, 90.0)
SELECT check_id, compared, matched, CASE WHEN threshold IS NULL THEN 'INFO' WHEN compared = 0 THEN 'NO_DATA' WHEN 100.0 * matched / compared >= threshold THEN 'PASS' ELSE 'FAIL' END AS status FROM s""")
def q01_q02_q04_scorecard(t):
    _, b, c = _sources(t)
    keys = ["race_id", "driver_id", "lap_number"]
    both = b.join(c.select(*keys, F.col("lap_time_ms").alias("other"), F.col("position").alias("other_position")), keys, "full").withColumn("g", F.col("race_id") % 3)
    met = F.col("lap_time_ms").isNotNull() & F.col("other").isNotNull()
    card = quality.check(both, "laps", {"time": (met, C.within("lap_time_ms", "other", 1)), "position": (met, F.col("position") == F.col("other_position"))}, {"time": 70.0}, ["g"])
    none = quality.check(both.where("false"), "none", {"x": (F.lit(True), F.lit(True))}, {"x": 90.0})
    return quality.scorecard([card, none]).select("check_id", "compared", "matched", "status")


@query("""SELECT o_custkey, 'n' AS column_name, CAST(a AS DOUBLE) AS own, CAST(b AS DOUBLE) AS official FROM (SELECT o_custkey, count(*) AS a, CASE WHEN o_custkey % 10 = 0 THEN NULL WHEN o_custkey % 7 = 0 THEN count(*) + 1 ELSE count(*) END AS b FROM orders GROUP BY o_custkey) WHERE abs(a - b) > 0.005 OR b IS NULL""")
def q07_parity(t):
    own = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    k = F.col("o_custkey")
    official = own.select("o_custkey", F.when(k % 10 == 0, None).when(k % 7 == 0, F.col("n") + 1).otherwise(F.col("n")).alias("n"))
    return quality.parity(own, official, ["o_custkey"], ["n"])


@query("""WITH p AS (SELECT a.s_suppkey AS a, b.s_suppkey AS b, a.s_suppkey % 3 AS won, b.s_suppkey % 3 AS lost FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey WHERE (a.s_suppkey + 2 * b.s_suppkey) % 11 <> 0)
SELECT x.a, x.b FROM p x LEFT JOIN p y ON x.a = y.b AND x.b = y.a WHERE y.a IS NULL OR x.won <> y.lost""")
def q10_symmetry(t):
    pairs = J.peer_pairs(t.supplier, ["s_nationkey"], "s_suppkey", []).select("s_nationkey", F.col("s_suppkey").alias("a"), F.col("peer_s_suppkey").alias("b")).where("(a + 2 * b) % 11 <> 0")
    return quality.asymmetric(pairs.withColumns({"won": F.col("a") % 3, "lost": F.col("b") % 3}), ["s_nationkey"], "a", "b", {"won": "lost"}).select("a", "b")


@query("""SELECT table_name, was, now, greatest(was - now, 0) AS lost, CASE table_name WHEN 'orders' THEN was <= now WHEN 'customer' THEN was - now <= 5 ELSE 100.0 * (was - now) <= 2 * was END AS is_allowed FROM (
SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS was, (SELECT count(*) FROM orders WHERE o_orderkey > 2) AS now UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer WHERE c_custkey > 3) UNION ALL SELECT 'part', (SELECT count(*) FROM part), (SELECT count(*) FROM part WHERE p_size > 1))""")
def q16_row_loss(t):
    count = lambda df, name: df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
    before = count(t.orders, "orders").unionByName(count(t.customer, "customer")).unionByName(count(t.part, "part"))
    after = count(t.orders.where("o_orderkey > 2"), "orders").unionByName(count(t.customer.where("c_custkey > 3"), "customer")).unionByName(count(t.part.where("p_size > 1"), "part"))
    return quality.row_loss(before, after, ["orders"], ["customer"])


# Published model


@query(f"""WITH {LAPS_SQL}, c AS (SELECT DISTINCT race_id, driver_id, 5 AS official_laps, CASE WHEN driver_id = 'd2' THEN 'shared_car' ELSE 'ok' END AS status FROM laps WHERE driver_id <> 'd3')
SELECT race_id, driver_id, lap_number, coalesce(lap_number > official_laps AND status <> 'shared_car', false) AS is_incomplete_lap, coalesce(status, 'unmatched_driver') AS quality_status FROM laps LEFT JOIN c USING (race_id, driver_id)""")
def r07_r19_lap_facts(t):
    x = laps(t)
    c = x.where("driver_id <> 'd3'").select("race_id", "driver_id").distinct().withColumns({"official_laps": F.lit(5), "status": F.when(F.col("driver_id") == "d2", "shared_car").otherwise("ok")})
    return marts.lap_facts(x, c).select("race_id", "driver_id", "lap_number", "is_incomplete_lap", "quality_status")


@query("""SELECT c_custkey, b.n_name AS born_in, n.n_name AS nation, r_name AS region FROM customer JOIN nation n ON c_nationkey = n.n_nationkey JOIN nation b ON (c_custkey % 25) = b.n_nationkey JOIN region ON n.n_regionkey = r_regionkey""")
def r21_dimension(t):
    c = t.customer.withColumn("born", F.col("c_custkey") % 25)
    out = marts.with_dimension(c, t.nation, "born", "n_nationkey", {"born_in": "n_name"})
    out = marts.with_dimension(out, t.nation, "c_nationkey", "n_nationkey", {"nation": "n_name", "_region": "n_regionkey"})
    return marts.with_dimension(out, t.region, "_region", "r_regionkey", {"region": "r_name"}).select("c_custkey", "born_in", "nation", "region")


@query(f"""WITH {RESULTS_SQL}, q AS (SELECT race_id, driver_id, position_display_order, position_number, least(points, CASE WHEN is_pole THEN points - 1 END) AS best FROM results WHERE session_type = 'RACE')
SELECT race_id, driver_id, position_display_order, coalesce(position_number = 1, false) AS is_pole, best AS best_time_ms, count(*) AS n FROM q GROUP BY ALL""")
def r22_session_facts(t):
    r = results(t).where("session_type = 'RACE'").withColumns({"q1_ms": F.col("points"), "q2_ms": F.when(F.col("is_pole"), F.col("points") - 1), "q3_ms": F.lit(None).cast("double"), "time_ms": F.lit(None).cast("double")}).drop("is_pole")
    return marts.qualifying_facts(r).groupBy("race_id", "driver_id", "position_display_order", "is_pole", "best_time_ms").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT user_id AS race_id, 'a' AS source, event_id, ts FROM events WHERE event_type = 'error' AND user_id % 3 = 0), b AS (SELECT user_id AS race_id, 'b' AS source, event_id, ts FROM events WHERE event_type = 'click'),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE race_id NOT IN (SELECT race_id FROM a)) SELECT race_id, source, event_id, CAST(row_number() OVER (PARTITION BY race_id ORDER BY ts, event_id) AS INT) AS seq FROM u""")
def r23_one_source_log(t):
    one = lambda kind, name: t.events.where(F.col("event_type") == kind).select(F.col("user_id").alias("race_id"), F.lit(name).alias("source"), "event_id", "ts")
    return marts.one_source_log(one("error", "a").where("race_id % 3 = 0"), one("click", "b"), ["ts", "event_id"], "seq").select("race_id", "source", "event_id", "seq")


@query("""SELECT user_id, event_id, epoch_us(ts) // 1000 AS sample_ms FROM events WHERE event_type = 'view'""")
def r27_sample_times(t):
    start = F.lit("2024-01-01").cast("timestamp")
    e = t.events.withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp")) - F.unix_millis(start))
    zero = e.select("user_id", (start + C.ms_interval("ms")).alias("utc"), "ms")
    out = flatten.sample_times(e.where("event_type = 'view'").select("user_id", "event_id", "ms"), zero, ["user_id"], "utc", "ms", "ms")
    return out.select("user_id", "event_id", C.epoch_ms("sample_utc").alias("sample_ms"))


@query("""SELECT k AS check_id, compared, matched, compared - matched AS missing FROM (SELECT 'rows:' || l_returnflag AS k, count(*) AS compared, count(*) FILTER (WHERE l_quantity > 1) AS matched FROM lineitem GROUP BY l_returnflag) WHERE compared > matched AND k IN ('rows:ok:A', 'rows:A', 'rows:N')""")
def q05_q15_q17_notices(t):
    card = quality.scorecard([quality.check(t.lineitem, "rows", {"ok": (F.lit(True), F.col("l_quantity") > 1)}, {"ok": 90.0}, ["l_returnflag"])])
    return quality.notices(card, ["rows:ok:A", "rows:ok:N"]).select(F.replace("check_id", F.lit(":ok")).alias("check_id"), "compared", "matched", "missing")


@query("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'P') <> (o_orderkey % 3 = 0) OR regexp_matches(o_orderpriority, '^[0-9]+$')")
def q14_domain_rules(t):
    return t.orders.where(((F.col("o_orderstatus") == "P") != (F.col("o_orderkey") % 3 == 0)) | F.col("o_orderpriority").rlike("^[0-9]+$")).select("o_orderkey")


@query(f"""WITH {RESULTS_SQL}, y AS (SELECT season, driver_id, sum(points) AS own FROM results GROUP BY ALL), s AS (SELECT season, driver_id, sum(points) FILTER (WHERE driver_id <> 'd7') AS official FROM results GROUP BY ALL)
SELECT season, driver_id, own, official FROM y JOIN s USING (season, driver_id) WHERE official IS NULL""")
def q11_q12_consistency(t):
    own = results(t).groupBy("season", "driver_id").agg(F.sum("points").alias("points"))
    official = own.withColumn("points", F.when(F.col("driver_id") != "d7", F.col("points")))
    return quality.parity(own, official, ["season", "driver_id"], ["points"]).drop("column_name")


@query("""WITH s AS (SELECT o_orderkey AS session_key, o_custkey AS meeting_key, year(o_orderdate) AS season, o_orderkey % 2 = 0 AS is_race, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 - 1 AS INT) AS d FROM orders WHERE o_orderkey % 7 <> 0),
r AS (SELECT min(o_orderkey) AS race_id, year(o_orderdate) AS season, CAST(o_orderdate AS DATE) AS d FROM orders GROUP BY ALL),
b AS (SELECT meeting_key, race_id, row_number() OVER (PARTITION BY session_key ORDER BY abs(date_diff('day', s.d, r.d)), race_id) AS rn FROM s JOIN r ON s.season = r.season AND abs(date_diff('day', s.d, r.d)) <= 1 WHERE is_race),
m AS (SELECT meeting_key, min(race_id) AS race_id FROM b WHERE rn = 1 GROUP BY 1) SELECT session_key, race_id, session_key % 5 = race_id % 3 OR session_key % 5 = race_id % 4 AS is_name_consistent FROM s JOIN m USING (meeting_key)""")
def r09_match_sessions(t):
    key = F.col("o_orderkey")
    letters = lambda c: F.translate(c.cast("string"), "0123456789", "ABCDEÉabcd")
    sessions = t.orders.select(
        key.alias("session_key"), F.col("o_custkey").alias("meeting_key"), F.year("o_orderdate").alias("season"), F.when(key % 2 == 0, "Race").otherwise("Qualifying").alias("session_name"),
        F.date_add(F.to_date("o_orderdate"), (key % 3 - 1).cast("int")).alias("local_date"), letters(key % 5).alias("country_name"), (key % 7 == 0).alias("is_cancelled"),
    )
    races = t.orders.groupBy(F.year("o_orderdate").alias("season"), F.to_date("o_orderdate").alias("race_date")).agg(F.min("o_orderkey").alias("race_id"))
    races = races.withColumns({"country": letters(F.col("race_id") % 3), "name": letters(F.col("race_id") % 4)})
    return feed.match_sessions(sessions, races, ["country", "name"]).select("session_key", "race_id", "is_name_consistent")


@query(f"""WITH {LAPS_SQL}, f AS (SELECT race_id, driver_id, min(lap_time_ms) AS best, arg_min(lap_number, (lap_time_ms, lap_number)) AS lap FROM laps GROUP BY ALL)
SELECT race_id, driver_id, abs(best - (best + race_id % 3)) <= 1 AS is_time_match, CASE WHEN race_id % 4 <> 0 THEN lap = lap + race_id % 2 END AS is_lap_match FROM f""")
def q03_fastest_lap_consistency(t):
    own = laps(t).groupBy("race_id", "driver_id").agg(F.min("lap_time_ms").alias("best"), F.min_by("lap_number", F.struct("lap_time_ms", "lap_number")).alias("at"))
    stated, lap = F.col("best") + F.col("race_id") % 3, F.when(F.col("race_id") % 4 != 0, F.col("at") + F.col("race_id") % 2)
    return own.select("race_id", "driver_id", C.match_flag(F.col("best"), stated, 1).alias("is_time_match"), C.match_flag(F.col("at"), lap).alias("is_lap_match"))
