"""Scalar functions and predicates on the given tables."""

from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.functions import names as N
from concordia.plans.base import cents, query


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1) THEN NULL ELSE o_orderkey % 3600000 END AS ms,
  CASE WHEN o_orderkey % 7 IN (0, 1) THEN NULL ELSE 86400000 * 2 + o_orderkey % 3600000 END AS exact_ms FROM orders""")
def x01_x02_durations(t):
    k = F.col("o_orderkey") % 3_600_000
    text = F.format_string("%d:%02d.%03d", F.floor(k / 60_000), F.floor(k % 60_000 / 1000), k % 1000)
    marked = F.when(F.col("o_orderkey") % 7 == 0, "-").when(F.col("o_orderkey") % 7 == 1, "+1 Lap").when(F.col("o_orderkey") % 7 == 2, F.concat(F.lit(" +"), text)).otherwise(text)
    exact = F.when(F.col("o_orderkey") % 7 <= 1, "DNF").otherwise(F.concat(F.lit("2 days "), text, F.lit("9")))
    return t.orders.select("o_orderkey", C.duration_ms(marked).alias("ms"), C.duration_ms_exact(exact).alias("exact_ms"))


@query("""SELECT s_suppkey, trim(regexp_replace(replace(regexp_replace(lower(strip_accents(n)), ' jr\\.', '', 'g'), '-', ' '), '[^a-z ]', '', 'g')) AS name
  FROM (SELECT s_suppkey, s_name || CASE s_suppkey % 4 WHEN 0 THEN ' Jr.' WHEN 1 THEN ' Éñü-Øx' WHEN 2 THEN ' Ångström Ł' ELSE ' ćž-İ' END AS n FROM supplier)""")
def x03_normalized_names(t):
    more = F.element_at(F.array(*map(F.lit, [" Jr.", " Éñü-Øx", " Ångström Ł", " ćž-İ"])), (F.col("s_suppkey") % 4 + 1).cast("int"))
    return t.supplier.select("s_suppkey", N.normalized_name(F.concat("s_name", more)).alias("name"))


@query("""SELECT page_id, try_cast(regexp_extract(url, '([0-9]+)', 1) AS INT) AS n, ends_with(url, '.html') AS is_html, contains(url, '?') AS has_query, url LIKE 'https%' AS is_https,
  regexp_matches(url, '#[a-z]+$') AS has_anchor, upper(replace(regexp_extract(url, '://([^/]+)', 1), '.', '_')) AS host FROM pages""")
def x04_x05_x06_text_tests(t):
    u = F.col("url")
    number = F.regexp_extract(u, "([0-9]+)", 1)
    return t.pages.select("page_id", number.try_cast("int").alias("n"), u.endswith(".html").alias("is_html"), u.contains("?").alias("has_query"), u.like("https%").alias("is_https"), u.rlike("#[a-z]+$").alias("has_anchor"), F.upper(F.replace(F.regexp_extract(u, "://([^/]+)", 1), F.lit("."), F.lit("_"))).alias("host"))


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'FILLED' ELSE o_orderstatus END AS status, regexp_matches(o_orderpriority, '[45]') AS is_low,
  CASE WHEN upper(o_orderpriority) IN ('4-NOT SPECIFIED', '') THEN NULL ELSE upper(o_orderpriority) END AS priority FROM orders""")
def x07_x08_p12_codes(t):
    return t.orders.select("o_orderkey", C.code_map("o_orderstatus", {"O": "OPEN", "F": "FILLED"}).alias("status"), C.has_code("o_orderpriority", "45").alias("is_low"), C.placeholder_null("o_orderpriority", ["4-NOT SPECIFIED", ""]).alias("priority"))


@query("""SELECT event_id, CASE WHEN event_type = 'error' AND value > 20 THEN 'severe' WHEN event_type = 'error' THEN 'error' WHEN props LIKE '%"k": 1%' THEN 'one' WHEN event_type IN ('view', 'click') THEN 'traffic' ELSE 'other' END AS class FROM events""")
def x09_x21_event_class(t):
    kind = F.col("event_type")
    return t.events.select("event_id", C.classify([((kind == "error") & (F.col("value") > 20), "severe"), (kind == "error", "error"), (F.col("props").contains('"k": 1'), "one"), (kind.isin("view", "click"), "traffic")], "other").alias("class"))


@query("""SELECT event_id, epoch_us(ts) // 1000 AS ms, CAST(ts + INTERVAL 9 HOUR + INTERVAL 30 MINUTE AS DATE) AS local_date, abs(date_diff('day', CAST(ts AS DATE), DATE '2024-01-15')) AS days,
  epoch_us(ts + to_milliseconds(1500)) // 1000 AS later_ms FROM events""")
def x10_x11_x12_x13_times(t):
    ts = C.utc_timestamp(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")))
    return t.events.select("event_id", C.epoch_ms(ts).alias("ms"), C.local_date(ts, F.lit("09:30:00")).alias("local_date"), C.days_apart(ts.cast("date"), F.lit("2024-01-15").cast("date")).alias("days"), C.epoch_ms(ts + C.ms_interval(F.lit(1500))).alias("later_ms"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, least(a, b, c) AS low, greatest(a, b, c) AS high, coalesce(b, a) AS first_known FROM
  (SELECT *, CAST(l_linenumber AS BIGINT) AS a, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_partkey END AS b, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_suppkey END AS c FROM lineitem)""")
def x14_x15_x22_least_greatest(t):
    a, b, c = F.col("l_linenumber").cast("long"), F.when(F.col("l_returnflag") != "N", F.col("l_partkey")), F.when(F.col("l_linestatus") != "O", F.col("l_suppkey"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.least(a, b, c).alias("low"), F.greatest(a, b, c).alias("high"), F.coalesce(b, a).alias("first_known"))


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, array_to_string([x FOR x IN [CASE WHEN c % 3 = 0 THEN 'b' END, CASE WHEN c % 2 = 0 THEN 'c' END, CASE WHEN l_returnflag = 'R' THEN 'late' END] IF x IS NOT NULL], ',') AS tags,
  l_returnflag = 'R' OR c % 2 = 0 AS has_c_or_late, (c % 10) * (c % 10) + 1 AS folded FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem)""")
def x16_x17_x18_arrays(t):
    c = cents("l_extendedprice")
    tags = C.compact(F.when(c % 3 == 0, "b"), F.when(c % 2 == 0, "c"))
    tags = F.when(F.col("l_returnflag") == "R", F.array_append(tags, F.lit("late"))).otherwise(tags)
    squares = F.transform(F.array(c % 10, F.lit(1).cast("long")), lambda x: x * x)
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.array_join(tags, ",").alias("tags"), (F.array_contains(tags, "late") | F.array_contains(tags, "c")).alias("has_c_or_late"), F.aggregate(squares, F.lit(0).cast("long"), lambda s, x: s + x).alias("folded"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS k, CASE WHEN event_type = 'error' THEN '{"id":' || user_id || ',"name":"' || event_type || '"}' END AS ref FROM events""")
def x19_x20_json(t):
    ref = F.when(F.col("event_type") == "error", F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name")))
    return t.events.select("event_id", C.json_number("props", "$.k").alias("k"), F.to_json(ref).alias("ref"))


@query("""SELECT o_orderkey, a IS NOT DISTINCT FROM b AS is_same, abs(a - b) <= 1 AS is_within, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a = b END AS is_match FROM
  (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 10 END AS a, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey % 10 + o_orderkey % 4 - 1 END AS b FROM orders)""")
def p09_p10_p11_unknowns(t):
    a, b = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey") % 10), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 10 + F.col("o_orderkey") % 4 - 1)
    return t.orders.select("o_orderkey", C.same(a, b).alias("is_same"), C.within(a, b, 1).alias("is_within"), C.match_flag(a, b).alias("is_match"))


@query("SELECT c_custkey AS customer_id, trim(c_name) AS full_name, CAST(c_nationkey AS BIGINT) AS nation_id, 'crm' AS source, CAST(NULL AS VARCHAR) AS note FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_acctbal > 0")
def p01_p04_p05_p06_p07_project(t):
    from concordia.sources.readers import rename_cast

    kept = t.customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & (F.col("c_acctbal") > 0))
    kept = kept.withColumns({"c_name": F.trim("c_name")}).drop("c_acctbal", "c_mktsegment")
    return rename_cast(kept, {"c_custkey": ("customer_id", "bigint"), "c_name": ("full_name", "string"), "c_nationkey": ("nation_id", "bigint")}).withColumns({"source": F.lit("crm"), "note": F.lit(None).cast("string")})


@query("SELECT l_returnflag, l_linestatus, l_linenumber FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem) WHERE try_cast(CASE WHEN l_linenumber % 2 = 0 THEN 'Grid' ELSE CAST(l_linenumber AS VARCHAR) END AS INT) IS NOT NULL")
def p03_p08_distinct_data_rows(t):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").dropDuplicates()
    lap = F.when(F.col("l_linenumber") % 2 == 0, "Grid").otherwise(F.col("l_linenumber").cast("string"))
    return rows.where(lap.try_cast("int").isNotNull())


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (3, 5, 7) AND contains(lower(s_name), 'supplier') ")
def p13_p14_p15_optional_search(t):
    wanted = {"s_nationkey": [3, 5, 7], "s_suppkey": None}
    test = N.name_contains("s_name", "SÚPPLIER")
    for c, w in wanted.items():
        test = test & C.in_optional(c, w)
    return t.supplier.where(test).select("s_suppkey", "s_name")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CASE WHEN v IS NOT NULL AND list_bool_or([abs(x - v) <= 1 FOR x IN known]) THEN 'confirmed' WHEN v IS NULL OR len(known) = 0 THEN 'single_source'
  WHEN l_linenumber = 1 OR list_min([abs(x - v) FOR x IN known]) < 1000 OR v > 9000000 OR list_bool_or([x > 9000000 FOR x IN known]) THEN 'timing_convention' ELSE 'disputed' END AS status,
  array_to_string([n FOR n IN [CASE WHEN abs(b - v) <= 1 THEN 'b' END, CASE WHEN abs(c - v) <= 1 THEN 'c' END] IF n IS NOT NULL], ',') AS confirmed_by
  FROM (SELECT *, [x FOR x IN [b, c] IF x IS NOT NULL] AS known FROM (SELECT *, CASE WHEN l_partkey % 10 = 0 THEN NULL ELSE p + l_partkey % 3 * 700 END AS b, CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE p + l_suppkey % 5 * 800 END AS c, CASE WHEN l_orderkey % 20 <> 0 THEN p END AS v
  FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS p FROM lineitem)))""")
def r12_r13_validation_status(t):
    p = cents("l_extendedprice")
    b, c = F.when(F.col("l_partkey") % 10 != 0, p + F.col("l_partkey") % 3 * 700), F.when(F.col("l_suppkey") % 4 != 0, p + F.col("l_suppkey") % 5 * 800)
    df = t.lineitem.withColumns({"b": b, "c": c, "v": F.when(F.col("l_orderkey") % 20 != 0, p)})
    status = C.validation_status("v", [F.col("b"), F.col("c")], F.col("l_linenumber") == 1, longest=9_000_000)
    return df.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", status.alias("status"), F.array_join(C.confirmed_by("v", {"b": F.col("b"), "c": F.col("c")}), ",").alias("confirmed_by"))
