"""Joins, aggregates, windows, sorts and set operations on the given tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from concordia.functions import columns as C
from concordia.operators import aggregates as A
from concordia.operators import joins as J
from concordia.operators import windows as W
from concordia.plans.base import cents, query

# Joins


@query("""SELECT s_suppkey, s.n_name AS nation, r.r_name AS region, home.n_name AS peer_nation FROM supplier
  JOIN nation s ON s_nationkey = s.n_nationkey LEFT JOIN region r ON s.n_regionkey = r.r_regionkey JOIN nation home ON (s_nationkey + 5) % 25 = home.n_nationkey""")
def j01_j02_role_dimensions(t):
    n = t.nation
    out = t.supplier.join(J.broadcast_if_small(n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"), "n_regionkey")), "s_nationkey")
    out = out.join(J.broadcast_if_small(t.region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    home = n.select(F.col("n_nationkey").alias("home"), F.col("n_name").alias("peer_nation"))
    return out.join(J.broadcast_if_small(home), (F.col("s_nationkey") + 5) % 25 == F.col("home")).select("s_suppkey", "nation", F.col("r_name").alias("region"), "peer_nation")


@query("""SELECT coalesce(a.k, b.k) AS order_id, a.k IS NOT NULL AS in_left, b.k IS NOT NULL AS in_right, status, lines FROM
  (SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderkey % 3 <> 0) a FULL JOIN (SELECT l_orderkey AS k, count(*) AS lines FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY 1) b ON a.k = b.k""")
def j03_full_reconcile(t):
    a = t.orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    b = t.lineitem.where("l_orderkey % 4 <> 0").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.count("*").alias("lines"))
    return J.full_reconcile(a, b, ["order_id"])


@query("""SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS has_filled FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')""")
def j04_j05_semi_anti(t):
    calm = t.customer.join(t.orders.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    filled = t.orders.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("has_filled", F.lit(True))
    return calm.join(filled, "c_custkey", "left").select("c_custkey", F.coalesce("has_filled", F.lit(False)).alias("has_filled"))


_ASOF = """SELECT p.event_id, e.event_id AS last_id, e.event_type AS last_type FROM (SELECT * FROM events WHERE event_type = 'purchase') p
  ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') e ON p.user_id = e.user_id AND p.ts {} >= e.ts"""


@query(_ASOF.format(""))
def j07_asof(t):
    e = t.events
    right = e.where("event_type <> 'purchase'").select("user_id", F.col("ts").alias("rts"), F.col("event_id").alias("last_id"), F.col("event_type").alias("last_type"))
    return J.asof_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "rts", ["last_id", "last_type"]).select("event_id", "last_id", "last_type")


@query(_ASOF.format("+ INTERVAL 2 HOUR"))
def j07_asof_tolerance(t):
    e = t.events
    right = e.where("event_type <> 'purchase'").select("user_id", F.col("ts").alias("rts"), F.col("event_id").alias("last_id"), F.col("event_type").alias("last_type"))
    return J.asof_join(e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), right, ["user_id"], "ts", "rts", ["last_id", "last_type"], F.expr("interval 2 hours")).select("event_id", "last_id", "last_type")


def _spans(t):
    end = F.when(F.col("event_id") % 10 != 0, F.col("ts") + F.make_interval(mins=F.floor(F.col("value") * 10).cast("int")))
    return t.events.where("event_type = 'signup'").select("user_id", F.col("event_id").alias("span_id"), F.col("ts").alias("span_start"), end.alias("span_end"))


_SPANS = "spans AS (SELECT user_id, event_id AS span_id, ts AS span_start, CASE WHEN event_id % 10 <> 0 THEN ts + to_minutes(CAST(floor(value * 10) AS INT)) END AS span_end FROM events WHERE event_type = 'signup')"


@query(f"WITH {_SPANS} SELECT event_id, span_id FROM events e JOIN spans s ON e.user_id = s.user_id AND ts >= span_start AND (span_end IS NULL OR ts <= span_end) WHERE event_type = 'click'")
def j08_point_in_interval(t):
    clicks = t.events.where("event_type = 'click'").select("user_id", "event_id", "ts")
    return J.interval_join(clicks, _spans(t), ["user_id"], "ts", "span_start", "span_end").select("event_id", "span_id")


@query(f"""WITH {_SPANS} SELECT event_id, coalesce(bool_or(span_start < e.ts + INTERVAL 3 HOUR AND coalesce(span_end, e.ts + INTERVAL 3 HOUR) > e.ts), false) AS is_overlapped
  FROM (SELECT * FROM events WHERE event_type = 'view') e LEFT JOIN spans s ON e.user_id = s.user_id GROUP BY event_id""")
def j09_interval_overlap(t):
    views = t.events.where("event_type = 'view'").select("user_id", "event_id", F.col("ts").alias("a"), (F.col("ts") + F.expr("interval 3 hours")).alias("b"))
    return J.overlaps(views, _spans(t), ["user_id"], ("a", "b"), ("span_start", "span_end"), "is_overlapped").select("event_id", "is_overlapped")


@query("""SELECT s.event_id, min(e.ts) AS ended_at FROM (SELECT * FROM events WHERE event_type = 'error') s LEFT JOIN (SELECT * FROM events WHERE event_type IN ('signup', 'click')) e
  ON s.user_id = e.user_id AND e.ts > s.ts GROUP BY s.event_id""")
def j10_first_end_after(t):
    e = t.events.select("user_id", "event_id", "ts", "event_type")
    return J.first_end_after(e, ["user_id"], "ts", F.col("event_type") == "error", F.col("event_type").isin("signup", "click")).select("event_id", "ended_at")


@query(f"WITH {_SPANS} SELECT span_id FROM spans s WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.user_id AND event_type = 'error' AND e.ts >= span_start AND (span_end IS NULL OR e.ts <= span_end))")
def j11_range_exists(t):
    errors = t.events.where("event_type = 'error'").select("user_id", F.col("ts").alias("at"))
    s = _spans(t)
    inside = (F.col("at") >= F.col("span_start")) & (F.col("span_end").isNull() | (F.col("at") <= F.col("span_end")))
    return s.alias("s").join(errors.alias("e"), (F.col("s.user_id") == F.col("e.user_id")) & inside, "left_semi").select("span_id")


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, EXISTS (SELECT 1 FROM lineitem f WHERE f.l_orderkey = l.l_orderkey AND f.l_returnflag = 'R' AND f.l_linenumber BETWEEN l.l_linenumber - 3 AND l.l_linenumber) AS is_near FROM lineitem l""")
def j12_flag_within_previous(t):
    return J.flag_within_previous(t.lineitem, ["l_orderkey"], "l_linenumber", F.col("l_returnflag") == "R", 3, "is_near").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "is_near")


@query("""SELECT event_id, o_orderkey FROM (SELECT event_id, o_orderkey, row_number() OVER (PARTITION BY event_id ORDER BY abs(date_diff('day', day, CAST(o_orderdate AS DATE))), o_orderkey) AS rn
  FROM (SELECT event_id, user_id, CAST(ts AS DATE) - 9500 + CAST(event_id % 2000 AS INT) AS day FROM events) e JOIN orders ON o_custkey = user_id AND abs(date_diff('day', day, CAST(o_orderdate AS DATE))) <= 1) WHERE rn = 1""")
def j13_nearest_date(t):
    e = t.events.select("event_id", F.col("user_id").alias("o_custkey"), F.date_add(F.date_sub(F.to_date("ts"), 9500), (F.col("event_id") % 2000).cast("int")).alias("day"))
    return J.nearest_date(e, t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "event_id", "day", "o_orderdate", ["o_orderkey"]).select("event_id", "o_orderkey")


@query("SELECT s.s_suppkey, n_name, m.boss FROM supplier s JOIN nation ON s_nationkey = n_nationkey LEFT JOIN (SELECT s_nationkey AS k, min(s_suppkey) AS boss FROM supplier WHERE s_acctbal > 0 GROUP BY 1) m ON m.k = s.s_nationkey")
def j14_inherit_from_sibling(t):
    boss = t.supplier.where("s_acctbal > 0").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("boss"))
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(boss, "s_nationkey", "left").select("s_suppkey", "n_name", "boss")


@query("""SELECT a.s_suppkey, b.s_suppkey AS peer_s_suppkey FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey <> b.s_suppkey
  WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_nationkey = a.s_nationkey AND c_custkey = a.s_suppkey + b.s_suppkey)""")
def j15_j16_peer_pairs(t):
    pairs = J.peer_pairs(t.supplier, ["s_nationkey"], "s_suppkey", ["s_acctbal"])
    shared = t.customer.select(F.col("c_nationkey").alias("s_nationkey"), F.col("c_custkey").alias("both"))
    return pairs.withColumn("both", F.col("s_suppkey") + F.col("peer_s_suppkey")).join(shared, ["s_nationkey", "both"], "left_anti").select("s_suppkey", "peer_s_suppkey")


@query("""SELECT s_suppkey, CASE s_nationkey % 3 WHEN 0 THEN 'N' || s_nationkey WHEN 1 THEN 'R' || (s_nationkey % 5) END AS join_key, n FROM supplier LEFT JOIN
  (SELECT 'N' || n_nationkey AS k, n_regionkey AS n FROM nation UNION ALL SELECT 'R' || r_regionkey, r_regionkey FROM region) ON k = CASE s_nationkey % 3 WHEN 0 THEN 'N' || s_nationkey WHEN 1 THEN 'R' || (s_nationkey % 5) END""")
def j19_conditional_key(t):
    key = F.when(F.col("s_nationkey") % 3 == 0, F.concat(F.lit("N"), "s_nationkey")).when(F.col("s_nationkey") % 3 == 1, F.concat(F.lit("R"), F.col("s_nationkey") % 5))
    dims = t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("join_key"), F.col("n_regionkey").alias("n")).unionByName(t.region.select(F.concat(F.lit("R"), "r_regionkey").alias("join_key"), F.col("r_regionkey").alias("n")))
    return t.supplier.withColumn("join_key", key).join(J.broadcast_if_small(dims), "join_key", "left").select("s_suppkey", "join_key", "n")


@query("""SELECT l_returnflag, measure, count(*) AS n, CAST(sum(v) AS BIGINT) AS total FROM (SELECT l_returnflag, unnest(['discount', 'tax']) AS measure, unnest([CAST(round(l_discount * 100) AS BIGINT), CAST(round(l_tax * 100) AS BIGINT)]) AS v FROM lineitem) GROUP BY ALL""")
def j20_u08_unpivot(t):
    long = J.unpivot_pairs(t.lineitem, ["l_returnflag"], "measure", {"discount": [cents("l_discount")], "tax": [cents("l_tax")]}, ["v"])
    return long.groupBy("l_returnflag", "measure").agg(F.count("*").alias("n"), F.sum("v").alias("total"))


@query("SELECT c_mktsegment, count(*) AS n, 100.0 * CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM customer) AS pct FROM customer GROUP BY 1")
def j21_share_of_total(t):
    n = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n"))
    return J.with_total(n, t.customer.agg(F.count("*").alias("_all"))).select("c_mktsegment", "n", C.percent("n", "_all").alias("pct"))


@query("""SELECT c_nationkey AS nation, 'customer' AS source, c_custkey AS id FROM customer WHERE c_nationkey % 2 = 0
  UNION ALL SELECT s_nationkey, 'supplier', s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey % 2 = 0)""")
def j22_prefer_source(t):
    a = t.customer.where("c_nationkey % 2 = 0").select(F.col("c_nationkey").alias("nation"), F.lit("customer").alias("source"), F.col("c_custkey").alias("id"))
    return J.prefer_source(a, t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id")), ["nation"])


# Aggregates


@query("""SELECT l_suppkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_partkey) FILTER (WHERE l_linestatus = 'O') AS open_parts,
  count(DISTINCT (l_linenumber, l_returnflag)) AS kinds, sum(l_quantity) FILTER (WHERE l_tax = 0.08 AND l_discount = 0.1) AS rare_quantity, bool_or(l_discount = 0.1) AS any_tenth, bool_and(l_quantity > 1) AS all_many, min(l_linestatus) AS any_status FROM lineitem GROUP BY 1""")
def a01_to_a07_counts(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), A.count_where(F.col("l_returnflag") == "R").alias("returned"), F.count_distinct("l_partkey").alias("parts"), A.distinct_where(F.col("l_linestatus") == "O", "l_partkey").alias("open_parts"),
        F.count_distinct(F.struct("l_linenumber", "l_returnflag")).alias("kinds"), A.sum_where((F.col("l_tax") == 0.08) & (F.col("l_discount") == 0.1), "l_quantity").alias("rare_quantity"),
        F.bool_or(F.col("l_discount") == 0.1).alias("any_tenth"), F.bool_and(F.col("l_quantity") > 1).alias("all_many"), F.min("l_linestatus").alias("any_status"),
    )


@query("SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders GROUP BY 1")
def a08_a09_last_by_tuple(t):
    return t.orders.groupBy("o_custkey").agg(A.top_value("o_orderkey", "o_orderdate", "o_orderkey").alias("last_order"), F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"))


@query("""WITH c AS (SELECT s_nationkey, p_brand, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL)
  SELECT s_nationkey, arg_min(p_brand, (-n, p_brand)) AS brand, max(n) AS brand_n, CAST(max(n) AS DOUBLE) / sum(n) AS brand_share FROM c GROUP BY 1""")
def a10_a17_a23_dominant(t):
    j = t.lineitem.select("l_suppkey", "l_partkey").join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return A.dominant(j, ["s_nationkey"], "p_brand", "brand").select("s_nationkey", "brand", "brand_n", "brand_share")


@query("SELECT l_returnflag, l_linestatus, median(l_quantity) AS median_quantity, CAST(sum(q * c) AS DOUBLE) / CAST(sum(c) AS DOUBLE) AS weighted FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem) GROUP BY ALL")
def a11_a22_median_weighted(t):
    df = t.lineitem.withColumns({"c": cents("l_extendedprice"), "q": F.col("l_quantity").cast("long")})
    return df.groupBy("l_returnflag", "l_linestatus").agg(F.median("l_quantity").alias("median_quantity"), A.weighted_mean("q", "c").alias("weighted"))


@query("""SELECT o_custkey, array_to_string(list(o_orderkey ORDER BY o_orderdate, o_orderkey), ',') AS orders, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses,
  coalesce(array_to_string(list(o_orderkey ORDER BY o_orderdate, o_orderkey) FILTER (WHERE o_orderstatus = 'F'), ','), '') AS filled, count(DISTINCT {'s': o_orderstatus, 'p': o_orderpriority}) AS pairs FROM orders GROUP BY 1""")
def a12_a13_ordered_lists(t):
    filled = A.ordered_list(["o_orderdate", "o_orderkey"], "o_orderkey", F.col("o_orderstatus") == "F")
    return t.orders.groupBy("o_custkey").agg(F.array_join(A.ordered_list(["o_orderdate", "o_orderkey"], "o_orderkey"), ",").alias("orders"), F.array_join(F.array_sort(F.collect_set("o_orderstatus")), ",").alias("statuses"), F.array_join(filled, ",").alias("filled"), F.size(F.array_sort(F.collect_set(F.struct("o_orderstatus", "o_orderpriority")))).cast("long").alias("pairs"))


@query("SELECT o_custkey, min(o_orderpriority) AS priority, count(*) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) = 2 AND count(*) > 2")
def a14_having(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderpriority").alias("priority"), F.count("*").alias("n"), F.count_distinct("o_orderpriority").alias("p")).where("p = 2 and n > 2").drop("p")


@query("SELECT o_custkey, " + ", ".join(f"max(o_orderkey) FILTER (WHERE o_orderstatus = '{s}') AS {s}" for s in "FOP") + " FROM orders GROUP BY 1")
def a15_pivot(t):
    return A.pivot_corrections(t.orders, ["o_custkey"], "o_orderstatus", "o_orderkey", ["F", "O", "P"])


@query("""SELECT c_nationkey, count(*) AS buyers, CAST(sum(n) AS BIGINT) AS orders, max(n) AS most, CAST(round(10000.0 * count(*) FILTER (WHERE n > 10) / count(*)) AS BIGINT) AS busy FROM
  (SELECT c_nationkey, o_custkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) GROUP BY 1""")
def a16_a18_two_levels(t):
    by = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey")
    return by.groupBy("c_nationkey").agg(F.count("*").alias("buyers"), F.sum("n").alias("orders"), F.max("n").alias("most"), A.count_where(F.col("n") > 10).alias("b")).select("c_nationkey", "buyers", "orders", "most", F.round(100 * C.percent("b", "buyers")).cast("long").alias("busy"))


@query("SELECT o_custkey, min(o_orderdate) AS first_day, max(epoch_ms(o_orderdate) - o_orderkey * 1000) AS zero_ms FROM orders GROUP BY 1")
def a19_a24_earliest_and_clock(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"), F.max(C.epoch_ms("o_orderdate") - F.col("o_orderkey") * 1000).alias("zero_ms"))


@query("SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS mean_small, count(*) AS n FROM lineitem WHERE l_quantity <= 30 GROUP BY 1")
def a20_a21_capped_mean(t):
    return t.lineitem.where("l_quantity <= 30").groupBy("l_suppkey").agg(F.avg("l_quantity").alias("mean_small"), F.count("*").alias("n"))


@query("""SELECT o_orderkey, expected, coalesce(n, 0) AS n, expected > 0 AND coalesce(n, 0) >= 0.95 * expected AS is_covered FROM (SELECT o_orderkey, o_orderkey % 6 AS expected FROM orders)
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def a25_coverage(t):
    expected = t.orders.select("o_orderkey", (F.col("o_orderkey") % 6).alias("expected"))
    return A.coverage(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey")), expected, ["o_orderkey"], "expected")


# Windows

_ORDER = ["o_orderdate", "o_orderkey"]


@query("""SELECT o_orderkey, lead(o_orderkey) OVER w AS next_order, lag(o_orderstatus) OVER w AS last_status, row_number() OVER w AS nth, o_orderkey = max(o_orderkey) OVER (PARTITION BY o_custkey) AS is_last_key,
  CAST(sum(o_orderkey % 100) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running, min(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS first_filled,
  count(*) OVER (PARTITION BY o_custkey) AS orders, bool_and(o_orderkey > 100) OVER (PARTITION BY o_custkey) AS all_late FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def w01_to_w13_windows(t):
    own, w = Window.partitionBy("o_custkey"), Window.partitionBy("o_custkey").orderBy(*_ORDER)
    df = W.running_sum(W.sequence_number(t.orders, ["o_custkey"], _ORDER, "nth"), ["o_custkey"], _ORDER, F.col("o_orderkey") % 100, "running")
    return df.select(
        "o_orderkey", F.lead("o_orderkey").over(w).alias("next_order"), F.lag("o_orderstatus").over(w).alias("last_status"), "nth", (F.col("o_orderkey") == F.max("o_orderkey").over(own)).alias("is_last_key"), "running",
        F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).over(own).alias("first_filled"), F.count("*").over(own).alias("orders"), F.bool_and(F.col("o_orderkey") > 100).over(own).alias("all_late"),
    )


@query("""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, c - min(c) OVER (PARTITION BY l_orderkey) AS gap, rank() OVER (PARTITION BY l_orderkey ORDER BY q NULLS LAST) AS place FROM
  (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c, CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS q FROM lineitem)""")
def w03_w07_gap_and_rank(t):
    df = t.lineitem.withColumns({"c": cents("l_extendedprice"), "q": F.when(F.col("l_returnflag") != "R", F.col("l_quantity"))})
    return W.ranked(W.gap_to_best(df, ["l_orderkey"], "c", "gap"), ["l_orderkey"], [F.asc_nulls_last("q")], "place").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "gap", "place")


@query("SELECT l_orderkey, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1")
def w05_w06_pick_first(t):
    return W.pick_first(t.lineitem, ["l_orderkey"], [F.desc("l_extendedprice"), "l_partkey", "l_suppkey", "l_linenumber"]).select("l_orderkey", "l_partkey", "l_suppkey")


@query("""SELECT DISTINCT l_orderkey, l_returnflag, CAST(d AS INT) AS statuses FROM lineitem JOIN (SELECT l_orderkey AS k, l_returnflag AS f, count(DISTINCT l_linestatus) AS d FROM lineitem GROUP BY ALL) ON k = l_orderkey AND f = l_returnflag""")
def w10_w11_distinct_over(t):
    return W.distinct_count_over(t.lineitem, ["l_orderkey", "l_returnflag"], "l_linestatus", "statuses").select("l_orderkey", "l_returnflag", "statuses").distinct()


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(floor(100000 * (q / min(q) OVER (PARTITION BY l_orderkey) - 1)) AS BIGINT) AS above FROM (SELECT *, l_quantity AS q FROM lineitem)")
def w14_percent_to_best(t):
    w = Window.partitionBy("l_orderkey")
    return t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.floor(100_000 * (F.col("l_quantity") / F.min("l_quantity").over(w) - 1)).alias("above"))


@query("""SELECT user_id, island, min(event_id) AS first_id, count(*) AS n, min(event_type) AS kind FROM (SELECT *, CAST(sum(CASE WHEN prev = 'error' OR prev <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS island
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events)) GROUP BY ALL""")
def w15_islands(t):
    order = ["ts", "event_id"]
    prev = t.events.withColumn("prev", W.previous(F.col("event_type"), ["user_id"], order))
    return W.islands(prev, ["user_id"], order, (F.col("prev") == "error") | (F.col("prev") != F.col("event_type")), "island").groupBy("user_id", "island").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n"), F.min("event_type").alias("kind"))


@query("SELECT user_id, bin, event_id FROM (SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS bin, event_id, row_number() OVER (PARTITION BY user_id, floor(value / 10) ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1")
def w17_first_of_bin(t):
    return W.first_of_bin(t.events, ["user_id"], "value", 10.0, ["ts", "event_id"]).select("user_id", "bin", "event_id")


# Sorts and sets


@query("""SELECT o_custkey, n, rank() OVER (ORDER BY n DESC) AS place, row_number() OVER (ORDER BY n DESC, o_custkey) AS nth FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 25)""")
def t01_t02_w16_w18_leaderboard(t):
    top = W.top(t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")), [F.desc_nulls_last("n"), F.col("o_custkey")], 25)
    return top.select("o_custkey", "n", F.rank().over(Window.orderBy(F.desc("n"))).alias("place"), F.row_number().over(Window.orderBy(F.desc("n"), "o_custkey")).alias("nth"))


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20 OFFSET 40")
def t03_page(t):
    return W.top(t.customer, [F.desc_nulls_last("c_acctbal"), F.col("c_custkey")], 20, 40).select("c_custkey", "c_name")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate <= TIMESTAMP '1998-06-30' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def t04_latest_before(t):
    return W.top(t.orders.where("o_orderdate <= timestamp '1998-06-30'"), [F.desc("o_orderdate"), F.desc("o_orderkey")], 1).select("o_orderkey", "o_orderdate")


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate) AS year, count(*) AS n FROM orders GROUP BY ALL), top AS (SELECT o_custkey FROM y WHERE year = (SELECT max(year) FROM y) ORDER BY n DESC, o_custkey LIMIT 10)
  SELECT o_custkey, CAST(year AS INT) AS year, n FROM y WHERE o_custkey IN (SELECT o_custkey FROM top)""")
def t05_leaders_history(t):
    y = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    return W.leaders_history(y, "o_custkey", "year", "n", 10).select("o_custkey", "year", "n")


@query("SELECT n_nationkey, n_name, CAST(list_position([7, 3, 11, 2], n_nationkey) AS INT) AS asked FROM nation WHERE n_nationkey IN (7, 3, 11, 2)")
def t06_t07_caller_order(t):
    place = F.array_position(F.array(*map(F.lit, [7, 3, 11, 2])), F.col("n_nationkey")).cast("int")
    return t.nation.where(F.col("n_nationkey").isin(7, 3, 11, 2)).select("n_nationkey", "n_name", place.alias("asked")).orderBy("asked")


@query("""SELECT kind, count(*) AS n FROM (SELECT 'union' AS kind FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier) UNION ALL SELECT 'both' FROM (SELECT c_custkey FROM customer INTERSECT SELECT s_suppkey FROM supplier)
  UNION ALL SELECT 'except' FROM (SELECT c_custkey FROM customer EXCEPT SELECT s_suppkey FROM supplier) UNION ALL SELECT 'values' FROM (VALUES (1), (2)) v UNION ALL SELECT 'named' FROM (SELECT c_custkey AS id FROM customer UNION ALL BY NAME SELECT s_suppkey AS id, s_name AS name FROM supplier)) GROUP BY 1""")
def u01_to_u07_sets(t):
    c, s = t.customer, t.supplier
    parts = {
        "union": c.select("c_nationkey").union(s.select("s_nationkey")).distinct(), "both": c.select("c_custkey").intersect(s.select("s_suppkey")), "except": c.select("c_custkey").exceptAll(s.select("s_suppkey")),
        "values": t.spark.range(1, 3), "named": c.select(F.col("c_custkey").alias("id")).unionByName(s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")), allowMissingColumns=True),
    }
    out = None
    for kind, df in parts.items():
        one = df.select(F.lit(kind).alias("kind"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("kind").agg(F.count("*").alias("n"))
