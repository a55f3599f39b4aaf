"""Sources and sinks: the given tables written, replaced and read again."""

from pyspark.sql import functions as F

from concordia.functions.columns import duration_ms_exact
from concordia.plans.base import cents, query
from concordia.sources import flatten, readers


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN 'X' ELSE o_orderstatus END AS status FROM orders")
def s01_s02_s07_partition_rewrite(t):
    path = readers.workspace(t.spark, "orders")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("season"))
    readers.write_partitions(rows, path, ["season"])
    readers.write_partitions(rows.where("season = 1998").withColumn("status", F.lit("X")), path, ["season"])
    return readers.read_glob(t.spark, path).select("o_orderkey", "status")


@query("SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS note FROM supplier")
def s03_optional_source(t):
    schema = "s_suppkey bigint, s_name string, note string"
    found = readers.optional_source(t.spark, f"{t.folder}/supplier.parquet", schema)
    return found.unionByName(readers.optional_source(t.spark, readers.workspace(t.spark, "absent"), schema))


@query("SELECT CAST(c_custkey AS VARCHAR) AS cust_key, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS mkt_segment FROM customer")
def s04_p02_csv_text(t):
    path = readers.workspace(t.spark, "csv")
    t.customer.select(F.col("c_custkey").alias("custKey"), F.when(F.col("c_custkey") % 3 == 0, "\\N").otherwise(F.col("c_mktsegment")).alias("Mkt Segment")).write.csv(path, header=True)
    return readers.snake_case(readers.read_csv_text(t.spark, path))


@query("SELECT n_nationkey, n_name FROM nation")
def s05_seed(t):
    path = readers.workspace(t.spark, "seed")
    t.nation.select("n_nationkey", "n_name").write.csv(path, header=True, sep=";")
    return readers.read_seed(t.spark, path, "n_nationkey int, n_name string", sep=";")


@query("SELECT 'part' AS name, count(*) AS n FROM part UNION ALL SELECT 'big_part', count(*) FROM part WHERE p_size > 25 UNION ALL SELECT 'written', 1")
def s08_s09_s10_s11_exports(t):
    path = readers.workspace(t.spark, "export")
    counts = readers.export_tables({"part": t.part, "big_part": readers.fixture(t.part, F.col("p_size") > 25)}, path)
    writes = [readers.write_if_changed(t.nation, f"{path}/nation") for _ in range(2)]
    view = readers.publish(t.spark.createDataFrame([(n, k) for n, k in counts.items()], "name string, n bigint"), "quality", "exports", as_table=False)
    return view.unionByName(t.spark.createDataFrame([("written", sum(writes))], "name string, n bigint"))


_ENTRIES = """e AS (SELECT l_orderkey, l_linenumber, min(l_suppkey) AS s, min(l_quantity) AS points, bool_and(l_returnflag <> 'R') AS ok, min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS c FROM lineitem GROUP BY ALL)"""


@query(f"""WITH {_ENTRIES} SELECT CAST(year(o_orderdate) AS INT) AS season, CAST(month(o_orderdate) AS INT) AS round, s_name AS driver, n_name AS team, l_linenumber AS car_number, CASE WHEN ok THEN CAST(l_linenumber AS VARCHAR) ELSE 'R' END AS position_text, points,
  CASE WHEN c % 2 = 0 THEN 2 ELSE 1 END AS fastest_lap, 60000 + CASE WHEN c % 2 = 0 THEN c % 1000 ELSE c % 1000 + 1 END AS fastest_ms FROM e JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON s = s_suppkey JOIN nation ON s_nationkey = n_nationkey""")
def j23_r28_r30_dump(t):
    e = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s"), F.min("l_quantity").alias("points"), F.bool_and(F.col("l_returnflag") != "R").alias("ok"), F.min(cents("l_extendedprice")).alias("c"))
    e = e.withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    round_id = (year * 100 + month).cast("long")
    dump = {
        "season": t.orders.select(year.cast("long").alias("id"), year.alias("year")).distinct(), "round": t.orders.select(round_id.alias("id"), year.cast("long").alias("season_id"), month.alias("number")).distinct(),
        "session": t.orders.select(F.col("o_orderkey").alias("id"), round_id.alias("round_id"), F.lit("R").alias("type")),
        "sessionentry": e.select("id", F.col("l_orderkey").alias("session_id"), F.col("id").alias("round_entry_id"), F.col("l_linenumber").alias("position"), F.col("ok").alias("is_classified"), F.lit(11).alias("status"), "points"),
        "roundentry": e.select("id", F.col("s").alias("team_driver_id"), F.col("l_linenumber").alias("car_number")), "teamdriver": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").alias("driver_id"), F.col("s_nationkey").alias("team_id")),
        "driver": t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("reference")), "team": t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("reference")),
    }
    k = F.col("c") % 1000
    text = lambda ms: F.format_string("1:%02d.%03d", F.floor(ms / 1000), ms % 1000)
    laps = e.select(F.col("id").alias("session_entry_id"), F.inline(F.array(F.struct(F.lit(1).alias("number"), text(k + 1).alias("time")), F.struct(F.lit(2).alias("number"), text(F.when(F.col("c") % 2 == 0, k).otherwise(k + 2)).alias("time")))))
    out = flatten.flat_results(flatten.flat_entries(dump), laps, {11: "R"})
    return out.select("season", "round", "driver", "team", "car_number", "position_text", "points", "fastest_lap", "fastest_ms")


@query(f"""WITH {_ENTRIES} SELECT l_orderkey AS entry, 70000 + min(c % 1000) FILTER (WHERE l_linenumber % 3 = 1) AS q1_ms, 70000 + min(c % 1000) FILTER (WHERE l_linenumber % 3 = 2) AS q2_ms, 70000 + min(c % 1000) FILTER (WHERE l_linenumber % 3 = 0) AS q3_ms FROM e GROUP BY 1""")
def r29_dump_qualifying(t):
    e = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min(cents("l_extendedprice")).alias("c"))
    kind = F.element_at(F.array(*map(F.lit, ("Q3", "Q1", "Q2"))), F.col("l_linenumber") % 3 + 1)
    entries = e.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.lit(2024).alias("season"), F.lit(1).alias("round"), F.col("l_orderkey").alias("driver"), F.lit("t").alias("team"), kind.alias("type"), F.col("l_linenumber").alias("position"))
    laps = e.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("session_entry_id"), F.format_string("1:10.%03d", F.col("c") % 1000).alias("time"))
    return flatten.flat_qualifying(entries, laps).select(F.col("driver").alias("entry"), "q1_ms", "q2_ms", "q3_ms")


@query("SELECT count(*) AS n, CAST(sum(ms) AS BIGINT) AS total FROM (SELECT 86400000 + o_orderkey % 60000 AS ms FROM orders)")
def x02_exact_sum(t):
    text = F.format_string("1 day 0:%02d.%03d", F.floor(F.col("o_orderkey") % 60_000 / 1000), F.col("o_orderkey") % 1000)
    ms = t.orders.select(duration_ms_exact(text).alias("ms"))
    return ms.agg(F.count("*").alias("n"), F.sum("ms").alias("total"))
