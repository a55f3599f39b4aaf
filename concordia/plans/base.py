"""Registry of queries: each runs library operators over the given tables and has DuckDB SQL for the same result."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordia.sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder, read when asked for: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def cents(column: str):
    return F.round(F.col(column) * 100).cast("long")


# Published marts: built on the first use and read by all queries of the session.


def _state(t: Tables, names: list[str]) -> str:
    """A name for the present files of some tables: their places, sizes and times."""
    files = []
    for name in names:
        path = t.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{t.folder}/{name}.parquet")
        system = path.getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
        found = system.listFiles(path, True)
        while found.hasNext():
            f = found.next()
            files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()[:24]


def published(t: Tables, name: str, sources: list[str], build: Callable[[Tables], DataFrame], bucket: list[str], partition: list[str] | None = None) -> DataFrame:
    """The mart as a table of the session: bucketed, partitioned, and made again only if files of its sources have changed.

    Its first source gives its rows at most, so marts of one first source have as many buckets and join without an exchange."""
    table = f"mart_{name}_{_state(t, sources)}"
    df = build(t)
    if t.spark.catalog.tableExists(table):
        return t.spark.table(table).select(*df.columns)
    buckets = readers.buckets_for(getattr(t, sources[0]).count())
    return readers.publish_mart(df, table, readers.workspace(t.spark, table), bucket, buckets, partition)


# Series that the queries share, derived by integer arithmetic so that both engines agree.

LAPS_SQL = """laps AS (SELECT l_orderkey // 4 AS race_id, 'd' || (l_orderkey % 4) AS driver_id, l_linenumber AS lap_number,
  60000 + min(CAST(round(l_extendedprice * 100) AS BIGINT)) % 100000 + CASE WHEN l_orderkey % 97 = 3 AND l_linenumber > 2 THEN 500000 ELSE 0 END AS lap_time_ms,
  CAST(min(l_quantity) AS INT) % 4 + 1 AS place FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def laps(t: Tables) -> DataFrame:
    return published(t, "laps", ["lineitem"], _laps, ["race_id"])


def _laps(t: Tables) -> DataFrame:
    g = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min(cents("l_extendedprice")).alias("c"), F.min("l_quantity").alias("q"))
    slow = F.when((F.col("l_orderkey") % 97 == 3) & (F.col("l_linenumber") > 2), 500_000).otherwise(0)
    return g.select(
        F.floor(F.col("l_orderkey") / 4).alias("race_id"), F.concat(F.lit("d"), F.col("l_orderkey") % 4).alias("driver_id"), F.col("l_linenumber").alias("lap_number"),
        (60_000 + F.col("c") % 100_000 + slow).alias("lap_time_ms"), (F.col("q").cast("int") % 4 + 1).alias("place"),
    )


RESULTS_SQL = """results AS (SELECT l_orderkey AS race_id, CAST(year(o_orderdate) AS INT) AS season, CASE WHEN l_tax = 0.08 THEN 'SPRINT' ELSE 'RACE' END AS session_type,
  'd' || (l_suppkey % 40) AS driver_id, 'c' || (l_suppkey % 8) AS constructor_id, 'n' || (l_partkey % 3) AS driver_number,
  CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS position_number, CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_quantity > 25 THEN 'DNS' ELSE 'DNF' END ELSE CAST(l_linenumber AS VARCHAR) END AS position_text,
  l_linenumber AS position_display_order, l_quantity AS points, l_discount = 0.05 AS is_pole, l_tax = 0.03 AS is_fastest_lap
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def results(t: Tables) -> DataFrame:
    return published(t, "results", ["lineitem", "orders"], _results, ["race_id"], ["season"])


def _results(t: Tables) -> DataFrame:
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    out = F.col("l_returnflag") == "R"
    return j.select(
        F.col("l_orderkey").alias("race_id"), F.year("o_orderdate").alias("season"), F.when(F.col("l_tax") == 0.08, "SPRINT").otherwise("RACE").alias("session_type"),
        F.concat(F.lit("d"), F.col("l_suppkey") % 40).alias("driver_id"), F.concat(F.lit("c"), F.col("l_suppkey") % 8).alias("constructor_id"), F.concat(F.lit("n"), F.col("l_partkey") % 3).alias("driver_number"),
        F.when(~out, F.col("l_linenumber")).alias("position_number"), F.when(out, F.when(F.col("l_quantity") > 25, "DNS").otherwise("DNF")).otherwise(F.col("l_linenumber").cast("string")).alias("position_text"),
        F.col("l_linenumber").alias("position_display_order"), F.col("l_quantity").alias("points"), (F.col("l_discount") == 0.05).alias("is_pole"), (F.col("l_tax") == 0.03).alias("is_fastest_lap"),
    )


def codes_sql(members: str) -> str:
    """CTEs from members (g, id, code or null, name or null, ran) to codes (g, id, chosen), member after member."""
    own = "upper(coalesce(code, substr(CASE WHEN ends_with(CAST(id AS VARCHAR), '-jr') THEN split_part(CAST(id AS VARCHAR), '-', -2) ELSE split_part(CAST(id AS VARCHAR), '-', -1) END, 1, 3)))"
    return f"""mem AS (SELECT g, id, {own} AS code, coalesce(nullif(upper(regexp_extract(strip_accents(coalesce(name, CAST(id AS VARCHAR))), '[A-Za-z]')), ''), 'X') AS initial, ran FROM ({members})),
bear AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (WHERE ran) OVER w AS r FROM mem WINDOW w AS (PARTITION BY g, code)), mark AS (SELECT *, n = 1 OR (ran AND r = 1) AS keeps FROM bear),
pend AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY id) AS i FROM mark WHERE NOT keeps),
steps(g, i, taken, id, chosen) AS (SELECT g, CAST(0 AS BIGINT), coalesce(list(code) FILTER (WHERE keeps), []), min(id), CAST(NULL AS VARCHAR) FROM mark GROUP BY g
  UNION ALL SELECT g, i, list_append(taken, c), id, c FROM (SELECT p.g, p.i, taken, p.id, CASE WHEN NOT list_contains(taken, initial || left(code, 2)) THEN initial || left(code, 2) WHEN NOT list_contains(taken, initial || code) THEN initial || code ELSE code || list_filter(range(2, len(taken) + 3), lambda k: NOT list_contains(taken, code || k))[1] END AS c FROM steps s JOIN pend p ON p.g = s.g AND p.i = s.i + 1)),
codes AS (SELECT g, id, code AS chosen FROM mark WHERE keeps UNION ALL SELECT g, id, chosen FROM steps WHERE i > 0)"""
