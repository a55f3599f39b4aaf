"""Scans, optional sources, idempotent sinks and work lists."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_glob(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder or glob, columns united by name, partition folders not as columns."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a glob matches anything, in whatever store Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def optional_source(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A source that may not be there yet: its rows with the declared columns, or a typed empty relation."""
    wanted = spark.createDataFrame([], schema)
    if not path_exists(spark, path):
        return wanted
    found = read_glob(spark, path)
    have = {c.lower(): c for c in found.columns}
    return found.select(*[(F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted.schema])


def read_csv_text(spark: SparkSession, path: str, na: str = "\\N", sep: str = ",") -> DataFrame:
    """A CSV with a header, all columns as text, `na` as null."""
    return spark.read.csv(path, header=True, nullValue=na, inferSchema=False, sep=sep)


def read_seed(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True, sep=sep)


#: Names of a database's base tables, where it has the standard catalogue.
BASE_TABLES = "SELECT table_name FROM information_schema.tables WHERE table_type = 'BASE TABLE'"


def base_tables(spark: SparkSession, url: str, catalogue: str = BASE_TABLES, **options: str) -> list[str]:
    """The base tables of a JDBC source, by its catalogue query (one column of names)."""
    return sorted(r[0] for r in spark.read.format("jdbc").options(url=url, query=catalogue, **options).load().collect())


def read_database(spark: SparkSession, url: str, table: str, bounds: tuple[str, int] | None = None, **options: str) -> DataFrame:
    """A table of a JDBC source; with bounds (an integer, date or timestamp column, parts) read in as many ranges of that
    column between its least and largest value. Rows with a null there are in the first range. A table without rows is read whole."""
    read = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if bounds is not None:
        column, parts = bounds
        ends = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
        low, high = spark.read.format("jdbc").options(url=url, query=ends, **options).load().first()
        if low is not None:
            read = read.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts))
    return read.load()


def counted_write(df: DataFrame, path: str, **options: str) -> int:
    """Writes df as Parquet in place of what is there; its rows, counted while they are written."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").options(**options).parquet(path)
    return seen.get["rows"]


def copy_database(spark: SparkSession, url: str, out: str, tables: Iterable[str] | None = None, catalogue: str = BASE_TABLES, bounds: dict[str, tuple[str, int]] | None = None, **options: str) -> dict[str, int]:
    """Every table (None: every base table) of a JDBC source as Parquet; rows by table, counted while they are written.

    bounds: by table what `read_database` cuts it by; other tables are read by one task."""
    names = base_tables(spark, url, catalogue, **options) if tables is None else tables
    return {name: counted_write(read_database(spark, url, name, (bounds or {}).get(name), **options), f"{out}/{name}") for name in names}


def snake_case(df: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Headers renamed by `names`, then in snake_case."""
    new = [(names or {}).get(c, c) for c in df.columns]
    return df.toDF(*[re.sub(r"_+", "_", re.sub(r"[^0-9a-zA-Z]+", "_", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", n))).strip("_").lower() for n in new])


def without_repeats(df: DataFrame) -> tuple[DataFrame, int]:
    """Distinct rows and how many went."""
    out = df.dropDuplicates()
    return out, df.count() - out.count()


def rename_cast(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """The staging projection: column -> (name, type); bad values become null."""
    return df.select(*[F.col(c).try_cast(kind).alias(name) for c, (name, kind) in columns.items()])


def write_partitions(df: DataFrame, path: str, partition: list[str]) -> None:
    """Loading a partition again replaces it and leaves the others; rows are dealt by partition so each has few files."""
    df.repartition(*partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def write_if_changed(df: DataFrame, path: str) -> bool:
    """Writes unless the path already holds these rows."""
    from concordia.operators.quality import same_rows

    spark = df.sparkSession
    if path_exists(spark, path) and spark.read.parquet(path).columns == df.columns and same_rows(df, spark.read.parquet(path)):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def export_tables(tables: dict[str, DataFrame], out: str) -> dict[str, int]:
    """Each table as zstd Parquet; rows by table, counted while they are written."""
    return {name: counted_write(df, f"{out}/{name}", compression="zstd") for name, df in tables.items()}


#: Rows of a mart's bucket. One task reads a bucket, sorts and groups it: the number of buckets grows with the rows, so its memory doesn't.
BUCKET_ROWS = 400_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets of a mart with so many rows."""
    return max(least, -(-rows // BUCKET_ROWS))


def publish_mart(df: DataFrame, name: str, path: str, bucket: list[str], buckets: int = 8, partition: list[str] | None = None) -> DataFrame:
    """A published table at path: folders by `partition`, files bucketed and sorted by `bucket`. Joins and groups of such
    tables on the bucket's columns need no exchange, and filters on the partition read only its files."""
    write = df.repartition(buckets, *bucket).write.mode("overwrite").bucketBy(buckets, *bucket).sortBy(*bucket).option("path", path)
    (write.partitionBy(*partition) if partition else write).saveAsTable(name)
    return df.sparkSession.table(name).select(*df.columns)


def publish(df: DataFrame, layer: str, name: str, as_table: bool) -> DataFrame:
    """A view for light layers, a table of the layer's database for published ones."""
    spark = df.sparkSession
    if not as_table:
        df.createOrReplaceTempView(f"{layer}_{name}")
        return df
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    df.write.mode("overwrite").saveAsTable(f"{layer}.{name}")
    return spark.table(f"{layer}.{name}")


def fixture(df: DataFrame, test: Column | None = None) -> DataFrame:
    """A deterministic extract: filtered, in the order of all columns."""
    return (df if test is None else df.where(test)).orderBy(*df.columns)


def completed(schedule: DataFrame, end: str, now, margin_hours: int = 6) -> DataFrame:
    return schedule.where(F.col(end) + F.expr(f"interval {margin_hours} hours") <= F.lit(now).cast("timestamp"))


def pending(calendar: DataFrame, loaded: DataFrame, gaps: DataFrame, on: list[str], end: str, now, margin_hours: int = 6) -> DataFrame:
    """Completed partitions that are neither loaded nor known gaps."""
    done = completed(calendar, end, now, margin_hours)
    return done.join(loaded.select(*on).distinct(), on, "left_anti").join(gaps.select(*on).distinct(), on, "left_anti")


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder below `spark.checkpoint.dir`, which all executors share; a local one only where that is unset and the
    session runs on one machine."""
    import tempfile
    import uuid

    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        top = "file://" + tempfile.gettempdir()
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"
