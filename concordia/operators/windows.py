"""Window recipes: picks, runs, gaps and islands. Every order is total, so results don't depend on reading order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_first(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key; Catalyst limits each task's groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") <= n).drop("_nth")


def sequence_number(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def gap_to_best(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.col(value) - F.min(value).over(Window.partitionBy(*keys)))


def percent_to_best(df: DataFrame, keys: list[str], value: str, name: str, digits: int = 3) -> DataFrame:
    return df.withColumn(name, F.round(100 * (F.col(value) / F.min(value).over(Window.partitionBy(*keys)) - 1), digits))


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Ties share a rank; nulls must be placed by the caller."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(*keys).orderBy(*order)))


def running_sum(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))


def distinct_count_over(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Distinct values of the keys on each row, by aggregation and a join, so that no set is held for a window. Null keys are
    keys like others, as in a window; null values don't count."""
    counts = df.groupBy(*keys).agg(F.count_distinct(value).cast("int").alias(name))
    return join_null_safe(df, counts, keys)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which nulls equal nulls; the left side's keys stay, a right side's other columns follow."""
    test = None
    for k in keys:
        same = F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
        test = same if test is None else test & same
    rest = [] if how in ("left_semi", "left_anti") else [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), test, how).select("l.*", *rest)


def islands(df: DataFrame, keys: list[str], order: list[Column], boundary: Column, name: str) -> DataFrame:
    """Numbers the runs of each key: a row where `boundary` holds begins a new one. boundary may use `previous()`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = df.withColumn("_new", F.when(F.coalesce(boundary, F.lit(False)), 1).otherwise(0))
    return marked.withColumn(name, F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def previous(value: Column, keys: list[str], order: list[Column]) -> Column:
    return F.lag(value).over(Window.partitionBy(*keys).orderBy(*order))


def following(value: Column, keys: list[str], order: list[Column]) -> Column:
    return F.lead(value).over(Window.partitionBy(*keys).orderBy(*order))


def first_of_bin(df: DataFrame, keys: list[str], value: str, step: float, order: list[Column]) -> DataFrame:
    """Downsampling: the first row of each `step` wide bin of value; the bin is kept as `bin`."""
    return pick_first(df.withColumn("bin", F.floor(F.col(value) / step)), [*keys, "bin"], order)


def top(df: DataFrame, order: list[Column], n: int, offset: int = 0) -> DataFrame:
    out = df.orderBy(*order)
    return (out.offset(offset) if offset else out).limit(n)


def leaders_history(df: DataFrame, entity: str, step: str, value: str, n: int) -> DataFrame:
    """All rows of the n entities that lead at the last step (ties by entity)."""
    last = df.agg(F.max(step).alias("_last"))
    lead = df.join(F.broadcast(last), F.col(step) == F.col("_last")).orderBy(F.desc_nulls_last(value), entity).limit(n).select(entity)
    return df.join(F.broadcast(lead), entity, "left_semi")
