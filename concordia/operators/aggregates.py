"""Aggregates with total tie-breaks, pivots and shares. All combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(test: Column) -> Column:
    return F.count_if(test)


def distinct_where(test: Column, *values: str | Column) -> Column:
    """Distinct tuples among rows where the test holds; a tuple with null parts counts."""
    return F.count_distinct(F.when(test, F.struct(*values)))


def sum_where(test: Column, value: str | Column) -> Column:
    """Null if the test holds nowhere."""
    return F.sum(F.when(test, value if isinstance(value, Column) else F.col(value)))


def top_value(value: str, *ranking: Column | str) -> Column:
    """The value of the row with the largest ranking tuple."""
    return F.max_by(F.col(value), F.struct(*ranking))


def dominant(df: DataFrame, keys: list[str], value: str, name: str, ranking: list[Column] | None = None) -> DataFrame:
    """The commonest value of each key with its count and share: `name`, `name`_n, `name`_share.

    Ties go to the largest `ranking` of the value, by default to the smallest value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    total = counts.withColumn("_rank", F.struct("_n", *(ranking or [])))
    best = total.groupBy(*keys).agg(F.max("_rank").alias("_best"), F.max("_n").alias(f"{name}_n"), F.sum("_n").alias("_all"))
    tied = total.join(best, keys).where(F.col("_rank") == F.col("_best"))
    return tied.groupBy(*keys, f"{name}_n", "_all").agg(F.min(value).alias(name)).withColumn(f"{name}_share", F.col(f"{name}_n") / F.col("_all")).drop("_all")


def ordered_list(order: list[str], value: str, test: Column | None = None) -> Column:
    """Values in the order of other columns; grouped rows must be few, such as one series."""
    item = F.struct(*order, F.col(value).alias("_value"))
    return F.transform(F.array_sort(F.collect_list(item if test is None else F.when(test, item))), lambda s: s["_value"])


def pivot_corrections(cells: DataFrame, keys: list[str], column: str, value: str, columns: list[str]) -> DataFrame:
    """Rows (key, column, value) to one row for each key with a fixed list of columns."""
    return cells.groupBy(*keys).pivot(column, columns).agg(F.max(value))


def weighted_mean(value: str, weight: str) -> Column:
    return F.sum(F.col(value) * F.col(weight)) / F.sum(weight)


def coverage(found: DataFrame, expected: DataFrame, keys: list[str], expected_col: str, least: float = 0.95) -> DataFrame:
    """Rows by key against the expected number: n, expected and is_covered."""
    n = found.groupBy(*keys).agg(F.count("*").alias("n"))
    n = expected.join(n, keys, "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return n.withColumn("is_covered", (F.col(expected_col) > 0) & (F.col("n") >= least * F.col(expected_col)))
