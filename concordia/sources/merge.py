"""Bulk and incremental feeds merged by coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordia.operators.windows import join_null_safe


def coverage_log(bulk: DataFrame, delta: DataFrame, expected: DataFrame, keys: list[str], expected_col: str, previous: DataFrame | None = None) -> DataFrame:
    """By partition (null is one) the numbers of rows: expected, bulk_rows, delta_rows and, with previous, previous_rows; null where a side has none."""
    sides = [expected.select(*keys, F.col(expected_col).cast("long").alias("expected"))]
    sides += [df.groupBy(*keys).agg(F.count("*").alias(name)) for df, name in ((bulk, "bulk_rows"), (delta, "delta_rows"), (previous, "previous_rows")) if df is not None]
    stacked = sides[0]
    for side in sides[1:]:
        stacked = stacked.unionByName(side, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in stacked.columns if c not in keys])


def merge_log(bulk: DataFrame, delta: DataFrame, expected: DataFrame, keys: list[str], expected_col: str, previous: DataFrame, merged: DataFrame) -> DataFrame:
    """What a merge did, by partition: the numbers of `coverage_log`, the rows now, their origin and an action: `new` (there was
    none), `grown`, `kept` (as many as before) or `gap` (fewer than `least` of the expected rows are there)."""
    n = coverage_log(bulk, delta, expected, keys, expected_col, previous)
    now = merged.groupBy(*keys).agg(F.count("*").alias("rows"), F.min("origin").alias("origin"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = join_null_safe(n, now, keys, "left").withColumn("rows", z("rows"))
    action = F.when(z("rows") < 0.95 * z("expected"), "gap").when(z("previous_rows") == 0, "new").when(F.col("rows") > z("previous_rows"), "grown").otherwise("kept")
    return out.withColumn("action", action)


def with_new_members(dimension: DataFrame, facts: list[DataFrame], delta_dimension: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(the dimension with the members that facts name and only the incremental feed knows, the keys that no feed knows).

    A member of the dimension stays as it is; of several new rows of one member the first by its columns counts; a column that
    the feed's dimension hasn't is null. Null keys name nothing."""
    named = None
    for df in facts:
        own = df.where(F.col(key).isNotNull()).select(key)
        named = own if named is None else named.unionByName(own)
    missing = named.distinct().join(dimension.select(key), key, "left_anti")
    known = delta_dimension.where(F.col(key).isNotNull()).select(*[c for c in dimension.columns if c in delta_dimension.columns])
    rest = [c for c in known.columns if c != key]
    known = known.groupBy(key).agg(F.min(F.struct(*rest)).alias("_m")).select(key, "_m.*") if rest else known.distinct()
    added = known.join(missing, key, "left_semi")
    return dimension.unionByName(added, allowMissingColumns=True), missing.join(known, key, "left_anti")


def merge_by_coverage(bulk: DataFrame, delta: DataFrame, expected: DataFrame, keys: list[str], expected_col: str, previous: DataFrame | None = None, least: float = 0.95) -> DataFrame:
    """By partition the bulk's rows if they cover `least` of the expected number, else the delta's if they are more; a
    partition never gets fewer rows than `previous` had (then previous stays). Adds origin. A null partition is one like
    others; rows count once each, repeated ones too."""
    n = coverage_log(bulk, delta, expected, keys, expected_col, previous)
    n = n.withColumnsRenamed({"expected": "_e", "bulk_rows": "_b", "delta_rows": "_d", "previous_rows": "_p"})
    z = lambda c: F.coalesce(c, F.lit(0))
    own = F.when((z("_e") > 0) & (z("_b") >= least * F.col("_e")), "bulk").when(z("_d") > z("_b"), "delta").otherwise("bulk")
    n = n.withColumn("origin", own)
    sources = {"bulk": bulk, "delta": delta}
    if previous is not None:
        chosen = F.when(F.col("origin") == "bulk", z("_b")).otherwise(z("_d"))
        n = n.withColumn("origin", F.when(chosen < z("_p"), "previous").otherwise(F.col("origin")))
        sources["previous"] = previous
    out = None
    for name, df in sources.items():
        one = join_null_safe(df, n.where(F.col("origin") == name).select(*keys, "origin"), keys)
        out = one if out is None else out.unionByName(one)
    return out


def newest_covered(coverage: DataFrame, order: list[str]) -> DataFrame:
    """The last partition that is covered."""
    return coverage.where("is_covered").orderBy(*[F.desc(o) for o in order]).limit(1)


def loaded_summary(rows: DataFrame, group: str, part: str, source: str | None = None, backup: str | None = None) -> DataFrame:
    """By group the last part with rows, how many there are and, with a source column, how many only the backup serves."""
    by = rows.groupBy(group, part).agg(*([F.bool_and(F.col(source) == backup).alias("_only")] if source else [F.lit(False).alias("_only")]))
    return by.groupBy(group).agg(F.max(part).alias("last_part"), F.count("*").alias("parts"), F.count_if("_only").alias("backup_only"))
