"""Windows over keys of any size.

A window function sorts all rows of a key in one task. Here rows are dealt by ranges of (keys, order), so a key that
holds a third of all rows lies in many ranges. Each range is worked on by itself; what reaches over its border (a count,
a sum, the last state) is carried by a scan of one row for each range and key. Only the first key of a range can have
begun in an earlier one, so at most one carried row for each range goes to all tasks.

Orders are names of columns, with a minus sign before those that descend; nulls come last either way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANGE, _SALT = "_concordia_range", "_concordia_salt"


def pinned(df: DataFrame) -> DataFrame:
    """df as a checkpoint in the folder that `spark.checkpoint.dir` names, so that ranges stay what they are when tasks run
    again. A folder of its own only where none is set and the session runs on one machine."""
    from concordia.sources.readers import workspace

    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(workspace(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def _sorts(order: list[str]) -> list[Column]:
    return [F.desc_nulls_last(c[1:]) if c[0] == "-" else F.asc_nulls_last(c) for c in order]


def _names(order: list[str]) -> list[str]:
    return [c.lstrip("-") for c in order]


def _same(left: str, right: str, columns: list[str]) -> Column:
    test = F.col(f"{left}.{_RANGE}") == F.col(f"{right}.{_RANGE}")
    for c in columns:
        test = test & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return test


def in_ranges(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """df dealt by ranges of (keys, order), pinned, with the range's number. Rows equal in all these lie in one range."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pinned(df.repartitionByRange(parts, *[F.asc_nulls_last(k) for k in keys], *_sorts(order)).withColumn(_RANGE, F.spark_partition_id()))


def _with_carried(rows: DataFrame, whole: DataFrame, keys: list[str], carried: dict[str, Column]) -> DataFrame:
    """rows with what the earlier ranges of their keys give: columns over `whole`, one row by range and key; null at a key's start."""
    before = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(_RANGE))
    later = whole.select(_RANGE, *keys, first.alias("_nth"), *[c.over(before).alias(n) for n, c in carried.items()]).where("_nth > 1")
    return rows.alias("l").join(F.broadcast(later).alias("c"), _same("l", "c", keys), "left").select("l.*", *[F.col(f"c.{n}") for n in carried])


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """df with row_number() of the keys' rows in that order, as a window gives it; rows equal in the order in any turn.

    Null keys are a key of their own. An empty table stays empty."""
    salted = in_ranges(df.withColumn(_SALT, F.monotonically_increasing_id()), keys, [*order, _SALT], parts)
    local = salted.withColumn("_nth", F.row_number().over(Window.partitionBy(_RANGE, *keys).orderBy(*_sorts(order), _SALT)))
    out = _with_carried(local, salted.groupBy(_RANGE, *keys).agg(F.count("*").alias("_n")), keys, {"_before": F.sum("_n")})
    return out.select(*df.columns, (F.col("_nth") + F.coalesce("_before", F.lit(0))).cast("long").alias(name))


def ranks(df: DataFrame, keys: list[str], order: list[str], rank: str | None = None, dense: str | None = None, parts: int | None = None) -> DataFrame:
    """df with rank() and dense_rank() as windows give them, under the names given. Null keys and null values count as equal.

    Equal values are counted before they are dealt, so a value that a third of the rows share is one row; the ranks of values
    then join the rows."""
    columns = [*keys, *_names(order)]
    values = in_ranges(df.groupBy(*columns).agg(F.count("*").alias("_n")), keys, order, parts)
    w = Window.partitionBy(_RANGE, *keys).orderBy(*_sorts(order))
    local = values.withColumns({"_upto": F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_nth": F.row_number().over(w)})
    whole = values.groupBy(_RANGE, *keys).agg(F.sum("_n").alias("_rows"), F.count("*").alias("_values"))
    out = _with_carried(local, whole, keys, {"_rows_before": F.sum("_rows"), "_values_before": F.sum("_values")})
    zero = lambda c: F.coalesce(c, F.lit(0))
    found = {rank: zero("_rows_before") + F.col("_upto") - F.col("_n") + 1, dense: zero("_values_before") + F.col("_nth")}
    found = {n: c.cast("long") for n, c in found.items() if n}
    ranked = out.select(*[F.col(c).alias(f"_of_{c}") for c in columns], *[c.alias(n) for n, c in found.items()])
    test = None
    for c in columns:
        same = F.col(c).eqNullSafe(F.col(f"_of_{c}"))
        test = same if test is None else test & same
    return df.join(ranked, test).select(*df.columns, *found)


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, parts: int | None = None) -> DataFrame:
    """df with the sum of value up to each row; null while all values so far are null. The order must be total."""
    rows = in_ranges(df, keys, order, parts)
    local = rows.withColumn("_local", F.sum(value).over(Window.partitionBy(_RANGE, *keys).orderBy(*_sorts(order)).rowsBetween(Window.unboundedPreceding, 0)))
    out = _with_carried(local, rows.groupBy(_RANGE, *keys).agg(F.sum(value).alias("_sum")), keys, {"_before": F.sum("_sum")})
    total = F.when(F.col("_local").isNull(), F.col("_before")).otherwise(F.col("_local") + F.coalesce("_before", F.lit(0)))
    return out.select(*df.columns, total.alias(name))


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], tolerance: Column | None = None, tie: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Each left row with the `values` of the last right row of its keys at or before left_time (+ tolerance), for keys of any size.

    Right rows of one time rank by `tie`, then by all their values, so the result is one whatever the partitioning. Left
    rows without a match, and those with a null key or time, keep nulls; repeated left rows stay."""
    at = F.col(left_time) if tolerance is None else F.col(left_time) + tolerance
    keep, ties = [c for c in left.columns if c not in on], [*(tie or []), *values]
    rank = lambda real: F.struct(*[(F.col(c) if real else F.lit(None).cast(right.schema[c].dataType)).alias(f"t{i}") for i, c in enumerate(ties)]).alias("_tie")
    l = left.select(*on, at.alias("_t"), F.lit(1).alias("_side"), rank(False), F.struct(*keep).alias("_row"), F.lit(None).alias("_state"))  # noqa: E741
    r = right.where(F.col(right_time).isNotNull()).select(*on, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), rank(True), F.lit(None).alias("_row"), F.struct(*values).alias("_state"))
    both = l.unionByName(r).withColumn(_SALT, F.monotonically_increasing_id())  # a moment with many left rows isn't one range
    both = in_ranges(both, on, ["_t", "_side", "_tie", _SALT], parts)
    order = Window.partitionBy(_RANGE, *on).orderBy(F.asc_nulls_last("_t"), "_side", "_tie", _SALT)
    local = both.withColumn("_local", F.last("_state", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    final = both.where("_side = 0").groupBy(_RANGE, *on).agg(F.max_by("_state", F.struct("_t", "_tie", _SALT)).alias("_final"))
    whole = both.select(_RANGE, *on).distinct().alias("l").join(final.alias("r"), _same("l", "r", on), "left").select("l.*", "r._final")
    out = _with_carried(local, whole, on, {"_before": F.last("_final", ignorenulls=True)}).where("_side = 1")
    known = F.col("_t").isNotNull() & F.forall(F.array(*[F.col(k).isNotNull() for k in on]), lambda x: x)
    state = F.when(known, F.coalesce("_local", "_before"))
    return out.withColumn("_state", state).select(*on, *[F.col(f"_row.{c}").alias(c) for c in keep], *[F.col(f"_state.{v}").alias(v) for v in values])
