"""Joins that Spark has no single call for. All have an equality prefix, so they stay hash or sort-merge joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A side is broadcast by hint only if a caller has counted it to be at most so many rows.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `most` rows; else as it is, and the join shuffles."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def full_reconcile(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join with coalesced keys and `in_left`, `in_right`."""
    marked = left.withColumn("in_left", F.lit(True)).join(right.withColumn("in_right", F.lit(True)), on, "full")
    return marked.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("in_left", "in_right")})


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, values: list[str], tolerance: Column | None = None, tie: str | None = None) -> DataFrame:
    """Each left row with the `values` of the last right row of its keys at or before left_time (+ tolerance).

    One shuffle and one sort: both sides are stacked and the last right row is carried forward. Rows of the right
    side with equal times rank by `tie`, then by all their values, so the result doesn't depend on partitioning. Left rows
    without a match keep nulls. A key's rows are one window; `sliced.asof_join` is for keys that hold a large share of them."""
    at = F.col(left_time) if tolerance is None else F.col(left_time) + tolerance
    keep = [c for c in left.columns if c not in on]
    carried = F.struct(*[F.col(v).alias(v) for v in values])
    ties = [*([tie] if tie else []), *values]
    rank = F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)])
    l = left.select(*on, at.alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_tie"), F.struct(*keep).alias("_row"), F.lit(None).alias("_state"))  # noqa: E741
    r = right.where(F.col(right_time).isNotNull()).select(*on, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), rank.alias("_tie"), F.lit(None).alias("_row"), carried.alias("_state"))
    order = Window.partitionBy(*on).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    state = F.when(F.col("_t").isNotNull() & F.forall(F.array(*[F.col(k).isNotNull() for k in on]), lambda x: x), F.last("_state", ignorenulls=True).over(order))
    both = l.unionByName(r, allowMissingColumns=True).withColumn("_state", state)
    return both.where("_side = 1").select(*on, *[F.col(f"_row.{c}").alias(c) for c in keep], *[F.col(f"_state.{v}").alias(v) for v in values])


#: Each level of bins is so many times as wide as the one before.
_WIDER = 8


def _number(df: DataFrame, column: str) -> Column:
    """Times and numbers as doubles that keep their order."""
    kind, c = df.schema[column].dataType.typeName(), F.col(column)
    return (F.unix_micros(c.cast("timestamp")) if kind.startswith("timestamp") else F.unix_date(c) if kind == "date" else c).cast("double")


def _bin(at: Column, level: Column) -> Column:
    return F.floor(at / F.pow(F.lit(float(_WIDER)), level))


def _with_bins(df: DataFrame, start: str, end: str) -> DataFrame:
    """df by each bin that [start, end] touches: `_level` by its length, which is one to _WIDER widths of that level's bins."""
    a, b = _number(df, start), _number(df, end)
    level = F.when(b > a, F.floor(F.log(b - a) / F.log(F.lit(float(_WIDER))))).otherwise(0)
    leveled = df.where(F.col(start) <= F.col(end)).withColumn("_level", level.cast("int"))
    return leveled.withColumn("_bin", F.explode(F.sequence(_bin(a, F.col("_level")), _bin(b, F.col("_level")))))


def _in_bins(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, how: str, rest: list[str]) -> DataFrame:
    """interval_join for intervals that have an end; rest: their columns that an inner join gives."""
    cut = _with_bins(intervals, start, end)
    levels = sorted(r[0] for r in cut.select("_level").distinct().collect())  # at most one for each power of _WIDER

    def meet(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        p, i = left.alias("p"), right.alias("i")
        keys = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in [*on, "_level", "_bin"]]
        found = p.join(i, [*keys, (F.col(f"p.{at}") >= F.col(f"i.{start}")) & (F.col(f"p.{at}") <= F.col(f"i.{end}"))], how)
        return found.select(*[F.col(f"p.{c}") for c in points.columns], *([F.col(f"i.{c}") for c in rest] if how == "inner" else []))

    def on_level(left: DataFrame, level: Column) -> DataFrame:
        return left.withColumn("_level", level).withColumn("_bin", _bin(_number(points, at), F.col("_level")))

    if how == "inner":
        return meet(on_level(points, F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))), cut, how)
    met, left = None, points  # a point is met on its first level only
    for level in levels:
        own, there = on_level(left, F.lit(level)), cut.where(F.col("_level") == level)
        one = meet(own, there, "left_semi")
        met, left = one if met is None else met.unionByName(one), meet(own, there, "left_anti")
    return left if how == "left_anti" else points.limit(0) if met is None else met


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], at: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Points within closed intervals of the same keys; an interval without an end is open. how: inner, left_semi, left_anti.

    An equality join on the keys and bins of time: an interval lies in the few bins of a width near its own length, a point
    in one bin of each width that occurs. So a key that holds most rows is dealt by time, and only pairs that are near each
    other meet. Open intervals are kept apart: they end at their key's last point, which makes their own lengths. Null
    keys, points and starts match nothing; repeated rows match each for itself."""
    last = points.where(F.col(at).isNotNull()).groupBy(*on).agg(F.max(at).alias("_last"))
    closed = intervals.where(F.col(end).isNotNull())
    until = intervals.where(F.col(end).isNull() & F.col(start).isNotNull()).join(last, on).withColumn("_end", F.col("_last")).drop("_last")
    fields = [c for c in intervals.columns if c not in on]
    if how == "inner":
        return _in_bins(points, closed, on, at, start, end, how, fields).union(_in_bins(points, until, on, at, start, "_end", how, fields))
    first = _in_bins(points, closed, on, at, start, end, "left_anti", [])
    if how == "left_anti":
        return _in_bins(first, until, on, at, start, "_end", how, [])
    return _in_bins(points, closed, on, at, start, end, how, []).union(_in_bins(first, until, on, at, start, "_end", how, []))


def overlaps(spans: DataFrame, periods: DataFrame, on: list[str], span: tuple[str, str], period: tuple[str, str], flag: str) -> DataFrame:
    """spans with `flag`: whether any period of the same keys overlaps them; a period without an end reaches to the span's.

    No pairs are made: in one order of time a span's end sees the latest end among the periods that began before it."""
    keep = [c for c in spans.columns if c not in on]
    s = spans.select(*on, F.col(span[1]).alias("_t"), F.lit(0).alias("_side"), F.struct(*keep).alias("_row"), F.lit(None).alias("_end"), F.lit(False).alias("_open"))
    p = periods.where(F.col(period[0]).isNotNull()).select(*on, F.col(period[0]).alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_row"), F.col(period[1]).alias("_end"), F.col(period[1]).isNull().alias("_open"))
    before = Window.partitionBy(*on).orderBy(F.col("_t").asc_nulls_first(), "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = s.unionByName(p, allowMissingColumns=True).withColumns({"_last": F.max("_end").over(before), "_any": F.max("_open").over(before)})
    start = F.col(f"_row.{span[0]}")
    met = (F.col("_last") > start) | (F.col("_any") & (F.col("_t") > start))
    known = F.forall(F.array(*[F.col(k).isNotNull() for k in on]), lambda x: x)
    return both.where("_side = 0").select(*on, *[F.col(f"_row.{c}").alias(c) for c in keep], F.coalesce(known & met, F.lit(False)).alias(flag))


def first_end_after(events: DataFrame, on: list[str], at: str, is_start: Column, is_end: Column, end_name: str = "ended_at") -> DataFrame:
    """Of an event log the starts, each with the time of the first strictly later end of its keys: one growing window
    over descending time, no range join."""
    later = Window.partitionBy(*on).orderBy(F.unix_micros(F.col(at).cast("timestamp")).desc()).rangeBetween(Window.unboundedPreceding, -1)
    return events.withColumn(end_name, F.min(F.when(is_end, F.col(at))).over(later)).where(is_start)


def flag_within_previous(df: DataFrame, on: list[str], step: str, flagged: Column, back: int, name: str, ahead: int = 0) -> DataFrame:
    """df with `name`: whether a flagged row of the same keys lies on the step, `back` steps before or `ahead` after."""
    w = Window.partitionBy(*on).orderBy(F.col(step).cast("long")).rangeBetween(-back, ahead)
    return df.withColumn(name, F.coalesce(F.max(F.when(flagged, 1)).over(w), F.lit(0)) == 1)


def nearest_date(left: DataFrame, right: DataFrame, on: list[str], left_id: str, left_date: str, right_date: str, right_order: list[str], days: int = 1) -> DataFrame:
    """Each left row with the right row of its keys nearest in date within a band, then by `right_order`.

    The band is an equality on each day that it spans, so no range join is needed."""
    gap = F.abs(F.date_diff(F.col(left_date), F.col(right_date)))
    spread = left.withColumn("_day", F.explode(F.transform(F.sequence(F.lit(-days), F.lit(days)), lambda d: F.date_add(F.to_date(left_date), d))))
    found = spread.join(right.withColumn("_day", F.to_date(right_date)), [*on, "_day"])
    w = Window.partitionBy(left_id).orderBy(gap, *right_order)
    return found.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth", "_day")


def peer_pairs(df: DataFrame, group: list[str], member: str, columns: list[str]) -> DataFrame:
    """Ordered pairs of different members of a group: `columns` as they are, and of the peer with `peer_` before."""
    peer = df.select(*group, *[F.col(c).alias(f"peer_{c}") for c in [member, *columns]])
    return df.select(*group, member, *columns).join(peer, group).where(F.col(member) != F.col(f"peer_{member}"))


def peers_of_teams(df: DataFrame, group: list[str], member: str, columns: list[str]) -> DataFrame:
    """`peer_pairs` of groups that fit a row, such as a race's teams: they are grouped instead of joined, so rows that are
    partitioned by a part of the group already (a mart's buckets) aren't shuffled. Null members and null groups have no peers."""
    known = df
    for c in [*group, member]:
        known = known.where(F.col(c).isNotNull())
    teams = known.groupBy(*group).agg(F.collect_list(F.struct(member, *columns)).alias("_team"))
    one = teams.select(*group, F.explode("_team").alias("_own"), "_team")
    pairs = one.select(*group, "_own.*", F.explode(F.filter("_team", lambda p: p[member] != F.col("_own")[member])).alias("_peer"))
    return pairs.select(*group, member, *columns, *[F.col(f"_peer.{c}").alias(f"peer_{c}") for c in [member, *columns]])


def prefer_source(first: DataFrame, second: DataFrame, on: list[str]) -> DataFrame:
    """All rows of the first source and those of the second whose keys the first hasn't."""
    return first.unionByName(second.join(first.select(*on).distinct(), on, "left_anti"), allowMissingColumns=True)


def wildcard_rules(rows: DataFrame, rules: DataFrame, on: list[str], optional: dict[str, str], priority: list[str]) -> DataFrame:
    """Each row with the first rule (by `priority`, then by all its columns) of its keys whose optional columns are null or
    equal the row's.

    optional: rule column to row column. Rules without a match give nulls; a row keeps its count of one. A rule's mask says
    which of its optional columns are set. For each mask that occurs (at most 2 to the number of optional columns) a row has
    one key, with nulls at the others, so rules are found by one hash join however many a key has. Of rules with one
    condition only the first counts. Rules are found once for each combination of values that rows have, which then joins
    the rows. Null keys match nothing."""
    own = [*on, *dict.fromkeys(c for c in optional.values() if c not in on)]
    rest = [c for c in rules.columns if c not in on]
    order = [F.col(p).asc_nulls_last() for p in [*priority, *[c for c in rest if c not in priority]]]
    conditions = list(optional)
    mask = sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))
    marked = rules.withColumn("_mask", mask).withColumn("_nth", F.row_number().over(Window.partitionBy(*on, *conditions).orderBy(*order))).where("_nth = 1").drop("_nth")
    masks = sorted(r[0] for r in rules.select(mask.alias("m")).distinct().collect())
    combined = rows.select(*own).distinct().select(*[F.col(c).alias(f"_of_{c}") for c in own])
    keyed = F.array(*[F.struct(F.lit(m).alias("m"), *[(F.col(f"_of_{optional[c]}") if m >> i & 1 else F.lit(None).cast(rows.schema[optional[c]].dataType)).alias(f"c{i}") for i, c in enumerate(conditions)]) for m in masks])
    asked = combined.select("*", F.explode(keyed).alias("_asked")).alias("r") if masks else combined.limit(0).select("*", F.struct(F.lit(0).alias("m"), *[F.lit(None).alias(f"c{i}") for i in range(len(conditions))]).alias("_asked")).alias("r")
    met = [F.col(f"r._of_{k}") == F.col(f"u.{k}") for k in on] + [F.col("r._asked.m") == F.col("u._mask")] + [F.col(f"r._asked.c{i}").eqNullSafe(F.col(f"u.{c}")) for i, c in enumerate(conditions)]
    found = asked.join(marked.alias("u"), met).select(*[F.col(f"r._of_{c}") for c in own], *[F.col(f"u.{c}") for c in rest])
    w = Window.partitionBy(*[f"_of_{c}" for c in own]).orderBy(*order)
    found = found.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in own]
    return rows.join(found, same, "left").drop(*[f"_of_{c}" for c in own])


def unpivot_pairs(df: DataFrame, keys: list[str], name: str, values: dict[str, list[Column]], fields: list[str]) -> DataFrame:
    """Wide to long: a row for each entry of `values`, its columns named by `fields`."""
    items = [F.struct(F.lit(k).alias(name), *[c.alias(f) for f, c in zip(fields, cols)]) for k, cols in values.items()]
    return df.select(*keys, F.inline(F.array(*items)))


def with_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """df with the columns of a one-row aggregate (no grouping keys, so one row whatever the data)."""
    return df.crossJoin(F.broadcast(total))
