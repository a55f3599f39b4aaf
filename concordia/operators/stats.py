"""Distribution statistics and dense series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.operators.sliced import running_sum
from concordia.operators.windows import join_null_safe


def representative(df: DataFrame, keys: list[str], value: str, step: str, excluded: Column, times: float = 1.5) -> DataFrame:
    """Rows past the first step that aren't excluded and lie within `times` the median of such rows of their keys."""
    usable = df.where((F.col(step) > 1) & ~F.coalesce(excluded, F.lit(False)) & F.col(value).isNotNull())
    median = usable.groupBy(*keys).agg(F.median(value).alias("_median"))
    return usable.join(median, keys).where(F.col(value) <= times * F.col("_median")).drop("_median")


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], parts: int | None = None) -> DataFrame:
    """keys, n and a column for each of `shares`: exact quantiles of the non-null values, linear between order statistics.

    Selection by ranges: equal values are counted first, the counts are dealt by ranges of (keys, value), and the number of
    values before each range tells which range holds an order statistic, so no task holds a key's values. Null keys are a
    key; a key without values has no row."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_w"))
    placed = running_sum(counts, keys, ["_v"], "_w", "_upto", parts)
    sizes = counts.groupBy(*keys).agg(F.sum("_w").alias("n"))
    both = join_null_safe(placed, sizes, keys)
    place = {q: F.lit(s) * (F.col("n") - 1) for q, s in shares.items()}
    holds = lambda at: (F.col("_upto") > at) & (F.col("_upto") - F.col("_w") <= at)
    picks = [F.max(F.when(holds(f(p)), F.col("_v"))).alias(f"_{side}_{q}") for q, p in place.items() for side, f in (("low", F.floor), ("high", F.ceil))]
    out = both.groupBy(*keys, "n").agg(*picks)
    between = lambda q: F.col(f"_low_{q}") + (F.col(f"_high_{q}") - F.col(f"_low_{q}")) * (place[q] - F.floor(place[q]))
    return out.select(*keys, "n", *[between(q).alias(q) for q in shares])


def box(df: DataFrame, keys: list[str], value: str, least: int = 5) -> DataFrame:
    """n, q1, median, q3 (linear interpolation) and the last values inside 1.5 IQR, of keys with `least` values."""
    q = exact_quantiles(df, keys, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}).where(F.col("n") >= least)
    fence = 1.5 * (F.col("q3") - F.col("q1"))
    inside = join_null_safe(df, q, keys).where((F.col(value) >= F.col("q1") - fence) & (F.col(value) <= F.col("q3") + fence))
    return inside.groupBy(*keys, "n", "q1", "median", "q3").agg(F.min(value).alias("low"), F.max(value).alias("high"))


def density(df: DataFrame, keys: list[str], value: str, points: int = 60, least_width: float = 50.0) -> DataFrame:
    """A Gaussian density on a grid from the least to the largest value: (keys, point, x, density), bandwidth max(1.06 sd n^-0.2, least_width).

    Each task sums the kernel at all points of a key's grid over its own rows, so what is shuffled is one row of `points`
    sums for each key and task; these are added after. Equal values are combined first. Null values don't count; null keys
    are a key; a key without values has no row."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_w"))
    shape = df.groupBy(*keys).agg(F.count(value).alias("_n"), F.coalesce(F.stddev(value), F.lit(0.0)).alias("_sd"), F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    shape = shape.where("_n > 0").withColumn("_h", F.greatest(1.06 * F.col("_sd") * F.pow("_n", F.lit(-0.2)), F.lit(least_width)))
    # In bandwidths: where a value lies from the least one, and how far apart points are.
    near = {"_at": (F.col("_v") - F.col("_lo")) / F.col("_h"), "_gap": (F.col("_hi") - F.col("_lo")) / (max(points - 1, 1) * F.col("_h"))}
    grid = ["_n", "_h", "_lo", "_hi"]
    placed = join_null_safe(counts, shape, keys).select(*keys, *grid, "_w", *[c.alias(n) for n, c in near.items()])
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    def kernel(i: Column) -> Column:
        z = F.col("_at") - i * F.col("_gap")
        return F.col("_w") * F.exp(-0.5 * z * z)

    at_points = array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), kernel))
    sums = placed.groupBy(*keys, *grid).agg(Summarizer.sum(at_points).alias("_sums"))
    root = 2.5066282746310002
    long = sums.select(*keys, *grid, F.posexplode(vector_to_array("_sums")).alias("point", "_s"))
    x = F.col("_lo") + F.col("point") * (F.col("_hi") - F.col("_lo")) / F.lit(max(points - 1, 1))
    return long.select(*keys, "point", x.alias("x"), (F.col("_s") / (F.col("_n") * F.col("_h") * root)).alias("density"))


def dense_series(df: DataFrame, keys: list[str], step: str, value: str, steps: int) -> DataFrame:
    """An array of the values at steps 1 to `steps`, null where absent; one series of a unit is a row."""
    known = F.map_from_entries(F.collect_list(F.struct(step, value)))
    got = df.where(F.col(step).between(1, steps)).groupBy(*keys, step).agg(F.min(value).alias(value)).groupBy(*keys).agg(known.alias("_m"))
    return got.select(*keys, F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda i: F.try_element_at("_m", i.cast(df.schema[step].dataType))).alias(value))


def position_chart(laps: DataFrame, results: DataFrame, group: list[str], unit: str, step: str, position: str, grid: str, finish: str, others: list[str]) -> DataFrame:
    """One row for each unit with laps: `positions`, whose slot 0 is the start (the result's grid), then one for each step up to
    the group's last, null where it has none; an array by step for each of `others` (such as the compound); start, best,
    finish and led.

    Steps below 1 and null steps have no slot; of several rows of one step the least position and values count; of several
    results of a unit the least. A group's last step bounds a row's length."""
    own = [*group, unit]
    kind = dict(laps.dtypes)
    slots = laps.where(F.col(step) >= 1).groupBy(*own, step).agg(*[F.min(c).alias(c) for c in [position, *others]])
    last = slots.groupBy(*group).agg(F.max(step).alias("_last"))
    series = slots.groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct(step, F.struct(position, *others)))).alias("_m"), F.min(position).alias("best"), F.count_if(F.col(position) == 1).alias("led"))
    first = results.groupBy(*own).agg(F.min(F.struct(F.col(grid).alias("start"), F.col(finish).alias("finish"))).alias("_r"))
    out = join_null_safe(join_null_safe(series, last, group), first, own, "left")
    at = lambda c: F.transform(F.sequence(F.lit(1), F.col("_last").cast("int")), lambda i: F.try_element_at("_m", i.cast(kind[step]))[c])
    start = F.array(F.col("_r.start").cast(kind[position]))
    return out.select(*own, F.concat(start, at(position)).alias("positions"), *[at(c).alias(c) for c in others], F.col("_r.start").alias("start"), "best", F.col("_r.finish").alias("finish"), "led")


def led(df: DataFrame, keys: list[str], position: str, step: str) -> DataFrame:
    """Steps led, the best position and the first and last one."""
    known = F.col(position).isNotNull()
    at = lambda f: f(F.when(known, F.col(position)), F.when(known, F.col(step)))
    return df.groupBy(*keys).agg(F.count_if(F.col(position) == 1).alias("led"), F.min(position).alias("best"), at(F.min_by).alias("first_position"), at(F.max_by).alias("last_position"))


def trace_summary(df: DataFrame, keys: list[str], speed: str, throttle: str, full: float) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(speed).alias("top"), F.min(speed).alias("low"), (100.0 * F.avg(F.when(F.col(throttle) >= full, 1.0).otherwise(0.0))).alias("full_pct"))


def progression(df: DataFrame, entity: str, step: str, value: str, steps: list) -> DataFrame:
    """Entity by step, the steps as columns."""
    return df.groupBy(entity).pivot(step, steps).agg(F.max(value))


def decade(season: Column) -> Column:
    return (F.floor(season / 10) * 10).cast("int")
