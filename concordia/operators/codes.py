"""Unique short codes within small groups, such as one race's entrants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.names import without_accents
from concordia.operators.windows import join_null_safe


def _from_id(entity: Column) -> Column:
    """Three letters of an id's last part, or of the one before a last `jr`."""
    parts = F.split(entity.cast("string"), "-")
    last = F.when((F.element_at(parts, -1) == "jr") & (F.size(parts) > 1), F.try_element_at(parts, F.lit(-2))).otherwise(F.element_at(parts, -1))
    return F.upper(F.substring(last, 1, 3))


def unique_codes(df: DataFrame, group: list[str], entity: str, code: str, name: str, started: str | None = None) -> DataFrame:
    """(group, entity, unique_code) of distinct entities of any number.

    Without a code, three letters of the id stand for it. A code's sole bearer keeps it, or its sole bearer that `started`.
    The others come in the order of their ids: the initial of the name (or id) before two letters, then before the whole
    code, then the code with the least free number from 2 on. One row holds a group's codes, so a group is one race's
    entrants or the like. Null entities have no code; of several codes or names of one entity the least counts."""
    ran = F.coalesce(F.bool_or(started), F.lit(False)) if started else F.lit(True)
    members = df.where(F.col(entity).isNotNull()).groupBy(*group, F.col(entity).alias("_id")).agg(F.min(code).alias("_code"), F.min(name).alias("_name"), ran.alias("_ran"))
    first = F.regexp_extract(without_accents(F.coalesce("_name", F.col("_id").cast("string"))), r"\p{L}", 0)
    members = members.withColumns({"_code": F.upper(F.coalesce("_code", _from_id(F.col("_id")))), "_initial": F.when(first == "", "X").otherwise(F.upper(first))})
    members = members.withColumn("_nth", F.row_number().over(Window.partitionBy(*group, "_code", "_initial").orderBy("_id")))
    bearers = Window.partitionBy(*group, "_code")
    alone = (F.count("*").over(bearers) == 1) | (F.col("_ran") & (F.count_if("_ran").over(bearers) == 1))
    digits = F.col("_code").rlike("[0-9]$") | F.substring("_code", 1, 2).rlike("[0-9]$")
    members = members.withColumns({"_keeps": alone, "_digits": F.max(digits).over(Window.partitionBy(*group))})
    kind = dict(members.dtypes)["_id"]
    # All of one initial and code want the same two codes, so only their first two may get one (one of three may have kept
    # its own). The others are numbered by a window; only where a code has a digit could a number be another's code.
    early = F.col("_digits") | (F.col("_nth") <= 3)
    kept = F.collect_list(F.when(F.col("_keeps"), F.struct("_id", F.col("_code").alias("code"))))
    rest = F.array_sort(F.collect_list(F.when(~F.col("_keeps") & early, F.struct("_id", "_code", "_initial", "_digits"))))
    late = F.collect_list(F.when(~F.col("_keeps") & ~early, F.struct("_id", F.lit(None).cast("string").alias("code"), F.col("_code").alias("base"))))
    whole = members.groupBy(*group).agg(kept.alias("_kept"), rest.alias("_rest"), late.alias("_late"))

    def give(state: Column, member: Column) -> Column:
        free = lambda c: ~F.array_contains(state.taken, c)
        short, full = F.concat(member["_initial"], F.substring(member["_code"], 1, 2)), F.concat(member["_initial"], member["_code"])
        number = F.filter(F.sequence(F.lit(2), F.size(state.taken) + 2), lambda k: free(F.concat(member["_code"], k.cast("string"))))
        numbered = F.when(member["_digits"], F.concat(member["_code"], F.element_at(number, 1).cast("string")))
        chosen = F.when(free(short), short).when(free(full), full).otherwise(numbered)
        taken = F.when(chosen.isNull(), state.taken).otherwise(F.array_append(state.taken, chosen))
        return F.struct(taken.alias("taken"), F.array_append(state.given, F.struct(member["_id"].alias("_id"), chosen.alias("code"), member["_code"].alias("base"))).alias("given"))

    triples = f"array<struct<_id: {kind}, code: string, base: string>>"
    begin = F.struct(F.transform("_kept", lambda k: k.code).alias("taken"), F.transform("_kept", lambda k: F.struct(k["_id"], k.code, k.code)).cast(triples).alias("given"))
    given = F.aggregate("_rest", begin.cast(f"struct<taken: array<string>, given: {triples}>"), give, lambda state: state.given)
    out = whole.select(*group, F.inline(F.concat(given, F.col("_late").cast(triples))))
    nth = F.row_number().over(Window.partitionBy(*group, "base", F.col("code").isNull()).orderBy("_id"))
    return out.select(*group, F.col("_id").alias(entity), F.coalesce("code", F.concat("base", (nth + 1).cast("string"))).alias("unique_code"))


def _units(rows: DataFrame, group: list[str], entity: str, unit: str) -> DataFrame:
    """rows with `_units`: with how many units the entity appears in the group; to be without one counts as one more."""
    count = F.count_distinct(unit) + F.max(F.col(unit).isNull().cast("int"))
    return join_null_safe(rows, rows.groupBy(*group, entity).agg(count.alias("_units")), [*group, entity])


def unit_keys(rows: DataFrame, group: list[str], entity: str, unit: str) -> DataFrame:
    """rows with unit_key: the entity, or entity_unit where it appears with several units in the group.

    A null group is a group like others; a row without an entity has a null key; one without a unit is named by its entity."""
    several = (F.col("_units") > 1) & F.col(unit).isNotNull()
    key = F.when(several, F.concat(F.col(entity).cast("string"), F.lit("_"), F.col(unit).cast("string"))).otherwise(F.col(entity).cast("string"))
    return _units(rows, group, entity, unit).withColumn("unit_key", key).drop("_units")


def unit_results(rows: DataFrame, results: DataFrame, group: list[str], entity: str, unit: str, order: list[str], values: list[str]) -> DataFrame:
    """One row for each unit of rows (group, entity, unit, unit_key) with `values` of its result: the first (by `order`) of the
    entity with that unit, or with any if the row has none; if there is no such result, the entity's first, but not where the
    entity has several units, as it would be another one's. Else nulls."""
    own = _units(unit_keys(rows, group, entity, unit).select(*group, entity, unit, "unit_key").distinct(), group, entity, unit)
    first = lambda keys, name: results.groupBy(*keys).agg(F.min(F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], *values)).alias(name))
    both = join_null_safe(join_null_safe(own, first([*group, entity, unit], "_exact").where(F.col(unit).isNotNull()), [*group, entity, unit], "left"), first([*group, entity], "_any"), [*group, entity], "left")
    any_fits = F.col(unit).isNull() | (F.col("_exact").isNull() & (F.col("_units") == 1))
    found = F.when(any_fits, F.col("_any")).otherwise(F.col("_exact"))
    return both.withColumn("_found", found).select(*group, entity, unit, "unit_key", *[F.col(f"_found.{v}").alias(v) for v in values])
