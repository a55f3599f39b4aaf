"""Evidence-guarded corrections: they apply only while the value that was reviewed still stands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.operators.aggregates import pivot_corrections
from concordia.operators.joins import wildcard_rules


def apply_row_rules(base: DataFrame, rules: DataFrame, on: list[str], optional: dict[str, str], setters: dict[str, str], priority: list[str]) -> DataFrame:
    """Layer 1: the first rule that fits a row sets columns (rule column to row column, where the rule's isn't null).

    Adds is_corrected and original_<column> of each settable column."""
    marked = wildcard_rules(base, rules.withColumn("_hit", F.lit(True)), on, optional, priority)
    out = marked.withColumns({f"original_{c}": F.col(c) for c in setters.values()} | {"is_corrected": F.coalesce("_hit", F.lit(False))})
    out = out.withColumns({c: F.coalesce(F.col(rule), F.col(c)) for rule, c in setters.items()})
    return out.select(*base.columns, *[f"original_{c}" for c in setters.values()], "is_corrected")


def apply_cell_overrides(base: DataFrame, overrides: DataFrame, on: list[str], columns: dict[str, str]) -> DataFrame:
    """Layer 2: overrides (keys, column_name, original_value, corrected_value, action) for the columns given with their types.

    An override counts if the cell still holds original_value as text (null as ''). `set` replaces it, `flag` only
    marks it. Adds overridden_columns and disputed_columns, sorted."""
    cells = base.select(*on, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_now")) for c in columns])))
    valid = cells.join(overrides, [*on, "column_name"]).where(F.col("_now") == F.coalesce("original_value", F.lit("")))
    sets = valid.where("action = 'set'")
    wide = pivot_corrections(sets, on, "column_name", "corrected_value", list(columns)).select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    listed = lambda action: F.array_sort(F.collect_set(F.when(F.col("action") == action, F.col("column_name"))))
    lists = valid.groupBy(*on).agg(listed("set").alias("overridden_columns"), listed("flag").alias("disputed_columns"))
    out = base.join(lists, on, "left").join(wide, on, "left")
    none = F.array().cast("array<string>")
    new: dict[str, Column] = {c: F.when(F.array_contains("overridden_columns", c), F.col(f"_new_{c}").try_cast(kind)).otherwise(F.col(c)) for c, kind in columns.items()}
    out = out.withColumns({n: F.coalesce(n, none) for n in ("overridden_columns", "disputed_columns")}).withColumns(new)
    return out.select(*base.columns, "overridden_columns", "disputed_columns")


def apply_value_corrections(rows: DataFrame, sheet: DataFrame, on: list[str], value: str) -> DataFrame:
    """Value-guarded: sheet (keys, original_value, corrected_value) joins on the keys and the reviewed value.

    Adds original_<value> and is_corrected."""
    sheet = sheet.select(*on, F.col("original_value").alias(value), "corrected_value")
    out = rows.join(sheet, [*on, value], "left")
    hit = F.col("corrected_value").isNotNull()
    return out.select(*on, *[c for c in rows.columns if c not in (*on, value)], F.coalesce("corrected_value", value).alias(value), F.col(value).alias(f"original_{value}"), hit.alias("is_corrected"))


def stale_corrections(base: DataFrame, sheet: DataFrame, on: list[str], value: str) -> DataFrame:
    """Sheet rows that no row of base bears out any more."""
    now = base.select(*on, F.coalesce(F.col(value).cast("string"), F.lit("")).alias("_now"))
    return sheet.withColumn("_now", F.coalesce(F.col("original_value").cast("string"), F.lit(""))).join(now, [*on, "_now"], "left_anti").drop("_now")


def build_overrides(evidence: DataFrame, base: DataFrame, on: list[str], locate: list[str], value_columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(overrides, errors) from evidence lines (keys, column_name, old_value, new_value, decision).

    A line counts if exactly one base row has its keys and that row's cell still holds old_value; else it's an error
    with the reason. Cells are counted by key and column before they meet the lines, so a line is never told from others by
    its place; repeated lines give repeated overrides and one error. Null keys locate nothing."""
    located = [c for c in locate if c not in on]
    cells = base.select(*on, *located, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("_now")) for c in value_columns])))
    cells = cells.groupBy(*on, "column_name").agg(F.count("*").alias("_n"), F.min(F.struct(*located, "_now")).alias("_cell"))
    met = evidence.join(cells, [*on, "column_name"], "left")
    reason = F.when(F.col("_n").isNull(), "no row").when(F.col("_n") > 1, "several rows").when(F.col("_cell._now") != F.coalesce("old_value", F.lit("")), "value changed")
    met = met.withColumn("reason", reason)
    good = met.where("reason is null").select(*on, *[F.col(f"_cell.{c}").alias(c) for c in located], "column_name", F.col("old_value").alias("original_value"), F.col("new_value").alias("corrected_value"), F.lit("set").alias("action"), "decision")
    return good, met.where("reason is not null").select(*on, "column_name", "old_value", "new_value", "decision", "reason").distinct()
