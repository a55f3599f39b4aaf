"""Offset estimation between two numberings from two kinds of evidence, and cross-source reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_CASES, LEAST_SHARE = 3, 0.8


def case_offsets(found: DataFrame, official: DataFrame, on: list[str], step: str, official_step: str, case: list[str], residual=None) -> DataFrame:
    """For each case the offset (found minus official step) closest to 0, then the smaller."""
    offset = F.col(step) - F.col(official_step)
    met = official.join(found, on)
    met = met if residual is None else met.where(residual)
    return met.groupBy(*on, *[c for c in case if c not in on]).agg(F.min_by(offset, F.struct(F.abs(offset), offset)).alias("step_offset"))


def offset_status(evidence: DataFrame, group: str, limits: DataFrame, first: str = "fastest", second: str = "stop") -> DataFrame:
    """evidence: (group, evidence, step_offset), a row by case. limits: (group, last_step, official_last).

    Each kind needs 3 cases; its offset is the commonest, then that closest to 0, then the smaller. consistent: one
    offset, 0, with 80 % of the cases. pit_lap_convention: first kind 0 or absent and second -1 with 80 %.
    renumbered: one other offset with 80 % that keeps the last step within the official one. Else inconsistent.
    applied_shift is minus the offset if renumbered, else 0."""
    counts = evidence.groupBy(group, "evidence", "step_offset").agg(F.count("*").alias("cases"))
    rank = F.struct("cases", F.negative(F.abs("step_offset")), F.negative("step_offset"))
    kinds = counts.groupBy(group, "evidence").agg(F.sum("cases").alias("n"), F.max_by("step_offset", rank).alias("top"), (F.max("cases") / F.sum("cases")).alias("share")).where(F.col("n") >= LEAST_CASES)
    pick = lambda kind, c: F.max(F.when(F.col("evidence") == kind, F.col(c)))
    per = kinds.groupBy(group).agg(
        pick(first, "top").alias("first_offset"), pick(second, "top").alias("second_offset"), pick(second, "share").alias("second_share"),
        F.count_distinct("top").alias("offsets"), F.min("top").alias("common"), F.min("share").alias("least_share"),
    ).join(limits, group, "left")
    one = (F.col("offsets") == 1) & (F.col("least_share") >= LEAST_SHARE)
    fits = F.col("last_step") - F.col("common") <= F.col("official_last")
    moved = F.coalesce(one & (F.col("common") != 0) & fits, F.lit(False))
    status = (
        F.when(one & (F.col("common") == 0), "consistent")
        .when((F.coalesce("first_offset", F.lit(0)) == 0) & (F.col("second_offset") == -1) & (F.col("second_share") >= LEAST_SHARE), "pit_lap_convention")
        .when(moved, "renumbered")
        .otherwise("inconsistent")
    )
    return per.select(group, "first_offset", "second_offset", status.alias("status"), F.when(status == "renumbered", -F.col("common")).otherwise(0).alias("applied_shift"))


def reliability(candidate: DataFrame, references: list[tuple[str, DataFrame]], archive: DataFrame, official: DataFrame, group: str, keys: list[str], value: str, step: str, agree: float = 90, cover: float = 98, complete: float = 95, tolerance: int = 1) -> DataFrame:
    """How far a source can be trusted in each group: match_pct against the first reference that has the group (steps
    above 1 with both values), is_reliable (unknown counts as reliable), is_missing and is_complete of an archive that is
    the reference, and is_replaced. official: (group, official_rows)."""
    on = [group, *keys]
    own = candidate.select(*on, F.col(value).alias("_own"))
    chosen, taken = None, None
    for name, ref in references:
        rows = ref.select(*on, F.col(value).alias("_ref"), F.lit(name).alias("reference"))
        if taken is not None:
            rows = rows.join(taken, group, "left_anti")
        chosen = rows if chosen is None else chosen.unionByName(rows)
        names = ref.select(group).distinct()
        taken = names if taken is None else taken.unionByName(names).distinct()
    compared = own.join(chosen, on).where((F.col(step) > 1) & F.col("_own").isNotNull() & F.col("_ref").isNotNull())
    compared = compared.groupBy(group).agg(F.max("reference").alias("reference"), F.count("*").alias("compared"), F.count_if(F.abs(F.col("_own") - F.col("_ref")) <= tolerance).alias("matched"))
    in_both = archive.select(*on).join(own.select(*on), on, "left_semi").groupBy(group).agg(F.count("*").alias("in_both"))
    sizes = archive.groupBy(group).agg(F.count("*").alias("archive_rows"))
    mine = candidate.groupBy(group).agg(F.count("*").alias("own_rows"))
    out = mine.join(compared, group, "left").join(sizes, group, "left").join(in_both, group, "left").join(official, group, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    pct = F.when(F.col("compared") > 0, F.round(100.0 * F.col("matched") / F.col("compared"), 2))
    by_archive = F.coalesce(F.col("reference") == references[-1][0], F.lit(False))
    out = out.withColumn("match_pct", pct).withColumn("is_reliable", F.coalesce(F.col("match_pct") >= agree, F.lit(True)))
    out = out.withColumn("is_missing", by_archive & (100.0 * zero("in_both") < cover * zero("archive_rows")))
    out = out.withColumn("is_complete", by_archive & (zero("official_rows") > 0) & (100.0 * zero("archive_rows") >= complete * zero("official_rows")))
    replaced = F.col("is_complete") & (~F.col("is_reliable") | (F.col("is_missing") & (zero("archive_rows") > F.col("own_rows"))))
    return out.withColumn("is_replaced", replaced).select(group, "reference", "compared", "match_pct", "is_reliable", "is_missing", "is_complete", "is_replaced")
