"""Chat formatting: collapse cumulative snapshots, then render.

Chat logs often hold one conversation again at each turn. A rolling hash of every turn
prefix (running sums of two 64-bit hashes of place, role and text, exact in decimals)
names it; a conversation whose last prefix is also a proper prefix of another is dropped
by an anti-join, as are all but the smallest id of equal ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PREFIX = ["_a", "_b", "_n"]


def prefix_hashes(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Turns with conv, role, text, their place `_n` from 1 and the prefix's hash `_a`, `_b`; `_last` marks the whole.

    Rows without a conversation go; null turns, roles and texts come first and differ from empty ones; repeated rows are turns
    of their own. An empty table stays empty; other columns are not read."""
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()]
    w = Window.partitionBy("conv").orderBy(*order)
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).where("conv is not null")
    t = t.withColumns({"_n": F.row_number().over(w), "_next": F.lead(F.lit(1)).over(w)})
    seen = lambda seed: F.xxhash64(F.lit(seed), "_n", F.col("role").isNull(), "role", F.col("text").isNull(), "text").cast("decimal(20,0)")
    t = t.withColumns({"_a": F.sum(seen(1)).over(so_far).cast("decimal(30,0)"), "_b": F.sum(seen(2)).over(so_far).cast("decimal(30,0)")})
    return t.select("conv", "turn", "role", "text", *PREFIX, F.col("_next").isNull().alias("_last"))


def maximal_conversations(turns: DataFrame, **columns: str) -> DataFrame:
    """conv and n_turns of each conversation that is neither a proper prefix of another nor equal to one with a smaller id.

    Nulls, repeated rows and empty tables as in `prefix_hashes`."""
    hashes = prefix_hashes(turns, **columns).select("conv", *PREFIX, "_last")
    whole = hashes.where("_last").groupBy(*PREFIX).agg(F.min("conv").alias("conv"))
    parts = hashes.where("not _last").select(*PREFIX).distinct()
    return whole.join(parts, PREFIX, "left_anti").select("conv", F.col("_n").cast("long").alias("n_turns"))


def render_maximal(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", start: str = "<|", middle: str = "|>\n", end: str = "\n") -> DataFrame:
    """One row per maximal conversation: its id, n_turns and rendered, each turn as start + role + middle + text + end.

    Turns are in the order of turn, role, text, nulls first; null roles and texts render as empty, but differ from
    empty ones in the comparison. Repeated rows are turns of their own. Rows without a conversation id belong to
    no conversation and aren't rendered. An empty table gives an empty result."""
    kept = maximal_conversations(turns, conv_col=conv_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    said = F.concat(F.lit(start), F.coalesce("role", F.lit("")), F.lit(middle), F.coalesce("text", F.lit("")), F.lit(end))
    t = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    t = t.join(kept, "conv").groupBy("conv", "n_turns").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", said.alias("said")))).alias("all"))
    # array_sort puts a null field first, as the window does
    return t.select(F.col("conv").alias(conv_col), "n_turns", F.array_join("all.said", "").alias("rendered"))
