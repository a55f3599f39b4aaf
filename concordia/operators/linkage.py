"""Entity resolution: links are found once for each distinct record, then joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from concordia.functions.names import normalized_name
from concordia.operators.windows import join_null_safe, pick_first


def link_records(records: DataFrame, registry: DataFrame, group: list[str], number: str, name: str, entity: str, reg_number: str, reg_name: str, reg_surname: str) -> DataFrame:
    """records with `entity` and match_level: 1 number and name, 2 number and surname, 3 name, 4 a surname that is unique
    in the group, 5 number; null where nothing fits. Ties by entity, then number.

    No record meets its whole group: the registry gives one key for each level, of which its first entity counts, and a record
    asks for its number, its name and each run of last words of its name, all in one hash join. Null groups, numbers and
    names match nothing; registry rows without an entity take no part; repeated records stay."""
    keys = [*group, number, name]
    none = F.lit(None).cast("string")
    reg = registry.where(F.col(entity).isNotNull()).select(*group, F.col(entity), F.col(reg_number).alias("_number"), normalized_name(reg_name).alias("_full"), normalized_name(reg_surname).alias("_surname")).distinct()
    tie = F.struct(F.col(entity), F.col("_number").isNull().alias("last"), F.col("_number"))
    number_key = F.col("_number").cast("string")
    index = None
    for level, k, text in ((1, number_key, F.col("_full")), (2, number_key, F.col("_surname")), (3, none, F.col("_full")), (4, none, F.col("_surname")), (5, number_key, none)):
        keyed = reg.select(*group, F.lit(level).alias("_level"), k.alias("_k"), text.alias("_text"), F.col(entity).alias("_e"), tie.alias("_tie"))
        if level in (1, 2, 5):
            keyed = keyed.where("_k is not null")
        if level != 5:
            keyed = keyed.where("_text is not null")
        first = keyed.groupBy(*group, "_level", "_k", "_text").agg(F.min("_tie").alias("_tie"), F.min("_e").alias("_lo"), F.max("_e").alias("_hi"))
        first = (first.where("_lo = _hi") if level == 4 else first).drop("_lo", "_hi")
        index = first if index is None else index.unionByName(first)

    words = F.split("_name", " ")
    runs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(2), F.size(words)), lambda i: F.array_join(F.slice(words, i, F.size(words)), " "))).otherwise(F.array().cast("array<string>"))
    ask = lambda level, k, text: F.struct(F.lit(level).alias("_level"), k.alias("_k"), text.alias("_text"))
    own, full = F.col(number).cast("string"), F.col("_name")
    plain = F.array(ask(1, own, full), ask(3, none, full), ask(5, own, none))
    asked = F.concat(plain, F.transform(runs, lambda t: ask(2, own, t)), F.transform(runs, lambda t: ask(4, none, t)))
    distinct = records.select(*keys).distinct().withColumn("_name", normalized_name(name))
    # Without a name there are no runs, and no array of them.
    distinct = distinct.select(*keys, F.inline(F.coalesce(asked, plain)))
    asks = distinct.where(F.when(F.col("_level").isin(1, 2, 5), F.col("_k").isNotNull()).otherwise(True) & ((F.col("_level") == 5) | F.col("_text").isNotNull()))
    met = [F.col(f"a.{g}") == F.col(f"x.{g}") for g in group] + [F.col("a._level") == F.col("x._level"), F.col("a._k").eqNullSafe(F.col("x._k")), F.col("a._text").eqNullSafe(F.col("x._text"))]
    found = asks.alias("a").join(index.alias("x"), met).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col("a._level").alias("match_level"), "_tie")
    best = found.groupBy(*keys).agg(F.min(F.struct("match_level", "_tie")).alias("_best"))
    best = best.select(*keys, F.col(f"_best._tie.{entity}").alias(entity), F.col("_best.match_level").alias("match_level"), F.col("_best._tie._number").alias("matched_number"))
    return join_null_safe(records, best, keys, "left")


def align_batches(batches: DataFrame, official: DataFrame, scope: list[str], label: str, signature: list[str]) -> DataFrame:
    """Mislabelled batches go to the candidate of their scope with the most equal signatures; on a tie the label stays,
    then the smallest candidate. One row by (scope, label): aligned, score, total, is_realigned, match_pct."""
    left = batches.select(*scope, label, *signature).distinct()
    right = official.select(*scope, F.col(label).alias("aligned"), *signature).distinct()
    total = left.groupBy(*scope, label).agg(F.count("*").alias("total"))
    scores = left.join(right, [*scope, *signature]).groupBy(*scope, label, "aligned").agg(F.count("*").alias("score"))
    best = pick_first(scores, [*scope, label], [F.desc("score"), (F.col("aligned") == F.col(label)).desc(), F.col("aligned")])
    out = total.join(best, [*scope, label], "left")
    out = out.withColumns({"aligned": F.coalesce("aligned", label), "score": F.coalesce("score", F.lit(0))})
    return out.withColumns({"is_realigned": F.col("aligned") != F.col(label), "match_pct": F.round(100.0 * F.col("score") / F.col("total"), 1)})


def map_ids(a: DataFrame, b: DataFrame, on: list[str], ref: str, entity: str, confirmed) -> DataFrame:
    """ref to entity by co-occurrence on shared keys: pairs that `confirmed` bears out, the most frequent (then largest id)."""
    pairs = a.join(b, on).where(confirmed).groupBy(ref, entity).agg(F.count("*").alias("shared"))
    return pairs.groupBy(ref).agg(F.max_by(entity, F.struct("shared", entity)).alias(entity), F.max("shared").alias("shared"))


def bridge(entries: DataFrame, keys: list[str], entity: str, kinds: list[str], kind: str) -> DataFrame:
    """The distinct (keys, entity) of the kinds of session that matter."""
    return entries.where(F.col(kind).isin(*kinds) & F.col(entity).isNotNull()).select(*keys, entity).distinct()


def equivalences(pairs: DataFrame, group: list[str], absolute: str, relative: str, order: str) -> DataFrame:
    """The dominant relative category of each absolute one, and whether the group's mapping is one to one and keeps order.

    order: the relative category's rank. is_consistent holds for all rows of a group or none."""
    counts = pairs.groupBy(*group, absolute, relative, order).agg(F.count("*").alias("n"))
    best = counts.groupBy(*group, absolute).agg(F.max_by(F.struct(relative, order), F.struct("n", F.negative(F.col(order)))).alias("_m"), F.max("n").alias("n"), F.sum("n").alias("total"))
    best = best.select(*group, absolute, F.col(f"_m.{relative}").alias(relative), F.col(f"_m.{order}").alias(order), "n", "total")
    w = Window.partitionBy(*group).orderBy(absolute)
    rising = F.coalesce(F.col(order) > F.lag(order).over(w), F.lit(True))
    every = Window.partitionBy(*group)
    return best.withColumn("_up", rising).withColumn("is_consistent", F.bool_and("_up").over(every)).drop("_up")
