"""Violation queries, scorecards and data diffs: each returns rows that break a rule, or counts of them."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from concordia.functions.columns import differs, match_flag
from concordia.operators.joins import full_reconcile


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def blanks(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(F.col(column)) == "")


def missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def outside(df: DataFrame, column: str, accepted: Iterable) -> DataFrame:
    return df.where(~F.col(column).isin(*accepted))


def orphans(df: DataFrame, column: str, parents: DataFrame, parent_column: str) -> DataFrame:
    """Non-null values without a parent."""
    keys = parents.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def assert_unique(df: DataFrame, keys: list[str], shown: int = 5) -> DataFrame:
    """df, or an error with some of the repeated keys."""
    bad = duplicates(df, keys).limit(shown).collect()
    if bad:
        raise ValueError(f"repeated keys: {[r.asDict() for r in bad]}")
    return df


def parity(totals: DataFrame, official: DataFrame, keys: list[str], columns: list[str], tolerance: float = 0.005) -> DataFrame:
    """Rows whose totals differ from the official ones: (keys, column_name, own, official); null equals null only."""
    cell = lambda df, name: df.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias(name)) for c in columns])))
    both = cell(totals, "own").join(cell(official, "official"), [*keys, "column_name"], "left")
    apart = F.coalesce(F.abs(F.col("own") - F.col("official")) > tolerance, differs("own", "official"))
    return both.where(apart)


def not_single(df: DataFrame, keys: list[str], value: str | Column) -> DataFrame:
    """Keys with another number of distinct values than one."""
    return df.groupBy(*keys).agg(F.count_distinct(value).alias("n")).where("n <> 1")


def asymmetric(pairs: DataFrame, keys: list[str], a: str, b: str, mirrored: dict[str, str]) -> DataFrame:
    """Pairs whose reverse is absent or doesn't mirror them (column to its counterpart)."""
    back = pairs.select(*keys, F.col(a).alias(b), F.col(b).alias(a), *[F.col(v).alias(f"_back_{c}") for c, v in mirrored.items()], F.lit(True).alias("_has"))
    bad = F.col("_has").isNull()
    for c in mirrored:
        bad = bad | differs(c, f"_back_{c}")
    return pairs.join(back, [*keys, a, b], "left").where(bad).select(*pairs.columns)


def check(df: DataFrame, name: str, tests: dict[str, tuple[Column, Column]], thresholds: dict[str, float | None], by: list[str] | None = None) -> DataFrame:
    """Several checks over one scan: name -> (is compared, matches). Grouped checks get their group in the id."""
    keys = by or []
    sums = [c for k, (compared, matched) in tests.items() for c in (F.count_if(compared).alias(f"_c_{k}"), F.count_if(compared & matched).alias(f"_m_{k}"))]
    wide = (df.groupBy(*keys) if keys else df).agg(*sums)
    label = lambda k: F.concat_ws(":", F.lit(name), F.lit(k), *[F.col(b).cast("string") for b in keys])
    rows = [F.struct(label(k).alias("check_id"), F.col(f"_c_{k}").alias("compared"), F.col(f"_m_{k}").alias("matched"), F.lit(thresholds.get(k)).cast("double").alias("threshold")) for k in tests]
    return wide.select(F.inline(F.array(*rows)))


def scorecard(checks: list[DataFrame]) -> DataFrame:
    """All checks with their status: INFO without a threshold, NO_DATA without cases, else PASS or FAIL on the unrounded percentage."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    pct = 100.0 * F.col("matched") / F.col("compared")
    status = F.when(F.col("threshold").isNull(), "INFO").when(F.col("compared") == 0, "NO_DATA").when(pct >= F.col("threshold"), "PASS").otherwise("FAIL")
    return out.withColumn("status", status)


def failures_first(card: DataFrame) -> DataFrame:
    rank = F.when(F.col("status") == "FAIL", 0).when(F.col("status") == "NO_DATA", 1).when(F.col("status") == "PASS", 2).otherwise(3)
    return card.orderBy(rank, "check_id")


def notices(card: DataFrame, watched: list[str]) -> DataFrame:
    """Watched checks with unmatched cases, and how many."""
    return card.where(F.col("check_id").isin(*watched) & (F.col("compared") > F.col("matched"))).withColumn("missing", F.col("compared") - F.col("matched"))


def row_loss(before: DataFrame, after: DataFrame, strict: list[str], history: list[str], most_history: int = 5, most_pct: float = 2.0, excepted: Iterable[str] = ()) -> DataFrame:
    """Row counts of two versions (table_name, n): lost rows and whether the loss is allowed for that kind of table."""
    both = before.select("table_name", F.col("n").alias("was")).join(after.select("table_name", F.col("n").alias("now")), "table_name", "left").withColumn("now", F.coalesce("now", F.lit(0)))
    lost = F.greatest(F.col("was") - F.col("now"), F.lit(0))
    allowed = F.when(F.col("table_name").isin(*excepted), True).when(F.col("table_name").isin(*strict), lost == 0).when(F.col("table_name").isin(*history), lost <= most_history).otherwise(100.0 * lost <= most_pct * F.col("was"))
    return both.select("table_name", "was", "now", lost.alias("lost"), allowed.alias("is_allowed"))


def diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys only in a, only in b, or with different cells: (keys, kind, changed columns)."""
    columns = [c for c in a.columns if c not in keys]
    left = a.select(*keys, F.struct(*columns).alias("_a"))
    both = left.join(b.select(*keys, F.struct(*columns).alias("_b")), keys, "full")
    changed = F.array_compact(F.array(*[F.when(differs(F.col(f"_a.{c}"), F.col(f"_b.{c}")), F.lit(c)) for c in columns]))
    kind = F.when(F.col("_b").isNull(), "only_left").when(F.col("_a").isNull(), "only_right").when(F.size(changed) > 0, "different")
    return both.select(*keys, kind.alias("kind"), F.when(kind == "different", changed).otherwise(F.array().cast("array<string>")).alias("changed")).where("kind is not null")


def compare_rows(a: DataFrame, b: DataFrame, keys: list[str], fields: dict[str, int | None]) -> DataFrame:
    """Full join of two sources by keys: in_left, in_right and <field>_matches for each field (with a tolerance, or exact),
    null where one of the two has no value."""
    left, right = (df.select(*keys, *[F.col(f).alias(f"{f}_{n}") for f in fields]) for df, n in ((a, "left"), (b, "right")))
    both = full_reconcile(left, right, keys)
    return both.withColumns({f"{f}_matches": match_flag(f"{f}_left", f"{f}_right", tolerance) for f, tolerance in fields.items()})


def comparison_checks(compared: DataFrame, name: str, fields: dict[str, float | None], by: list[str] | None = None) -> DataFrame:
    """Checks of a `compare_rows`: one for each field (name to threshold), and `presence`: rows that both sources have."""
    tests = {f: (F.col(f"{f}_matches").isNotNull(), F.coalesce(F.col(f"{f}_matches"), F.lit(False))) for f in fields}
    return check(compared, name, {**tests, "presence": (F.lit(True), F.col("in_left") & F.col("in_right"))}, fields, by)


def applied_rates(overrides: DataFrame, corrected: DataFrame, keys: list[str], threshold: float = 100.0) -> DataFrame:
    """A check for each decision: its override lines (keys, column_name, action, decision), and those that some corrected
    row bears: `set` among its overridden_columns, else among its disputed_columns."""
    borne = [corrected.select(*keys, F.explode(column).alias("column_name"), F.lit(kind).alias("_kind")) for column, kind in (("overridden_columns", True), ("disputed_columns", False))]
    lines = overrides.withColumn("_kind", F.col("action") == "set")
    met = lines.join(borne[0].union(borne[1]).distinct().withColumn("_met", F.lit(True)), [*keys, "column_name", "_kind"], "left")
    return check(met, "overrides", {"applied": (F.lit(True), F.coalesce("_met", F.lit(False)))}, {"applied": threshold}, ["decision"])


def gate(card: DataFrame) -> DataFrame:
    """The failed checks of a scorecard; publication goes on only if there are none."""
    return card.where(F.col("status") == "FAIL")


def assert_gate(card: DataFrame, shown: int = 5) -> DataFrame:
    """card, or an error with some of its failed checks."""
    bad = gate(card).orderBy("check_id").limit(shown).collect()
    if bad:
        raise ValueError(f"failed checks: {[r.check_id for r in bad]}")
    return card


def coverage_gaps(facts: DataFrame, totals: DataFrame, keys: list[str], model: str) -> DataFrame:
    """Keys of facts without a row in totals: (model, keys)."""
    return facts.select(*keys).distinct().join(totals.select(*keys), keys, "left_anti").select(F.lit(model).alias("model"), *keys)


def wrong_ranges(facts: DataFrame, totals: DataFrame, key: str, value: str, first: str, last: str, model: str) -> DataFrame:
    """Rows of totals whose first and last value aren't those of the facts: (model, key, first)."""
    seen = facts.groupBy(key).agg(F.min(value).alias("_first"), F.max(value).alias("_last"))
    both = totals.select(key, first, last).join(seen, key, "left")
    return both.where(differs(first, "_first") | differs(last, "_last")).select(F.lit(model).alias("model"), key, first)


def single_pairs(pairs: DataFrame, keys: list[str], peer: str, columns: list[str]) -> DataFrame:
    """The only peer of keys that have but one, with columns of that pair."""
    one = pairs.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in [peer, *columns]])
    return one.where("_n = 1").drop("_n")


def disagreements(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str], tolerance: float = 0.005, how: str = "left") -> DataFrame:
    """Rows of a whose columns differ from those of b by more than the tolerance, or that b lacks (how = left):
    keys, <column>, other_<column>."""
    other = b.select(*keys, *[F.col(c).alias(f"other_{c}") for c in columns], F.lit(True).alias("_has"))
    bad = F.col("_has").isNull()
    for c in columns:
        bad = bad | F.coalesce(F.abs(F.col(c) - F.col(f"other_{c}")) > tolerance, F.lit(False))
    return a.join(other, keys, how).where(bad).select(*keys, *[x for c in columns for x in (c, f"other_{c}")])


def beyond(parts: DataFrame, wholes: DataFrame, keys: list[str], column: str, tolerance: float = 0.005) -> DataFrame:
    """Rows of parts whose column passes that of wholes, or that wholes lack."""
    both = parts.select(*keys, column).join(wholes.select(*keys, F.col(column).alias("whole"), F.lit(True).alias("_has")), keys, "left")
    return both.where(F.col("_has").isNull() | (F.col(column) > F.col("whole") + tolerance)).drop("_has")


def reference_cases(df: DataFrame, cases: DataFrame, keys: list[str], tolerance: float = 0.005) -> DataFrame:
    """Cases worked out by hand (keys and expected columns) that df lacks or contradicts: keys, column_name, expected, actual.

    Values are compared as text, numbers within the tolerance."""
    columns = [c for c in cases.columns if c not in keys]
    cell = lambda d, name: d.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias(name)) for c in columns])))
    both = cell(cases, "expected").join(cell(df, "actual"), [*keys, "column_name"], "left")
    near = F.abs(F.col("expected").try_cast("double") - F.col("actual").try_cast("double")) <= tolerance
    return both.where(differs("expected", "actual") & ~F.coalesce(near, F.lit(False)))


def stops_in_pit_laps(stops: DataFrame, laps: DataFrame, keys: list[str], flag: str = "is_pit_in_lap") -> DataFrame:
    """Official stops with is_pit_in_match: whether the lap of the stop is marked as a pit entry; null without that lap."""
    marks = laps.groupBy(*keys).agg(F.bool_or(F.coalesce(F.col(flag), F.lit(False))).alias("is_pit_in_match"))
    return stops.join(marks, keys, "left")


def flag_phases(messages: DataFrame, laps: DataFrame, starts: DataFrame, at: str, flag: str = "is_red_flag") -> DataFrame:
    """Messages (race_id, lap_number, `at`) with their phase and is_lap_flagged: whether a lap of the message, the one before
    or the one after has the flag.

    phase: no_laps (the race has none), pre_start (before the race's start of `starts`), after_end (more than one lap
    after the last), else race."""
    last = laps.groupBy("race_id").agg(F.max("lap_number").alias("_last"))
    flagged = laps.where(flag).select("race_id", F.explode(F.array(F.col("lap_number") - 1, F.col("lap_number"), F.col("lap_number") + 1)).alias("lap_number")).distinct().withColumn("_flagged", F.lit(True))
    out = messages.join(last, "race_id", "left").join(starts.select("race_id", F.col(at).alias("_start")), "race_id", "left").join(flagged, ["race_id", "lap_number"], "left")
    phase = F.when(F.col("_last").isNull(), "no_laps").when(F.col(at) < F.col("_start"), "pre_start").when(F.col("lap_number") - 1 > F.col("_last"), "after_end").otherwise("race")
    return out.select(*messages.columns, phase.alias("phase"), F.coalesce("_flagged", F.lit(False)).alias("is_lap_flagged"))


def text_contradicts_number(df: DataFrame, text: str, number: str) -> DataFrame:
    """Rows whose text is a number other than `number`, or that have one of the two as a number only."""
    stated = F.when(F.col(text).rlike("^[0-9]+$"), F.col(text).try_cast("bigint"))
    return df.where(differs(stated, F.col(number).cast("bigint")))


def rows_of_one_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of the two holds more often than the other: side (only_left, only_right), the columns and n, how much
    more often. One aggregation over both, so repeated rows count."""
    both = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    more = both.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return more.select(F.when(F.col("_n") > 0, "only_left").otherwise("only_right").alias("side"), *a.columns, F.abs("_n").alias("n"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether both hold the same rows as often."""
    return rows_of_one_side(a, b.select(*a.columns)).isEmpty()


def manifest(df: DataFrame, partition: list[str]) -> DataFrame:
    """Rows and an order-free digest of each partition: sums of two hashes of its rows, so nothing is gathered."""
    row = lambda seed: F.xxhash64(F.lit(seed), *df.columns).cast("decimal(20,0)")
    return df.groupBy(*partition).agg(F.count("*").alias("n"), F.sha2(F.concat_ws(":", F.sum(row(1)).cast("string"), F.sum(row(2)).cast("string")), 256).alias("digest"))


def manifest_diff(a: DataFrame, b: DataFrame, partition: list[str]) -> DataFrame:
    """Partitions lost, added or changed between two manifests."""
    both = a.select(*partition, F.col("n").alias("was"), F.col("digest").alias("_a")).join(b.select(*partition, F.col("n").alias("now"), F.col("digest").alias("_b")), partition, "full")
    kind = F.when(F.col("_b").isNull(), "lost").when(F.col("_a").isNull(), "added").when(F.col("_a") != F.col("_b"), "changed")
    return both.select(*partition, "was", "now", kind.alias("kind")).where("kind is not null")


def wide_types(df: DataFrame, allowed: Iterable[str] = ("string", "int", "bigint", "double", "boolean", "date", "timestamp", "array<string>")) -> list[tuple[str, str]]:
    """Columns whose type isn't one that published tables may have."""
    return [(c, t) for c, t in df.dtypes if t not in set(allowed)]


# Checks while data flow


def observed(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """df that counts, while whatever reads it flows, its rows and those that break each rule (the rule holds of a bad row; null
    is not bad). Figures are there once a job has read all of it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(test).alias(name) for name, test in rules.items()]), seen


def repeated_keys(df: DataFrame, keys: dict[str, list[str]]) -> DataFrame:
    """rule, n: for each rule how many keys occur more than once (null keys too), all in one grouped pass."""
    one = [F.struct(F.lit(rule).alias("rule"), F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]), {"ignoreNullFields": "false"}).alias("key")) for rule, columns in keys.items()]
    counts = df.select(F.inline(F.array(*one))).groupBy("rule", "key").agg(F.count("*").alias("n"))
    return counts.groupBy("rule").agg(F.count_if(F.col("n") > 1).alias("n"))


class Rejected(ValueError):
    """Data that broke rules; `card` has the figures."""

    def __init__(self, card: dict[str, int]):
        super().__init__(f"rules are broken: { {k: n for k, n in card.items() if n and k != 'rows'} }")
        self.card = card


def checked_write(df: DataFrame, path: str, rules: dict[str, Column], keys: dict[str, list[str]] | None = None, allowed: dict[str, int] | None = None) -> dict[str, int]:
    """Writes df as Parquet in place of what is at path, if it keeps the rules; the figures: rows and bad rows or keys by rule.

    Row rules are counted while rows are written to a folder beside, key rules by one pass over that. If a rule has more
    cases than `allowed` (none, unless given), the folder goes, what was at path stays and Rejected is raised."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    counted, seen = observed(df, rules)
    counted.write.parquet(beside)
    card = dict(seen.get)
    if keys:
        card |= dict.fromkeys(keys, 0) | {r.rule: r.n for r in repeated_keys(spark.read.schema(df.schema).parquet(beside), keys).collect()}
    own, other = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x) for x in (path, beside))
    files = own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if any(n > (allowed or {}).get(rule, 0) for rule, n in card.items() if rule != "rows"):
        files.delete(other, True)
        raise Rejected(card)
    files.delete(own, True)
    files.rename(other, own)
    return card
