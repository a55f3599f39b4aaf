"""Nested feed documents to rows, declaratively: `from_json` with a schema, then explode."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concordia.functions.columns import duration_ms_exact


def explode_json(docs: DataFrame, column: str, schema: str, keep: list[str]) -> DataFrame:
    """One row for each element of a JSON array of objects, its fields as columns; malformed text gives none."""
    return docs.select(*keep, F.inline(F.from_json(column, schema)))


#: What a lap's object is called in the nested feeds, by the path of arrays that leads through it. Fixed values.
LAP_FIELDS = {"Timings": {"lap": "number"}}


def explode_lists(docs: DataFrame, column: str, schema: str, keep: dict[str, str], path: str, fields: dict[str, tuple[str, str]], outer: dict[str, dict[str, str]] = LAP_FIELDS) -> DataFrame:
    """keep: name -> field of the document; path: a dotted path of arrays to walk; fields: name -> (field, type); outer: by a
    step of the path the fields of the object that holds it (name -> field)."""
    out = docs.select(F.from_json(column, schema).alias("_d")).select(*[F.col(f"_d.{f}").alias(n) for n, f in keep.items()], F.col("_d").alias("_x"))
    for step in path.split("."):
        own = {n: f for n, f in outer.get(step, {}).items() if n not in out.columns}
        out = out.select(*[c for c in out.columns if c != "_x"], F.explode(F.col(f"_x.{step}")).alias("_x"), *[F.col(f"_x.{f}").alias(n) for n, f in own.items()])
    return out.select(*[c for c in out.columns if c != "_x"], *[F.col(f"_x.{f}").try_cast(kind).alias(n) for n, (f, kind) in fields.items()])


def message_feed(lines: DataFrame, column: str, message_schema: str, keep: list[str]) -> DataFrame:
    """Lines of `[time, {"Messages": [...] or {"0": {...}}}]`: one row by message, with session_time and the message's fields."""
    pair = F.from_json(column, "array<string>")
    body = F.get_json_object(pair[1], "$.Messages")
    listed = F.from_json(body, f"array<{message_schema}>")
    mapped = F.map_values(F.from_json(body, f"map<string, {message_schema}>"))
    all_of = F.when(body.startswith("["), listed).otherwise(mapped)
    return lines.select(*keep, duration_ms_exact(pair[0]).alias("session_ms"), F.inline(all_of))


def as_json_text(value: Column) -> Column:
    """A feed's value that may be number, text or list, as one JSON text: lists and numbers as they are, other text quoted."""
    is_json = F.try_parse_json(value).isNotNull()
    return F.when(is_json, value).otherwise(F.to_json(F.array(value)).substr(F.lit(2), F.length(F.to_json(F.array(value))) - 2))


def stable_columns(df: DataFrame) -> DataFrame:
    """Struct, map and array columns as JSON text, so that files with other shapes unite by name."""
    wide = [f.name for f in df.schema if f.dataType.typeName() in ("struct", "map", "array", "variant")]
    return df.withColumns({c: F.to_json(c) for c in wide})


def sample_times(samples: DataFrame, events: DataFrame, on: list[str], utc: str, session_ms: str, sample_ms: str, name: str = "sample_utc") -> DataFrame:
    """Session-relative samples in UTC: the zero is the latest (utc - session time) that any event shows."""
    from concordia.functions.columns import ms_interval

    zero = events.groupBy(*on).agg(F.max(F.col(utc) - ms_interval(session_ms)).alias("_zero"))
    return samples.join(zero, on, "left").withColumn(name, F.col("_zero") + ms_interval(sample_ms)).drop("_zero")


# Relational dump to flat tables


def flat_entries(dump: dict[str, DataFrame]) -> DataFrame:
    """season, round, session and entry tables of a dump joined flat; its dimensions are looked up by id."""
    s = dump["session"].join(dump["round"].select(F.col("id").alias("round_id"), "season_id", F.col("number").alias("round")), "round_id").join(dump["season"].select(F.col("id").alias("season_id"), F.col("year").alias("season")), "season_id")
    e = dump["sessionentry"].join(s.select(F.col("id").alias("session_id"), "season", "round", "type"), "session_id")
    r = dump["roundentry"].select(F.col("id").alias("round_entry_id"), "team_driver_id", "car_number")
    td = dump["teamdriver"].select(F.col("id").alias("team_driver_id"), "driver_id", "team_id")
    return e.join(r, "round_entry_id").join(td, "team_driver_id").join(dump["driver"].select(F.col("id").alias("driver_id"), F.col("reference").alias("driver")), "driver_id").join(dump["team"].select(F.col("id").alias("team_id"), F.col("reference").alias("team")), "team_id")


def flat_results(entries: DataFrame, laps: DataFrame, statuses: dict[int, str]) -> DataFrame:
    """Race entries as results: position text (the place, else the status' code), status and the fastest lap's number and time."""
    from concordia.functions.columns import code_map
    from concordia.operators.windows import pick_first

    fast = pick_first(laps.where("time is not null").withColumn("_ms", duration_ms_exact("time")), ["session_entry_id"], [F.col("_ms"), F.col("number")]).select(F.col("session_entry_id").alias("id"), F.col("number").alias("fastest_lap"), F.col("_ms").alias("fastest_ms"))
    text = F.when(F.col("is_classified"), F.col("position").cast("string")).otherwise(code_map(F.col("status").cast("string"), {str(k): v for k, v in statuses.items()}))
    return entries.where("type = 'R'").join(fast, "id", "left").select("season", "round", "driver", "team", "car_number", "position", text.alias("position_text"), "points", "fastest_lap", "fastest_ms")


def flat_qualifying(entries: DataFrame, laps: DataFrame) -> DataFrame:
    """Qualifying sessions of an entry folded to q1, q2, q3 by their order; the last one gives the position."""
    best = laps.groupBy("session_entry_id").agg(F.min(duration_ms_exact("time")).alias("ms")).withColumnRenamed("session_entry_id", "id")
    q = entries.where(F.col("type").startswith("Q")).join(best, "id", "left").withColumn("n", F.when(F.col("type").isin("Q1", "Q2", "Q3"), F.substring("type", 2, 1).cast("int")).otherwise(1))
    part = lambda n: F.min(F.when(F.col("n") == n, F.col("ms"))).alias(f"q{n}_ms")
    return q.groupBy("season", "round", "driver", "team").agg(part(1), part(2), part(3), F.max_by("position", "n").alias("position"))


def flat_steps(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """Laps or stops of a dump with their entry's keys; times in exact milliseconds."""
    return rows.join(entries.select(F.col("id").alias("session_entry_id"), "season", "round", "type", "driver"), "session_entry_id").withColumn("ms", duration_ms_exact("time")).drop("session_entry_id", "time")
