"""Scalar helpers: functions from columns to a column, all inside Catalyst.

Nulls are kept unless said otherwise: a comparison with an unknown value is unknown.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text to numbers and times


def duration_ms(text: ColumnOrName) -> Column:
    """`h:m:s.f`, `m:s.f` or `s.f`, also with a leading +, as rounded milliseconds; any other text gives null."""
    clean = F.trim(F.regexp_replace(F.trim(col(text)), r"^\+", ""))
    seconds = F.aggregate(F.transform(F.split(clean, ":"), lambda p: p.try_cast("double")), F.lit(0.0), lambda total, part: total * 60 + part)
    return F.when(clean.rlike(r"^(\d+:){0,2}\d+(\.\d+)?$"), F.round(seconds * 1000).cast("long"))


def duration_ms_exact(text: ColumnOrName) -> Column:
    """As duration_ms with an optional `N days ` before it, but exact decimals, cut to whole milliseconds."""
    c = F.trim(col(text))
    pattern = r"^(?:(\d+) days? )?(?:(?:(\d+):)?(\d+):)?(\d+(?:\.\d+)?)$"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(c, pattern, i), F.lit("")).cast("decimal(20,9)"), F.lit(0).cast("decimal(20,9)"))
    seconds = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(c.rlike(pattern), F.floor(seconds * 1000).cast("long"))


def json_number(text: ColumnOrName, path: str = "$") -> Column:
    """The number at `path` of JSON text; null for malformed text, other kinds and absent paths."""
    return F.try_variant_get(F.try_parse_json(col(text)), path, "double")


def utc_timestamp(text: ColumnOrName) -> Column:
    """ISO 8601 with a zone as a timestamp; null if malformed."""
    return F.try_to_timestamp(col(text))


def local_date(ts: ColumnOrName, offset: ColumnOrName) -> Column:
    """The date at an `[-]HH:MM:SS` offset from UTC."""
    return (col(ts) + col(offset).try_cast("interval hour to second")).cast("date")


def ms_interval(ms: ColumnOrName) -> Column:
    zero = F.lit(0)
    return F.make_dt_interval(zero, zero, zero, col(ms) / F.lit(1000).cast("decimal(10,0)"))


def epoch_ms(ts: ColumnOrName) -> Column:
    return F.unix_millis(col(ts).cast("timestamp"))


def days_apart(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.abs(F.date_diff(col(a), col(b)))


# Comparison with unknowns


def same(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Equal, or both null."""
    return col(a).eqNullSafe(col(b))


def differs(a: ColumnOrName, b: ColumnOrName) -> Column:
    return ~same(a, b)


def within(a: ColumnOrName, b: ColumnOrName, tolerance) -> Column:
    """At most `tolerance` apart; null if either is."""
    return F.abs(col(a) - col(b)) <= tolerance


def match_flag(a: ColumnOrName, b: ColumnOrName, tolerance=None) -> Column:
    """Whether two sources agree; null where they can't be compared."""
    a, b = col(a), col(b)
    return F.when(a.isNotNull() & b.isNotNull(), a == b if tolerance is None else within(a, b, tolerance))


def in_optional(c: ColumnOrName, wanted) -> Column:
    """An optional filter: None lets all pass, a list asks for membership, else equality."""
    if wanted is None:
        return F.lit(True)
    return col(c).isin(list(wanted)) if isinstance(wanted, (list, tuple, set)) else col(c) == wanted


# Codes and classes


def placeholder_null(c: ColumnOrName, placeholders: Iterable[str] = ("NAN", "NONE", "UNKNOWN", "")) -> Column:
    """Upper case, with the feed's words for nothing as null."""
    upper = F.upper(col(c))
    return F.when(~upper.isin(*placeholders), upper)


def code_map(c: ColumnOrName, names: dict[str, str]) -> Column:
    """Mapped where the code is known, else as it is."""
    pairs = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, col(c)), col(c))


def classify(rules: Iterable[tuple[Column, str]], default: str | None = None) -> Column:
    """The name of the first rule that holds, in order."""
    out = None
    for test, name in rules:
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(F.lit(default))


def has_code(c: ColumnOrName, codes: str) -> Column:
    """Whether a packed status text holds any of the one-letter codes."""
    return col(c).rlike(f"[{codes}]")


# Arithmetic and arrays


def percent(part: ColumnOrName, whole: ColumnOrName, digits: int | None = None) -> Column:
    """100 * part / whole as a double, null where whole is 0 or null."""
    whole = col(whole)
    value = F.when(whole != 0, F.lit(100.0) * col(part) / whole)
    return value if digits is None else F.round(value, digits)


def compact(*items: Column) -> Column:
    """An array of the items that aren't null."""
    return F.array_compact(F.array(*items))


def no_texts() -> Column:
    return F.array().cast("array<string>")


# Verdicts on one value among several sources


def validation_status(value: ColumnOrName, others: list[Column], is_first: Column, tolerance: int = 1, convention: int = 1000, longest: int = 300_000) -> Column:
    """How the other sources judge a time.

    confirmed: one is within the tolerance. single_source: nothing to compare. timing_convention: the first step, a
    difference below `convention`, or a time above `longest`. Else disputed."""
    value = col(value)
    known = F.array_compact(F.array(*others))
    nearest = F.array_min(F.transform(known, lambda o: F.abs(o - value)))
    any_long = (value > longest) | F.exists(known, lambda o: o > longest)
    return classify([
        (nearest <= tolerance, "confirmed"),
        (value.isNull() | (F.size(known) == 0), "single_source"),
        (is_first | (nearest < convention) | any_long, "timing_convention"),
    ], "disputed")


def confirmed_by(value: ColumnOrName, others: dict[str, Column], tolerance: int = 1) -> Column:
    """The names of the sources within the tolerance, in the given order."""
    return compact(*[F.when(within(value, c, tolerance), F.lit(name)) for name, c in others.items()])
