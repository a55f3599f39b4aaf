"""Comparable forms of names."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordia.functions.columns import ColumnOrName, col


@cache
def _accents() -> tuple[str, str]:
    """Letters from U+00C0 to U+024F that decompose to a base letter and marks, and those base letters."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))) for c in range(0xC0, 0x250)]
    pairs = [(a, d[0]) for a, d in pairs if len(d) > 1 and all(unicodedata.combining(m) for m in d[1:])]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def without_accents(text: ColumnOrName) -> Column:
    return F.translate(col(text), *_accents())


def normalized_name(text: ColumnOrName) -> Column:
    """Lower case without accents and ` jr.`, hyphens as spaces, then only a-z and spaces, trimmed."""
    plain = F.regexp_replace(without_accents(F.lower(col(text))), r" jr\.", "")
    return F.trim(F.regexp_replace(F.translate(plain, "-", " "), "[^a-z ]", ""))


def name_contains(name: ColumnOrName, wanted: str) -> Column:
    """Accent- and case-insensitive search for a literal piece of text; digits and marks count."""
    plain = lambda c: without_accents(F.lower(c))
    return plain(col(name)).contains(plain(F.lit(wanted)))
