"""Text scalars as native Columns; null counts as empty everywhere."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Every character that Python's str.split() takes for white space.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


def col(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def squeeze(c: Column | str) -> Column:
    """White space runs become one space; none at the ends."""
    return F.trim(F.regexp_replace(col(c), SPACE, " "))


@F.pandas_udf(StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape(c: Column | str) -> Column:
    """HTML entities become characters; texts without an ampersand stay inside the JVM's columns."""
    return _unescape(col(c))


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def strip_tags(c: Column | str) -> Column:
    """Tags go, entities are decoded, the ends trimmed."""
    return F.regexp_replace(unescape(F.regexp_replace(col(c), "<[^>]+>", "")), f"^{SPACE}|{SPACE}$", "")


def strip_tags_spaced(c: Column | str) -> Column:
    """Tags become spaces, white space is squeezed, then entities are decoded."""
    return unescape(squeeze(F.regexp_replace(col(c), "<[^>]*>", " ")))


def split_lines(c: Column | str) -> Column:
    """Lines between newlines, bars and bullets, squeezed, without blank ones."""
    parts = F.split(F.regexp_replace(col(c), "\r", "\n"), "[\n|•·]+")
    return F.filter(F.transform(parts, squeeze), lambda x: x != "")


def tokens(c: Column | str) -> Column:
    """Distinct lower-case alphanumeric tokens of two characters or more, in order."""
    parts = F.split(F.lower(squeeze(c)), "[^0-9a-zA-Z가-힣]+")
    return F.array_distinct(F.filter(parts, lambda x: F.length(x) >= 2))


def link_text(c: Column | str) -> Column:
    return F.lower(squeeze(c))


def joined(*columns: Column | str) -> Column:
    """The columns with a space between, squeezed."""
    return squeeze(F.concat_ws(" ", *[col(c) for c in columns]))


def row_text() -> Column:
    """What a place row says, for weak keywords."""
    return joined("title", "category", "summary", "source_query", "road_address", "full_address")


def strings(words) -> Column:
    """The words as an array literal."""
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def any_of(text: Column, words) -> Column:
    """Whether any word is a substring: one alternation over quoted words."""
    return text.rlike("|".join(re.escape(w) for w in words)) if words else F.lit(False)


def hits(text: Column, words) -> Column:
    """The words that are substrings, in their order."""
    return F.filter(F.array(*[F.when(F.contains(text, F.lit(w)), F.lit(w)) for w in words]), lambda w: w.isNotNull()) if words else strings(())


def keyword_hits(words, *columns: Column | str) -> Column:
    """Hits over the lower-cased columns, joined by a bar."""
    return F.array_join(hits(F.lower(F.concat_ws(" ", *[col(c) for c in columns])), words), "|")


def pattern_hits(text: Column, patterns) -> Column:
    """The patterns that are found, case aside, in their order."""
    found = [F.when(text.rlike(f"(?iu){p}"), F.lit(p)) for p in patterns]
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array().cast("array<string>")


def any_pattern(text: Column, patterns) -> Column:
    return text.rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False)


def first_filled(*columns: Column | str) -> Column:
    """The first column that isn't empty, or empty."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in columns], F.lit(""))


def safe_int(c: Column | str, default: int = 0) -> Column:
    return F.coalesce(col(c).try_cast("int"), F.lit(default))


def cut(c: Column | str, length: int) -> Column:
    return F.substring(col(c), 1, length)
