"""Dates and addresses as native Columns; a date is an ISO string, empty if there is none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, first_filled, let, squeeze
from .vocabulary import DATE_RANGE, DATE_SINGLE, PLACES


def iso(y: Column, m: Column, d: Column) -> Column:
    """yyyy-MM-dd of the parts, empty where they are no date."""
    day = F.try_make_timestamp(y.try_cast("int"), m.try_cast("int"), d.try_cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(8,6)"))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(""))


def normalize_date(c: Column | str, year: Column | None = None) -> Column:
    """Y.M.D, or M.D with a year, in dots, slashes or dashes, as an ISO date; else empty."""

    def whole(parts: Column) -> Column:
        part = lambda i: F.trim(F.get(parts, F.lit(i)))
        out = F.when(F.size(parts) == 3, iso(part(0), part(1), part(2)))
        if year is not None:
            out = out.when((F.size(parts) == 2) & year.isNotNull(), iso(year.cast("string"), part(0), part(1)))
        return out.otherwise("")

    return let(F.filter(F.split(F.regexp_replace(squeeze(c), "[./]", "-"), "-"), lambda x: F.trim(x) != ""), whole)


def date_range(c: Column | str) -> tuple[Column, Column]:
    """(start, end) of the first range in a text, whose short end borrows the start's year; else of the first date."""
    text = col(c)
    ranged = text.rlike(DATE_RANGE)
    first = normalize_date(F.when(ranged, F.regexp_extract(text, DATE_RANGE, 1)).otherwise(F.regexp_extract(text, DATE_SINGLE, 0)))

    def both(start: Column) -> Column:
        year = F.when(start != "", F.substring(start, 1, 4).try_cast("int"))
        return F.struct(start.alias("start"), F.when(ranged, normalize_date(F.regexp_extract(text, DATE_RANGE, 2), year)).otherwise("").alias("end"))

    found = let(first, both)
    return found["start"], found["end"]


def parse_iso(c: Column | str) -> Column:
    """A date of yyyy-MM-dd or yyyyMMdd, else null."""
    text = F.trim(col(c))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd")).when(text.rlike(r"^\d{8}$"), F.try_to_date(text, "yyyyMMdd"))


def effective_end(start: Column | str, end: Column | str) -> Column:
    return F.coalesce(parse_iso(end), parse_iso(start))


def is_current(start: Column | str, end: Column | str, today: Column) -> Column:
    """Whether the end, or else the start, is today or later; no date: false."""
    return F.coalesce(effective_end(start, end) >= today, F.lit(False))


def default_end(start: Column | str, end: Column | str) -> Column:
    return first_filled(end, start)


def location(c: Column | str) -> Column:
    """The first place that a pattern finds: a labelled one, then street addresses."""
    return first_filled(*[squeeze(F.regexp_extract(col(c), p, group)) for p, group in PLACES])


def address_parts(c: Column | str, suffixes: tuple = ("구", "군", "시")) -> tuple[Column, Column, Column]:
    """(main, sub, detail): the second token is sub if it ends in a suffix, and detail follows; else it is detail."""
    t = F.filter(F.split(squeeze(c), " "), lambda x: x != "")
    at = lambda i: F.coalesce(F.get(t, F.lit(i)), F.lit(""))
    sub = F.coalesce(*[F.when(at(1).endswith(s), F.lit(True)) for s in suffixes], F.lit(False))
    return at(0), F.when(sub, at(1)).otherwise(""), F.when(sub, at(2)).otherwise(at(1))
