"""Event records: validity, gap filling, page outcomes, release rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..functions.vocabulary import EVENT_GENERIC
from .dedup import first_by


def is_valid(name: str = "exhibition_name", start: str = "start_date", end: str = "end_date") -> Column:
    """A name and a date."""
    return (T.col(name) != "") & ((T.col(start) != "") | (T.col(end) != ""))


def needs_detail() -> Column:
    return (T.col("start_date") == "") | (T.col("end_date") == "") | (T.col("location") == "")


def runs(mode: str, missing: Column) -> Column:
    """Whether a costlier stage runs: always, auto (where something is missing) or never."""
    return F.lit(True) if mode == "always" else missing if mode == "auto" else F.lit(False)


def kept_labels(rows: DataFrame, label: str = "is_art_venue", keep: tuple = ("yes", "maybe")) -> DataFrame:
    return rows.filter(F.trim(T.col(label)).isin(*keep))


def filled(more: dict[str, list[Column]], generic: tuple = EVENT_GENERIC) -> dict[str, Column]:
    """Event fields with gaps filled from the first candidate that isn't empty; a generic name is replaced too."""
    new = {c: T.first_filled(c, *found) for c, found in more.items() if c != "exhibition_name"}
    if "exhibition_name" in more:
        name = F.col("exhibition_name")
        new["exhibition_name"] = F.when((T.col(name) == "") | name.isin(*generic), T.first_filled(*more["exhibition_name"], name)).otherwise(name)
    return new


def merge_fields(events: DataFrame, found: DataFrame, key: str, generic: tuple = EVENT_GENERIC) -> DataFrame:
    """``events`` with gaps filled from at most one row of ``found`` a key; a generic name is replaced too."""
    fields = ("start_date", "end_date", "location", "detail_url")
    more = found.select(key, *[F.col(c).alias(f"__{c}") for c in ("exhibition_name", *fields) if c in found.columns])
    out = events.join(more, key, "left")
    return out.withColumns(filled({c: [F.col(f"__{c}")] for c in ("exhibition_name", *fields) if f"__{c}" in more.columns}, generic)).select(*events.columns)


def outcomes(pages: DataFrame, events: DataFrame, failures: DataFrame, today: Column, page: str = "list_url", carry: tuple = ()) -> DataFrame:
    """One row for each current event, or one status row for a page without any.

    pages: page, and columns to carry; events: page and the event fields, maybe with failure fields of
    their own; failures: page and its summary.  A page whose valid events are all over is ``filtered``;
    else it is ``failed``.  Events meet their page by a join, so no row gathers a page's events."""
    fields = ("exhibition_name", "start_date", "end_date", "location", "detail_url")
    summary = ("failure_stage", "failure_type", "failure_message")
    valid = events.filter(is_valid()).withColumn("__current", D.is_current("start_date", "end_date", today))
    # what a page has, with map-side combining: one small row a page
    had = valid.groupBy(page).agg(F.max("__current").alias("__any"))
    mine = valid.filter("__current").select(page, *fields, *[(T.col(c) if c in events.columns else F.lit("")).alias(c) for c in summary])
    rest = [T.squeeze(c).alias(c) for c in carry]
    ok = pages.select(page, *carry).join(mine, page).select(*[T.squeeze(c).alias(c) for c in fields], F.col(page).alias("source_list_url"), F.lit("ok").alias("status"), *[T.squeeze(c).alias(c) for c in summary], *rest)
    none = pages.select(page, *carry).join(had, page, "left").filter("__any is null or not __any").join(failures.select(page, *summary), page, "left")
    gone = F.col("__any").isNotNull()
    said = {"failure_stage": ("filtered", "no-events"), "failure_type": ("Filtered", "NoEvents"), "failure_message": ("Filtered out by end_date < today", "No events extracted")}
    status = none.select(
        *[F.lit("").alias(c) for c in fields], F.col(page).alias("source_list_url"), F.when(gone, "filtered").otherwise("failed").alias("status"),
        *[T.first_filled(c, F.when(gone, over).otherwise(nothing)).alias(c) for c, (over, nothing) in said.items()], *rest,
    )
    return ok.unionByName(status)


def release(events: DataFrame, carry: tuple = (), fill_end: bool = False, position: str = "position") -> DataFrame:
    """Release rows: valid events, the first of each key, ends filled before keys are compared."""
    c = {x: T.squeeze(x) for x in ("exhibition_name", "start_date", "end_date", "location", "detail_url", "source_list_url")}
    end = D.default_end(c["start_date"], c["end_date"]) if fill_end else c["end_date"]
    rows = events.select(
        c["exhibition_name"].alias("exhibition_name"), c["start_date"].alias("exhibition_start_date"), end.alias("exhibition_end_date"), c["location"].alias("exhibition_location"),
        c["detail_url"].alias("exhibition_detail_url"), c["source_list_url"].alias("source_list_url"), *[T.squeeze(x).alias(x) for x in carry], position,
    ).filter(is_valid("exhibition_name", "exhibition_start_date", "exhibition_end_date"))
    return first_by(rows, [F.lower("exhibition_name"), *[F.col(f"exhibition_{x}") for x in ("start_date", "end_date", "detail_url")]], position)
