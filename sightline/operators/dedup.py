"""First-wins dedup, ordered merges, and summaries that keep an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

EVENT_KEY = ("exhibition_name", "start_date", "end_date", "detail_url")


def first_by(df: DataFrame, keys: list[Column], position: str) -> DataFrame:
    """The first row of each key.  A map-side combined minimum by position, so a hot key costs one row a task."""
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    whole = F.struct(*df.columns)
    return df.groupBy(*named).agg(F.min_by(whole, F.col(position)).alias("__row")).select("__row.*")


def first_wide(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """As ``first_by``, for wide rows and positions that don't repeat: the least position of each key is found
    first, over small rows, and only its row moves."""
    least = df.groupBy(*keys).agg(F.min(position).alias(position))
    return df.join(least, [*keys, position], "left_semi")


def dedupe_events(events: DataFrame, position: str = "position", page: str | None = None) -> DataFrame:
    """Events squeezed, the first of each (name in lower case, start, end, detail URL), of each page if given."""
    fields = [*EVENT_KEY, "location", "source_list_url"]
    clean = events.withColumns({c: T.squeeze(c) for c in fields if c in events.columns})
    keys = [F.lower("exhibition_name"), *[F.col(c) for c in EVENT_KEY[1:]], *([F.col(page)] if page else [])]
    return first_by(clean, keys, position)


def dedupe_places(places: DataFrame, position: str = "position") -> DataFrame:
    """The first of each (title, full_address, official_url), as they are."""
    return first_by(places, [F.col(c) for c in ("title", "full_address", "official_url")], position)


def unseen(rows: DataFrame, before: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key isn't in an earlier output; null keys count as equal."""
    old = before.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = [rows[k].eqNullSafe(old[f"__{k}"]) for k in keys]
    return rows.join(old, same, "left_anti")


def _gather(parts: Column, separator: str, whole: bool) -> Column:
    """Folds strings in order: a part is added unless it is a member (whole) or a substring of what is there.
    What is joined has no bars or spaces at its ends."""

    def step(acc: Column, x: Column) -> Column:
        there = F.array_contains(F.split(acc, r"\|"), x) if whole else F.contains(acc, x)
        both = F.concat(acc, F.lit(separator), x)
        return F.when((x == "") | ((acc != "") & there), acc).when((acc == "") & F.lit(whole), x).otherwise(both if whole else F.regexp_replace(T.squeeze(both), r"^[ |]+|[ |]+$", ""))

    return F.aggregate(F.slice(parts, 2, 1 << 30), F.coalesce(F.get(parts, F.lit(0)), F.lit("")), step)


def merge_candidates(candidates: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """One row for each key (such as host and candidate key): the first URL; the distinct sources joined by
    a bar; anchor texts and contexts joined unless what is there holds them.

    The substring rule depends on the order, so each field's distinct values are reduced to their first
    positions, with map-side combining; what one key gathers of a field is its distinct values."""
    clean = candidates.withColumns({"source": T.col("source"), "anchor_text": T.squeeze("anchor_text"), "source_context": T.squeeze("source_context")})
    first = clean.groupBy(*keys).agg(F.min(F.struct(position, "url")).alias("__first")).select(*keys, F.col(f"__first.{position}").alias(position), F.col("__first.url").alias("url"))
    fields = ("source", "anchor_text", "source_context")
    # one row for each field of a candidate: its value under the field's number
    each = clean.select(*keys, position, F.posexplode(F.array(*fields)).alias("__field", "__value"))
    once = each.groupBy(*keys, "__field", "__value").agg(F.min(position).alias("__at"))
    got = once.groupBy(*keys).agg(*[F.sort_array(F.collect_list(F.when(F.col("__field") == i, F.struct("__at", "__value")))).alias(f) for i, f in enumerate(fields)])
    values = lambda f: F.transform(f, lambda r: r["__value"])
    joined = got.select(*keys, *[_gather(values(f), "|" if f == "source" else " | ", f == "source").alias(f) for f in fields])
    return first.join(joined, keys)


def summarize_failures(failures: DataFrame, key: str, position: str = "position", most: int = 800) -> DataFrame:
    """Each key's failure stages and types (sorted, distinct) and its messages, distinct in order and cut.

    Messages are reduced to their first position before they are gathered."""
    clean = failures.select(key, T.col("stage").alias("stage"), T.col("error_type").alias("error_type"), T.squeeze("error_message").alias("message"), position)
    once = clean.groupBy(key, "stage", "error_type", "message").agg(F.min(position).alias(position))
    got = once.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(F.nullif("stage", F.lit("")))), ",").alias("failure_stage"), F.array_join(F.sort_array(F.collect_set(F.nullif("error_type", F.lit("")))), ",").alias("failure_type"), F.sort_array(F.collect_list(F.struct(position, "message"))).alias("m"))
    text = F.array_join(F.array_distinct(F.filter(F.transform("m", lambda r: r["message"]), lambda x: x != "")), " | ")
    return got.select(key, "failure_stage", "failure_type", F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("..."))).otherwise(text).alias("failure_message"))


def label_summary(rows: DataFrame, label: str = "is_art_venue", status: str = "url_status", search: str = "api_search_status") -> DataFrame:
    """One row of counts: rows, labels, URL statuses, searches that found something."""
    count = lambda c, v: F.count_if(F.col(c) == v)
    return rows.agg(F.count("*").alias("n_rows"), *[count(label, x).alias(f"n_{x}") for x in ("yes", "maybe", "no")], *[count(status, x).alias(f"n_url_{x}") for x in ("ok", "blank", "skipped")], count(search, "found").alias("n_api_found"))


def discovery_summary(rows: DataFrame, venue: str = "venue_index", strong: int = 55) -> DataFrame:
    """One row: venues, venues with a candidate, venues with a strong one, rows."""
    return rows.agg(F.count_distinct(venue).alias("n_venues"), F.count_distinct(F.when(F.col("candidate_type") != "not_found", F.col(venue))).alias("n_found"), F.count_distinct(F.when(F.col("confidence") >= strong, F.col(venue))).alias("n_strong"), F.count("*").alias("n_rows"))
