"""Venue classification, URL choice and URL checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions.vocabulary import VenueRules
from ..operators.scoring import best_search_hit, classify_venue, search_hit, url_check
from ..sources.search import official_site_query


def classified(places: DataFrame, rules: VenueRules | None = None) -> DataFrame:
    """``places`` with label, confidence, type, reason and review flag: one projection, no shuffle."""
    return places.withColumns(classify_venue("title", "category", T.row_text(), rules))


def search_records(venues: DataFrame, results: DataFrame, venue: str = "venue_index") -> DataFrame:
    """The best search hit of each venue.  results: venue, query, pos, title, link, description, and maybe
    status and message."""
    hits = results.withColumnsRenamed({"title": "hit_title", "description": "hit_text"}).join(venues.select(venue, "title", "region_sub"), venue)
    scored = hits.withColumns(search_hit(F.col("title"), F.col("region_sub"), T.strip_tags_spaced("hit_title"), T.strip_tags_spaced("hit_text"), F.col("link"))).withColumn("link", T.unescape("link"))
    return best_search_hit(scored, venue)


def search_queries(venues: DataFrame, venue: str = "venue_index", suffix: str = "공식") -> DataFrame:
    """(venue, query): what is asked for each venue's own site."""
    return venues.select(venue, official_site_query(F.col("title"), T.first_filled(T.squeeze("road_address"), T.squeeze("full_address")), suffix).alias("query"))


def searched(venues: DataFrame, found: DataFrame, venue: str = "venue_index") -> DataFrame:
    """The records of venues whose queries' results are in ``found``: query, pos, title, link, description, status, message."""
    return search_records(venues, search_queries(venues, venue).join(found, "query"), venue)


def with_urls(venues: DataFrame, records: DataFrame | None = None, snapshots: DataFrame | None = None, venue: str = "venue_index", only_candidates: bool = True) -> DataFrame:
    """``venues`` with the chosen URL, where it came from, and its check against the snapshots."""
    empty = {"api_found_url": "", "api_search_status": "not_requested", "api_url_type": "", "api_match_score": 0, "api_search_reason": "", "api_search_query": ""}
    rows = venues.join(records, venue, "left") if records is not None else venues.withColumns({c: F.lit(v) for c, v in empty.items()})
    skip = (F.col("is_art_venue") == "no") if only_candidates else F.lit(False)
    rows = rows.withColumns({c: F.when(skip, {"api_search_status": "skipped", "api_search_reason": "not an art candidate"}.get(c, "" if v == "" or c == "api_search_status" else v)).otherwise(F.coalesce(c, F.lit(v))) for c, v in empty.items()})
    rows = rows.withColumn("__best", U.best_url(U.existing_url(), "api_found_url"))
    rows = rows.withColumns({"url": F.when(skip, "").otherwise(F.col("__best.url")), "selected_url_source": F.when(skip, "").otherwise(F.col("__best.source"))}).drop("__best")
    if snapshots is None:
        snapshots = venues.sparkSession.createDataFrame([], "url string, final_url string, status string, http_status string, title string, error string")
    return url_check(rows, snapshots, only_candidates=only_candidates).withColumnRenamed("final_url_type", "url_type").drop("url")
