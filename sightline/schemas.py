"""Column orders of the tables that pipelines read and write (fixed values); all cells are strings."""

from __future__ import annotations

PLACES = ("title", "link", "start_date", "end_date", "full_address", "road_address", "region_main", "region_sub", "region_detail", "official_url", "summary", "tel", "category", "price", "mapx", "mapy", "source_query")
CLASSIFIED = (
    "input_url", "verified_url", "url_status", "url_http_status", "url_type", "url_page_title", "url_art_keyword_hits", "url_error", "api_found_url", "api_search_status", "api_url_type", "api_match_score",
    "api_search_reason", "api_search_query", "selected_url_source", "is_art_venue", "art_confidence", "venue_type", "classification_reason", "needs_manual_review",
)
CANDIDATES = (
    "venue_index", "venue_title", "is_art_venue", "venue_type", "homepage_url", "homepage_status", "rank", "candidate_url", "candidate_type", "confidence", "score", "source", "source_link_text", "evidence_text",
    "http_status", "fetch_status", "page_title", "heading_text", "needs_manual_review", "error",
)
EVENTS = ("exhibition_name", "start_date", "end_date", "location", "detail_url", "source_list_url", "status", "failure_stage", "failure_type", "failure_message")
FAILED_PAGES = ("list_url", "stage", "error_type", "error_message", "source_title")
RELEASE = ("exhibition_name", "exhibition_start_date", "exhibition_end_date", "exhibition_location", "exhibition_detail_url", "source_list_url")
#: A fetched page: one row a URL.
SNAPSHOT = "url string, final_url string, status string, http_status string, content_type string, text string, error string"
EVENT_FIELDS = "exhibition_name string, start_date string, end_date string, location string, detail_url string"
