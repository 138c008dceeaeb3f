"""Rule scorers compiled from vocabularies into native Columns."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions import vocabulary as V


def points(condition: Column, n: int) -> Column:
    return F.when(condition, n).otherwise(0)


def total(parts: list[Column]) -> Column:
    return reduce(add, parts, F.lit(0))


def evidence(*pairs: tuple[Column, Column | str]) -> Column:
    """The labels whose conditions hold, distinct, in order."""
    made = [F.when(c, F.lit(label) if isinstance(label, str) else label) for c, label in pairs]
    return F.array_distinct(F.filter(F.array(*made), lambda x: x.isNotNull()))


def lookup(table: dict, key: Column) -> Column:
    """The value of a fixed table, null if the key isn't there."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key) if table else F.lit(None)


# --- Venues -----------------------------------------------------------------------------------


def venue_type(title: Column, category: Column, types: tuple = V.VENUE_TYPES) -> Column:
    """The first kind whose words the title or category hold, else unknown."""
    text = F.lower(F.concat_ws(" ", title, category))
    out = None
    for label, words in types:
        out = F.when(T.any_pattern(text, words), label) if out is None else out.when(T.any_pattern(text, words), label)
    return out.otherwise("unknown")


def classify_venue(title: Column | str, category: Column | str, row_text: Column, rules: V.VenueRules | None = None) -> dict[str, Column]:
    """label, confidence, venue_type, reason, needs_manual_review of a place.

    A category known exactly decides alone.  Otherwise category, strong title, weak text, excluded
    category and negative title add up, clamped to 0..99; 80 is yes, 45 maybe.
    """
    rules = rules or V.VenueRules()
    title, category = T.squeeze(title), T.squeeze(category)
    excluded, negative = T.pattern_hits(category, rules.excluded), T.pattern_hits(title, rules.negative)
    strong, weak = T.pattern_hits(title, rules.strong), T.pattern_hits(row_text, rules.weak)
    base = lookup(rules.maybe, category)
    some = lambda a: F.size(a) > 0
    score = total([F.coalesce(base, F.lit(0)), points(some(strong), 28), points(some(weak), 12), points(some(excluded), -70), points(some(negative), -35)])
    score = F.greatest(F.lit(0), F.least(F.lit(99), score))
    label = F.when(score >= 80, "yes").when(score >= 45, "maybe").otherwise("no")
    review = F.when((label == "maybe") | ((label == "yes") & (some(excluded) | some(negative))), "yes").otherwise("no")
    listed = lambda prefix, a, n: F.concat(F.lit(prefix), F.array_join(F.slice(a, 1, n), ", "))
    reasons = F.array(
        F.when(base.isNotNull(), F.concat(F.lit(V.REASON_MAYBE), category)), F.when(some(strong), listed(V.REASON_STRONG, strong, 4)), F.when(some(weak), listed(V.REASON_WEAK, weak, 4)),
        F.when(some(excluded), listed(V.REASON_EXCLUDED, excluded, 3)), F.when(some(negative), listed(V.REASON_NEGATIVE, negative, 4)),
    )
    reason = F.coalesce(F.nullif(F.array_join(reasons, "; "), F.lit("")), F.lit(V.REASON_NONE))
    exact = {i: lookup({k: v[i] for k, v in rules.exact.items()}, category) for i in range(3)}
    return {
        "is_art_venue": F.coalesce(exact[0], label),
        "art_confidence": F.coalesce(exact[1], score).cast("int"),
        "venue_type": venue_type(title, category, rules.types),
        "classification_reason": F.coalesce(exact[2], reason),
        "needs_manual_review": F.when(exact[0].isNotNull(), "no").otherwise(review),
    }


# --- Search hits ------------------------------------------------------------------------------


def search_hit(title: Column, region_sub: Column, hit_title: Column, hit_text: Column, hit_link: Column, keywords: tuple = V.PAGE_KEYWORDS) -> dict[str, Column]:
    """score, reason and url_type of a search hit for a venue; titles are compared without white space."""
    wanted = F.regexp_replace(F.lower(T.col(title)), T.SPACE, "")
    both = F.concat_ws(" ", T.col(hit_title), T.col(hit_text))
    haystack = F.regexp_replace(F.lower(both), T.SPACE, "")
    kind = U.url_type(hit_link)
    named = (wanted != "") & F.contains(haystack, wanted)
    near = (T.col(region_sub) != "") & F.contains(both, T.col(region_sub))
    art = T.any_of(F.lower(both), keywords)
    own, blog, store = kind == "official_or_unknown", kind.isin("blog", "social"), kind == "store"
    score = total([points(named, 50), points(near, 10), points(art, 20), points(own, 15), points(blog, 8), points(store, -10)])
    why = evidence((named, "title_match"), (near, "region_match"), (art, "art_keyword"), (own, "official_like"), (blog, kind), (store, "store_penalty"))
    return {"score": score, "reason": F.array_join(why, "|"), "url_type": kind}


def best_search_hit(hits: DataFrame, venue: str = "venue_index", least: int = 20) -> DataFrame:
    """One record a venue: the first of its best hits and the status found, no_confident_match, no_results,
    or what the search itself ended with (missing_credentials, http_error_N, error).

    hits: venue, pos (null: the search gave nothing), link, score, reason, url_type, query, and maybe
    status and message."""
    usable = F.col("link") != ""
    told = "status" in hits.columns
    failed = (T.col("status") != "ok") & (T.col("status") != "") if told else F.lit(False)
    best = hits.groupBy(venue).agg(
        F.count("pos").alias("items"), F.min("query").alias("query"), F.max_by(F.when(usable, F.struct("link", "score", "reason", "url_type")), F.when(usable, F.struct("score", (-F.col("pos")).alias("p")))).alias("b"),
        F.max(F.when(failed, F.struct("status", T.col("message").alias("message")))).alias("f") if told else F.lit(None).cast("struct<status: string, message: string>").alias("f"),
    )
    none = F.col("items") == 0
    lost = none & F.col("f").isNotNull()
    found = ~none & (F.coalesce(F.col("b.score"), F.lit(-1)) >= least)
    status = F.when(lost, F.col("f.status")).when(none, "no_results").when(found, "found").otherwise("no_confident_match")
    why = F.when(lost, T.col("f.message")).when(none, "No search results.").when(found, T.first_filled(F.col("b.reason"), F.lit("best_search_result"))).otherwise(T.col("b.reason"))
    return best.select(
        venue, F.when(found, F.col("b.link")).otherwise("").alias("api_found_url"), status.alias("api_search_status"), F.when(found, F.col("b.url_type")).otherwise("").alias("api_url_type"),
        F.when(none, 0).otherwise(F.greatest(F.lit(0), F.coalesce("b.score", F.lit(0)))).alias("api_match_score"), why.alias("api_search_reason"), F.col("query").alias("api_search_query"),
    )


# --- Candidates -------------------------------------------------------------------------------


def initial_score(url: Column, decoded: Column, anchor: Column, context: Column, source: Column, rules: V.CandidateRules | None = None) -> tuple[Column, list]:
    """(score, evidence pairs) of a candidate before its page is read; overlapping patterns all count."""
    rules = rules or V.CandidateRules()
    haystack = F.concat_ws(" ", decoded, F.lower(T.col(anchor)), F.lower(T.col(context)), F.lower(T.col(source)))
    words = (("primary", 55, "primary_exhibition_keyword"), ("upcoming", 14, "upcoming_keyword"), ("current", 12, "current_keyword"), ("past", 8, "past_keyword"), ("secondary", 26, "secondary_info_keyword"))
    parts = [(T.any_of(haystack, getattr(rules, name)), n, label) for name, n, label in words]
    parts += [(haystack.rlike(f"(?iu){p}"), n, label) for p, n, label in rules.paths]
    parts += [(F.contains(T.col(source), F.lit(s)), n, f"source={s}") for s, n in rules.sources]
    detail = U.is_detail(url, decoded_url=decoded)
    parts += [(detail, -28, "detail_page_penalty"), (~detail, 10, "list_like_url")]
    bad = T.hits(haystack, rules.negative)
    score = total([points(c, n) for c, n, _ in parts]) - F.least(F.lit(45), 12 * F.size(bad))
    shown = [(c, label) for c, _, label in parts] + [(F.size(bad) > 0, F.concat(F.lit("negative="), F.array_join(F.slice(bad, 1, 4), "|")))]
    return F.greatest(F.lit(0), score), shown


def page_score(page_text: Column, read: Column, fetch_status: Column, http_status: Column, rules: V.CandidateRules | None = None) -> tuple[Column, list]:
    """(score, evidence pairs) of a candidate's page; ``read`` tells whether there is a page summary."""
    rules = rules or V.CandidateRules()
    text = F.lower(T.col(page_text))
    words = (("primary", 35, "page_title_heading_exhibition"), ("upcoming", 8, "page_upcoming_keyword"), ("current", 6, "page_current_keyword"), ("secondary", 16, "page_notice_news_program"))
    parts = [(read & T.any_of(text, getattr(rules, name)), n, label) for name, n, label in words]
    bad = T.hits(text, rules.negative)
    negative = read & (F.size(bad) > 0)
    shown = [(c, label) for c, _, label in parts] + [(negative, F.concat(F.lit("page_negative="), F.array_join(F.slice(bad, 1, 4), "|")))]
    odd = (T.col(fetch_status) == "ok") & (T.col(http_status) != "") & ~T.col(http_status).startswith("2")
    failed = T.col(fetch_status).isin("error", "http_error")
    score = total([points(c, n) for c, n, _ in parts]) - F.when(negative, F.least(F.lit(35), 8 * F.size(bad))).otherwise(0) - F.when(odd, 30).when(failed, 18).otherwise(0)
    return score, [*shown, (odd, "non_2xx_status"), (~odd & failed, "fetch_failed")]


def confidence(initial: Column, page: Column, detail: Column, source: Column, fetch_status: Column) -> Column:
    """The sum clamped to 0..100, under the cap of how far the candidate was checked."""
    status = T.col(fetch_status)
    sum_ = F.greatest(F.lit(0), F.least(F.lit(100), initial + page))
    cap = F.when(status.isin("error", "http_error"), 45).when(status != "", 100).when(F.contains(T.col(source), F.lit("common_path")), 48).when(F.contains(T.col(source), F.lit("inferred_list_path")), 65).otherwise(80)
    return F.least(sum_, cap, F.when(detail, 72).otherwise(100))


def candidate_type(url: Column, decoded: Column, anchor: Column, page_text: Column, rules: V.CandidateRules | None = None) -> Column:
    rules = rules or V.CandidateRules()
    text = F.concat_ws(" ", decoded, F.lower(T.col(anchor)), F.lower(T.col(page_text)))
    main = T.any_of(text, rules.primary)
    return (
        F.when(main & U.is_detail(url, decoded_url=decoded), "exhibition_detail").when(main & T.any_of(text, rules.upcoming), "upcoming_exhibition").when(main & T.any_of(text, rules.current), "current_exhibition")
        .when(main & T.any_of(text, rules.past), "past_exhibition").when(main, "exhibition_list").when(T.any_of(text, rules.notice), "notice_likely").when(T.any_of(text, rules.news), "news_likely")
        .when(T.any_of(text, rules.program), "program_likely").otherwise("weak_candidate")
    )


def scored_candidates(candidates: DataFrame, rules: V.CandidateRules | None = None, with_pages: bool = True) -> DataFrame:
    """``candidates`` (url, source, anchor_text, source_context, fetch_status, http_status, page_title,
    heading_text, page_meta) with initial_score, page_score, confidence, candidate_type, evidence and
    needs_manual_review."""
    # the URL is decoded once, in Python; all rules then read the column
    rows = candidates.withColumn("__decoded", U.decoded("url"))
    url, source, decoded = F.col("url"), F.col("source"), F.col("__decoded")
    initial, first = initial_score(url, decoded, F.col("anchor_text"), F.col("source_context"), source, rules)
    text = F.concat_ws(" ", T.col("page_title"), T.col("heading_text"), T.col("page_meta")) if with_pages else F.lit("")
    read = F.col("page_read") if with_pages else F.lit(False)
    status = F.col("fetch_status") if with_pages else F.lit("")
    http = F.col("http_status") if with_pages else F.lit("")
    page, second = page_score(text, read, status, http, rules)
    kind = candidate_type(url, decoded, F.col("anchor_text"), F.when(read, text).otherwise(""), rules)
    scored = rows.withColumns({"initial_score": initial, "page_score": page, "evidence": evidence(*first, *second), "candidate_type": kind})
    sure = confidence(F.col("initial_score"), F.col("page_score"), U.is_detail(url, decoded_url=decoded), source, status)
    return scored.withColumn("confidence", sure).withColumn("needs_manual_review", F.when(F.col("confidence") < 55, "yes").otherwise("no")).drop("__decoded")


# --- Images and recognised text ---------------------------------------------------------------


def image_score(url: Column, alt: Column, title: Column, rules: V.EventRules | None = None) -> Column:
    """0 to 1, in whole hundredths: hints, poster words, an image suffix, and long captions."""
    rules = rules or V.EventRules()
    meta = F.lower(T.joined(url, alt, title))
    score = total([points(T.any_of(meta, rules.image_hints), 45), points(T.any_of(meta, rules.image_poster), 25), points(F.lower(T.col(url)).rlike(V.IMAGE_EXTENSION), 10), points(F.length(T.squeeze(alt)) >= 6, 10), points(F.length(T.squeeze(title)) >= 6, 10)])
    return F.least(F.lit(100), score) / 100.0


def ocr_score(text: Column, rules: V.EventRules | None = None) -> Column:
    """0 to 1: length, dates, title words, quotes."""
    rules = rules or V.EventRules()
    line = T.squeeze(text)
    score = F.least(F.length(line) / 120.0, F.lit(0.35)) + total([points(line.rlike(V.DATE_RANGE), 30), points(line.rlike(V.DATE_SINGLE), 12), points(T.any_of(line, rules.strong), 20), points(T.any_of(line, rules.quotes), 10), points(T.any_of(line, rules.ocr_words), 15)]) / 100.0
    return F.when(line == "", 0.0).otherwise(F.least(F.lit(1.0), score))


def best_ocr_text(variants: DataFrame, key: str, text: str = "text", position: str = "pos", rules: V.EventRules | None = None) -> DataFrame:
    """The best recognised text of each key: score, then length, then the first."""
    line = T.squeeze(text)
    rows = variants.filter(line != "")
    return rows.groupBy(key).agg(F.max_by(F.col(text), F.struct(ocr_score(F.col(text), rules), F.length(line), -F.col(position))).alias(text))


def url_check(checked: DataFrame, snapshots: DataFrame, keywords: tuple = V.PAGE_KEYWORDS, only_candidates: bool = True) -> DataFrame:
    """``checked`` (url, is_art_venue, ...) with the fetch result of its URL: status blank, skipped, ok,
    http_error, error or not_checked, the final URL, its kind, title and keyword hits.

    snapshots: url, final_url, status, http_status, title, error, one row a URL."""
    own = U.with_scheme("url")
    rows = checked.withColumn("__url", own)
    seen = snapshots.select(F.col("url").alias("__url"), *[F.col(c).alias(f"__{c}") for c in ("final_url", "status", "http_status", "title", "error")])
    out = rows.join(seen, "__url", "left")
    skip = (F.col("is_art_venue") == "no") if only_candidates else F.lit(False)
    status = F.when(skip, "skipped").when(T.col("url") == "", "blank").otherwise(F.coalesce("__status", F.lit("not_checked")))
    live = ~status.isin("skipped", "blank")
    final = T.first_filled("__final_url", "__url")
    ok = status == "ok"
    return out.select(
        *[c for c in checked.columns], F.when(live, T.squeeze("url")).otherwise("").alias("input_url"), F.when(live, final).otherwise("").alias("verified_url"), status.alias("url_status"),
        F.when(live, T.col("__http_status")).otherwise("").alias("url_http_status"), F.when(live, U.url_type(F.when(ok, final).otherwise(F.col("__url")))).otherwise("").alias("final_url_type"),
        F.when(ok, T.col("__title")).otherwise("").alias("url_page_title"), F.when(ok, T.keyword_hits(keywords, "__title", final)).otherwise("").alias("url_art_keyword_hits"),
        F.when(skip, "not an art candidate").when(live, T.cut("__error", 240)).otherwise("").alias("url_error"),
    )
