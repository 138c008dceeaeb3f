"""URL discovery: candidates from every source of a site, merged, scored, probed and ranked."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..functions import vocabulary as V
from ..operators.dedup import merge_candidates
from ..operators.html import parsed, robots_sitemaps, sitemap_locs
from ..operators.ranking import probe_targets, top_n
from ..operators.scoring import scored_candidates
from ..schemas import CANDIDATES
from ..session import kept
from ..sources.search import site_query


@dataclass(frozen=True)
class Options:
    top_n: int = 5
    max_home_links: int = 250
    max_sitemap_urls: int = 500
    probe_pages: int = 5
    sitemap: bool = True
    common_paths: bool = True
    site_search: bool = True
    rules: V.CandidateRules = V.CandidateRules()


FIELDS = ("venue_index", "source_ord", "position", "url", "source", "anchor_text", "source_context")


def homepages(venues: DataFrame, snapshots: DataFrame, limit: int = 800_000) -> DataFrame:
    """Each venue with its homepage's snapshot (status empty where there is none), parsed once."""
    rows = venues.withColumn("homepage_url", U.homepage(*[c for c in ("verified_url", "input_url", "api_found_url", "official_url", "link") if c in venues.columns]))
    seen = snapshots.select(F.col("url").alias("homepage_url"), F.col("final_url").alias("__final"), F.col("status").alias("homepage_status"), F.col("content_type").alias("__kind"), F.substring("text", 1, limit).alias("__text"))
    out = rows.join(seen, "homepage_url", "left")
    readable = (F.col("homepage_status") == "ok") & F.contains(F.lower(T.col("__kind")), F.lit("html"))
    # a page that wasn't fetched is an error
    return out.withColumns(
        {"final_homepage": T.first_filled(U.clean_url(T.first_filled("__final", "homepage_url"), entities=False), "homepage_url"), "homepage_status": F.when(F.col("homepage_url") == "", "no_homepage_url").otherwise(F.coalesce("homepage_status", F.lit("error"))), "readable": F.coalesce(readable, F.lit(False))}
    ).withColumn("page", F.when(F.col("readable"), parsed("__text", "final_homepage"))).drop("__final", "__kind", "__text")


def with_inferred(rows: DataFrame) -> DataFrame:
    """Each candidate, then the list pages its URL hints at."""
    more = rows.select("venue_index", "source_ord", F.col("position").alias("at"), F.posexplode(U.infer_list_urls("url")).alias("i", "x"), "anchor_text")
    inferred = more.select("venue_index", "source_ord", (F.col("at") + F.col("i") + 1).alias("position"), F.col("x.url").alias("url"), F.lit("inferred_list_path").alias("source"), "anchor_text", F.col("x.reason").alias("source_context"))
    return rows.select(*FIELDS).unionByName(inferred)


def from_homepage(home: DataFrame, o: Options) -> DataFrame:
    links = home.filter("readable").select("venue_index", "final_homepage", F.posexplode(F.slice("page.links", 1, o.max_home_links)).alias("i", "link"))
    links = links.filter(~F.col("link.href").rlike("^(mailto:|tel:|javascript:)"))
    rows = links.select("venue_index", "final_homepage", (F.col("i") * 10).cast("long").alias("position"), U.clean_url("link.url", entities=False).alias("url"), T.squeeze("link.text").alias("anchor_text"), T.squeeze("link.context").alias("source_context"))
    rows = rows.filter((F.col("url") != "") & U.same_host("final_homepage", "url")).filter(U.is_relevant(F.col("url"), F.col("anchor_text"), F.col("source_context"), o.rules))
    nav = F.col("source_context").rlike("header|nav")
    return with_inferred(rows.withColumns({"source_ord": F.lit(0), "source": F.when(nav, "homepage_nav").otherwise("homepage_link")}))


def from_self(home: DataFrame, o: Options) -> DataFrame:
    """The homepage itself: if it looks like a list page, or if it can't be read."""
    rows = home.filter("homepage_url <> ''")
    said = F.concat_ws(" ", T.col("page.title"), T.col("page.headings"))
    rows = rows.filter(~F.col("readable") | U.is_relevant(F.col("final_homepage"), said, F.lit(""), o.rules))
    return rows.select("venue_index", F.lit(0).alias("source_ord"), F.lit(1 << 40).alias("position"), F.col("final_homepage").alias("url"), F.when(F.col("readable"), "homepage_self").otherwise("homepage_unreadable").alias("source"), T.squeeze("title").alias("anchor_text"), F.when(F.col("readable"), T.col("page.title")).otherwise("").alias("source_context"))


def root(url: Column) -> Column:
    return F.regexp_extract(url, "^([^:/?#]+://[^/?#]*)", 1)


def from_sitemaps(home: DataFrame, snapshots: DataFrame, o: Options) -> DataFrame:
    """Relevant URLs of the default sitemaps and those that robots.txt names, and of up to ten nested
    ones each.  One level of nesting needs two joins and no recursion."""
    ok = snapshots.filter("status = 'ok'").select(F.col("url").alias("at"), "text")
    base = home.filter("homepage_url <> ''").select("venue_index", "final_homepage", root(F.col("final_homepage")).alias("root"))
    named = base.join(ok.withColumnRenamed("at", "robots"), F.concat("root", F.lit("/robots.txt")) == F.col("robots"), "left")
    maps = F.concat(F.array(F.concat("root", F.lit("/sitemap.xml")), F.concat("root", F.lit("/sitemap_index.xml"))), F.coalesce(robots_sitemaps("text"), F.array().cast("array<string>")))
    maps = named.select("venue_index", "final_homepage", F.posexplode(F.array_distinct(F.transform(maps, lambda u: U.clean_url(u, entities=False)))).alias("m", "at")).join(ok, "at")
    locs = maps.select("venue_index", "final_homepage", "m", F.posexplode(sitemap_locs("text")).alias("i", "loc")).withColumn("loc", T.unescape("loc"))
    inner = Window.partitionBy("venue_index", "m").orderBy("i")
    nested = locs.filter(F.lower("loc").endswith(".xml")).withColumn("n", F.row_number().over(inner)).filter("n <= 10")
    deep = nested.join(ok, F.col("loc") == F.col("at")).select("venue_index", "final_homepage", "m", ((F.col("n") + 1) * F.lit(10_000_000)).cast("long").alias("base"), F.posexplode(sitemap_locs("text")).alias("i", "loc"))
    both = locs.select("venue_index", "final_homepage", "m", F.col("i").cast("long").alias("i"), "loc").unionByName(deep.select("venue_index", "final_homepage", "m", (F.col("base") + F.col("i")).alias("i"), T.unescape("loc").alias("loc")))
    rows = top_n(both, "venue_index", [F.col("m"), F.col("i")], o.max_sitemap_urls, "k").withColumn("url", U.clean_url("loc", entities=False))
    rows = rows.filter((F.col("url") != "") & U.same_host("final_homepage", "url")).filter(U.is_relevant(F.col("url"), F.lit(""), F.lit(""), o.rules))
    return with_inferred(rows.select("venue_index", F.lit(1).alias("source_ord"), (F.col("k") * 10).cast("long").alias("position"), "url", F.lit("sitemap").alias("source"), F.lit("").alias("anchor_text"), F.lit("").alias("source_context")))


def from_common_paths(home: DataFrame, paths: tuple = V.LIKELY_PATHS) -> DataFrame:
    rows = home.filter("homepage_url <> ''").select("venue_index", root(F.col("final_homepage")).alias("root"), F.posexplode(T.strings(paths)).alias("i", "path"))
    return rows.select("venue_index", F.lit(2).alias("source_ord"), F.col("i").cast("long").alias("position"), U.join_path(F.col("root"), F.col("path")).alias("url"), F.lit("common_path").alias("source"), F.regexp_replace("path", "^/+|/+$", "").alias("anchor_text"), F.lit("").alias("source_context"))


def from_site_search(home: DataFrame, results: DataFrame, o: Options) -> DataFrame:
    """Relevant results on the venue's own host.  results: venue_index, pos, title, link, description."""
    found = results.filter("pos is not null").select("venue_index", "pos", U.clean_url("link").alias("url"), T.strip_tags_spaced("title").alias("anchor_text"), T.strip_tags_spaced("description").alias("source_context"))
    rows = found.join(home.select("venue_index", "final_homepage"), "venue_index").filter((F.col("url") != "") & U.same_host("final_homepage", "url"))
    rows = rows.filter(U.is_relevant(F.col("url"), F.concat_ws(" ", "anchor_text", "source_context"), F.lit(""), o.rules))
    return with_inferred(rows.withColumns({"source_ord": F.lit(3), "position": (F.col("pos") * 10).cast("long"), "source": F.lit("naver_site_search")}))


def site_queries(home: DataFrame) -> DataFrame:
    """(venue_index, query): what is searched for on each venue's own site."""
    return home.filter("homepage_url <> ''").select("venue_index", site_query(U.host_key("final_homepage"), F.col("title")).alias("query"))


def candidates(home: DataFrame, snapshots: DataFrame, search: DataFrame | None, o: Options) -> DataFrame:
    """One row for each candidate of a venue, evidence merged within a source, then over the sources."""
    rows = from_homepage(home, o).unionByName(from_self(home, o))
    if o.sitemap:
        rows = rows.unionByName(from_sitemaps(home, snapshots, o))
    if o.common_paths:
        rows = rows.unionByName(from_common_paths(home))
    if o.site_search and search is not None:
        rows = rows.unionByName(from_site_search(home, search, o))
    rows = rows.withColumn("url", U.bare_url(F.col("url"))).filter("url <> ''").withColumn("key", U.candidate_key("url"))
    inner = merge_candidates(rows, ["venue_index", "source_ord", "key"])
    inner = inner.withColumn("position", F.col("source_ord") * F.lit(1 << 42) + F.col("position")).drop("source_ord")
    return merge_candidates(inner, ["venue_index", "key"])


def scored(found: DataFrame, snapshots: DataFrame, o: Options) -> DataFrame:
    """All candidates with their scores: the ``probe_pages`` best of each venue by first score have their page read."""
    first = scored_candidates(kept(found, "candidates"), o.rules, with_pages=False).select("venue_index", "position", "url", "source", "anchor_text", "source_context", F.col("initial_score").alias("first_score"))
    probed = probe_targets(first, "venue_index", "first_score", "position", o.probe_pages)
    pages = snapshots.select(F.col("url").alias("__url"), F.col("status").alias("fetch_status"), "http_status", "error", F.contains(F.lower(T.col("content_type")), F.lit("html")).alias("is_html"), F.substring("text", 1, 500_000).alias("__text"))
    # only probed candidates meet the snapshots: the others never carry a page through the join
    target = probed.filter("probe").join(pages, F.col("url") == F.col("__url"), "left")
    read = F.coalesce((F.col("fetch_status") == "ok") & F.col("is_html"), F.lit(False))
    target = target.withColumn("page_read", read).withColumn("p", F.when(F.col("page_read"), parsed("__text", "url", ("title", "headings", "meta"))))
    target = target.withColumns({"fetch_status": F.coalesce("fetch_status", F.lit("error")), "http_status": T.col("http_status"), "error": T.col("error"), "page_title": T.col("p.title"), "heading_text": T.col("p.headings"), "page_meta": T.col("p.meta")})
    columns = ("venue_index", "position", "url", "source", "anchor_text", "source_context", "first_score", "page_read", "fetch_status", "http_status", "error", "page_title", "heading_text", "page_meta")
    rest = probed.filter("not probe").withColumns({"page_read": F.lit(False), **{c: F.lit("") for c in columns[8:]}})
    return scored_candidates(kept(target.select(*columns).unionByName(rest.select(*columns)), "probed"), o.rules)


def ranked(found: DataFrame, snapshots: DataFrame, o: Options) -> DataFrame:
    """The best candidates of each venue, by their confidence once the best pages are read."""
    top = top_n(scored(found, snapshots, o), "venue_index", [F.desc("confidence"), F.desc("first_score"), F.asc("position")], o.top_n)
    best = F.max("confidence").over(Window.partitionBy("venue_index"))
    return top.withColumn("__best", best).filter((F.col("confidence") >= 30) | (F.col("__best") < 30)).drop("__best")


def discover(venues: DataFrame, snapshots: DataFrame, search: DataFrame | None = None, options: Options | None = None) -> DataFrame:
    """Candidate rows of every venue (venue_index, title, URLs), ranked; a venue without any has one row that says why."""
    o = options or Options()
    # five branches read the parsed homepages: they are parsed once
    home = kept(homepages(venues, snapshots), "homepages")
    best = ranked(candidates(home, snapshots, search, o), snapshots, o)
    info = home.select("venue_index", T.squeeze("title").alias("venue_title"), *[(T.squeeze(c) if c in venues.columns else F.lit("")).alias(c) for c in ("is_art_venue", "venue_type")], F.when(F.col("homepage_url") == "", "").otherwise(F.col("final_homepage")).alias("homepage_url"), "homepage_status")
    out = info.join(best.drop("key"), "venue_index", "left")
    none = F.col("url").isNull()
    why = F.when(F.col("homepage_url") == "", "No verified/input/api URL available.").otherwise("No relevant internal links found.")
    shown = {
        "rank": F.coalesce("rank", F.lit(1)), "candidate_url": T.col("url"), "candidate_type": F.coalesce("candidate_type", F.lit("not_found")), "confidence": F.coalesce("confidence", F.lit(0)), "score": F.coalesce(F.col("initial_score") + F.col("page_score"), F.lit(0)),
        "source": T.col("source"), "source_link_text": T.cut("anchor_text", 500), "evidence_text": F.coalesce(F.substring(F.array_join("evidence", "; "), 1, 1000), F.lit("")), "http_status": T.col("http_status"), "fetch_status": T.col("fetch_status"),
        "page_title": T.col("page_title"), "heading_text": T.col("heading_text"), "needs_manual_review": F.coalesce("needs_manual_review", F.lit("yes")), "error": F.when(none, why).otherwise(T.col("error")),
    }
    return out.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in CANDIDATES])
