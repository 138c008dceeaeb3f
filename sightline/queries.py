"""Registered queries over the test tables, one or more for each family of operators, and their SQL.

The tables hold no venues or event pages, so the queries feed the operators expressions over the
tables (the same on both sides) and vocabularies that match the tables' words.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates as D
from .functions import text as T
from .functions import urls as U
from .functions import vocabulary as V
from .operators import dedup, html, ranking, records, scoring
from .plans import classify, collect, discover, extract, release
from .session import shared_dir, spread, table
from .sources.search import official_site_query
from .streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function under its name, with the SQL that says the same."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- SQL pieces -------------------------------------------------------------------------------


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def any_sql(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, {lit(w)})" for w in words) + ")"


def hits_sql(text: str, words) -> str:
    return f"list_filter([{', '.join(map(lit, words))}], lambda w: contains({text}, w))"


def rx(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, {lit('(?i)' + pattern)})"


def hits_rx(text: str, patterns) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {rx(text, p)} THEN {lit(p)} END" for p in patterns) + "], lambda x: x IS NOT NULL)"


def case(*pairs: tuple[str, str], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in pairs) + f" ELSE {other} END"


def points_sql(pairs) -> str:
    return " + ".join(f"CASE WHEN {c} THEN {n} ELSE 0 END" for c, n in pairs)


SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def squeeze_sql(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{SPACES}', ' ', 'g'))"


def clean_sql(u: str) -> str:
    """For URLs that have a lower-case scheme and no white space."""
    return f"regexp_replace(regexp_replace({u}, '#.*$', ''), '\\?$', '')"


def host_sql(u: str) -> str:
    return f"regexp_replace(lower(regexp_extract({u}, '^[^:]+://([^/?#]*)', 1)), '^www\\.', '')"


def path_sql(u: str) -> str:
    return f"regexp_extract({u}, '^[^:]+://[^/?#]*([^?#]*)', 1)"


def key_sql(u: str) -> str:
    c = clean_sql(u)
    trimmed = f"rtrim({path_sql(c)}, '/')"
    return f"lower({host_sql(u)} || CASE WHEN {trimmed} = '' THEN '/' ELSE {trimmed} END || '?' || regexp_extract({c}, '^[^?]*\\?(.*)$', 1))"


def detail_sql(u: str) -> str:
    keys = ", ".join(map(lit, V.DETAIL_KEYS))
    names = f"list_transform(list_filter(string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&'), lambda p: p <> ''), lambda p: lower(url_decode(replace(regexp_extract(p, '^([^=]*)', 1), '+', ' '))))"
    return f"(list_has_any({names}, [{keys}]) OR regexp_matches(lower({u}), '/(detail|view|read)'))"


def entity_sql(c: str) -> str:
    return f"replace(replace(replace(replace(replace(replace({c}, '&quot;', '\"'), '&middot;', '·'), '&copy;', '©'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')"


# --- The vocabulary of the test tables --------------------------------------------------------

RULES = V.CandidateRules(
    primary=("tion", "whin"), secondary=("ing",), upcoming=("ea ",), current=("st",), past=("ou",), negative=("and", "ent", "ble"), paths=(("/th", 55, "p=th"), ("/(on|in)", 42, "p=on"), ("er |es", 22, "p=er")),
    notice=("est",), news=("re",), program=("he",),
)
VENUES = V.VenueRules(
    exact={"ECONOMY": ("yes", 95, "exact economy"), "PROMO": ("yes", 93, "exact promo")}, maybe={"MEDIUM": 76, "LARGE": 55}, excluded=("^SMALL$", "STAND"), strong=("widget", "ring", "red w"), weak=("Brand#1", "blue", "gear"),
    negative=("bolt", "green"), types=(("fastener", ("bolt", "screw")), ("shape", ("ring", "widget")), ("colour", ("red", "blue"))),
)
EVENTS = V.EventRules(excluded=("thethe", "ê"), strong=("tion",), hints=("and", "des"), word="ing", generic=("Of.", "The."), link_generic=("the", "and"), image_hints=("red", "large"), image_poster=("ring",), ocr_words=("blue",))
CONTEXT = "html|head|body|nav|ul|li|a"


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """Every link of every page: page_id, base, at, href, text, context, url."""
    pages = spread(table(spark, sf, "pages")).select("page_id", F.col("url").alias("base"), html.parsed("html", "url", ("links",)).alias("page"))
    return pages.select("page_id", "base", F.posexplode("page.links").alias("at", "link")).select("page_id", "base", "at", "link.*")


LINKS_SQL = f"""
    SELECT page_id, url AS base, unnest(range(len(hrefs))) AS at, {entity_sql("unnest(hrefs)")} AS href, {squeeze_sql(entity_sql("unnest(texts)"))} AS text
    FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages)"""
_listed_tags = lambda tags: "(" + ", ".join(map(lit, tags)) + ")"
#: Every tag and text of every page: page_id, i, tok, k (< start, > end, . text), tag; script and style texts are left out.
TOKENS_SQL = r"""
    WITH c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?i)<!doctype[^>]*>', '', 'g'), '(?is)(<(?:script|style)[^>]*>).*?(</(?:script|style)>)', '\1\2', 'g') AS h FROM pages),
    t0 AS (SELECT page_id, unnest(l) AS tok, unnest(range(len(l))) AS i FROM (SELECT page_id, regexp_extract_all(h, '<[^>]*>|[^<]+') AS l FROM c)),
    t AS (SELECT *, CASE WHEN starts_with(tok, '</') THEN '>' WHEN starts_with(tok, '<') THEN '<' ELSE '.' END AS k, CASE WHEN starts_with(tok, '<') THEN lower(regexp_extract(tok, '^</?([A-Za-z0-9]+)', 1)) ELSE '' END AS tag FROM t0)"""
FULL_SQL = "regexp_extract(base, '^([^:]+://[^/?#]*)', 1) || href"


# --- Flagship: the best list pages of every site ----------------------------------------------


def site_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Merged, scored candidates of every site."""
    links = page_links(spark, sf).select(U.host_key("base").alias("site"), "base", (F.col("page_id") * 1000 + F.col("at")).alias("position"), U.clean_url("url", entities=False).alias("url"), F.col("text").alias("anchor_text"), F.col("context").alias("source_context"))
    links = links.filter((F.col("url") != "") & U.same_host("base", "url")).filter(U.is_relevant(F.col("url"), F.col("anchor_text"), F.col("source_context"), RULES))
    rows = links.withColumns({"source": F.when(F.col("source_context").rlike("header|nav"), "homepage_nav").otherwise("homepage_link"), "key": U.candidate_key("url")})
    merged = dedup.merge_candidates(rows, ["site", "key"])
    return scoring.scored_candidates(merged, RULES, with_pages=False)


_hay = "(lower(url) || ' ' || lower(anchor_text) || ' ' || " + lit(CONTEXT) + " || ' homepage_nav')"
_keywords = [(RULES.primary, 55), (RULES.upcoming, 14), (RULES.current, 12), (RULES.past, 8), (RULES.secondary, 26)]
_initial = points_sql([(any_sql("hay", w), n) for w, n in _keywords] + [(rx("hay", p), n) for p, n, _ in RULES.paths]) + " + 16 + CASE WHEN detail THEN -28 ELSE 10 END - least(45, 12 * len(" + hits_sql("hay", RULES.negative) + "))"
_type = case(
    (f"{any_sql('t', RULES.primary)} AND detail", "'exhibition_detail'"), *[(f"{any_sql('t', RULES.primary)} AND {any_sql('t', w)}", lit(n)) for w, n in ((RULES.upcoming, "upcoming_exhibition"), (RULES.current, "current_exhibition"), (RULES.past, "past_exhibition"))],
    (any_sql("t", RULES.primary), "'exhibition_list'"), (any_sql("t", RULES.notice), "'notice_likely'"), (any_sql("t", RULES.news), "'news_likely'"), (any_sql("t", RULES.program), "'program_likely'"), other="'weak_candidate'",
)
SITES_SQL = f"""
    WITH l AS ({LINKS_SQL}), u AS (SELECT {host_sql("base")} AS site, page_id * 1000 + l.at AS position, {clean_sql(FULL_SQL)} AS url, text AS anchor_text FROM l),
    r AS (SELECT *, {key_sql("url")} AS key, {_hay} AS hay FROM u),
    f AS (SELECT * FROM r WHERE {any_sql("hay", RULES.primary + RULES.secondary)} OR {" OR ".join(rx("(lower(url) || ' ' || lower(anchor_text) || ' ' || " + lit(CONTEXT) + ")", p) for p, _, _ in RULES.paths)}),
    once AS (SELECT site, key, anchor_text, min(position) AS position, arg_min(url, position) AS url FROM f GROUP BY ALL),
    m AS (SELECT site, key, min(position) AS position, arg_min(url, position) AS url, list_reduce(list(anchor_text ORDER BY position, url), lambda acc, x: CASE WHEN x = '' OR contains(acc, x) THEN acc WHEN acc = '' THEN x ELSE acc || ' | ' || x END) AS anchor_text FROM once GROUP BY site, key),
    h AS (SELECT *, {_hay} AS hay, lower(url) || ' ' || lower(anchor_text) || ' ' AS t, {detail_sql("url")} AS detail FROM m),
    s AS (SELECT *, greatest(0, {_initial}) AS initial_score FROM h),
    c AS (SELECT *, least(least(100, initial_score), 80, CASE WHEN detail THEN 72 ELSE 100 END) AS confidence, {_type} AS candidate_type FROM s)"""


@query(SITES_SQL + """,
    k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY confidence DESC, position) AS rank, max(confidence) OVER (PARTITION BY site) AS best FROM c)
    SELECT site, CAST(rank AS INTEGER) AS rank, url, anchor_text, CAST(confidence AS INTEGER) AS confidence, candidate_type FROM k WHERE rank <= 3 AND (confidence >= 30 OR best < 30)""")
def url_candidates_topk(spark, sf):
    top = ranking.top_n_with_fallback(site_candidates(spark, sf), "site", "confidence", "position", 3)
    return top.select("site", "rank", "url", "anchor_text", "confidence", "candidate_type")


@query(SITES_SQL + " SELECT site, key, CAST(initial_score AS INTEGER) AS initial_score, CAST(confidence AS INTEGER) AS confidence, CASE WHEN confidence < 55 THEN 'yes' ELSE 'no' END AS needs_manual_review FROM c")
def candidate_scores(spark, sf):
    return site_candidates(spark, sf).select("site", "key", "initial_score", "confidence", "needs_manual_review")


@query(SITES_SQL + """, p AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY initial_score DESC, position) <= 2 AS probe FROM c) SELECT site, key, probe FROM p""")
def probe_targets(spark, sf):
    return ranking.probe_targets(site_candidates(spark, sf), "site", "initial_score", "position", 2).select("site", "key", "probe")


@query(SITES_SQL + " SELECT count(DISTINCT site) AS n_venues, count(DISTINCT site) AS n_found, count(DISTINCT CASE WHEN confidence >= 55 THEN site END) AS n_strong, count(*) AS n_rows FROM c")
def discovery_summary(spark, sf):
    return dedup.discovery_summary(site_candidates(spark, sf), "site")


# --- URLs -------------------------------------------------------------------------------------


@query(f"SELECT {key_sql('url')} AS key, arg_min({clean_sql('url')}, page_id) AS url, min({host_sql('url')}) AS host, min(page_id) AS page_id FROM pages GROUP BY 1")
def url_canonical_dedup(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", U.clean_url("url").alias("url")).withColumns({"host": U.host_key("url"), "key": U.candidate_key("url")})
    return dedup.first_by(rows, [F.col("key")], "page_id")


HOSTS = {"spam-farm.example.org": "store", "www.cheap-pills.example.com": "booking"}
_typed = "CASE page_id % 5 WHEN 0 THEN replace(url, '.example.com', '.instagram.com') WHEN 1 THEN replace(url, '.example.net', '.naver.com') WHEN 2 THEN 'bit.ly/' || page_id WHEN 3 THEN '' ELSE url END"


@query(f"""WITH t AS (SELECT page_id, {_typed} AS u FROM pages), h AS (SELECT page_id, u, lower(regexp_extract(CASE WHEN u = '' OR starts_with(u, 'http') THEN u ELSE 'https://' || u END, '^[^:]+://([^/?#]*)', 1)) AS h FROM t)
    SELECT page_id, CASE WHEN u = '' THEN '' WHEN h = 'spam-farm.example.org' OR h = 'www.spam-farm.example.org' THEN 'store' WHEN h = 'www.cheap-pills.example.com' THEN 'booking' WHEN h = 'bit.ly' THEN 'shortlink'
    WHEN contains(h, 'naver.com') AND contains(h, 'blog') THEN 'blog' WHEN contains(h, 'instagram.com') THEN 'social' ELSE 'official_or_unknown' END AS url_type FROM h""")
def url_type_classify(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.url_type(F.expr(_typed), HOSTS).alias("url_type"))


_detail = "CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '^([^:]+://[^/?#]*)', 1) || '/view?id=' || page_id WHEN 1 THEN regexp_replace(url, '[?#].*$', '') || '?x=%20&wr%5FID=3' WHEN 2 THEN regexp_extract(url, '^([^:]+://[^/?#]*)', 1) || '/Reader/' || page_id ELSE url END"


@query(f"WITH d AS (SELECT page_id, {_detail} AS u FROM pages) SELECT page_id, {detail_sql('u')} AS is_detail FROM d")
def url_detail_like(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.is_detail(F.expr(_detail)).alias("is_detail"))


@query("""WITH b AS (SELECT page_id, regexp_extract(url, '^([^:]+://[^/?#]*)', 1) AS root FROM pages), r AS (SELECT unnest(['/show', '/show/list', '/show/index', '/show/view']) AS p, unnest(['removed_detail_path', 'detail_to_list', 'detail_to_index', 'removed_detail_query']) AS reason)
    SELECT page_id, root || p AS url, reason FROM b, r""")
def url_infer_list(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.inline(U.infer_list_urls(F.concat(F.regexp_extract("url", "^([^:]+://[^/?#]*)", 1), F.lit("/show/view?id="), "page_id"))))
    return rows.select("page_id", "url", "reason")


@query(f"""WITH first AS (SELECT {host_sql('url')} AS host, arg_min(url, page_id) AS api FROM pages GROUP BY 1),
    p AS (SELECT page_id, CASE page_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'https://www.instagram.com/x' || page_id WHEN 2 THEN 'https://bit.ly/' || page_id ELSE url END AS own, CASE page_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'https://blog.naver.com/' || page_id ELSE api END AS api FROM pages JOIN first ON host = {host_sql('url')}),
    c AS (SELECT *, {host_sql('own')} || rtrim({path_sql('own')}, '/') = {host_sql('api')} || rtrim({path_sql('api')}, '/') AS same, own LIKE '%instagram%' AS social, own LIKE '%bit.ly%' AS short, api LIKE '%blog.naver%' AS blog FROM p),
    s AS (SELECT *, CASE WHEN own = '' AND api = '' THEN '' WHEN own = '' THEN 'naver_api' WHEN api = '' THEN 'existing' WHEN same THEN 'existing_api_same' WHEN (social OR short) AND NOT blog THEN 'naver_api_preferred' WHEN short AND blog THEN 'naver_api_preferred' ELSE 'existing' END AS source FROM c)
    SELECT page_id, CASE WHEN source IN ('naver_api', 'naver_api_preferred') THEN api ELSE own END AS url, source FROM s""")
def url_select_best(spark, sf):
    pages = table(spark, sf, "pages")
    first = pages.groupBy(U.host_key("url").alias("host")).agg(F.min_by("url", "page_id").alias("api"))
    rows = pages.join(first, U.host_key("url") == F.col("host"))
    own = F.expr("CASE page_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'https://www.instagram.com/x' || page_id WHEN 2 THEN 'https://bit.ly/' || page_id ELSE url END")
    api = F.expr("CASE page_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'https://blog.naver.com/' || page_id ELSE api END")
    return rows.select("page_id", U.best_url(own, api).alias("b")).select("page_id", "b.url", "b.source")


@query(f"WITH l AS ({LINKS_SQL}) SELECT page_id, count(*) AS n_links, count(DISTINCT {clean_sql(FULL_SQL)}) AS n_urls, min({clean_sql(FULL_SQL)}) AS first_url FROM l GROUP BY 1")
def internal_links(spark, sf):
    links = page_links(spark, sf).withColumn("u", U.clean_url("url", entities=False)).filter(U.same_host("base", "u"))
    return links.groupBy("page_id").agg(F.count("*").alias("n_links"), F.count_distinct("u").alias("n_urls"), F.min("u").alias("first_url"))


@query(f"SELECT page_id, regexp_extract(url, '^([^:]+://[^/?#]*)', 1) || unnest([{', '.join(map(lit, V.LIKELY_PATHS))}]) AS url FROM pages")
def url_common_paths(spark, sf):
    home = table(spark, sf, "pages").select(F.col("page_id").alias("venue_index"), F.lit("x").alias("homepage_url"), F.col("url").alias("final_homepage"))
    return discover.from_common_paths(home).select(F.col("venue_index").alias("page_id"), "url")


@query(f"SELECT page_id, CASE page_id % 3 WHEN 0 THEN {clean_sql('url')} WHEN 1 THEN 'https://own' || page_id || '.example.com' ELSE '' END AS homepage, trim(CASE page_id % 3 WHEN 2 THEN '' ELSE 'T' || page_id END || ' Road ' || page_id || ' official') AS query FROM pages")
def url_homepage(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(" ").alias("verified_url"), F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("own"), "page_id", F.lit(".example.com#x"))).otherwise("https://").alias("link"))
    title = F.when(F.col("page_id") % 3 != 2, F.concat(F.lit("T"), "page_id"))
    return rows.select("page_id", U.homepage("verified_url", "link").alias("homepage"), official_site_query(title, F.concat(F.lit(" Road  "), "page_id"), "official").alias("query"))


# --- HTML -------------------------------------------------------------------------------------


@query(f"SELECT page_id, left({squeeze_sql(entity_sql("regexp_extract(html, '<title>(.*?)</title>', 1)"))}, 300) AS title, left({squeeze_sql(entity_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))}, 500) AS headings FROM pages")
def page_title_headings(spark, sf):
    return spread(table(spark, sf, "pages")).select("page_id", html.parsed("html", "url", ("title", "headings")).alias("p")).select("page_id", "p.title", "p.headings")


@query(f"""{TOKENS_SQL}, p AS (SELECT page_id, i, CASE WHEN k = '.' THEN {squeeze_sql(entity_sql("tok"))} WHEN k = '>' AND tag IN {_listed_tags(V.LINE_BREAK_TAGS)} THEN chr(10) ELSE '' END AS piece FROM t),
    s AS (SELECT page_id, string_agg(piece, '' ORDER BY i) AS body FROM p GROUP BY 1), l AS (SELECT page_id, list_filter(list_transform(string_split(body, chr(10)), lambda x: {squeeze_sql("x")}), lambda x: x <> '') AS l FROM s)
    SELECT page_id, CAST(unnest(range(len(l))) AS INTEGER) AS at, unnest(l) AS line FROM l""")
def page_visible_lines(spark, sf):
    pages = spread(table(spark, sf, "pages")).select("page_id", html.parsed("html", "url", ("lines",)).alias("p"))
    return pages.select("page_id", F.posexplode("p.lines").alias("at", "line"))


# the owner of a token is the last block that began at its level: levels count the open blocks
@query(f"""{TOKENS_SQL}, b AS (SELECT *, tag IN {_listed_tags(V.BLOCK_TAGS)} AS blk FROM t),
    d AS (SELECT *, sum(CASE WHEN blk AND k = '<' THEN 1 WHEN blk AND k = '>' THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) + CASE WHEN blk AND k = '>' THEN 1 ELSE 0 END AS lev FROM b),
    o AS (SELECT *, max(CASE WHEN blk AND k = '<' THEN i END) OVER (PARTITION BY page_id, lev ORDER BY i) AS own FROM d WHERE lev >= 1),
    g AS (SELECT page_id, own, max(CASE WHEN i = own THEN tag END) AS tag, min(lev) - 1 AS depth, max(CASE WHEN blk AND k = '>' THEN i END) AS ended, count(*) FILTER (k = '>' AND tag = 'a') AS n_links,
      string_agg(CASE WHEN k = '.' THEN {entity_sql(entity_sql("tok"))} WHEN tag IN {_listed_tags(V.LINE_BREAK_TAGS)} THEN chr(10) ELSE '' END, '' ORDER BY i) AS text FROM o GROUP BY page_id, own),
    n AS (SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY ended) - 1 AS place, tag, depth, n_links, len(list_filter(list_transform(regexp_split_to_array(replace(text, chr(13), chr(10)), '[\\n|•·]+'), lambda x: {squeeze_sql("x")}), lambda x: x <> '')) AS n_lines FROM g WHERE ended IS NOT NULL AND (text <> '' OR n_links > 0))
    SELECT page_id, CAST(place AS INTEGER) AS at, tag, CAST(depth AS INTEGER) AS depth, CAST(n_links AS INTEGER) AS n_links, CAST(n_lines AS INTEGER) AS n_lines FROM n""")
def page_blocks(spark, sf):
    pages = spread(table(spark, sf, "pages")).select("page_id", html.parsed("html", "url", ("blocks",)).alias("p"))
    return pages.select("page_id", F.posexplode("p.blocks").alias("at", "b")).select("page_id", "at", "b.tag", "b.depth", F.size("b.links").alias("n_links"), F.size(T.split_lines("b.text")).alias("n_lines"))


# the trail above a link: at each level, the last start tag before it
@query(rf"""{TOKENS_SQL}, e AS (SELECT *, sum(CASE k WHEN '<' THEN 1 WHEN '>' THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) AS lev FROM t),
    s AS (SELECT page_id, i, lev, tag, CASE WHEN tag IN {_listed_tags(V.MENU_TAGS)} THEN tag WHEN regexp_matches(lower(tag || ' ' || regexp_extract(tok, 'id="([^"]*)"', 1) || ' ' || regexp_extract(tok, 'class="([^"]*)"', 1)), {lit(V.MENU_NAME)}) THEN {lit(V.MENU_LABEL)} ELSE tag END AS label FROM e WHERE k = '<'),
    a AS (SELECT page_id, i, lev, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS place FROM s WHERE tag = 'a'),
    x AS (SELECT a.page_id, a.place, s.lev, arg_max(s.label, s.i) AS label FROM a JOIN s ON s.page_id = a.page_id AND s.i <= a.i AND s.lev <= a.lev GROUP BY ALL)
    SELECT page_id, CAST(place AS INTEGER) AS at, string_agg(label, '|' ORDER BY lev) AS context FROM x GROUP BY page_id, place""")
def page_link_contexts(spark, sf):
    return page_links(spark, sf).select("page_id", "at", "context")


_order_day = "date_format(o_orderdate, 'yyyy-MM-dd')"
_order_page = f"""'<html><head><script type="application/ld+json">{{"@graph": [{{"@type": "Event", "name": " Sale  ' || o_orderkey || '", "startDate": "' || {_order_day} || 'T09:00", "endDate": "' || date_format(o_orderdate + interval 10 days, 'M/d') || '", "url": "/e/' || o_orderkey || '", "location": {{"name": "Hall ' || o_custkey || '", "address": {{"streetAddress": "1 Road", "addressCountry": "X"}}}}}}, {{"@type": ["Event"], "name": "not this"}}]}}</script></head></html>'"""


@query("""SELECT o_orderkey, 'Sale ' || o_orderkey AS exhibition_name, strftime(o_orderdate, '%Y-%m-%d') AS start_date, strftime(make_date(year(o_orderdate), month(o_orderdate + INTERVAL 10 DAY), day(o_orderdate + INTERVAL 10 DAY)), '%Y-%m-%d') AS end_date,
    'Hall ' || o_custkey || ' 1 Road X' AS location, 'https://shop.example.com/e/' || o_orderkey AS detail_url FROM orders""")
def jsonld_events(spark, sf):
    pages = spread(table(spark, sf, "orders")).select("o_orderkey", html.parsed(F.expr(_order_page), F.lit("https://shop.example.com/list"), ("events",)).alias("page"))
    return html.linked_event_rows(pages, ["o_orderkey"]).drop("position")


_part_page = """'<body><img src="/i/' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.png' ELSE '' END || '" alt="' || p_name || '" title="' || p_type || '"><img data-src="//cdn.example.com/' || p_brand || '.gif"><img src="/i/' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.png' ELSE '' END || '"><img src="data:x"></body>'"""


@query("""WITH i AS (SELECT p_partkey, 0 AS pos, 'https://p.example.com/i/' || p_partkey || CASE WHEN p_partkey % 2 = 0 THEN '.png' ELSE '' END AS url, p_name AS alt, p_type AS title FROM part
    UNION ALL SELECT p_partkey, 1, 'https://cdn.example.com/' || p_brand || '.gif', '', '' FROM part),
    m AS (SELECT *, lower(url || ' ' || alt || ' ' || title) AS m FROM i),
    s AS (SELECT *, (CASE WHEN contains(m, 'red') OR contains(m, 'large') THEN 45 ELSE 0 END + CASE WHEN contains(m, 'ring') THEN 25 ELSE 0 END + CASE WHEN regexp_matches(lower(url), '\\.(png|jpg|jpeg|webp|gif)($|[?#])') THEN 10 ELSE 0 END + CASE WHEN length(alt) >= 6 THEN 10 ELSE 0 END + CASE WHEN length(title) >= 6 THEN 10 ELSE 0 END) / 100.0 AS score FROM m)
    SELECT p_partkey, url, alt, title, CAST(score AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, pos) AS INTEGER) AS rank FROM s""")
def image_candidates(spark, sf):
    pages = spread(table(spark, sf, "part")).select("p_partkey", html.parsed(F.expr(_part_page), F.lit("https://p.example.com/"), ("images",)).alias("page"))
    return html.image_candidates(pages, ["p_partkey"], rules=EVENTS).drop("position")


@query("""SELECT r_regionkey, CAST(i AS INTEGER) AS at, 'https://x.example.com/' || r_name || '/' || i || '?a=1&b=2' AS loc FROM region, range(3) t(i)""")
def sitemap_locs(spark, sf):
    xml = F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda i: F.concat(F.lit("<URL><loc>\n https://x.example.com/"), "r_name", F.lit("/"), i.cast("string"), F.lit("?a=1&amp;b=2 </loc></URL>"))), ""), F.lit("</urlset>"))
    rows = table(spark, sf, "region").select("r_regionkey", F.posexplode(html.sitemap_locs(xml)).alias("at", "loc"))
    return rows.withColumn("loc", T.unescape("loc"))


@query("SELECT n_nationkey, n_name AS found FROM nation")
def robots_sitemaps(spark, sf):
    text = F.concat(F.lit("User-agent: *\n  sitemap: "), "n_name", F.lit(" \nDisallow: /x"))
    return table(spark, sf, "nation").select("n_nationkey", F.explode(html.robots_sitemaps(text)).alias("found"))


# --- Text -------------------------------------------------------------------------------------


@query(f"SELECT doc_id, md5({squeeze_sql('text')}) AS normal, CAST(length({squeeze_sql('text')}) AS INTEGER) AS n FROM documents")
def text_normalize(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", F.md5(T.squeeze("text").cast("binary")).alias("normal"), F.length(T.squeeze("text")).alias("n"))


_lines_sql = f"list_filter(list_transform(regexp_split_to_array(replace(text, chr(13), chr(10)), '[\\n|•·]+'), lambda x: {squeeze_sql('x')}), lambda x: x <> '')"


@query(f"WITH l AS (SELECT doc_id, {_lines_sql} AS l FROM documents) SELECT doc_id, CAST(len(l) AS INTEGER) AS n, md5(array_to_string(l, chr(10))) AS lines FROM l")
def text_split_lines(spark, sf):
    lines = T.split_lines("text")
    return spread(table(spark, sf, "documents")).select("doc_id", F.size(lines).alias("n"), F.md5(F.array_join(lines, "\n").cast("binary")).alias("lines"))


@query(f"""WITH t AS (SELECT doc_id, regexp_split_to_array(lower({squeeze_sql('text')}), '[^0-9a-zA-Z가-힣]+') AS l FROM documents), u AS (SELECT doc_id, unnest(l) AS w, unnest(range(len(l))) AS i FROM t),
    f AS (SELECT doc_id, w, min(i) AS i FROM u WHERE length(w) >= 2 GROUP BY ALL) SELECT doc_id, count(*) AS n, md5(string_agg(w, ' ' ORDER BY i)) AS tokens FROM f GROUP BY 1""")
def text_tokens(spark, sf):
    rows = spread(table(spark, sf, "documents")).select("doc_id", T.tokens("text").alias("t")).filter(F.size("t") > 0)
    return rows.select("doc_id", F.size("t").cast("long").alias("n"), F.md5(F.array_join("t", " ").cast("binary")).alias("tokens"))


@query(f"""SELECT page_id, md5(regexp_replace({entity_sql("regexp_replace(html, '<[^>]+>', '', 'g')")}, '^[\\s]+|[\\s]+$', '', 'g')) AS bare FROM pages""")
def text_strip_tags(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(T.strip_tags("html").cast("binary")).alias("bare"))


@query(f"""SELECT page_id, md5({entity_sql(squeeze_sql("regexp_replace(html, '<[^>]*>', ' ', 'g')"))}) AS spaced FROM pages""")
def text_strip_tags_spaced(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.md5(T.strip_tags_spaced("html").cast("binary")).alias("spaced"))


WORDS = ("tion", "ing", "ée", "über", "the", "zzz")


@query(f"SELECT doc_id, array_to_string({hits_sql('lower(text)', WORDS)}, '|') AS hits FROM documents")
def keyword_hits(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", T.keyword_hits(WORDS, "text").alias("hits"))


PATTERNS = ("^the", "tion.*ing", "[0-9]{3}", "é+a", "MIT licen[cs]e")


@query(f"SELECT doc_id, array_to_string({hits_rx('text', PATTERNS)}, ';') AS hits FROM documents")
def pattern_hits(spark, sf):
    return spread(table(spark, sf, "documents")).select("doc_id", F.array_join(T.pattern_hits(F.col("text"), PATTERNS), ";").alias("hits"))


# --- Venues -----------------------------------------------------------------------------------


def venues(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.select(
        F.col("p_partkey").alias("venue_index"), F.concat(F.lit("  "), "p_name").alias("title"), F.col("p_type").alias("category"), F.lit(None).cast("string").alias("summary"), F.col("p_brand").alias("source_query"), F.lit("").alias("road_address"), F.lit("").alias("full_address"),
        F.col("p_brand").alias("region_sub"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("shop"), F.col("p_partkey") % 50, F.lit(".example.com"))).otherwise("").alias("official_url"), F.when(F.col("p_partkey") % 2 == 0, "https://bit.ly/x").otherwise("").alias("link"),
    )


_vt = "(p_name || ' ' || p_type || ' ' || p_brand)"
_score = f"greatest(0, least(99, CASE p_type WHEN 'MEDIUM' THEN 76 WHEN 'LARGE' THEN 55 ELSE 0 END + {points_sql([('len(st) > 0', 28), ('len(we) > 0', 12), ('len(ex) > 0', -70), ('len(ne) > 0', -35)])}))"


def _listed(prefix: str, name: str, n: int) -> str:
    return f"CASE WHEN len({name}) > 0 THEN {lit(prefix)} || array_to_string({name}[1:{n}], ', ') END"


VENUES_SQL = f"""
    WITH h AS (SELECT *, {hits_rx('p_name', VENUES.strong)} AS st, {hits_rx(_vt, VENUES.weak)} AS we, {hits_rx('p_type', VENUES.excluded)} AS ex, {hits_rx('p_name', VENUES.negative)} AS ne FROM part), s AS (SELECT *, {_score} AS score FROM h),
    l AS (SELECT *, CASE WHEN score >= 80 THEN 'yes' WHEN score >= 45 THEN 'maybe' ELSE 'no' END AS label,
      array_to_string(list_filter([CASE WHEN p_type IN ('MEDIUM', 'LARGE') THEN {lit(V.REASON_MAYBE)} || p_type END, {_listed(V.REASON_STRONG, 'st', 4)}, {_listed(V.REASON_WEAK, 'we', 4)}, {_listed(V.REASON_EXCLUDED, 'ex', 3)}, {_listed(V.REASON_NEGATIVE, 'ne', 4)}], lambda x: x IS NOT NULL), '; ') AS why FROM s),
    v AS (SELECT p_partkey AS venue_index, p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'yes' WHEN 'PROMO' THEN 'yes' ELSE label END AS is_art_venue, CAST(CASE p_type WHEN 'ECONOMY' THEN 95 WHEN 'PROMO' THEN 93 ELSE score END AS INTEGER) AS art_confidence,
      CASE WHEN {rx('p_name', 'bolt|screw')} THEN 'fastener' WHEN {rx('p_name', 'ring|widget')} THEN 'shape' WHEN {rx('p_name', 'red|blue')} THEN 'colour' ELSE 'unknown' END AS venue_type,
      CASE p_type WHEN 'ECONOMY' THEN 'exact economy' WHEN 'PROMO' THEN 'exact promo' ELSE CASE WHEN why = '' THEN {lit(V.REASON_NONE)} ELSE why END END AS classification_reason,
      CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 'no' WHEN label = 'maybe' OR (label = 'yes' AND (len(ex) > 0 OR len(ne) > 0)) THEN 'yes' ELSE 'no' END AS needs_manual_review FROM l)"""


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify.classified(venues(spark, sf), VENUES)


@query(VENUES_SQL + " SELECT venue_index, is_art_venue, art_confidence, venue_type, classification_reason, needs_manual_review FROM v")
def venue_classify(spark, sf):
    return classified(spark, sf).select("venue_index", "is_art_venue", "art_confidence", "venue_type", "classification_reason", "needs_manual_review")


@query(VENUES_SQL + " SELECT venue_type, count(*) AS n FROM v GROUP BY 1")
def venue_type(spark, sf):
    return classified(spark, sf).groupBy("venue_type").agg(F.count("*").alias("n"))


@query(VENUES_SQL + " SELECT venue_index, is_art_venue FROM v WHERE is_art_venue IN ('yes', 'maybe')")
def label_filter(spark, sf):
    return records.kept_labels(classified(spark, sf)).select("venue_index", "is_art_venue")


_URLS_SQL = VENUES_SQL + """, o AS (SELECT v.*, CASE WHEN is_art_venue = 'no' THEN '' WHEN venue_index % 3 = 0 THEN 'shop' || venue_index % 50 || '.example.com' WHEN venue_index % 2 = 0 THEN 'https://bit.ly/x' ELSE '' END AS url FROM v),
    w AS (SELECT *, CASE WHEN is_art_venue = 'no' THEN 'skipped' WHEN url = '' THEN 'blank' WHEN starts_with(url, 'shop') AND venue_index % 50 < 20 THEN 'ok' WHEN starts_with(url, 'shop') AND venue_index % 50 < 30 THEN 'error' ELSE 'not_checked' END AS url_status FROM o)"""


def checked(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("id")
    url = F.concat(F.lit("https://shop"), n, F.lit(".example.com"))
    fetched = spark.range(30).select(url.alias("url"), F.concat(url, F.lit("/gallery")).alias("final_url"), F.when(n < 20, "ok").otherwise("error").alias("status"), F.when(n < 20, "200").otherwise("").alias("http_status"), F.lit("A Museum").alias("title"), F.when(n < 20, "").otherwise("timed out").alias("error"))
    return classify.with_urls(classified(spark, sf), None, fetched)


@query(_URLS_SQL + """ SELECT venue_index, url_status, CASE WHEN url_status IN ('skipped', 'blank') THEN '' ELSE 'existing' END AS selected_url_source, CASE WHEN url_status = 'ok' THEN 'A Museum' ELSE '' END AS url_page_title, CASE WHEN url_status = 'ok' THEN 'gallery' ELSE '' END AS url_art_keyword_hits,
    CASE WHEN url_status IN ('skipped', 'blank') THEN '' WHEN starts_with(url, 'shop') THEN 'official_or_unknown' ELSE 'shortlink' END AS url_type,
    CASE WHEN url_status IN ('skipped', 'blank') THEN '' WHEN url_status IN ('ok', 'error') THEN 'https://' || url || '/gallery' WHEN starts_with(url, 'shop') THEN 'https://' || url ELSE url END AS verified_url,
    CASE url_status WHEN 'skipped' THEN 'not an art candidate' WHEN 'error' THEN 'timed out' ELSE '' END AS url_error FROM w""")
def url_check(spark, sf):
    return checked(spark, sf).select("venue_index", "url_status", "selected_url_source", "url_page_title", "url_art_keyword_hits", "url_type", "verified_url", "url_error")


@query(_URLS_SQL + """ SELECT count(*) AS n_rows, count(*) FILTER (is_art_venue = 'yes') AS n_yes, count(*) FILTER (is_art_venue = 'maybe') AS n_maybe, count(*) FILTER (is_art_venue = 'no') AS n_no,
    count(*) FILTER (url_status = 'ok') AS n_url_ok, count(*) FILTER (url_status = 'blank') AS n_url_blank, count(*) FILTER (url_status = 'skipped') AS n_url_skipped, CAST(0 AS BIGINT) AS n_api_found FROM w""")
def label_summary(spark, sf):
    return dedup.label_summary(checked(spark, sf))


_HIT_SQL = """
    WITH v AS (SELECT item_id, regexp_replace(lower(array_to_string(string_split(text, ' ')[1:2], ' ')), '\\s+', '', 'g') AS wanted, array_to_string(string_split(text, ' ')[3:3], '') AS near FROM benchmark),
    h AS (SELECT item_id, doc_id, text AS said, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'https://blog.naver.com/' || doc_id WHEN 2 THEN 'https://smartstore.naver.com/' || doc_id ELSE 'https://d' || doc_id || '.example.com/' END AS link, wanted, near FROM v JOIN documents ON doc_id % 40 = item_id),
    s AS (SELECT *, CASE WHEN wanted <> '' AND contains(regexp_replace(lower(said), '\\s+', '', 'g'), wanted) THEN 50 ELSE 0 END + CASE WHEN near <> '' AND contains(said, near) THEN 10 ELSE 0 END + CASE WHEN contains(lower(said), 'tion') OR contains(lower(said), 'ment') THEN 20 ELSE 0 END + CASE doc_id % 4 WHEN 1 THEN 8 WHEN 2 THEN -10 WHEN 3 THEN 15 ELSE 15 END AS score FROM h),
    b AS (SELECT item_id, arg_max(struct_pack(link := link, score := score), score * 1000000 - doc_id) FILTER (link <> '') AS b FROM s GROUP BY 1)"""


@query(_HIT_SQL + " SELECT item_id, CASE WHEN b.score >= 20 THEN b.link ELSE '' END AS api_found_url, CASE WHEN b.score >= 20 THEN 'found' ELSE 'no_confident_match' END AS api_search_status, CAST(greatest(0, b.score) AS INTEGER) AS api_match_score FROM b")
def best_hit(spark, sf):
    w = F.split("text", " ")
    seeds = table(spark, sf, "benchmark").select("item_id", F.array_join(F.slice(w, 1, 2), " ").alias("title"), F.coalesce(F.get(w, F.lit(2)), F.lit("")).alias("region_sub"))
    link = F.expr("CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'https://blog.naver.com/' || doc_id WHEN 2 THEN 'https://smartstore.naver.com/' || doc_id ELSE 'https://d' || doc_id || '.example.com/' END")
    docs = table(spark, sf, "documents").select((F.col("doc_id") % 40).alias("item_id"), F.col("doc_id").alias("pos"), link.alias("link"), F.col("text").alias("hit"))
    hits = seeds.join(docs, "item_id").withColumns(scoring.search_hit(F.col("title"), F.col("region_sub"), F.lit(""), F.col("hit"), F.col("link"), ("tion", "ment"))).withColumn("query", F.lit("q"))
    return scoring.best_search_hit(hits, "item_id").select("item_id", "api_found_url", "api_search_status", "api_match_score")


# --- Dates, addresses and events --------------------------------------------------------------

_period = "'period: ' || date_format(o_orderdate, 'y.M.d') || ' ~ ' || date_format(o_orderdate + interval 10 days, 'M.d')"


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS start_date, coalesce(strftime(try_cast(year(o_orderdate) || '-' || month(o_orderdate + INTERVAL 10 DAY) || '-' || day(o_orderdate + INTERVAL 10 DAY) AS DATE), '%Y-%m-%d'), '') AS end_date FROM orders")
def date_extract(spark, sf):
    start, end = D.date_range(F.expr(_period))
    return table(spark, sf, "orders").select("o_orderkey", start.alias("start_date"), end.alias("end_date"))


@query("SELECT o_orderkey, coalesce(strftime(try_cast((2020 + o_orderkey % 5) || '-' || (1 + o_orderkey % 14) || '-' || (1 + o_orderkey % 33) AS DATE), '%Y-%m-%d'), '') AS day FROM orders")
def date_invalid(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", D.normalize_date(F.expr("(2020 + o_orderkey % 5) || '/' || (1 + o_orderkey % 14) || '.' || (1 + o_orderkey % 33)")).alias("day"))


@query("""WITH e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS s, CASE WHEN o_orderkey % 4 < 2 THEN NULL ELSE o_orderdate + INTERVAL 30 DAY END AS e FROM orders)
    SELECT o_orderkey, strftime(coalesce(e, s), '%Y-%m-%d') AS effective_end FROM e WHERE CAST(coalesce(e, s) AS DATE) >= DATE '1998-01-01'""")
def event_current(spark, sf):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    rows = table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, day("o_orderdate")).alias("s"), F.when(F.col("o_orderkey") % 4 >= 2, day(F.col("o_orderdate") + F.expr("interval 30 days"))).otherwise("").alias("e"))
    return rows.filter(D.is_current("s", "e", F.lit("1998-01-01").cast("date"))).select("o_orderkey", F.date_format(D.effective_end("s", "e"), "yyyy-MM-dd").alias("effective_end"))


@query("SELECT c_custkey, n_name AS main, CASE WHEN c_mktsegment LIKE '%Y' THEN c_mktsegment ELSE '' END AS sub, CASE WHEN c_mktsegment LIKE '%Y' THEN CAST(c_custkey AS VARCHAR) ELSE c_mktsegment END AS detail FROM customer JOIN nation ON c_nationkey = n_nationkey")
def address_parts(spark, sf):
    rows = table(spark, sf, "customer").join(F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    main, sub, detail = D.address_parts(F.concat_ws("  ", "n_name", "c_mktsegment", "c_custkey"), ("Y",))
    return rows.select("c_custkey", main.alias("main"), sub.alias("sub"), detail.alias("detail"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Hall ' || c_custkey WHEN 1 THEN c_custkey || ' North Road' ELSE '' END AS place FROM customer")
def location_extract(spark, sf):
    text = F.expr("CASE c_custkey % 3 WHEN 0 THEN 'when | location:  Hall ' || c_custkey || ' | tel' WHEN 1 THEN 'at | ' || c_custkey || ' North Road' ELSE 'nothing' END")
    return table(spark, sf, "customer").select("c_custkey", D.location(text).alias("place"))


_names_sql = f"""
    WITH l AS (SELECT conv_id, turn, {_lines_sql} AS l FROM conversations), u AS (SELECT conv_id, turn, unnest(l) AS x, unnest(range(len(l))) AS i FROM l),
    f AS (SELECT * FROM u WHERE length(x) BETWEEN 4 AND 120 AND x NOT IN ('Of.', 'The.') AND NOT {any_sql('x', EVENTS.excluded)}),
    s AS (SELECT *, {points_sql([(any_sql('x', EVENTS.strong), 60), (any_sql('lower(x)', EVENTS.hints), 25), ("contains(x, 'ing')", 30), (any_sql('x', EVENTS.quotes), 20)])} AS score FROM f),
    b AS (SELECT conv_id, turn, arg_max(struct_pack(x := x, score := score), score * 100000 - i) AS b FROM s GROUP BY ALL)"""


@query(_names_sql + " SELECT c.conv_id, c.turn, CASE WHEN b.score >= 30 THEN b.x ELSE '' END AS event_name FROM conversations c LEFT JOIN b USING (conv_id, turn)")
def best_event_name(spark, sf):
    return spread(table(spark, sf, "conversations")).select("conv_id", "turn", html.event_name(T.split_lines("text"), F.array().cast("array<string>"), EVENTS).alias("event_name"))


@query(f"""WITH l AS ({LINKS_SQL}), t AS (SELECT page_id, lower(regexp_replace({squeeze_sql(entity_sql("regexp_extract(html, '<h1>(.*?)</h1>', 1)"))}, '[^0-9a-zA-Z가-힣]+', ' ', 'g')) AS name FROM pages),
    w AS (SELECT page_id, list_filter(list_distinct(string_split(name, ' ')), lambda x: length(x) >= 2) AS words FROM t),
    s AS (SELECT l.page_id, l.at AS i, {FULL_SQL} AS url, len(list_filter(words, lambda x: contains(lower(text), x))) * 2 + len(list_filter(words, lambda x: contains(lower({FULL_SQL}), x))) - CASE WHEN {FULL_SQL} = base THEN 1 ELSE 0 END AS score FROM l JOIN w USING (page_id) WHERE lower(text) NOT IN ('the', 'and')),
    b AS (SELECT page_id, arg_max(url, score * 10000 - i) AS url FROM s GROUP BY 1), f AS (SELECT page_id, arg_min({FULL_SQL}, l.at) AS url FROM l GROUP BY 1)
    SELECT f.page_id, coalesce(b.url, f.url) AS detail_url FROM f LEFT JOIN b USING (page_id)""")
def best_detail_link(spark, sf):
    pages = spread(table(spark, sf, "pages")).select("page_id", "url", html.parsed("html", "url", ("headings", "links")).alias("p"))
    return pages.filter(F.size("p.links") > 0).select("page_id", html.detail_url(F.col("p.links"), F.col("url"), F.regexp_extract("p.headings", "^(.*)$", 1), EVENTS).alias("detail_url"))


def order_events(spark: SparkSession, sf: str) -> DataFrame:
    line = table(spark, sf, "lineitem")
    day = F.date_format("l_shipdate", "yyyy-MM")
    return line.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"), F.concat(F.when(F.col("l_linenumber") % 2 == 0, " Ship ").otherwise("ship  "), F.col("l_suppkey") % 50).alias("exhibition_name"), F.concat(day, F.lit("-01")).alias("start_date"),
        F.when(F.col("l_linenumber") % 3 == 0, F.concat(day, F.lit("-01"))).otherwise("").alias("end_date"), F.col("l_returnflag").alias("location"), F.concat(F.lit("https://s.example.com/"), "l_linestatus").alias("detail_url"), F.lit("https://s.example.com/list").alias("source_list_url"),
    )


_ships = "SELECT l_orderkey * 10 + l_linenumber AS position, CASE WHEN l_linenumber % 2 = 0 THEN 'Ship ' ELSE 'ship ' END || l_suppkey % 50 AS n, strftime(l_shipdate, '%Y-%m') || '-01' AS s, CASE WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%Y-%m') || '-01' ELSE '' END AS e, l_returnflag AS loc, 'https://s.example.com/' || l_linestatus AS d FROM lineitem"


@query(f"WITH x AS ({_ships}) SELECT min(position) AS position, arg_min(n, position) AS exhibition_name, s AS start_date, e AS end_date, arg_min(loc, position) AS location, d AS detail_url FROM x GROUP BY lower(n), s, e, d")
def event_dedup_first(spark, sf):
    return dedup.dedupe_events(order_events(spark, sf)).select("position", "exhibition_name", "start_date", "end_date", "location", "detail_url")


@query(f"WITH x AS ({_ships}) SELECT arg_min(n, position) AS exhibition_name, s AS exhibition_start_date, CASE WHEN e = '' THEN s ELSE e END AS exhibition_end_date, arg_min(loc, position) AS exhibition_location, d AS exhibition_detail_url, 'https://s.example.com/list' AS source_list_url FROM x GROUP BY lower(n), s, CASE WHEN e = '' THEN s ELSE e END, d")
def release_build(spark, sf):
    return release.build(order_events(spark, sf), fill_end=True)


@query("""SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND m.k IS NOT NULL THEN 'line ' || m.k ELSE o_orderpriority END AS exhibition_name, CASE WHEN o_orderstatus = 'O' THEN coalesce(m.s, '') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS start_date, coalesce(m.f, '') AS location FROM orders
    LEFT JOIN (SELECT l_orderkey AS k, strftime(min(l_shipdate), '%Y-%m-%d') AS s, min(l_returnflag) AS f FROM lineitem GROUP BY 1) m ON o_orderkey = k""")
def merge_first_nonempty(spark, sf):
    events = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("exhibition_name"), F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("").alias("start_date"), F.lit("").alias("location"))
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("start_date"), F.min("l_returnflag").alias("location"))
    found = lines.withColumn("exhibition_name", F.concat(F.lit("line "), "o_orderkey"))
    return records.merge_fields(events, found, "o_orderkey", ("1-URGENT", "2-HIGH"))


@query("""WITH f AS (SELECT user_id, event_id, event_type AS stage, 'T' || user_id % 3 || '-' || event_id % 2 AS type, props AS m FROM events WHERE event_type IN ('error', 'click')),
    m AS (SELECT user_id, m, min(event_id) AS i FROM f GROUP BY ALL), t AS (SELECT user_id, string_agg(m, ' | ' ORDER BY i) AS m FROM m GROUP BY 1)
    SELECT user_id, string_agg(DISTINCT stage, ',' ORDER BY stage) AS failure_stage, string_agg(DISTINCT type, ',' ORDER BY type) AS failure_type, any_value(CASE WHEN length(t.m) > 60 THEN left(t.m, 60) || '...' ELSE t.m END) AS failure_message FROM f JOIN t USING (user_id) GROUP BY 1""")
def failure_summary(spark, sf):
    rows = table(spark, sf, "events").filter(F.col("event_type").isin("error", "click"))
    failures = rows.select("user_id", F.col("event_type").alias("stage"), F.concat(F.lit("T"), F.col("user_id") % 3, F.lit("-"), F.col("event_id") % 2).alias("error_type"), F.col("props").alias("error_message"), F.col("event_id").alias("position"))
    return dedup.summarize_failures(failures, "user_id", "position", 60)


@query("""WITH e AS (SELECT o_custkey, 'Order ' || o_orderkey AS n, strftime(o_orderdate, '%Y-%m-%d') AS s FROM orders WHERE o_orderstatus <> 'P'), c AS (SELECT * FROM e WHERE s >= '1999-01-01')
    SELECT 'c' || c_custkey AS source_list_url, coalesce(c.n, '') AS exhibition_name, coalesce(c.s, '') AS start_date, CASE WHEN c.n IS NOT NULL THEN 'ok' WHEN v.o_custkey IS NOT NULL THEN 'filtered' ELSE 'failed' END AS status,
    CASE WHEN c.n IS NOT NULL THEN '' WHEN c_custkey % 10 = 0 THEN 'fetch' WHEN v.o_custkey IS NOT NULL THEN 'filtered' ELSE 'no-events' END AS failure_stage, c_mktsegment FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM e) v ON c_custkey = v.o_custkey LEFT JOIN c ON c_custkey = c.o_custkey""")
def outcome_status(spark, sf):
    customers = table(spark, sf, "customer")
    page = F.concat(F.lit("c"), "c_custkey")
    failed = customers.filter("c_custkey % 10 = 0").select(page.alias("list_url"), F.lit("fetch").alias("failure_stage"), F.lit("E").alias("failure_type"), F.lit("m").alias("failure_message"))
    orders = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    events = orders.select(F.concat(F.lit("c"), "o_custkey").alias("list_url"), F.concat(F.lit("Order "), "o_orderkey").alias("exhibition_name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"), F.lit("").alias("end_date"), F.lit("").alias("location"), F.lit("").alias("detail_url"))
    out = records.outcomes(customers.select(page.alias("list_url"), "c_mktsegment"), events, failed, F.lit("1999-01-01").cast("date"), carry=("c_mktsegment",))
    return out.select("source_list_url", "exhibition_name", "start_date", "status", "failure_stage", "c_mktsegment")


@query("""WITH t AS (SELECT p_partkey, p_name || ' ' || p_type AS t FROM part) SELECT p_partkey, CAST(least(1.0, least(CAST(length(t) AS DOUBLE) / 120.0, CAST(0.35 AS DOUBLE)) + (CASE WHEN contains(t, 'tion') THEN 20 ELSE 0 END + CASE WHEN contains(t, 'blue') THEN 15 ELSE 0 END) / CAST(100.0 AS DOUBLE)) AS DOUBLE) AS score FROM t""")
def ocr_scores(spark, sf):
    return table(spark, sf, "part").select("p_partkey", scoring.ocr_score(F.concat_ws("  ", "p_name", "p_type"), EVENTS).alias("score"))


@query("""WITH v AS (SELECT p_brand, p_partkey, p_name || CASE WHEN p_partkey % 5 = 0 THEN ' station' ELSE '' END AS t FROM part WHERE p_partkey % 9 <> 0),
    s AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY least(length(t) / CAST(120.0 AS DOUBLE), 0.35) + (CASE WHEN contains(t, 'tion') THEN 20 ELSE 0 END + CASE WHEN contains(t, 'blue') THEN 15 ELSE 0 END) / CAST(100.0 AS DOUBLE) DESC, length(t) DESC, p_partkey) AS k FROM v)
    SELECT p_brand, t AS text FROM s WHERE k = 1""")
def ocr_best_variant(spark, sf):
    text = F.when(F.col("p_partkey") % 9 == 0, "  ").otherwise(F.concat("p_name", F.when(F.col("p_partkey") % 5 == 0, " station").otherwise("")))
    return scoring.best_ocr_text(table(spark, sf, "part").select("p_brand", F.col("p_partkey").alias("pos"), text.alias("text")), "p_brand", rules=EVENTS)


@query("SELECT p_partkey, CASE WHEN contains(lower(p_name), lower(p_type)) THEN p_name ELSE p_type || ' ' || p_name END AS name FROM part")
def event_closest(spark, sf):
    event = lambda c: F.struct(c.alias("exhibition_name"))
    events = F.array(event(F.col("p_name")), event(F.concat_ws(" ", "p_type", "p_name")), event(F.lit("other")))
    return table(spark, sf, "part").select("p_partkey", html.closest_event(events, F.col("p_type"))["exhibition_name"].alias("name"))


@query("""SELECT item_id, left(regexp_extract(text, '^([^\\n]*)', 1), 120) AS event_name, left(text, 300) AS description, '2024-05-0' || (1 + item_id % 9) AS start_date, CASE WHEN contains(text, 'ing') THEN '0.85' ELSE '0.65' END AS confidence FROM benchmark""")
def social_events(spark, sf):
    posts = table(spark, sf, "benchmark").select(F.concat(F.lit("p"), "item_id").alias("post_url"), F.col("text").alias("caption"), F.concat(F.lit("on 2024.5."), 1 + F.col("item_id") % 9).alias("ocr_text"))
    out = html.social_event(posts, EVENTS)
    return out.select(F.substring("evidence", 12, 20).cast("long").alias("item_id"), "event_name", "description", "start_date", "confidence")


# --- Runs -------------------------------------------------------------------------------------


def _numbered(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.select((F.col(key) + 1).alias("position"), F.col(value).alias("value"))


@query("SELECT CAST(r_regionkey * 25 + n_nationkey + 1 AS BIGINT) AS query_index, r_name || ' ' || n_name AS query FROM region, nation")
def query_cross_product(spark, sf):
    return collect.query_plan(_numbered(table(spark, sf, "region"), "r_regionkey", "r_name"), _numbered(table(spark, sf, "nation"), "n_nationkey", "n_name"))


@query("""WITH q AS (SELECT r_regionkey * 25 + n_nationkey + 1 AS i, r_name || ' ' || n_name AS query, r_name, n_nationkey FROM region, nation), s AS (SELECT q.*, s_suppkey, s_name, s_nationkey FROM q JOIN supplier ON s_nationkey = n_nationkey),
    p AS (SELECT i * 1000 + s_suppkey % 1000 AS position, s_name AS title, replace(r_name, ' ', '-') || ' S' || s_suppkey % 7 || '구 x' AS full_address, replace(r_name, ' ', '-') AS region_main, 'S' || s_suppkey % 7 || '구' AS region_sub, query FROM s),
    f AS (SELECT title, full_address, arg_min(struct_pack(position, region_main, region_sub, query), position) AS r FROM p GROUP BY ALL) SELECT r.position, title, full_address, r.region_main, r.region_sub, r.query AS source_query FROM f WHERE title NOT LIKE '%7'""")
def collect_places(spark, sf):
    queries = collect.query_plan(_numbered(table(spark, sf, "region"), "r_regionkey", "r_name"), _numbered(table(spark, sf, "nation"), "n_nationkey", "n_name"))
    q = table(spark, sf, "region").crossJoin(F.broadcast(table(spark, sf, "nation"))).select(F.concat_ws(" ", "r_name", "n_name").alias("query"), "r_name", "n_nationkey")
    hits = q.join(table(spark, sf, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"))
    address = F.concat(F.replace(F.col("r_name"), F.lit(" "), F.lit("-")), F.lit(" S"), F.col("s_suppkey") % 7, F.lit("구 x"))
    none = F.lit("")
    items = hits.select("query", (F.col("s_suppkey") % 1000).alias("pos"), F.concat(F.lit("<b>"), "s_name", F.lit("</b>")).alias("title"), none.alias("link"), none.alias("category"), none.alias("description"), none.alias("telephone"), address.alias("address"), none.alias("roadAddress"), none.alias("mapx"), none.alias("mapy"))
    old = items.filter(F.col("title").like("%7</b>")).select(F.regexp_replace("title", "<[^>]+>", "").alias("title"), F.col("address").alias("full_address"), F.col("link").alias("official_url"))
    return collect.collect_places(queries, items, old).select("position", "title", "full_address", "region_main", "region_sub", "source_query")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey BETWEEN 1001 AND 12000")
def resume_slice(spark, sf):
    first, last = incremental.resume_range(1 << 40, 1, 12_000, next_start=1001)
    return incremental.slice_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", first, last)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def seen_anti_join(spark, sf):
    old = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    return dedup.unseen(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), old, ["o_custkey"])


@query("""WITH s AS (SELECT p_partkey, p_brand, (p_partkey * 37 + p_size) % (CASE WHEN p_brand = 'Brand#3' THEN 25 ELSE 90 END) AS c FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY c DESC, p_partkey) AS rank, max(c) OVER (PARTITION BY p_brand) AS best FROM s)
    SELECT p_brand, p_partkey, CAST(c AS BIGINT) AS c, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 5 AND (c >= 30 OR best < 30)""")
def topn_with_fallback(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", F.expr("(p_partkey * 37 + p_size) % (CASE WHEN p_brand = 'Brand#3' THEN 25 ELSE 90 END)").cast("long").alias("c"))
    return ranking.top_n_with_fallback(rows, "p_brand", "c", "p_partkey", 5)


_messy = "CASE p_partkey % 4 WHEN 0 THEN 'x' || p_size WHEN 1 THEN ' ' || p_size || ' ' WHEN 2 THEN '' ELSE CAST(p_size AS {}) END"


@query(f"WITH m AS (SELECT p_partkey, p_brand, coalesce(try_cast(trim({_messy.format('VARCHAR')}) AS INTEGER), 0) AS n FROM part) SELECT p_partkey, n, row_number() OVER (ORDER BY n, coalesce(try_cast(p_brand AS INTEGER), 0), p_partkey) AS place FROM m")
def sort_safe_int(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_brand", F.expr(_messy.format("STRING")).alias("s"))
    return ranking.numbered(rows, [T.safe_int("s"), T.safe_int("p_brand"), F.col("p_partkey")], "place").select("p_partkey", T.safe_int("s").alias("n"), "place")


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL")
def stream_dedup(spark, sf):
    at = f"{shared_dir(spark)}/sightline/{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex}"
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    last = events.agg(F.max("event_id")).first()[0] or 0
    for i in range(4):  # four files that arrive one after another
        events.filter(F.col("event_id").between(i * (last + 4) // 4, (i + 1) * (last + 4) // 4 - 1)).coalesce(1).write.mode("append").parquet(f"{at}/in")
    stream = incremental.stream_files(spark, f"{at}/in", events.schema, 1)
    incremental.stream_first_rows(stream, ["user_id", "event_type"], f"{at}/out", f"{at}/state", "event_id").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("user_id", "event_type", "event_id")


# --- Whole pipelines --------------------------------------------------------------------------


def site_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Each page as a fetched homepage; a URL is fetched once."""
    pages = dedup.first_wide(table(spark, sf, "pages").withColumn("clean", U.clean_url("url")), ["clean"], "page_id")
    return pages.select(F.col("clean").alias("url"), F.col("url").alias("final_url"), F.lit("ok").alias("status"), F.lit("200").alias("http_status"), F.lit("text/html; charset=utf-8").alias("content_type"), F.col("html").alias("text"), F.lit("").alias("error"))


@query("""SELECT 'https://shop.example.com/list/' || o_orderkey AS source_list_url, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'Sale ' || o_orderkey ELSE '' END AS exhibition_name, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN 'ok' ELSE 'filtered' END AS status,
    CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN '' ELSE 'filtered' END AS failure_stage, CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS start_date FROM orders""")
def extract_pipeline(spark, sf):
    url = F.concat(F.lit("https://shop.example.com/list/"), "o_orderkey")
    # the event's own page is the list page, and its end lies in the start's year, at its end at the latest
    page = F.expr(_order_page.replace("date_format(o_orderdate + interval 10 days, 'M/d')", "'12/31'").replace("/e/", "/list/"))
    snapshots = spread(table(spark, sf, "orders")).select(url.alias("url"), url.alias("final_url"), F.lit("ok").alias("status"), F.lit("200").alias("http_status"), F.lit("text/html").alias("content_type"), page.alias("text"), F.lit("").alias("error"))
    out = extract.extract(snapshots.select(F.col("url").alias("list_url")), snapshots, F.lit("1998-01-01").cast("date"))
    return out.select("source_list_url", "exhibition_name", "status", "failure_stage", "start_date")
