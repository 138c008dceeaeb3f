"""More registered queries: sources and sinks over clients that make their answers up, and whole plans.

Fetchers, search clients, image readers and profiles are plug-ins.  The ones here answer by rule, so that
SQL can say what the operators make of it; they run on the executors like real ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import urls as U
from .functions import vocabulary as V
from .operators import dedup, html, records
from .plans import classify, discover, extract
from .queries import CONTEXT, EVENTS, FULL_SQL, LINKS_SQL, RULES, any_sql, clean_sql, detail_sql, entity_sql, hits_sql, host_sql, key_sql, lit, query, rx, site_snapshots, squeeze_sql
from .session import kept, shared_dir, spread, table
from .sources import files, images, pages, search, social
from .streaming import incremental


def scratch(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder; it goes when the application ends."""
    top = f"{shared_dir(spark)}/sightline/{spark.sparkContext.applicationId}"
    return f"{top}/{name}-{uuid.uuid4().hex}"


class Refused(Exception):
    """What a client raises for a page that isn't there."""

    def __init__(self, code: int):
        super().__init__("not found")
        self.code, self.reason = code, "not found"


def number(text: str) -> int:
    """The digits at a URL's end."""
    return int("".join(c for c in text.rpartition("/")[2] if c.isdigit()) or 0)


# --- Files ------------------------------------------------------------------------------------


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name || ', \"' || r_name || '\"' AS name, CASE n_nationkey % 3 WHEN 0 THEN '' ELSE 'two' || chr(10) || 'lines' END AS note FROM nation JOIN region ON n_regionkey = r_regionkey")
def csv_round_trip(spark, sf):
    rows = table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    out = rows.select(F.col("n_nationkey").cast("string").alias("id"), F.concat("n_name", F.lit(', "'), "r_name", F.lit('"')).alias("name"), F.when(F.col("n_nationkey") % 3 == 0, "").otherwise("two\nlines").alias("note"), F.lit("extra").alias("extra"))
    at = scratch(spark, "csv")
    for _ in range(2):  # the second replaces the first as a whole
        files.write_csv(out, at, ["id", "name", "note"])
    return files.read_csv(spark, at)


@query("SELECT n_name AS name, '전시 ' || n_nationkey AS title, CAST(n_nationkey + 1 AS BIGINT) AS source_row, e AS encoding FROM nation, (VALUES ('utf-8-sig'), ('cp949')) v(e)")
def csv_encodings(spark, sf):
    names = [r[0] for r in table(spark, sf, "nation").orderBy("n_nationkey").select("n_name").collect()]
    out = None
    for encoding in ("utf-8-sig", "cp949"):
        at = scratch(spark, "encoded")
        files.put(spark, f"{at}/list.csv", "".join(["name,title\n", *[f'{n},"전시 {i}"\n' for i, n in enumerate(names)]]).encode(encoding))
        rows = files.read_csv_any(spark, at).withColumn("encoding", F.lit(encoding))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT CAST(row_number() OVER (ORDER BY r_regionkey) AS INTEGER) AS position, r_name AS value FROM region")
def bullets(spark, sf):
    names = [r["r_name"] for r in table(spark, sf, "region").orderBy("r_regionkey").collect()]
    at = f"{scratch(spark, 'bullets')}/list.md"
    files.put(spark, at, ("# Regions\n\n" + "".join(f"  {'-*'[i % 2]}  {n}  \r\ntext - {n}\n" for i, n in enumerate(names + names[:2]))).encode())
    return files.read_bullets(spark, at, "region")


@query("SELECT n_nationkey AS id, n_name AS name FROM nation")
def csv_append(spark, sf):
    rows, at = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")), scratch(spark, "append")
    for part in range(3):
        files.append(rows.filter(F.col("id") % 3 == part), at, ["id", "name"])
    return spark.read.parquet(at)


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE 'a,' || chr(34) || n_nationkey END AS note, TRUE AS marked FROM nation")
def csv_single_file(spark, sf):
    """One file, with a byte-order mark, that replaces an earlier one."""
    rows, at = table(spark, sf, "nation").select("n_name", F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 1, F.concat(F.lit('a,"'), "n_nationkey")).alias("note")), f"{scratch(spark, 'single')}/out.csv"
    files.export_csv(rows.limit(3), at, ["name"])
    files.export_csv(rows, at, ["name", "note"])
    head = spark.read.format("binaryFile").load(at).select((F.substring("content", 1, 3) == F.lit(b"\xef\xbb\xbf")).alias("marked"))
    return files.read_csv(spark, at).crossJoin(F.broadcast(head))


@query("SELECT CAST(row_number() OVER (ORDER BY n_nationkey % 3, n_nationkey) AS BIGINT) AS line, n_name AS name FROM nation")
def csv_append_header(spark, sf):
    """A file that grows by three appends has one header."""
    import csv
    import os
    import tempfile

    rows = table(spark, sf, "nation")
    with tempfile.TemporaryDirectory() as folder:
        at = os.path.join(folder, "out.csv")
        for part in range(3):
            files.append_csv(rows.filter(F.col("n_nationkey") % 3 == part).orderBy("n_nationkey").select(F.col("n_name").alias("name")), at, ["name"])
        with open(at, encoding="utf-8-sig", newline="") as f:
            found = [(i, r["name"]) for i, r in enumerate(csv.DictReader(f), 1)]
    return spark.createDataFrame(found, "line long, name string")


@query("SELECT CAST(i * 40 AS BIGINT) AS last_processed_index, CAST(least(i * 40 + 1, 101) AS BIGINT) AS next_start_index, CAST(100 AS BIGINT) AS total, CAST(i * 40 - (i * 40) // 7 AS BIGINT) AS saved_rows, CAST((i * 40) // 7 AS BIGINT) AS saved_failures FROM range(1, 3) t(i) UNION ALL SELECT 100, 101, 100, 86, 14")
def run_in_slices(spark, sf):
    """A run of 100 pages with a checkpoint after each 40: what the progress says each time."""
    rows, at, told, saved, lost = spark.range(1, 101), scratch(spark, "progress"), [], 0, 0
    first, last = incremental.resume_range(100, 1, 0, (files.read_progress(spark, at) or {}).get("next_start_index", 1))
    for a, b in incremental.slices(first, last, 40):
        part = incremental.slice_rows(rows, "id", a, b)
        failed = part.filter("id % 7 = 0").count()
        saved, lost = saved + part.count() - failed, lost + failed
        files.write_progress(spark, at, b, 100, saved, lost)
        told.append(files.read_progress(spark, at))
    names = ["last_processed_index", "next_start_index", "total", "saved_rows", "saved_failures"]
    return spark.createDataFrame([tuple(t[n] for n in names) for t in told], ", ".join(f"{n} long" for n in names))


@query("SELECT CAST(row_number() OVER (ORDER BY page_id) AS BIGINT) AS page_index, trim(url) AS list_url FROM pages WHERE page_id % 4 <> 0")
def list_page_numbers(spark, sf):
    rows = table(spark, sf, "pages").select((F.col("page_id") + 1).alias("source_row"), F.when(F.col("page_id") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "url")).alias("url"))
    return files.list_pages(rows, "url").select("page_index", "list_url")


@query("SELECT * FROM (VALUES ('KEY', 'quoted value'), ('OTHER', 'a=b'), ('KEPT', 'of the environment'), ('credential', 'given'), ('constant', 'fixed'), ('fallback', 'a=b'), ('folder', '/data'), ('path', '/data/x.csv'), ('absolute', 's3://b/x.csv')) v(key, value)")
def config_values(spark, sf):
    import tempfile

    with tempfile.NamedTemporaryFile("w", suffix=".env") as f:
        f.write("# comment\n\nKEY='quoted value'\nOTHER=a=b\nKEPT=from the file\nnothing\n")
        f.flush()
        found = files.dotenv(f.name, {"KEPT": "of the environment", "DATA": "/data/"})
    folder = files.data_dir("", found, "DATA")
    rows = [(k, found[k]) for k in ("KEY", "OTHER", "KEPT")]
    rows += [("credential", files.credential("given", "fixed", found, "OTHER")), ("constant", files.credential("", "fixed", found, "OTHER")), ("fallback", files.credential("", "", found, "OTHER"))]
    rows += [("folder", folder), ("path", files.data_path("x.csv", folder)), ("absolute", files.data_path("s3://b/x.csv", folder))]
    return spark.createDataFrame(rows, "key string, value string")


# --- Pages, searches, images and posts that clients give --------------------------------------


def get_page(url: str, seconds: float):
    """A page of 50 bytes; some URLs fail, and some move."""
    n = number(url)
    if n % 7 == 3:
        raise Refused(404)
    if n % 7 == 5:
        raise TimeoutError("too slow")
    kind = "text/html; charset=cp949" if n % 2 else "text/html"
    return url + "/moved" * (n % 3 == 0), 200, kind, ("전시 " + "x" * 60).encode("cp949" if n % 2 else "utf-8")


@query("""WITH u AS (SELECT DISTINCT page_id AS n, 'https://x.example.com/a b/' || page_id AS url FROM pages)
    SELECT url, CASE WHEN n % 7 = 5 THEN '' WHEN n % 7 = 3 THEN url ELSE replace(url, ' ', '%20') || CASE WHEN n % 3 = 0 THEN '/moved' ELSE '' END END AS final_url, CASE n % 7 WHEN 3 THEN 'http_error' WHEN 5 THEN 'error' ELSE 'ok' END AS status, CASE n % 7 WHEN 3 THEN '404' WHEN 5 THEN '' ELSE '200' END AS http_status,
    CASE WHEN n % 7 IN (3, 5) THEN 0 WHEN n % 2 = 1 THEN 48 ELSE 46 END AS n, CASE n % 7 WHEN 3 THEN 'not found' WHEN 5 THEN 'TimeoutError: too slow' ELSE '' END AS error FROM u""")
def fetched_pages(spark, sf):
    urls = table(spark, sf, "pages").select(F.concat(F.lit("https://x.example.com/a b/"), "page_id").alias("url"))
    got = pages.fetch_pages(urls.unionByName(urls), get_page, 8, most_bytes=50)
    return got.select("url", "final_url", "status", "http_status", F.length("text").alias("n"), "error")


def find(asked: str, display: int, sort: str) -> list[dict]:
    """As many results as the query's number says, at most ``display``."""
    n = number(asked.replace(" ", "/"))
    if n % 5 == 3:
        raise Refused(429)
    if n % 5 == 4:
        raise ValueError("no answer")
    return [{"title": f"<b>{asked}</b> {sort}", "link": f"https://site{i}.example.com/", "description": None} for i in range(min(display, n % 12))]


def searched(spark: SparkSession, asked: DataFrame, name: str, display: int, fetch=find) -> DataFrame:
    """The results of a bounded list of queries."""
    spark.dataSource.register(search.search_source(fetch, [r[0] for r in asked.select("query").distinct().collect()], 16, name))
    return spark.read.format(name).option("display", display).option("sort", "SIM").load()


_asked = "SELECT p_partkey AS n, 'art ' || p_partkey AS query FROM part WHERE p_partkey <= 120"


@query(f"""WITH q AS ({_asked}), r AS (SELECT *, CASE WHEN n % 5 < 3 THEN least(10, n % 12) ELSE 0 END AS k, CASE n % 5 WHEN 3 THEN 'http_error_429' WHEN 4 THEN 'error' ELSE 'ok' END AS status, CASE n % 5 WHEN 3 THEN 'not found' WHEN 4 THEN 'ValueError: no answer' ELSE '' END AS message FROM q)
    SELECT query, CAST(i AS INTEGER) AS pos, '<b>' || query || '</b> sim' AS title, 'https://site' || i || '.example.com/' AS link, '' AS description, status, message FROM r, range(10) t(i) WHERE i < k
    UNION ALL SELECT query, -1, '', '', '', status, message FROM r WHERE k = 0""")
def search_results(spark, sf):
    asked = table(spark, sf, "part").filter("p_partkey <= 120").select(F.concat(F.lit("art "), "p_partkey").alias("query"))
    return searched(spark, asked, "made_up_search", 10).withColumn("pos", F.coalesce("pos", F.lit(-1)))


def find_places(asked: str, display: int, sort: str) -> list[dict]:
    return [{"title": f"<b>{asked}</b>", "category": sort, "address": f"A B구 {i}", "mapx": 100 + i} for i in range(min(display, number(asked.replace(" ", "/")) % 8))]


@query("""SELECT 'art ' || p_partkey AS query, CAST(i AS INTEGER) AS pos, 'comment' AS category, 'A B구 ' || i AS address, '10' || i AS mapx, '' AS telephone FROM part, range(4) t(i) WHERE p_partkey BETWEEN 1 AND 60 AND i < p_partkey % 8""")
def place_search(spark, sf):
    asked = [f"art {r[0]}" for r in table(spark, sf, "part").filter("p_partkey between 1 and 60").select("p_partkey").collect()]
    spark.dataSource.register(search.search_source(find_places, asked, 8, "made_up_places", search.PLACE_FIELDS))
    got = spark.read.format("made_up_places").option("display", 4).option("sort", "Comment").load()
    return got.filter("pos is not null").select("query", "pos", "category", "address", "mapx", "telephone")


@query(f"""WITH q AS ({_asked}), f AS (SELECT n, CASE WHEN n % 5 < 3 THEN least(10, n % 12) ELSE 0 END AS k FROM q)
    SELECT CAST(n AS BIGINT) AS venue_index, CASE WHEN n % 5 = 3 THEN 'http_error_429' WHEN n % 5 = 4 THEN 'error' WHEN k = 0 THEN 'no_results' ELSE 'found' END AS api_search_status, CASE WHEN n % 5 < 3 AND k > 0 THEN 'https://site0.example.com/' ELSE '' END AS api_found_url,
    CASE WHEN n % 5 < 3 AND k > 0 THEN 85 ELSE 0 END AS api_match_score, CASE WHEN n % 5 = 3 THEN 'not found' WHEN n % 5 = 4 THEN 'ValueError: no answer' WHEN k = 0 THEN 'No search results.' ELSE 'title_match|art_keyword|official_like' END AS api_search_reason FROM f
    UNION ALL SELECT 0, 'missing_credentials', '', 0, 'No search credentials are set.'""")
def search_records(spark, sf):
    """Each venue's best hit, through the whole way from its query to its record."""
    part = table(spark, sf, "part").filter("p_partkey <= 120")
    venues = part.select(F.col("p_partkey").cast("long").alias("venue_index"), F.lit("art").alias("title"), F.col("p_partkey").cast("string").alias("road_address"), F.lit("").alias("full_address"), F.lit("").alias("region_sub"))
    asked = classify.search_queries(venues, suffix="")
    found = searched(spark, asked, "made_up_sites", 10).withColumn("description", F.when(F.col("pos").isNotNull(), "gallery").otherwise(""))
    one = venues.limit(1).withColumn("venue_index", F.lit(0).cast("long"))
    none = searched(spark, spark.createDataFrame([("x",)], "query string"), "no_credentials", 5, None)
    out = classify.search_records(venues, asked.join(found, "query")).unionByName(classify.search_records(one, none.withColumn("venue_index", F.lit(0).cast("long"))))
    return out.select("venue_index", "api_search_status", "api_found_url", "api_match_score", "api_search_reason")


def get_image(url: str, seconds: float):
    """A small grey image; some are missing."""
    n = number(url)
    if n % 5 == 4:
        raise Refused(404)
    rows = bytes((n + 40 * i + 9 * j) % 256 for i in range(4) for j in range(6))
    return url, 200, "image/x-portable-graymap", b"P5 6 4 255\n" + rows


def read_image(image, mode: int) -> str:
    """More is read in the enlarged variants, and most in one mode; the first variant can't be read at all."""
    if image.shape[0] == 4:
        raise ValueError("unreadable")
    return f" ring  {image.shape[0]} {image.shape[1]} " + "x" * mode


@query("""SELECT 'https://i.example.com/' || p_partkey AS url, CASE WHEN p_partkey % 5 = 4 THEN '' ELSE 'ring 8 12 ' || repeat('x', 12) END AS text, CASE WHEN p_partkey % 5 = 4 THEN 'Refused: not found' ELSE '' END AS error FROM part WHERE p_partkey <= 200""")
def image_texts(spark, sf):
    urls = table(spark, sf, "part").filter("p_partkey <= 200").select(F.concat(F.lit("https://i.example.com/"), "p_partkey").alias("url"))
    return images.image_texts(images.read_images(urls, get_image, 8, read_image), EVENTS)


def profile_links(profile: str, seconds: float) -> list[str]:
    n = number(profile)
    if n % 6 == 5:
        raise ValueError("private")
    return [f"/p/{n}-{i}/" for i in range(n % 12)] + ["/p/0-0/", "/about", "https://elsewhere.example.com/p/1"]


def read_post(url: str, seconds: float) -> tuple[str, str]:
    if url.endswith("-3/"):
        raise TimeoutError("gone")
    return f"Post {url.split('/')[-2]}\nring on 2024.5.1 ~ 5.9", ""


_profiles = "SELECT n_nationkey AS n, 'https://www.instagram.com/' || n_nationkey AS list_url FROM nation"


@query(f"""WITH u AS ({_profiles}), p AS (SELECT n, list_url, unnest(list_distinct(list_transform(range(n % 12), lambda i: n || '-' || i) || ['0-0'])) AS post FROM u WHERE n % 6 <> 5),
    k AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY CASE WHEN post = '0-0' AND n <> 0 THEN 99 ELSE CAST(string_split(post, '-')[2] AS INTEGER) END) - 1 AS position FROM p),
    e AS (SELECT * FROM k WHERE position < 8 AND NOT ends_with(post, '-3'))
    SELECT list_url AS source_list_url, 'ok' AS status, 'Post ' || post AS exhibition_name, '2024-05-01' AS start_date, '2024-05-09' AS end_date, list_url AS detail_url FROM e
    UNION ALL SELECT list_url, 'failed', '', '', '', '' FROM u WHERE n % 6 = 5""")
def social_pipeline(spark, sf):
    """Profiles to posts to events, with the failures of some."""
    profiles = table(spark, sf, "nation").select(F.concat(F.lit("https://www.instagram.com/"), "n_nationkey").alias("list_url"))
    posts = social.with_texts(kept(social.fetch_posts(profiles, profile_links, read_post, 4), "posts"), spark.createDataFrame([], "url string, text string"))
    nothing = spark.createDataFrame([], "url string, final_url string, status string, text string, error string")
    out, _ = extract.extract_all(profiles, nothing, F.lit("2024-01-01").cast("date"), extract.Options(social=True, rules=EVENTS), posts=posts)
    return out.select("source_list_url", "status", "exhibition_name", "start_date", "end_date", "detail_url")


# --- Extraction: every stage, for list pages and for the pages of their events ----------------

_KIND = "o_orderkey % 9"
_ROOT = "https://shop.example.com"


def _linked(name: str, more: str = "") -> str:
    """SQL of a script of one JSON-LD event."""
    return f"""'<script type="application/ld+json">{{"@type": "Event", "name": "' || {name} || '"{more}}}</script>'"""


def _order_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(o_orderkey, kind, day, last, customer): what the pages below are made of."""
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.expr(_KIND).alias("kind"), F.expr("date_format(o_orderdate, 'yyyy-MM-dd')").alias("day"), F.expr("date_format(o_orderdate + interval 10 days, 'yyyy.M.d')").alias("last"), F.expr("date_format(o_orderdate, 'yyyy.M.d')").alias("dots"))


def extraction(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Nine kinds of list pages: 0 a linked event that lacks nothing; 1 a block whose page has linked events;
    2 a list page that moved, whose own text says the rest; 3 a block whose page is missing; 4 a page that
    can't be fetched; 5 events that only the rendered page has; 6 events that only an image has; 7 a block
    whose page says nothing until it is rendered, and its place only in an image; 8 nothing at all."""
    o = _order_pages(spark, sf)
    url = F.concat(F.lit(f"{_ROOT}/list/"), "o_orderkey")
    whole = _linked("'Concert ' || o_orderkey", """, "startDate": "' || day || '", "endDate": "' || replace(last, '.', '-') || '", "location": "Hall ' || o_custkey || '\"""")
    html_ = F.expr(f"""CASE kind WHEN 0 THEN {whole} WHEN 1 THEN '<div><a href="/e/' || o_orderkey || '">Evening ' || o_orderkey || '</a></div>'
        WHEN 2 THEN {_linked("'Concert ' || o_orderkey", ''', "startDate": "' || day || '"''')} || '<p>period ' || dots || ' ~ ' || last || '</p><p>장소: Hall ' || o_custkey || '</p>'
        WHEN 3 THEN '<ul><li><a href="/gone/' || o_orderkey || '">Morning ' || o_orderkey || '</a> ' || dots || '</li></ul>' WHEN 5 THEN '<p>wait</p>' WHEN 6 THEN '<img src="/poster/' || o_orderkey || '.png" alt="red poster">'
        WHEN 7 THEN '<div><a href="/late/' || o_orderkey || '">Evening ' || o_orderkey || '</a></div>' ELSE '<p>nothing</p>' END""")
    failed = F.col("kind") == 4
    row = lambda at, final, text: [at.alias("url"), final.alias("final_url"), F.when(failed, "http_error").otherwise("ok").alias("status"), F.when(failed, "").otherwise(text).alias("text"), F.when(failed, "HTTPError: 404").otherwise("").alias("error")]
    lists = o.select(*row(url, F.when(F.col("kind") == 2, F.concat(F.lit(f"{_ROOT}/moved/"), "o_orderkey")).otherwise(url), html_))
    other = _linked("'Other ' || o_orderkey", ', "startDate": "2001-01-01"')
    own = _linked("'Evening ' || o_orderkey || ' again'", """, "startDate": "' || day || '", "endDate": "' || replace(last, '.', '-') || '", "location": "Hall ' || o_custkey || '\"""")
    details = o.filter("kind in (1, 7)").select(*row(F.expr(f"'{_ROOT}' || CASE kind WHEN 1 THEN '/e/' ELSE '/late/' END || o_orderkey"), F.lit(""), F.expr(f"CASE kind WHEN 1 THEN {other} || {own} ELSE '<p>wait</p>' END")))
    rendered = o.filter("kind in (5, 7)").select(F.expr(f"'{_ROOT}' || CASE kind WHEN 5 THEN '/list/' ELSE '/late/' END || o_orderkey").alias("url"), F.expr(f"CASE kind WHEN 5 THEN {whole} ELSE '<p>' || dots || ' ~ ' || last || '</p><img src=\"/late/' || o_orderkey || '.png\">' END").alias("html"))
    broken = o.filter("kind = 8").select(url.alias("url"), F.lit("").alias("html"), F.lit("RenderError: no browser").alias("error"))
    seen = o.filter("kind in (6, 7)").select(F.expr(f"'{_ROOT}' || CASE kind WHEN 6 THEN '/poster/' ELSE '/late/' END || o_orderkey || '.png'").alias("url"), F.expr("CASE kind WHEN 6 THEN 'Singing ' || o_orderkey || ' | ' || dots || ' ~ ' || last ELSE 'Evening ' || o_orderkey END || ' | 장소: Hall ' || o_custkey").alias("text"))
    chosen = extract.Options(detail="auto", render="auto", ocr="auto", rules=EVENTS)
    snapshots = spread(lists.unionByName(details))
    return extract.extract_all(o.select(url.alias("list_url"), "kind"), snapshots, F.lit("1998-01-01").cast("date"), chosen, rendered.withColumn("error", F.lit("")).unionByName(broken), seen, ("kind",))


_EXTRACT_SQL = f"""
    WITH o AS (SELECT o_orderkey AS k, {_KIND} AS kind, '{_ROOT}/list/' || o_orderkey AS url, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate + INTERVAL 10 DAY, '%Y-%m-%d') AS last, 'Hall ' || o_custkey AS hall FROM orders),
    e AS (SELECT *, kind NOT IN (4, 8) AS has, CASE WHEN kind = 3 THEN day ELSE last END >= '1998-01-01' AS live,
      CASE WHEN kind IN (0, 2, 5) THEN 'Concert ' WHEN kind IN (1, 7) THEN 'Evening ' WHEN kind = 3 THEN 'Morning ' ELSE 'Singing ' END || k AS name,
      CASE kind WHEN 1 THEN '{_ROOT}/e/' || k WHEN 2 THEN '{_ROOT}/moved/' || k WHEN 3 THEN '{_ROOT}/gone/' || k WHEN 7 THEN '{_ROOT}/late/' || k ELSE url END AS detail FROM o)"""


@query(_EXTRACT_SQL + """ SELECT url AS source_list_url, CASE WHEN has AND live THEN 'ok' WHEN has THEN 'filtered' ELSE 'failed' END AS status, CASE WHEN has AND live THEN name ELSE '' END AS exhibition_name, CASE WHEN has AND live THEN day ELSE '' END AS start_date,
    CASE WHEN has AND live AND kind <> 3 THEN last ELSE '' END AS end_date, CASE WHEN has AND live AND kind <> 3 THEN hall ELSE '' END AS location, CASE WHEN has AND live THEN detail ELSE '' END AS detail_url, CAST(kind AS VARCHAR) AS kind,
    CASE WHEN kind = 3 THEN 'detail-fetch' WHEN has AND live THEN '' WHEN has THEN 'filtered' WHEN kind = 4 THEN 'fetch' ELSE 'js-render' END AS failure_stage, CASE WHEN kind = 3 THEN 'NotFetched' WHEN has AND live THEN '' WHEN has THEN 'Filtered' WHEN kind = 4 THEN 'HTTPError' ELSE 'RenderError' END AS failure_type,
    CASE WHEN has AND live THEN '' WHEN has THEN 'Filtered out by end_date < today' WHEN kind = 4 THEN 'HTTPError: 404' ELSE 'RenderError: no browser' END AS failure_message FROM e""")
def extract_stages(spark, sf):
    return extraction(spark, sf)[0]


@query(_EXTRACT_SQL + """ SELECT CASE kind WHEN 3 THEN detail ELSE url END AS list_url, CASE kind WHEN 3 THEN 'detail-fetch' WHEN 4 THEN 'fetch' ELSE 'js-render' END AS stage, CASE kind WHEN 3 THEN 'NotFetched' WHEN 4 THEN 'HTTPError' ELSE 'RenderError' END AS error_type,
    CASE kind WHEN 3 THEN '' WHEN 4 THEN 'HTTPError: 404' ELSE 'RenderError: no browser' END AS error_message, '' AS source_title FROM e WHERE kind IN (3, 4, 8)""")
def extract_failures(spark, sf):
    return extraction(spark, sf)[1]


@query("""WITH o AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 4 AS s FROM orders) SELECT 'https://x.example.com/' || k AS source_list_url, CASE WHEN s = 3 THEN 'failed' ELSE 'ok' END AS status, CASE WHEN s = 3 THEN 'page-timeout' ELSE '' END AS failure_stage, CASE WHEN s = 3 THEN 'Page processing exceeded 5s' ELSE '' END AS failure_message FROM o""")
def page_budget(spark, sf):
    """Pages that took longer than their budget lose their events."""
    o = _order_pages(spark, sf)
    page = F.expr(_linked("'Concert ' || o_orderkey", """, "startDate": "' || day || '", "endDate": "' || day || '", "location": "x\""""))
    seen = o.select(F.concat(F.lit("https://x.example.com/"), "o_orderkey").alias("url"), F.lit("").alias("final_url"), F.lit("ok").alias("status"), page.alias("text"), F.lit("").alias("error"), (F.col("o_orderkey") % 4 * 2.0).alias("seconds"))
    out = extract.extract(seen.select(F.col("url").alias("list_url")), seen, F.lit("1990-01-01").cast("date"), extract.Options(page_seconds=5))
    return out.select("source_list_url", "status", "failure_stage", "failure_message")


@query("SELECT p_partkey, (p_partkey % 2 = 0 OR p_partkey % 3 = 0 OR p_partkey % 5 = 0) AS lacks, TRUE AS always, (p_partkey % 2 = 0 OR p_partkey % 3 = 0 OR p_partkey % 5 = 0) AS auto, FALSE AS never FROM part")
def detail_needed(spark, sf):
    gap = lambda n: F.when(F.col("p_partkey") % n != 0, "x").otherwise("" if n % 2 else F.lit(None))
    rows = table(spark, sf, "part").select("p_partkey", gap(2).alias("start_date"), gap(3).alias("end_date"), gap(5).alias("location"))
    lacks = records.needs_detail()
    return rows.select("p_partkey", lacks.alias("lacks"), *[records.runs(mode, lacks).alias(mode) for mode in ("always", "auto", "never")])


# --- Discovery --------------------------------------------------------------------------------

_words = [("primary", RULES.primary, 55, 35, "primary_exhibition_keyword", "page_title_heading_exhibition"), ("upcoming", RULES.upcoming, 14, 8, "upcoming_keyword", "page_upcoming_keyword"), ("current", RULES.current, 12, 6, "current_keyword", "page_current_keyword"), ("past", RULES.past, 8, 0, "past_keyword", ""), ("secondary", RULES.secondary, 26, 16, "secondary_info_keyword", "page_notice_news_program")]
_relevant = lambda hay: "(" + " OR ".join([any_sql(hay, RULES.primary + RULES.secondary), *[rx(hay, p) for p, _, _ in RULES.paths]]) + ")"
_fold = lambda column: f"list_reduce(list({column} ORDER BY position), lambda acc, x: CASE WHEN x = '' OR (acc <> '' AND contains(acc, x)) THEN acc ELSE trim({squeeze_sql("(acc || ' | ' || x)")}, ' |') END)"
_fold_source = "list_reduce(list(source ORDER BY position), lambda acc, x: CASE WHEN list_contains(string_split(acc, '|'), x) THEN acc ELSE acc || '|' || x END)"
_root = "regexp_extract(home, '^([^:]+://[^/?#]*)', 1)"
_text = lambda tag, n: f"left({squeeze_sql(entity_sql(f'regexp_extract(html, {lit(f"<{tag}>(.*?)</{tag}>")}, 1)'))}, {n})"


def _merged(rows: str, keys: str) -> str:
    """SQL that merges candidates by keys; each field folds its distinct values in the order of their first positions."""
    fold = lambda c, f: f"(SELECT {keys}, {f} AS {c} FROM (SELECT {keys}, {c}, min(position) AS position FROM {rows} GROUP BY ALL) GROUP BY {keys})"
    first = f"(SELECT {keys}, min(position) AS position, arg_min(url, position) AS url FROM {rows} GROUP BY {keys})"
    return f"SELECT * FROM {first} JOIN {fold('source', _fold_source)} USING ({keys}) JOIN {fold('anchor_text', _fold('anchor_text'))} USING ({keys}) JOIN {fold('source_context', _fold('source_context'))} USING ({keys})"


CANDIDATES_SQL = f"""
    WITH v AS (SELECT page_id AS venue_index, 'Venue ' || page_id AS title, {clean_sql('url')} AS home FROM pages WHERE page_id % 10 <> 9),
    snap AS (SELECT {clean_sql('url')} AS spot, min(page_id) AS page_id, arg_min(html, page_id) AS html FROM pages GROUP BY 1),
    h AS (SELECT v.*, page_id, {_text('title', 300)} AS page_title, {_text('h1', 500)} AS headings FROM v JOIN snap ON home = spot),
    l AS ({LINKS_SQL}), links AS (SELECT venue_index, home, l.at * 10 AS position, {clean_sql(FULL_SQL)} AS url, l.text AS anchor_text FROM h JOIN l USING (page_id)),
    r AS (SELECT venue_index, 0 AS source_ord, position, url, 'homepage_nav' AS source, anchor_text, {lit(CONTEXT)} AS source_context FROM links WHERE {host_sql('home')} = {host_sql('url')} AND {_relevant("(lower(url) || ' ' || lower(anchor_text) || ' ' || " + lit(CONTEXT) + ")")}
      UNION ALL SELECT venue_index, 0, 1099511627776, home, 'homepage_self', title, page_title FROM h WHERE {_relevant("(lower(home) || ' ' || lower(trim(page_title || ' ' || headings)) || ' ')")}
      UNION ALL SELECT venue_index, 2, i, {_root} || p, 'common_path', trim(p, '/'), '' FROM v, (SELECT unnest([{', '.join(map(lit, V.LIKELY_PATHS))}]) AS p, unnest(range({len(V.LIKELY_PATHS)})) AS i)),
    keyed AS (SELECT *, {key_sql('url')} AS key FROM r), inner_ AS ({_merged('keyed', 'venue_index, source_ord, key')}),
    placed AS (SELECT * REPLACE (position + source_ord * 4398046511104 AS position) FROM inner_), c AS ({_merged('placed', 'venue_index, key')})"""


def venue_pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(F.col("page_id").alias("venue_index"), F.concat(F.lit("Venue "), "page_id").alias("title"), F.when(F.col("page_id") % 10 != 9, F.col("url")).otherwise("").alias("official_url"))


@query(CANDIDATES_SQL + " SELECT venue_index, key, url, source, anchor_text, source_context FROM c")
def discover_candidates(spark, sf):
    """Every candidate of every venue, from its homepage's links, itself, and common paths, merged by key."""
    chosen, snapshots = discover.Options(sitemap=False, rules=RULES), site_snapshots(spark, sf)
    home = kept(discover.homepages(venue_pages(spark, sf), snapshots), "homepages")
    return discover.candidates(home, snapshots, None, chosen).select("venue_index", "key", "url", "source", "anchor_text", "source_context")


_hay = "(lower(url) || ' ' || lower(anchor_text) || ' ' || lower(source_context) || ' ' || lower(source))"
_points = " + ".join([*[f"CASE WHEN {any_sql('hay', w)} THEN {n} ELSE 0 END" for _, w, n, _, _, _ in _words], *[f"CASE WHEN {rx('hay', p)} THEN {n} ELSE 0 END" for p, n, _ in RULES.paths], *[f"CASE WHEN contains(source, {lit(x)}) THEN {n} ELSE 0 END" for x, n in RULES.sources]])
_page_points = " + ".join(f"CASE WHEN read AND {any_sql('said', w)} THEN {n} ELSE 0 END" for name, w, _, n, _, _ in _words if n)
_kind = lambda c, label: f"CASE WHEN {c} THEN {lit(label)} END"
_first_evidence = [*[_kind(any_sql("hay", w), x) for _, w, _, _, x, _ in _words], *[_kind(rx("hay", p), x) for p, _, x in RULES.paths], *[_kind(f"contains(source, {lit(x)})", f"source={x}") for x, _ in RULES.sources], _kind("detail", "detail_page_penalty"), _kind("NOT detail", "list_like_url"), "CASE WHEN len(bad) > 0 THEN 'negative=' || array_to_string(bad[1:4], '|') END"]
_page_evidence = [*[_kind(f"read AND {any_sql('said', w)}", x) for _, w, _, n, _, x in _words if n], "CASE WHEN read AND len(page_bad) > 0 THEN 'page_negative=' || array_to_string(page_bad[1:4], '|') END", _kind("probe AND NOT read", "fetch_failed")]
_type = "CASE WHEN main AND detail THEN 'exhibition_detail' " + " ".join(f"WHEN main AND {any_sql('told', w)} THEN {lit(x)}" for w, x in ((RULES.upcoming, "upcoming_exhibition"), (RULES.current, "current_exhibition"), (RULES.past, "past_exhibition"))) + " WHEN main THEN 'exhibition_list' " + " ".join(f"WHEN {any_sql('told', w)} THEN {lit(x)}" for w, x in ((RULES.notice, "notice_likely"), (RULES.news, "news_likely"), (RULES.program, "program_likely"))) + " ELSE 'weak_candidate' END"
DISCOVER_SQL = CANDIDATES_SQL + f""",
    s0 AS (SELECT *, {_hay} AS hay, {detail_sql('url')} AS detail FROM c), s1 AS (SELECT *, {hits_sql('hay', RULES.negative)} AS bad FROM s0),
    s2 AS (SELECT *, greatest(0, {_points} + CASE WHEN detail THEN -28 ELSE 10 END - least(45, 12 * len(bad))) AS initial FROM s1),
    s3 AS (SELECT *, row_number() OVER (PARTITION BY venue_index ORDER BY initial DESC, position) <= 5 AS probe FROM s2),
    s4 AS (SELECT s3.*, probe AND snap.spot IS NOT NULL AS read, CASE WHEN probe THEN coalesce({_text('title', 300)}, '') ELSE '' END AS page_title, CASE WHEN probe THEN coalesce({_text('h1', 500)}, '') ELSE '' END AS heading_text FROM s3 LEFT JOIN snap ON snap.spot = url),
    s5 AS (SELECT *, lower(page_title || ' ' || heading_text || ' ') AS said FROM s4), s6 AS (SELECT *, {hits_sql('said', RULES.negative)} AS page_bad FROM s5),
    s7 AS (SELECT *, {_page_points} - CASE WHEN read AND len(page_bad) > 0 THEN least(35, 8 * len(page_bad)) ELSE 0 END - CASE WHEN probe AND NOT read THEN 18 ELSE 0 END AS page_score, lower(url) || ' ' || lower(anchor_text) || ' ' || CASE WHEN read THEN said ELSE '' END AS told FROM s6),
    s8 AS (SELECT *, {any_sql('told', RULES.primary)} AS main, least(greatest(0, least(100, initial + page_score)), CASE WHEN probe AND NOT read THEN 45 WHEN read THEN 100 WHEN contains(source, 'common_path') THEN 48 ELSE 80 END, CASE WHEN detail THEN 72 ELSE 100 END) AS confidence FROM s7),
    s9 AS (SELECT *, {_type} AS candidate_type, array_to_string(list_filter([{', '.join(_first_evidence + _page_evidence)}], lambda x: x IS NOT NULL), '; ') AS evidence FROM s8),
    k AS (SELECT *, row_number() OVER (PARTITION BY venue_index ORDER BY confidence DESC, initial DESC, position) AS rank, max(confidence) OVER (PARTITION BY venue_index) AS best FROM s9)"""


@query(DISCOVER_SQL + " SELECT venue_index, key, CAST(initial AS INTEGER) AS initial_score, CAST(page_score AS INTEGER) AS page_score, CAST(confidence AS INTEGER) AS confidence, candidate_type, evidence FROM k WHERE rank <= 40")
def candidate_page_scores(spark, sf):
    """What the pages of the best candidates add: scores, caps, kinds and evidence."""
    chosen, snapshots = discover.Options(sitemap=False, top_n=40, rules=RULES), site_snapshots(spark, sf)
    home = kept(discover.homepages(venue_pages(spark, sf), snapshots), "homepages")
    every = discover.scored(discover.candidates(home, snapshots, None, chosen), snapshots, chosen)
    return every.withColumn("key", U.candidate_key("url")).select("venue_index", "key", "initial_score", "page_score", "confidence", "candidate_type", F.array_join("evidence", "; ").alias("evidence"))


@query(DISCOVER_SQL + f""", top AS (SELECT * FROM k WHERE rank <= 3 AND (confidence >= 30 OR best < 30)),
    n AS (SELECT page_id AS venue_index, {clean_sql('url')} AS home FROM pages)
    SELECT n.venue_index, 'Venue ' || n.venue_index AS venue_title, '' AS is_art_venue, '' AS venue_type, CASE WHEN n.venue_index % 10 = 9 THEN '' ELSE home END AS homepage_url, CASE WHEN n.venue_index % 10 = 9 THEN 'no_homepage_url' ELSE 'ok' END AS homepage_status,
    CAST(coalesce(rank, 1) AS INTEGER) AS rank, coalesce(url, '') AS candidate_url, coalesce(candidate_type, 'not_found') AS candidate_type, CAST(coalesce(confidence, 0) AS INTEGER) AS confidence, CAST(coalesce(initial + page_score, 0) AS INTEGER) AS score, coalesce(source, '') AS source, left(coalesce(anchor_text, ''), 500) AS source_link_text,
    left(coalesce(evidence, ''), 1000) AS evidence_text, CASE WHEN read THEN '200' ELSE '' END AS http_status, CASE WHEN read THEN 'ok' WHEN probe THEN 'error' ELSE '' END AS fetch_status, coalesce(page_title, '') AS page_title, coalesce(heading_text, '') AS heading_text,
    CASE WHEN coalesce(confidence, 0) < 55 THEN 'yes' ELSE 'no' END AS needs_manual_review, CASE WHEN url IS NULL THEN 'No verified/input/api URL available.' ELSE '' END AS error FROM n LEFT JOIN top USING (venue_index)""")
def discover_pipeline(spark, sf):
    """Every venue's best list pages, from its homepage to the ranked rows."""
    return discover.discover(venue_pages(spark, sf), site_snapshots(spark, sf), None, discover.Options(top_n=3, rules=RULES))


# --- The rest ---------------------------------------------------------------------------------


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' ELSE regexp_extract(url, '^([^:]+)', 1) || '://' || lower(regexp_extract(url, '^[^:]+://([^/?#]*)', 1)) || CASE WHEN regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1) END END AS canonical FROM pages")
def url_canonical(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.canonical(F.when(F.col("page_id") % 5 != 0, F.regexp_replace("url", r"\.example\.", ".EXAMPLE."))).alias("canonical"))


@query(f"SELECT page_id AS venue_index, 'site:' || {host_sql('url')} || ' T' || page_id || ' shows' AS query FROM pages")
def site_search_queries(spark, sf):
    return table(spark, sf, "pages").select(F.col("page_id").alias("venue_index"), search.site_query(U.host_key("url"), F.concat(F.lit(" T"), "page_id"), "shows").alias("query"))


@query("""WITH w AS (SELECT CAST(max(epoch_us(ts)) // 300000000 * 300000000 AS BIGINT) AS last FROM events) SELECT epoch_us(ts) // 300000000 * 300 AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL""")
def stream_window_counts(spark, sf):
    """Counts by tumbling window of a stream of one file; a later end of the stream closes all its windows."""
    at = scratch(spark, "stream")
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.coalesce(1).write.parquet(f"{at}/in")
    spark.read.parquet(f"{at}/in").agg((F.max("ts") + F.expr("interval 2 days")).alias("ts"), F.lit("end").alias("event_type")).coalesce(1).write.mode("append").parquet(f"{at}/in")
    counts = incremental.stream_counts(incremental.stream_files(spark, f"{at}/in", events.schema, 1), "ts", "event_type", late="1 day")
    counts.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("window_start timestamp, event_type string, n long").parquet(f"{at}/out")
    return out.filter("event_type <> 'end'").select(F.unix_timestamp("window_start").alias("window_start"), "event_type", "n")


@query("""WITH b AS (SELECT p_partkey, p_name, p_type, p_partkey % 4 AS k FROM part), n AS (SELECT *, 'Ring ' || p_type || 'ing ' || p_partkey AS name FROM b)
    SELECT p_partkey, CASE k WHEN 3 THEN '' ELSE name END AS exhibition_name, CASE k WHEN 0 THEN '2024-03-05' ELSE '' END AS start_date, CASE k WHEN 0 THEN '2024-04-06' ELSE '' END AS end_date, CASE k WHEN 0 THEN 'Hall ' || p_partkey || ' x' ELSE '' END AS location, CASE k WHEN 0 THEN 'https://p.example.com/e/' || p_partkey ELSE 'https://p.example.com/' END AS detail_url FROM n WHERE k <> 3""")
def block_events(spark, sf):
    """Events that blocks tell of: dated ones, and those whose name says so; a block of a short text is none."""
    name = "'Ring ' || p_type || 'ing ' || p_partkey"
    page = F.expr(f"""CASE p_partkey % 4 WHEN 0 THEN '<div><a href="/e/' || p_partkey || '">' || {name} || '</a><br/>2024.3.5 ~ 4/6<p>장소: Hall ' || p_partkey || ' x</p></div>' WHEN 3 THEN '<li>abc</li>' ELSE '<td>' || {name} || '</td>' END""")
    rows = spread(table(spark, sf, "part")).select("p_partkey", F.lit("https://p.example.com/").alias("final_url"), html.parsed(page, F.lit("https://p.example.com/"), ("blocks",)).alias("page"))
    return html.block_events(rows, ["p_partkey"], rules=EVENTS).drop("position")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN '2024-01-05' ELSE '' END AS start_date, CASE WHEN p_partkey % 2 = 0 THEN '2024-02-06' ELSE '' END AS end_date, CASE WHEN p_partkey % 3 = 0 THEN 'Hall of ' || p_name ELSE '' END AS location FROM part""")
def detail_fields(spark, sf):
    """Dates and place in the visible text of a page; scripts say nothing."""
    page = F.expr("""'<script>2020.1.1 장소: none at all</script><div>' || CASE WHEN p_partkey % 2 = 0 THEN '2024.1.5</div> <p>~ </p>' || '<p>until</p><p>2024.1.5 ~ 2.6</p>' ELSE 'no date</div>' END || CASE WHEN p_partkey % 3 = 0 THEN '<p>장소: Hall of ' || p_name || '</p>' ELSE '' END""")
    rows = spread(table(spark, sf, "part")).select("p_partkey", html.parsed(page, F.lit("https://p.example.com/"), ("lines",)).alias("page"))
    return rows.select("p_partkey", *[c.alias(n) for n, c in html.detail_fields(F.col("page.lines")).items()])


@query("SELECT p_brand, count(*) AS n_rows, count(DISTINCT p_size) AS n_sizes, min(p_partkey) AS first FROM part GROUP BY 1")
def merged_sources(spark, sf):
    """Candidates that share a key: every source once, in the order of their first positions."""
    part = table(spark, sf, "part")
    rows = part.select("p_brand", F.col("p_partkey").alias("position"), F.col("p_name").alias("url"), F.concat(F.lit("s"), "p_size").alias("source"), F.lit("").alias("anchor_text"), F.lit("").alias("source_context"))
    merged = dedup.merge_candidates(rows, ["p_brand"])
    return merged.join(part.groupBy("p_brand").agg(F.count("*").alias("n_rows")), "p_brand").select("p_brand", "n_rows", F.size(F.split("source", r"\|")).cast("long").alias("n_sizes"), F.col("position").alias("first"))
