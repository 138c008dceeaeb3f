"""Scoring, dedup, ranking, HTML, sources, sinks and streams on small inputs."""

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sightline.functions import vocabulary as V
from sightline.operators import dedup, html, ranking, records, scoring
from sightline.plans import classify, extract
from sightline.sources import files, search
from sightline.streaming import incremental


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_classify_venue(spark):
    places = frame(
        spark, "title string, category string, summary string, source_query string, road_address string, full_address string",
        ("x", "문화,예술>미술관", "", "", "", ""), ("새 갤러리", "문화,예술>전시관", "사진", "", "", ""), ("집", "집", None, None, None, None), ("미술관 주차장", "", "", "", "", ""), ("갤러리art", "", "", "", "", ""), ("the ART", "", "", "", "", ""),
    )
    got = [tuple(r) for r in classify.classified(places).select("is_art_venue", "art_confidence", "venue_type", "needs_manual_review").collect()]
    # Unicode word boundaries: no art in 갤러리art beyond the gallery itself
    assert got == [("yes", 95, "art_museum", "no"), ("yes", 99, "gallery", "no"), ("no", 0, "unknown", "no"), ("no", 0, "art_museum", "no"), ("no", 28, "gallery", "no"), ("no", 28, "unknown", "no")]


def test_confidence_caps(spark):
    rows = frame(spark, "i int, p int, u string, s string, f string", (90, -18, "https://x/", "a", "error"), (90, 0, "https://x/", "common_path", ""), (90, 0, "https://x/", "inferred_list_path", ""), (90, 0, "https://x/", "a", ""), (90, 20, "https://x/view", "a", "ok"), (90, 20, "https://x/", "a", "ok"), (5, -30, "https://x/", "a", "ok"))
    from sightline.functions.urls import is_detail

    got = rows.select(scoring.confidence(F.col("i"), F.col("p"), is_detail("u"), F.col("s"), F.col("f")).alias("c")).collect()
    assert [r.c for r in got] == [45, 48, 65, 80, 72, 100, 0]


def test_overlapping_paths_add(spark):
    rows = frame(spark, "url string, source string, anchor_text string, source_context string", ("https://x/exhibitions", "common_path", "", ""))
    r = scoring.scored_candidates(rows, with_pages=False).first()
    # keyword 55, three path patterns 55 + 55 + 50, source 2, list-like 10
    assert r.initial_score == 227 and r.confidence == 48 and r.candidate_type == "exhibition_list"
    assert r.evidence[:2] == ["primary_exhibition_keyword", "url_path=exhibition"]


def test_merge_candidates(spark):
    rows = frame(spark, "k string, position long, url string, source string, anchor_text string, source_context string", ("k", 2, "b", "sitemap", "shows", ""), ("k", 1, "a", "homepage_link", "show", "nav"), ("k", 3, "c", "sitemap", "new", "na"), ("k", 4, "d", "homepage_link", "sho", None))
    r = dedup.merge_candidates(rows, ["k"]).first()
    assert (r.url, r.source, r.anchor_text, r.source_context) == ("a", "homepage_link|sitemap", "show | shows | new", "nav")


def test_top_n_with_fallback(spark):
    rows = frame(spark, "k int, s int, position int", (1, 80, 1), (1, 29, 2), (1, 55, 3), (2, 20, 1), (2, 10, 2), (3, 40, 2), (3, 40, 1))
    got = ranking.top_n_with_fallback(rows, "k", "s", "position", 5).select("k", "s", "position", "rank").collect()
    assert sorted(map(tuple, got)) == [(1, 55, 3, 2), (1, 80, 1, 1), (2, 10, 2, 2), (2, 20, 1, 1), (3, 40, 1, 1), (3, 40, 2, 2)]


def test_failures_and_first_hit(spark):
    f = frame(spark, "k int, stage string, error_type string, error_message string, position int", (1, "b", "X", "m", 1), (1, "a", "", " n  o ", 2), (1, "b", None, "m", 3))
    assert tuple(dedup.summarize_failures(f, "k").first()) == (1, "a,b", "X", "m | n o")
    hits = frame(spark, "venue_index int, pos int, link string, score int, reason string, url_type string, query string", (1, 0, "a", 30, "r", "blog", "q"), (1, 1, "b", 30, "s", "blog", "q"), (2, None, "", 0, "", "", "q"), (3, 0, "", 90, "", "", "q"), (4, 0, "x", 5, "", "", "q"))
    got = {r.venue_index: (r.api_found_url, r.api_search_status) for r in scoring.best_search_hit(hits).collect()}
    assert got == {1: ("a", "found"), 2: ("", "no_results"), 3: ("", "no_confident_match"), 4: ("", "no_confident_match")}


PAGE = """<html><head><title>T &amp; U</title><meta name="Description" content=" d "><script type="application/ld+json">[{"@type":"event","name":null,"startDate":"2024-01-02T10","endDate":"1/9","location":"L","sub":{"@type":"Event","name":"In","url":"x"}},{"@type":["Event"]}]</script>
<script type="application/ld+json">{bad</script></head><body><header id=top><a href="/a">One</a></header><div class="gnb big"><a href="b?x=1">Two <b>2</b></a></div>
<ul><li>Grand tion 2024.3.1 ~ 3.9 <a href="/view?id=1">Grand tion</a></li><li>x &amp;lt; y<br>z<br/>w</li></ul><noscript>no</noscript><img src=""><img data-src="p.png?x" alt="poster one"></body>"""


def test_html(spark):
    page = html.read_page(PAGE, "https://h.com/dir/", tuple(html.VIEWS))
    assert (page["title"], page["meta"], page["headings"]) == ("T & U", "d", "")
    assert [(x["text"], x["url"]) for x in page["links"]] == [("One", "https://h.com/a"), ("Two 2", "https://h.com/dir/b?x=1"), ("Grand tion", "https://h.com/view?id=1")]
    assert page["links"][0]["context"].endswith("header|a") and page["links"][1]["context"].split("|")[-2] == "nav_like"
    assert "x &lt; yz" in page["lines"] and "w" in page["lines"] and "no" not in page["lines"]
    assert [e["exhibition_name"] for e in page["events"]] == ["", "In"] and page["events"][1]["detail_url"] == "https://h.com/dir/x"
    assert "x < y\nz\n\nw" in [b["text"].strip() for b in page["blocks"]]
    assert page["images"] == [{"url": "https://h.com/dir/p.png?x", "alt": "poster one", "title": ""}]
    assert html.read_page("", "", tuple(html.VIEWS))["links"] == [] and html.read_page("<a href='//[x'>y</a", "http://[", ("links",))["links"] == []


RULES = V.EventRules(strong=("tion",), word="tion", hints=("grand",), excluded=("no",), generic=("tion",), link_generic=("more",))


def test_extract(spark):
    url = "https://h.com/dir/"
    detail = "<div>Location: Big Hall, 5 Street</div>"
    snapshots = frame(spark, "url string, final_url string, status string, http_status string, content_type string, text string, error string", (url, url, "ok", "200", "text/html", PAGE, ""), ("https://h.com/view?id=1", "", "ok", "200", "text/html", detail, ""), ("https://h.com/e", "", "error", "", "", "", "timed out"))
    pages = frame(spark, "list_url string, who string", (url, "a"), ("https://h.com/e", "b"), ("https://h.com/missing", "c"))
    out = extract.extract(pages, snapshots, F.lit("2024-03-05").cast("date"), extract.Options(rules=RULES), carry=("who",))
    got = {(r.who, r.status, r.exhibition_name, r.start_date, r.end_date, r.location, r.failure_type) for r in out.collect()}
    assert got == {("a", "ok", "Grand tion", "2024-03-01", "2024-03-09", "Big Hall, 5 Street", ""), ("b", "failed", "", "", "", "", "error"), ("c", "failed", "", "", "", "", "NotFetched")}
    late = extract.extract(pages.limit(1), snapshots, F.lit("2025-01-01").cast("date"), extract.Options(rules=RULES))
    assert [(r.status, r.failure_message) for r in late.collect()] == [("filtered", "Filtered out by end_date < today")]


def test_release_is_idempotent(spark):
    e = frame(spark, "position int, exhibition_name string, start_date string, end_date string, location string, detail_url string, source_list_url string", (1, "A b", "2024-01-01", "", "x", "u", "l"), (2, "a  B", "2024-01-01", "2024-01-01", "y", "u", "l"), (3, "", "2024-01-01", "", "", "", ""), (4, "c", "", "", "", "", ""))
    out = records.release(e, fill_end=True).drop("position")
    assert [(r.exhibition_name, r.exhibition_end_date, r.exhibition_location) for r in out.collect()] == [("A b", "2024-01-01", "x")]


def test_csv(spark, tmp_path):
    for name, encoding in (("a", "utf-8-sig"), ("b", "cp949")):
        (tmp_path / f"{name}.csv").write_bytes('title,url\n"한, ""글""\n둘",u\nx,\n'.encode(encoding))
    got = files.read_csv_any(spark, str(tmp_path / "*.csv"))
    assert got.columns == ["title", "url", "source_row"]
    assert rows_of(got) == sorted(repr(r) for r in ((1, '한, "글"\n둘', "u"), (2, "x", ""), (3, '한, "글"\n둘', "u"), (4, "x", "")))
    assert rows_of(files.read_csv(spark, str(tmp_path / "a.csv"))) == sorted([repr(('한, "글"\n둘', "u")), repr(("x", ""))])
    files.write_csv(got, str(tmp_path / "out"), ["url", "title"])
    assert rows_of(files.read_csv(spark, str(tmp_path / "out"))) == rows_of(got.select("url", "title"))
    assert files.export_csv(got, str(tmp_path / "one.csv"), ["title"]) == 4 and (tmp_path / "one.csv").read_bytes().startswith(b"\xef\xbb\xbftitle")
    files.append(got, str(tmp_path / "p"), ["title"])
    files.append(got, str(tmp_path / "p"), ["title"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 8


def test_bullets_and_progress(spark, tmp_path):
    (tmp_path / "r.md").write_text("# h\n- b \n* a\n-b\n - b\n")
    assert [tuple(r) for r in files.read_bullets(spark, str(tmp_path / "r.md")).orderBy("position").collect()] == [(1, "b"), (2, "a")]
    (tmp_path / "n.md").write_text("x")
    with pytest.raises(ValueError, match="no region"):
        files.read_bullets(spark, str(tmp_path / "n.md"), "region")
    at = str(tmp_path / "progress")
    assert files.read_progress(spark, at) == {}
    files.write_progress(spark, at, 7, 10, 3)
    assert files.read_progress(spark, at)["next_start_index"] == 8
    assert incremental.resume_range(10, 1, 0, 8) == (8, 10) and incremental.resume_range(10, 3, 99, 8) == (3, 10) and incremental.resume_range(10, 1, 4, 8, auto=False) == (1, 4)
    (tmp_path / ".env").write_text("# c\nA='1'\nB=2\nbad\n")
    assert files.dotenv(str(tmp_path / ".env"), {"B": "x"}) == {"A": "1", "B": "x"}
    assert files.credential("", "c", {"k": "e"}, "k") == "c" and files.credential("", "", {"k": "e"}, "k") == "e"


def test_search_source(spark):
    def fetch(query, display, sort):
        if query == "bad":
            raise RuntimeError("down")
        return [{"title": f"{query}{i}", "link": sort} for i in range(display)] if query != "none" else []

    spark.dataSource.register(search.search_source(fetch, ["q", "none", "bad"], 1))
    got = spark.read.format("search").option("display", "2").option("sort", "Sim").load()
    assert sorted((r.query, r.pos, r.title, r.status[:5]) for r in got.collect() if r.pos is not None) == [("q", 0, "q0", "ok"), ("q", 1, "q1", "ok")]
    assert sorted((r.query, r.status, r.message) for r in got.collect() if r.pos is None) == [("bad", "error", "RuntimeError: down"), ("none", "ok", "")]
    for display, sort in ((0, "random"), (6, "random"), (1, "x")):
        with pytest.raises(ValueError):
            search.check_options(display, sort)
    assert search.check_options(10, "SIM", web=True) == (10, "sim")


def test_resumed_stream_equals_batch(spark, tmp_path):
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    for i in range(2):
        rows.filter(F.col("id").between(i * 50, i * 50 + 49)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.stream_first_rows(incremental.stream_files(spark, str(tmp_path / "in"), rows.schema), ["k"], str(tmp_path / "out"), str(tmp_path / "state"), "id").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(7))


def test_json_is_walked_depth_first():
    tree = json.dumps({"@type": "Event", "name": "a", "x": [{"@type": "EVENT", "name": "b"}], "y": {"z": {"@type": "event", "name": "c"}}})
    assert [e["exhibition_name"] for e in html.linked_events([tree, "{"], "u")] == ["a", "b", "c"]
    assert html.place_of({"name": "n", "address": {"streetAddress": "s", "addressCountry": None}}) == "n s" and html.place_of(["x"]) == ""
