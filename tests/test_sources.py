"""Fetched pages, the command line, and shipping of the package."""

import subprocess
import sys
import time
from pathlib import Path

from sightline.__main__ import options, run
from sightline.sources import files, pages, search


def test_fetch_pages(spark):
    class Gone(Exception):
        code, reason, url = 404, "Not Found", "https://x/gone"

    def get(url, seconds):
        if url.endswith("gone"):
            raise Gone
        if url.endswith("down"):
            raise OSError("no route")
        return url + "/", 200, "text/html; charset=euc-kr" if "kr" in url else "text/html; charset=what", ("가" * 9).encode("euc-kr") if "kr" in url else b"abc \xff" + url.encode()

    urls = spark.createDataFrame([("https://x/kr",), ("https://x/a b",), ("https://x/gone",), ("https://x/down",), ("",), ("https://x/kr",)], "url string")
    got = {r.url: (r.status, r.http_status, r.text[:9], r.error) for r in pages.fetch_pages(urls, get, 2, most_bytes=10).collect()}
    assert got == {"https://x/kr": ("ok", "200", "가" * 5, ""), "https://x/a b": ("ok", "200", "abc �http", ""), "https://x/gone": ("http_error", "404", "", "Not Found"), "https://x/down": ("error", "", "", "OSError: no route")}
    late = pages.fetch_pages(urls, get, 1, budget=-1.0, pause=0.6).collect()
    assert len(late) == 4 and any(r.error.startswith("TimeoutError") for r in late)


def test_fetch_pages_waits_for_all_at_once(spark):
    """A second try is made after a pause, and other URLs are fetched meanwhile."""
    made: dict[str, list[float]] = {}

    def get(url, seconds):
        made.setdefault(url, []).append(time.monotonic())
        if url.endswith("/7") and len(made[url]) == 2:
            return url, 200, "", b"at last"
        raise OSError(" ".join(f"{t:.3f}" for t in made[url]))

    rows = pages.fetch_pages(spark.range(40).selectExpr("concat('https://x/', id) as url"), get, 1).collect()
    assert len(rows) == 40 and [(r.url, r.text) for r in rows if r.status == "ok"] == [("https://x/7", "at last")]
    tries = [[float(t) for t in r.error.removeprefix("OSError: ").split()] for r in rows if r.status == "error"]
    assert len(tries) == 39 and all(len(t) == 2 and t[1] - t[0] >= 0.24 for t in tries)
    assert max(t[1] for t in tries) - min(t[0] for t in tries) < 5


def test_place_search(spark):
    spark.dataSource.register(search.search_source(lambda q, n, s: [{"title": q, "address": "A B구 C", "mapx": 1}], ["q"], name="places", fields=search.PLACE_FIELDS))
    r = spark.read.format("places").load().first()
    assert (r.query, r.pos, r.title, r.address, r.mapx, r.category, r.status) == ("q", 0, "q", "A B구 C", "1", "", "ok")


def csv_rows(spark, path):
    return [r.asDict() for r in files.read_csv(spark, str(path)).collect()]


def test_command_line(spark, tmp_path):
    (tmp_path / "places.csv").write_text("title,category,summary,source_query,road_address,full_address,official_url,link\n새 갤러리,,,,,,ex.com,\n집,집,,,,,,\n", encoding="utf-8-sig")
    run(spark, options(["classify", "--input", f"{tmp_path}/places.csv", "--output", f"{tmp_path}/classified"]))
    got = csv_rows(spark, tmp_path / "classified")
    assert [(r["title"], r["is_art_venue"], r["url_status"]) for r in got] == [("새 갤러리", "no", "skipped"), ("집", "no", "skipped")]
    run(spark, options(["classify", "--check-all", "--input", f"{tmp_path}/places.csv", "--output", f"{tmp_path}/classified"]))
    assert [(r["verified_url"], r["url_status"]) for r in csv_rows(spark, tmp_path / "classified")] == [("https://ex.com", "not_checked"), ("", "blank")]
    (tmp_path / "c.csv").write_text("venue_index,rank,is_art_venue\n10,1,yes\n2,2,no\n2,1, maybe \nx,1,yes\n")
    run(spark, options(["sort", "--input", f"{tmp_path}/c.csv", "--output", f"{tmp_path}/sorted"]))
    assert [(r["venue_index"], r["rank"]) for r in csv_rows(spark, tmp_path / "sorted")] == [("x", "1"), ("2", "1"), ("2", "2"), ("10", "1")]
    run(spark, options(["filter", "--input", f"{tmp_path}/c.csv", "--output", f"{tmp_path}/kept"]))
    assert [r["venue_index"] for r in csv_rows(spark, tmp_path / "kept")] == ["10", "2", "x"]
    (tmp_path / "pages.csv").write_text("list_url,who\nhttps://h.com/l,a\n,b\nhttps://h.com/m,c\n")
    page = '<script type="application/ld+json">{"@type":"Event","name":"E","startDate":"2024-05-01","location":"L"}</script>'
    rows = [(u, u, "ok", "200", "text/html", page, "") for u in ("https://h.com/l", "https://h.com/m")]
    spark.createDataFrame(rows, "url string, final_url string, status string, http_status string, content_type string, text string, error string").write.parquet(f"{tmp_path}/snap")
    base = ["extract", "--input", f"{tmp_path}/pages.csv", "--output", f"{tmp_path}/events", "--snapshots", f"{tmp_path}/snap", "--today", "2024-01-01", "--pass-through-columns", "who", "--progress", f"{tmp_path}/progress"]
    run(spark, options([*base, "--end-index", "1"]))
    run(spark, options(base))
    assert sorted((r["who"], r["exhibition_name"], r["status"]) for r in csv_rows(spark, tmp_path / "events")) == [("a", "E", "ok"), ("c", "E", "ok")]
    run(spark, options(["release", "--input", f"{tmp_path}/events/*.csv", "--output", f"{tmp_path}/released", "--fill-missing-end-date"]))
    assert {r["exhibition_end_date"] for r in csv_rows(spark, tmp_path / "released")} == {"2024-05-01"}


def test_package_reaches_workers(tmp_path):
    """From another folder, without the package on the workers' path."""
    code = "import sys; sys.path.insert(0, sys.argv[1])\nfrom sightline.session import session\nfrom sightline.functions.text import unescape\nfrom pyspark.sql import functions as F\ns = session(1)\nprint('GOT', s.range(1).select(unescape(F.lit('&lt;'))).first()[0])"
    root = str(Path(__file__).resolve().parent.parent)
    out = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert "GOT <" in out.stdout, out.stderr[-800:]


def test_command_line_slices_and_files(spark, tmp_path):
    (tmp_path / "pages.csv").write_text("list_url\n" + "".join(f"https://h.com/{i}\n" for i in range(5)) + "https://www.instagram.com/x\n")
    page = '<script type="application/ld+json">{"@type":"Event","name":"E","startDate":"2024-05-01","endDate":"2024-05-02","location":"L"}</script>'
    rows = [(f"https://h.com/{i}", "", "ok" if i != 3 else "error", page, "") for i in range(5)]
    spark.createDataFrame(rows, "url string, final_url string, status string, text string, error string").write.parquet(f"{tmp_path}/snap")
    spark.createDataFrame([("https://www.instagram.com/x", 0, "https://www.instagram.com/p/1", "개인전\n2024.6.1", "")], "list_url string, position long, post_url string, caption string, ocr_text string").write.parquet(f"{tmp_path}/posts")
    base = ["extract", "--data-dir", str(tmp_path), "--input", "pages.csv", "--output", "events.csv", "--snapshots", "snap", "--posts", "posts", "--today", "2024-01-01", "--progress", "progress", "--failed-output", "failed.csv", "--single"]
    run(spark, options([*base, "--save-every", "2", "--end-index", "4"]))
    run(spark, options(base))
    got = csv_rows(spark, tmp_path / "events.csv")
    assert sorted((r["source_list_url"][-3:], r["exhibition_name"], r["status"]) for r in got) == sorted([*((f"m/{i}", "E", "ok") for i in (0, 1, 2, 4)), ("m/3", "", "failed"), ("m/x", "개인전", "ok")])
    assert [(r["list_url"], r["stage"]) for r in csv_rows(spark, tmp_path / "failed.csv")] == [("https://h.com/3", "fetch")]
    done = files.read_progress(spark, f"{tmp_path}/progress")
    assert (done["last_processed_index"], done["saved_rows"], done["saved_failures"]) == (6, 6, 1)
    (tmp_path / "social.csv").write_text("list_url\nhttps://www.instagram.com/x\n")
    run(spark, options(["social", "--input", f"{tmp_path}/social.csv", "--output", f"{tmp_path}/social", "--posts", f"{tmp_path}/posts", "--today", "2024-01-01"]))
    assert [(r["exhibition_name"], r["start_date"]) for r in csv_rows(spark, tmp_path / "social")] == [("개인전", "2024-06-01")]
    (tmp_path / "regions.md").write_text("- A\n- B\n")
    (tmp_path / "words.md").write_text("- x\n- y\n")
    hits = [(f"{r} {w}", 0, f"{r}{w}", *[""] * 8) for r in "AB" for w in "xy"]
    spark.createDataFrame(hits, "query string, pos int, title string, link string, category string, description string, telephone string, address string, roadAddress string, mapx string, mapy string").write.parquet(f"{tmp_path}/hits")
    collect = ["collect", "--input", f"{tmp_path}/regions.md", "--keywords", f"{tmp_path}/words.md", "--results", f"{tmp_path}/hits", "--output", f"{tmp_path}/places.csv", "--progress", f"{tmp_path}/collected", "--single"]
    run(spark, options([*collect, "--end-index", "3"]))
    run(spark, options([*collect, "--before", f"{tmp_path}/places.csv"]))
    assert [r["title"] for r in csv_rows(spark, tmp_path / "places.csv")] == ["Ax", "Ay", "Bx", "By"]
    assert files.read_progress(spark, f"{tmp_path}/collected")["next_start_index"] == 5


def test_command_line_search_and_discovery(spark, tmp_path, capsys):
    (tmp_path / "places.csv").write_text("title,category,summary,source_query,road_address,full_address,region_sub,official_url,link\n새 미술관,\"문화,예술>미술관\",,,길 1,,구,,\nx,,,,,,,,\n")
    found = [("새 미술관 길 1 공식", 0, "새 미술관", "https://own.example.com", "전시", "ok", ""), ("x 공식", None, "", "", "", "http_error_500", "down")]
    spark.createDataFrame(found, "query string, pos int, title string, link string, description string, status string, message string").write.parquet(f"{tmp_path}/hits")
    run(spark, options(["classify", "--check-all", "--input", f"{tmp_path}/places.csv", "--output", f"{tmp_path}/classified", "--results", f"{tmp_path}/hits"]))
    got = csv_rows(spark, tmp_path / "classified")
    assert [(r["api_search_status"], r["verified_url"], r["api_search_reason"]) for r in got] == [("found", "https://own.example.com", "title_match|art_keyword|official_like"), ("http_error_500", "", "down")]
    page = [("https://own.example.com", "https://own.example.com", "ok", "200", "text/html", '<nav><a href="/exhibition">전시</a></nav>', "")]
    spark.createDataFrame(page, "url string, final_url string, status string, http_status string, content_type string, text string, error string").write.parquet(f"{tmp_path}/snap")
    run(spark, options(["discover", "--input", f"{tmp_path}/classified/*.csv", "--output", f"{tmp_path}/found", "--snapshots", f"{tmp_path}/snap", "--limit", "1", "--top-n", "2", "--no-sitemap"]))
    rows = csv_rows(spark, tmp_path / "found")
    assert [r["rank"] for r in rows] == ["1", "2"] and {r["homepage_url"] for r in rows} == {"https://own.example.com"} and all(r["candidate_url"].endswith("exhibition") for r in rows)
    assert "n_api_found': 1" in capsys.readouterr().out


def test_images_and_profiles():
    import numpy as np

    from sightline.sources import images, social

    raw = images.encoded(np.arange(24, dtype=np.uint8).reshape(4, 6) * 10)
    assert images.decoded(raw).tolist() == (np.arange(24).reshape(4, 6) * 10).tolist() and images.decoded(images.encoded(np.zeros((2, 3, 3)))).shape == (2, 3, 3)
    found = images.variants(images.decoded(raw))
    assert [v.shape for v in found] == [(4, 6)] + [(8, 12)] * 4 and all(set(np.unique(v)) <= {0, 255} for v in found[2:])
    assert np.allclose(images.lanczos(9, 2).sum(1), 1) and images.lanczos(1, 2).shape == (2, 1)
    assert images.grey(np.full((2, 2, 3), 7, np.uint8)).tolist() == [[7, 7], [7, 7]]
    assert images.tesseract_command({"TESSERACT_CMD": __file__}) == __file__
    assert images.readings("bad\nurl", None, None, None, 1)[0][3] == "ValueError: no URL"
    hrefs = ["/p/1/", "/p/1/", "/reel/2/", "https://x/p/3", "/p/4/"]
    assert social.post_urls("https://www.instagram.com/a", hrefs, 8) == ["https://www.instagram.com/p/1/", "https://www.instagram.com/p/4/"]
    assert social.post_urls("https://www.instagram.com/reel/9/", hrefs) == ["https://www.instagram.com/reel/9/"]
