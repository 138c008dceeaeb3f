"""Unit cases, input to expected, of the scalars."""

import pytest
from pyspark.sql import functions as F

from sightline.functions import dates as D
from sightline.functions import text as T
from sightline.functions import urls as U


def values(spark, inputs, *columns):
    """One tuple of results for each input."""
    rows = [(i, *(x if isinstance(x, tuple) else (x,))) for i, x in enumerate(inputs)]
    width = max(len(r) for r in rows) - 1
    df = spark.createDataFrame(rows, ", ".join(["i int", *(f"x{k} string" for k in range(width))]))
    out = df.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in out]


def test_dates(spark):
    cases = {"2024.2.9": "2024-02-09", "2024-02-30": "", "24/1/2": "0024-01-02", "x": "", "2024": "", None: ""}
    assert values(spark, list(cases), D.normalize_date("x0")) == list(cases.values())
    assert values(spark, ["3/5", "13/5", "2024.1.1"], D.normalize_date("x0", F.lit(2024))) == ["2024-03-05", "", "2024-01-01"]


def test_date_ranges(spark):
    cases = {
        "2024.1.5 ~ 3.2": ("2024-01-05", "2024-03-02"), "2024.12.20 ~ 1.15": ("2024-12-20", "2024-01-15"), "2024.2.30 ~ 2024.3.1": ("", "2024-03-01"), "opens 2024/7/1": ("2024-07-01", ""), "none": ("", ""),
        "2024-01-01 to 2024-02-01": ("2024-01-01", "2024-02-01"), None: ("", ""),
    }
    assert values(spark, list(cases), *D.date_range("x0")) == list(cases.values())


def test_current(spark):
    today = F.lit("2024-03-02").cast("date")
    cases = {("", "2024-03-02"): True, ("2024-03-05", ""): True, ("", ""): False, ("2024-03-01", "bad"): False, (None, "20240303"): True}
    assert values(spark, list(cases), D.is_current("x0", "x1", today)) == list(cases.values())


def test_addresses(spark):
    cases = {"서울특별시 종로구 삼청동 1": ("서울특별시", "종로구", "삼청동"), "제주 애월읍 1": ("제주", "", "애월읍"), "": ("", "", ""), None: ("", "", "")}
    assert values(spark, list(cases), *D.address_parts("x0")) == list(cases.values())
    assert values(spark, ["장소: 시립 미술관 | 02", "at 12 Long Road x", "no"], D.location("x0")) == ["시립 미술관", "12 Long Road x", ""]


def test_text(spark):
    assert values(spark, ["Art-Now 2024 a art", None], T.tokens("x0")) == [["art", "now", "2024"], []]
    assert values(spark, ["a | b•c\n \n", ""], T.split_lines("x0")) == [["a", "b", "c"], []]
    assert values(spark, [" a 　\x1c b\n", None], T.squeeze("x0")) == ["a b", ""]
    assert values(spark, ["<b>x</b> &amp; <>y ", None], T.strip_tags("x0")) == ["x & <>y", ""]
    assert values(spark, ["<b>x</b>y<> &lt;z", None], T.strip_tags_spaced("x0")) == ["x y <z", ""]
    assert values(spark, ["12", " 7 ", "x", "", None], T.safe_int("x0")) == [12, 7, 0, 0, 0]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (U.normalize_url, {"//ex.com/a": "https://ex.com/a", " ex.com ": "https://ex.com", "HTTP://x": "HTTP://x", "": "", "http://x/?a=1&amp;b": "http://x/?a=1&b"}),
        (U.clean_url, {"HTTPS://ex.com/a?b#c": "https://ex.com/a?b", "mailto:x": "https://mailto:x", "https://": "", "": "", "ex.com/x?": "https://ex.com/x"}),
        (U.host_key, {"https://WWW.Ex.com:80/a": "ex.com:80", "x": ""}),
        (lambda c: U.candidate_key(U.clean_url(c)), {"http://www.Ex.com/A/?q=1#f": "ex.com/a?q=1", "https://ex.com": "ex.com/?", "https://ex.com//": "ex.com/?", "ex.com?x=/": "ex.com/?x=/"}),
        (U.url_type, {"https://www.instagram.com/x": "social", "https://bit.ly/x": "shortlink", "https://ex.com": "official_or_unknown", "": "", "my.blog.naver.com": "blog"}),
        (U.is_detail, {"https://ex.com/a?idx=3": True, "https://ex.com/view.do": True, "https://ex.com/list": False, "https://ex.com/%76iew": True, "https://ex.com/%2Fviewer": True}),
        (U.comparable, {"http://www.ex.com/A/": "ex.com/A", "ex.com": "ex.com"}),
        (U.canonical, {"Ex.com/a;p?q#f": "https://ex.com/a", "": "", "https://": ""}),
        (U.decoded, {"https://x/%EA%B0%80+%zz": "https://x/가+%zz"}),
    ],
)
def test_urls(spark, function, cases):
    assert values(spark, list(cases), function(F.col("x0"))) == list(cases.values())


def test_infer_list_urls(spark):
    got = values(spark, ["https://ex.com/show/view?id=3", "https://ex.com/a?no=1&b=x%20y", ""], U.infer_list_urls("x0"))
    assert [(r["url"], r["reason"]) for r in got[0]] == [("https://ex.com/show", "removed_detail_path"), ("https://ex.com/show/list", "detail_to_list"), ("https://ex.com/show/index", "detail_to_index"), ("https://ex.com/show/view", "removed_detail_query")]
    assert [(r["url"], r["reason"]) for r in got[1]] == [("https://ex.com/a?b=x+y", "removed_detail_params")]
    assert got[2] == []


def test_best_url(spark):
    cases = {("https://instagram.com/x", "https://ex.com"): ("https://ex.com", "naver_api_preferred"), ("", ""): ("", ""), ("", "a"): ("a", "naver_api"), ("a", ""): ("a", "existing"), ("www.a.com/", "http://a.com"): ("www.a.com/", "existing_api_same"), ("https://bit.ly/a", "https://blog.naver.com/b"): ("https://blog.naver.com/b", "naver_api_preferred")}
    assert [tuple(r) for r in values(spark, list(cases), U.best_url("x0", "x1"))] == list(cases.values())
