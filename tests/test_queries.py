"""Every query with SQL against DuckDB on the smallest tables: same columns, types and rows."""

import hashlib
import html
import re

import duckdb
import pytest

import __spark_entry__ as entry
from sightline import queries, source_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    assert [str(a[c].dtype) for c in columns] == [str(b[c].dtype) for c in columns]
    x, y = (sorted(map(tuple, d[columns].astype(str).values.tolist())) for d in (a, b))
    assert x == y


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf, duck, name):
    same(queries.QUERIES[name](spark, sf).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df())


def test_sql_gives_rows(duck):
    # two empty results are equal
    assert not [name for name, sql in queries.ORACLE_SQL.items() if not len(duck.sql(sql).df())]


def test_strip_tags_of_all_pages(spark, sf, duck):
    pages = duck.sql("SELECT page_id, html FROM pages").fetchall()
    want = {i: hashlib.md5(html.unescape(re.sub("<[^>]+>", "", t or "")).strip().encode()).hexdigest() for i, t in pages}
    got = {r.page_id: r.bare for r in queries.QUERIES["text_strip_tags"](spark, sf).collect()}
    assert got == want and len(got) == len(pages) > 0


def test_rows_only(spark, sf):
    for name in sorted(set(queries.QUERIES) - set(queries.ORACLE_SQL)):
        assert queries.QUERIES[name](spark, sf).count() > 0, name


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_discovery(spark, sf):
    rows = source_queries.discover_pipeline(spark, sf).toPandas()
    assert rows.venue_index.nunique() == 50
    none = rows[rows.homepage_status == "no_homepage_url"]
    assert set(none.candidate_type) == {"not_found"} and set(none["error"]) == {"No verified/input/api URL available."}
    assert rows.confidence.between(0, 100).all() and rows["rank"].between(1, 3).all()
    assert (rows.groupby("venue_index")["rank"].apply(lambda r: sorted(r) == list(range(1, len(r) + 1)))).all()
