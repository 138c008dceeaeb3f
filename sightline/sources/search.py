"""Search results as a table: a Python DataSource over a pluggable client, or a snapshot of results.

    spark.dataSource.register(search_source(fetch))
    spark.read.format("search").option("queries", path_of_parquet).option("display", "5").load()

``fetch(query, display, sort)`` returns dicts with the fields asked for: title, link and
description of a web search, or ``PLACE_FIELDS`` of a place search.  It runs on the
executors, one partition for a range of queries.  A query that fails gives a row that says so: status
missing_credentials (there is no ``fetch``), http_error_N (the error has a code) or error; one that
finds nothing has status ok and no position.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as T

WEB_FIELDS = ("title", "link", "description")
PLACE_FIELDS = ("title", "link", "category", "description", "telephone", "address", "roadAddress", "mapx", "mapy")
#: The orders and the most results of a place search and of a web search (fixed values).
PLACE_SORTS, MOST_PLACES = ("random", "comment"), 5
WEB_SORTS, MOST_HITS = ("sim", "date"), 10


def check_options(display: int, sort: str, web: bool = False) -> tuple[int, str]:
    """The number of results and the order of a search, or a ValueError."""
    sort, sorts, most = sort.lower(), WEB_SORTS if web else PLACE_SORTS, MOST_HITS if web else MOST_PLACES
    if not 1 <= display <= most:
        raise ValueError(f"display must be 1 to {most}")
    if sort not in sorts:
        raise ValueError(f"sort must be one of {', '.join(sorts)}")
    return display, sort


def retried(call: Callable, tries: int = 2, pause: float = 0.25):
    """call(), again after a growing pause; the last error is raised."""
    for n in range(1, tries + 1):
        try:
            return call()
        except Exception:  # noqa: BLE001
            if n == tries:
                raise
            time.sleep(pause * n)


class Range(InputPartition):
    def __init__(self, queries: list[str]):
        self.queries = queries


def outcome(call: Callable) -> tuple[list[dict], str, str]:
    """(items, status, message) of a search."""
    try:
        return retried(call), "ok", ""
    except Exception as e:  # noqa: BLE001  a failed query is a record, not a failed job
        if getattr(e, "code", None):
            return [], f"http_error_{e.code}", str(getattr(e, "reason", e))[:240]
        return [], "error", f"{type(e).__name__}: {e}"[:240]


def search_source(fetch: Callable[[str, int, str], list[dict]] | None, queries: list[str], per_partition: int = 64, name: str = "search", fields: tuple = WEB_FIELDS, pause: float = 0.0):
    """A DataSource class over ``fetch`` for the given queries; ``pause`` seconds between two of a partition.
    Place fields make it a place search (display up to 5, random or comment), others a web search (up
    to 10, sim or date)."""
    web = fields == WEB_FIELDS

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.display, self.sort = check_options(int(options.get("display", MOST_PLACES)), options.get("sort", "sim" if web else "random"), web)

        def partitions(self):
            return [Range(queries[i : i + per_partition]) for i in range(0, len(queries), per_partition)] or [Range([])]

        def read(self, partition):
            for k, query in enumerate(partition.queries):
                if k and pause:
                    time.sleep(pause)
                items, status, message = outcome(lambda q=query: fetch(q, self.display, self.sort)) if fetch else ([], "missing_credentials", "No search credentials are set.")
                for i, item in enumerate(items):
                    yield query, i, *[str(item.get(f) or "") for f in fields], status, message
                if not items:
                    yield query, None, *[""] * len(fields), status, message

    class Search(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return f"query string, pos int, {', '.join(f'{f} string' for f in fields)}, status string, message string"

        def reader(self, schema):
            return Reader(self.options)

    return Search


def official_site_query(title: Column, address: Column, suffix: str = "공식") -> Column:
    return T.squeeze(F.concat_ws(" ", T.col(title), T.col(address), F.lit(suffix)))


def site_query(host: Column, title: Column, terms: str = "전시 예정전시 현재전시") -> Column:
    return T.squeeze(F.concat_ws(" ", F.concat(F.lit("site:"), host), T.col(title), F.lit(terms)))
