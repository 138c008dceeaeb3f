"""Fetched pages as a snapshot table, through a client that the caller plugs in.

``get(url, seconds)`` returns (final_url, http_status, content_type, body).  It runs on the
executors; an ``HTTPError``-like exception (one with a ``code``) and any other become rows.  A fetch
is not repeatable: write the snapshot once and let every pipeline read that table.
"""

from __future__ import annotations

import heapq
import re
import time
from collections.abc import Callable
from urllib.parse import quote, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import SNAPSHOT

NAMES = [f.split()[0] for f in SNAPSHOT.split(", ")]
SAFE_PATH = "/:@!$&'()*+,;="
#: Seconds before a second try; twice as many before a third (fixed value).
BACKOFF = 0.25


def charset(content_type: str) -> str:
    """The charset that a content type names, else utf-8."""
    found = re.search(r"(?i)charset=([\w.-]+)", content_type or "")
    return found[1] if found else "utf-8"


def page_text(body: bytes, content_type: str) -> str:
    """The body's text; an unknown charset counts as utf-8, and bytes that don't fit are replaced."""
    try:
        return body.decode(charset(content_type), "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def quoted_path(url: str) -> str:
    """The URL with its path percent-quoted."""
    parts = urlsplit(url)
    return urlunsplit(parts._replace(path=quote(parts.path, safe=SAFE_PATH)))


class Again(Exception):
    """A try that failed and may be made again; its cause says why."""


def fetch_one(url: str, get: Callable, seconds: float, most_bytes: int | None) -> tuple:
    """A snapshot row from one try; server errors that carry a code are rows, others raise ``Again``."""
    try:
        final, status, kind, body = get(quoted_path(url), seconds)
    except Exception as e:  # noqa: BLE001
        if not hasattr(e, "code"):
            raise Again from e
        return url, getattr(e, "url", url) or url, "http_error", str(e.code), "", "", str(getattr(e, "reason", e))[:240]
    try:
        return url, final or url, "ok", str(status), kind or "", page_text(body[:most_bytes], kind), ""
    except Exception as e:  # noqa: BLE001  a page that fails is a record, not a failed job
        return failed(url, e)


def failed(url: str, e: BaseException) -> tuple:
    return url, "", "error", "", "", "", f"{type(e).__name__}: {e}"[:240]


def fetch_pages(urls: DataFrame, get: Callable, partitions: int, column: str = "url", seconds: float = 8.0, most_bytes: int | None = 700_000, tries: int = 2, budget: float | None = None, pause: float = 0.0) -> DataFrame:
    """A snapshot of the distinct URLs.  Hosts are spread over ``partitions`` tasks; a task that has used
    its ``budget`` of seconds gives error rows for the rest.

    A URL that fails is tried again after a growing pause, in which the task goes on with others: it
    waits only where nothing else is left."""
    wanted = urls.select(F.col(column).alias("url")).filter("url <> ''").distinct().repartition(partitions, "url")

    def fetch(batches):
        began = time.monotonic()
        fresh = (url for batch in batches for url in batch.column(0).to_pylist())
        # tries that failed, by when they are due: (due, tries made, url, error)
        waiting: list[tuple] = []
        out, held = [], 0
        while True:
            if waiting and waiting[0][0] <= time.monotonic():
                _, made, url, error = heapq.heappop(waiting)
            elif (url := next(fresh, None)) is not None:
                made, error = 0, None
            elif waiting:
                time.sleep(max(0.0, waiting[0][0] - time.monotonic()))
                continue
            else:
                break
            if budget is not None and time.monotonic() - began > max(1.0, budget):
                row = failed(url, error or TimeoutError(f"over {budget:.0f} s"))
            else:
                try:
                    row = fetch_one(url, get, seconds, most_bytes)
                except Again as e:
                    row = failed(url, e.__cause__)
                    if made + 1 < tries:
                        # URLs are distinct, so errors are never compared
                        heapq.heappush(waiting, (time.monotonic() + BACKOFF * (made + 1), made + 1, url, e.__cause__))
                        row = None
                if pause:
                    time.sleep(pause)
            if row:
                out.append(row)
                held += len(row[5])
            if len(out) >= 1000 or held > 8 << 20:
                yield _rows(out)
                out, held = [], 0
        if out:
            yield _rows(out)

    return wanted.mapInArrow(fetch, SNAPSHOT)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(len(NAMES))], NAMES)
