"""Posts of social profiles as a table, through clients that the caller plugs in.

``links(profile, seconds)`` returns the hrefs of a profile's page, ``post(url, seconds)`` a post's
(caption, image_url).  Both run on the executors.  Signing in is up to the client.  As with pages, a
fetch is not repeatable: write the table once.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from urllib.parse import urljoin, urlparse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Where profiles stand, what marks a post's path, and the posts of a profile that are read (fixed values).
SITE, POST_PATHS, MOST_POSTS = "https://www.instagram.com", ("/p/", "/reel/"), 8
POSTS = "list_url string, position long, post_url string, caption string, image_url string, stage string, error string"


def is_post(url: str) -> bool:
    """Whether a URL is a single post's."""
    path = urlparse(url).path.lower()
    return any(mark in path for mark in POST_PATHS)


def post_urls(profile: str, hrefs: list[str], most: int = MOST_POSTS) -> list[str]:
    """The first posts that a profile links to by a path, distinct; a post's own URL is its only one."""
    if is_post(profile):
        return [profile]
    found = dict.fromkeys(urljoin(SITE, h) for h in hrefs if h and h.startswith("/") and POST_PATHS[0] in h)
    return list(found)[:most]


def read_profile(profile: str, links: Callable, post: Callable, most: int, seconds: float, pause: float) -> list[tuple]:
    """Rows of ``POSTS``; what fails is a row that says so."""
    said = lambda e: f"{type(e).__name__}: {e}"[:240]
    try:
        urls = post_urls(profile, [] if is_post(profile) else links(profile, seconds), most)
    except Exception as e:  # noqa: BLE001
        return [(profile, 0, profile, "", "", "instagram-profile", said(e))]
    out = []
    for i, url in enumerate(urls):
        if i and pause:
            time.sleep(pause)
        try:
            caption, image = post(url, seconds)
            out.append((profile, i, url, caption or "", image or "", "", ""))
        except Exception as e:  # noqa: BLE001
            out.append((profile, i, url, "", "", "instagram-post", said(e)))
    return out


def fetch_posts(profiles: DataFrame, links: Callable, post: Callable, partitions: int, column: str = "list_url", most: int = MOST_POSTS, seconds: float = 10.0, pause: float = 0.0) -> DataFrame:
    """``POSTS`` of the distinct profiles."""
    wanted = profiles.select(F.col(column).alias("list_url")).filter("list_url <> ''").distinct().repartition(partitions, "list_url")
    names = [f.split()[0] for f in POSTS.split(", ")]

    def run(batches):
        for batch in batches:
            for profile in batch.column(0).to_pylist():
                rows = read_profile(profile, links, post, most, seconds, pause)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k == 1 else pa.string()) for k in range(len(names))], names)

    return wanted.mapInArrow(run, POSTS)


def with_texts(posts: DataFrame, images: DataFrame) -> DataFrame:
    """``posts`` with ocr_text, what was recognised in their image.  images: url, text."""
    seen = images.select(F.col("url").alias("image_url"), F.col("text").alias("ocr_text"))
    return posts.join(seen, "image_url", "left").withColumn("ocr_text", T.col("ocr_text"))
