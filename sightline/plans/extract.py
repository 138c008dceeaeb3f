"""List-page extraction: events of every page, enriched from their own pages, valid and current ones kept.

Stages go from cheap to costly: the fetched page, the page as a browser rendered it, the text that was
recognised in its images, and the same three for the page of each event that lacks something.  What
fails on the way is a row of its own, of a page or of one event, and no failure stops a run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocabulary as V
from ..operators import html as H
from ..operators.dedup import dedupe_events, summarize_failures
from ..operators.records import filled, needs_detail, outcomes, runs
from ..schemas import FAILED_PAGES
from ..session import kept


@dataclass(frozen=True)
class Options:
    detail: str = "auto"
    render: str = "never"
    ocr: str = "never"
    social: bool = False
    max_images: int = 3
    #: seconds that a page may take, with all that is fetched for it (None: any); beyond it its events are dropped
    page_seconds: float | None = None
    rules: V.EventRules = V.EventRules()


FIELDS = ("exhibition_name", "start_date", "end_date", "location", "detail_url")
FAILURE = ("list_url", "position", "url", "stage", "error_type", "error_message")
SUMMARY = ("failure_stage", "failure_type", "failure_message")


def page_events(pages: DataFrame, stage: int, o: Options, column: str = "page") -> DataFrame:
    """JSON-LD events, then block events, of parsed pages: list_url, final_url, position and the event fields."""
    rows = H.page_event_rows(pages, ["list_url"], "final_url", column, o.rules)
    return rows.withColumn("position", F.lit(stage << 32) + F.col("position"))


def image_texts(pages: DataFrame, key: list[str], base: str, images: DataFrame, o: Options) -> DataFrame:
    """key, base, position, text: what was recognised in the best images of parsed pages.  images: url, text."""
    best = H.image_candidates(pages, [*key, base] if base not in key else key, "page.images", o.rules).filter(F.col("rank") <= o.max_images)
    return best.join(images.select("url", "text"), "url").filter(T.col("text") != "").select(*key, *[base] * (base not in key), F.col("rank").alias("position"), "text")


def lacking(pages: DataFrame, events: DataFrame, mode: str) -> DataFrame:
    """The pages on which the next, costlier stage runs."""
    if mode == "always":
        return pages
    return pages.join(events.select("list_url").distinct(), "list_url", "left_anti")


def failure(rows: DataFrame, stage: Column | str, kind: Column | str, message: Column | str, url: str = "list_url", position: Column | None = None) -> DataFrame:
    """Failure records of the rows' pages, or of one event each."""
    said = {"position": F.lit(None).cast("long") if position is None else position, "url": F.col(url), "stage": F.lit(stage) if isinstance(stage, str) else stage, "error_type": T.first_filled(kind, F.lit("Error")), "error_message": T.cut(message, 300)}
    return rows.select("list_url", *[c.cast("long" if n == "position" else "string").alias(n) for n, c in said.items()])


def _error(table: DataFrame) -> Column:
    return T.col("error") if "error" in table.columns else F.lit("")


def _kind(error: Column) -> Column:
    """The class that an error's text begins with."""
    return F.regexp_extract(error, r"^(\w+)(?=:|$)", 1)


def _rendered(rendered: DataFrame | None) -> DataFrame | None:
    """(url, html, error, seconds) of pages after their scripts ran."""
    if rendered is None:
        return None
    named = rendered if "url" in rendered.columns else rendered.withColumnRenamed("list_url", "url")
    return named.select("url", T.col("html").alias("html"), _error(named).alias("error"), (F.col("seconds") if "seconds" in named.columns else F.lit(0.0)).cast("double").alias("seconds"))


def detail_parts(pages: DataFrame) -> DataFrame:
    """src, base and what a detail page says: its JSON-LD events, and dates and place in its text."""
    read = pages.select("src", "base", H.parsed("html", "base", ("events", "lines")).alias("page"))
    return read.select("src", "base", F.col("page.events").alias("linked"), *[c.alias(f"seen_{n}") for n, c in H.detail_fields(F.col("page.lines")).items()])


def with_details(events: DataFrame, parts: DataFrame, rules: V.EventRules) -> DataFrame:
    """``events`` (src, base and base_name: the name before any filling) with gaps filled from their detail
    page: the JSON-LD event closest to the name first, then the page's text."""
    rows = events.join(parts, ["src", "base"], "left").withColumn("near", H.closest_event(F.col("linked"), F.col("base_name")))
    start = H.D.normalize_date("near.start")
    end = H.D.normalize_date("near.end", F.substring(start, 1, 4).try_cast("int"))
    more = {"exhibition_name": [F.col("near.exhibition_name")], "start_date": [start, F.col("seen_start_date")], "end_date": [end, F.col("seen_end_date")], "location": [F.col("near.location"), F.col("seen_location")], "detail_url": [F.col("near.detail_url")]}
    return rows.withColumns(filled(more, rules.generic)).select(*events.columns)


def enriched(events: DataFrame, pages: DataFrame, snapshots: DataFrame, rendered: DataFrame | None, images: DataFrame | None, o: Options) -> tuple[DataFrame, DataFrame]:
    """(events, failures): gaps filled from the detail pages.  pages: list_url, final_url, html (as rendered, if it was).

    An event whose page is the list page itself reads that; each other URL is fetched and parsed once."""
    wanted = (T.col("detail_url") != "") & runs(o.detail, needs_detail())
    own = F.col("detail_url").isin(F.col("final_url"), F.col("list_url"))
    rows = events.withColumn("wanted", wanted).withColumns({"src": F.when(F.col("wanted"), F.when(own, F.col("list_url")).otherwise("")), "base": F.when(F.col("wanted"), F.col("detail_url")), "base_name": F.col("exhibition_name")})
    asked = rows.filter("wanted").select("src", "base").distinct()
    others = asked.filter("src = ''").join(snapshots.select(F.col("url").alias("base"), "status", T.col("text").alias("html"), T.col("error").alias("error"), F.col("status").alias("kind")), "base", "left")
    fetched = others.filter("status = 'ok'").select("src", "base", "html").unionByName(asked.filter("src <> ''").join(pages.select(F.col("list_url").alias("src"), "html"), "src").select("src", "base", "html"))
    parts = detail_parts(fetched)
    lost = rows.filter("wanted").join(others.filter("status is null or status <> 'ok'"), ["src", "base"])
    failures = failure(lost, "detail-fetch", F.when(F.col("kind").isNull(), "NotFetched").otherwise(T.first_filled(_kind(F.col("error")), "kind")), "error", "base", F.col("position"))
    # an event whose page can't be fetched isn't looked at further
    rows = with_details(rows, parts, o.rules).join(lost.select("list_url", "position", F.lit(True).alias("lost")), ["list_url", "position"], "left")
    rows = rows.withColumn("wanted", F.col("wanted") & F.col("lost").isNull()).drop("lost")
    again = None
    if rendered is not None and o.render != "never":
        rows = rows.withColumn("again", F.col("wanted") & runs(o.render, needs_detail()))
        urls = rows.filter("again").select("src", "base").distinct().join(rendered.withColumnRenamed("url", "base"), "base")
        failures = failures.unionByName(failure(rows.filter("again").join(urls.filter("error <> ''").select("src", "base", "error"), ["src", "base"]), "detail-js-render", _kind(F.col("error")), "error", "base", F.col("position")))
        again = urls.filter("html <> ''").select("src", "base", "html")
        more = detail_parts(again)
        keyed = rows.withColumns({"src": F.when(F.col("again"), F.col("src")), "base": F.when(F.col("again"), F.col("base")), "src0": F.col("src"), "base0": F.col("base")})
        rows = with_details(keyed, more, o.rules).withColumns({"src": F.col("src0"), "base": F.col("base0")}).drop("src0", "base0", "again")
    if images is not None and o.ocr != "never":
        rows = rows.withColumn("again", F.col("wanted") & runs(o.ocr, needs_detail()))
        urls = rows.filter("again").select("src", "base").distinct()
        shown = urls.join(fetched, ["src", "base"])
        if again is not None:
            shown = shown.join(again.withColumnRenamed("html", "__again"), ["src", "base"], "left").withColumn("html", F.coalesce("__again", "html"))
        texts = image_texts(shown.select("src", "base", H.parsed("html", "base", ("images",)).alias("page")), ["src", "base"], "base", images, o)
        found = H.ocr_events(texts, ["src", "base"], "base", o.rules)
        # at most ``max_images`` events a page
        seen = found.groupBy("src", "base").agg(F.sort_array(F.collect_list(F.struct("position", *FIELDS))).alias("seen"))
        joined = rows.join(seen, ["src", "base"], "left").withColumn("near", F.when(F.col("again"), H.closest_event(F.col("seen"), F.col("base_name"))))
        rows = joined.withColumns(filled({f: [F.col(f"near.{f}")] for f in FIELDS}, o.rules.generic)).drop("seen", "near", "again")
    return rows.select(*events.columns), failures


def social_events(list_pages: DataFrame, posts: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """(events, failures) of list pages that are social profiles.  posts: list_url, position, post_url, caption,
    ocr_text, and maybe error and the stage that failed."""
    own = posts.join(list_pages.select("list_url").distinct(), "list_url", "left_semi")
    error = _error(own)
    told = own.filter(error == "").withColumn("e", F.struct("list_url", "position"))
    rows = H.social_event(told, o.rules, keep=("e",))
    events = rows.select("e.list_url", F.col("e.list_url").alias("final_url"), F.col("e.position").cast("long").alias("position"), F.col("event_name").alias("exhibition_name"), "start_date", "end_date", F.lit("").alias("location"), F.col("e.list_url").alias("detail_url"))
    stage = T.first_filled("stage", F.lit("instagram-post")) if "stage" in own.columns else F.lit("instagram-post")
    lost = own.filter(error != "").withColumns({"said": error, "at": stage})
    return events, failure(lost, F.col("at"), _kind(F.col("said")), "said", "post_url")


def over_time(pages: DataFrame, events: DataFrame, snapshots: DataFrame, rendered: DataFrame | None, o: Options) -> DataFrame:
    """Failure records of the pages that took too long, with all that was fetched for them."""
    spent = [pages.select("list_url", F.col("list_url").alias("url")), events.filter(T.col("detail_url") != "").select("list_url", F.col("detail_url").alias("url"))]
    took = snapshots.select("url", F.col("seconds").cast("double").alias("seconds"))
    if rendered is not None:
        took = took.unionByName(rendered.select("url", "seconds"))
    each = spent[0].unionByName(spent[1]).distinct().join(took, "url").groupBy("list_url").agg(F.sum("seconds").alias("spent"))
    most = max(1.0, o.page_seconds)
    return failure(each.filter(F.col("spent") > most), "page-timeout", F.lit("TimeoutError"), F.lit(f"Page processing exceeded {most:.0f}s"))


def extract_all(list_pages: DataFrame, snapshots: DataFrame, today, options: Options | None = None, rendered: DataFrame | None = None, images: DataFrame | None = None, carry: tuple = (), posts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(outcomes, failures): one row for each current event of a list page, or a status row for the page; and
    one row for everything that failed (``FAILED_PAGES``).

    snapshots: the fetched pages (list and detail), maybe with seconds; rendered: url (or list_url) and html
    after scripts ran, maybe with error and seconds; images: url and recognised text; posts: see
    ``social_events``.  Costlier stages see only the pages that need them."""
    o = options or Options()
    rendered = _rendered(rendered)
    asked = list_pages.select("list_url").distinct()
    is_social = F.contains(F.lower("list_url"), F.lit("instagram.com")) if o.social and posts is not None else F.lit(False)
    seen = snapshots.select(F.col("url").alias("list_url"), T.first_filled("final_url", "url").alias("final_url"), "status", "text", "error")
    pages = asked.filter(~is_social).join(seen, "list_url", "left")
    failures = failure(pages.filter("status is null or status <> 'ok'"), "fetch", F.when(F.col("status").isNull(), "NotFetched").otherwise(T.first_filled(_kind(T.col("error")), "status")), "error")
    ok = pages.filter("status = 'ok'").select("list_url", "final_url", T.col("text").alias("html"))
    events = kept(page_events(ok.select("list_url", "final_url", H.parsed("html", "final_url", ("events", "blocks")).alias("page")), 0, o), "list-events")
    if rendered is not None and o.render != "never":
        again = lacking(ok, events, o.render).drop("html").join(rendered.withColumnRenamed("url", "list_url"), "list_url")
        failures = failures.unionByName(failure(again.filter("error <> ''"), "js-render", _kind(F.col("error")), "error"))
        again = again.filter("html <> ''").select("list_url", "final_url", "html")
        events = events.unionByName(kept(page_events(again.select("list_url", "final_url", H.parsed("html", "final_url", ("events", "blocks")).alias("page")), 1, o), "rendered-events"))
        ok = ok.join(again.select("list_url", F.col("html").alias("__again")), "list_url", "left").select("list_url", "final_url", F.coalesce("__again", "html").alias("html"))
    if images is not None and o.ocr != "never":
        shown = lacking(ok, events, o.ocr).select("list_url", "final_url", H.parsed("html", "final_url", ("images",)).alias("page"))
        texts = image_texts(shown, ["list_url"], "final_url", images, o)
        events = events.unionByName(H.ocr_events(texts, ["list_url"], "final_url", o.rules).withColumn("position", F.lit(2 << 32) + F.col("position")))
    events = dedupe_events(events, "position", "list_url").join(ok.select("list_url", "final_url"), "list_url")
    if o.detail != "never":
        events, more = enriched(events, ok, snapshots, rendered, images, o)
        failures = failures.unionByName(more)
    if o.social and posts is not None:
        told, more = social_events(asked.filter(is_social), posts, o)
        events, failures = events.unionByName(told.select(*events.columns)), failures.unionByName(more)
    if o.page_seconds is not None and "seconds" in snapshots.columns:
        late = kept(over_time(ok, events, snapshots, rendered, o), "late")
        events, failures = events.join(late.select("list_url"), "list_url", "left_anti"), failures.unionByName(late)
    failures = kept(failures.withColumn("at", F.coalesce("position", F.lit(-1))), "failures")
    of_event = summarize_failures(failures.filter("position is not null").withColumn("key", F.struct("list_url", "position")), "key", "at").select("key.list_url", "key.position", *SUMMARY)
    done = kept(events.join(of_event, ["list_url", "position"], "left").select("list_url", *FIELDS, *[T.col(c).alias(c) for c in SUMMARY]), "events")
    out = outcomes(list_pages, done, summarize_failures(failures, "list_url", "at"), today, "list_url", carry)
    told = {"list_url": F.col("url"), "source_title": F.lit("")}
    return out, failures.select(*[told.get(c, F.col(c)).alias(c) for c in FAILED_PAGES])


def extract(*args, **named) -> DataFrame:
    """The outcomes of ``extract_all``."""
    return extract_all(*args, **named)[0]
