"""The pipelines on CSV files:

    spark-submit -m sightline classify --input places.csv --output classified [--results hits.parquet] [--snapshots pages.parquet]

Every input is a CSV path that Spark can read (snapshots, search results, posts: Parquet).  Outputs are
CSV folders, or with ``--single`` one CSV file with a byte-order mark, replaced or appended to as a whole.
Relative paths stand below ``--data-dir``, else DATA_DIR, if either is set.
"""

from __future__ import annotations

import argparse
import datetime
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.dedup import discovery_summary, label_summary
from .operators.ranking import sort_by_ints
from .operators.records import kept_labels
from .plans import classify, collect, discover, extract, release
from .schemas import CANDIDATES, EVENTS, FAILED_PAGES, PLACES, RELEASE
from .session import kept, ship
from .sources import files
from .streaming.incremental import resume_range, slice_rows, slices


def options(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="sightline")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, *extra: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for flag in ("--input", "--output"):
            p.add_argument(flag, required=True)
        for flag in ("--data-dir", *extra):
            p.add_argument(flag, default="")
        p.add_argument("--single", action="store_true")
        return p

    def numbers(p: argparse.ArgumentParser, **flags: int) -> None:
        for name, default in flags.items():
            p.add_argument("--" + name.replace("_", "-"), type=int, default=default)

    p = command("collect", "--keywords", "--results", "--before", "--progress")
    numbers(p, start_index=1, end_index=0)
    p = command("classify", "--snapshots", "--results")
    p.add_argument("--check-all", action="store_true")
    numbers(p, limit=0)
    command("filter")
    p = command("discover", "--snapshots", "--results")
    numbers(p, top_n=5, probe_pages=5, max_home_links=250, max_sitemap_urls=500, limit=0)
    for flag in ("--no-sitemap", "--no-common-paths", "--no-site-search"):
        p.add_argument(flag, action="store_true")
    command("sort")
    p = command("extract", "--snapshots", "--rendered", "--images", "--posts", "--pass-through-columns", "--progress", "--failed-output")
    p.add_argument("--list-url-column", default="list_url")
    p.add_argument("--today", default=datetime.date.today().isoformat())
    for flag in ("--detail", "--render", "--ocr"):
        p.add_argument(flag, choices=("auto", "always", "never"), default="auto")
    p.add_argument("--page-timeout-seconds", type=float, default=0.0)
    p.add_argument("--no-resume", action="store_true")
    numbers(p, start_index=1, end_index=0, save_every=0, max_images=3)
    command("social", "--posts").add_argument("--today", default=datetime.date.today().isoformat())
    command("release", "--pass-through-columns").add_argument("--fill-missing-end-date", action="store_true")
    return parser.parse_args(argv)


def names(listed: str) -> tuple:
    return tuple(c.strip() for c in listed.split(",") if c.strip())


def save(df: DataFrame, o: argparse.Namespace, columns, more: bool = False, path: str = "") -> None:
    """``df`` as a CSV folder or file, replaced, or appended to."""
    path = path or o.output
    if o.single:
        (files.append_csv if more else files.export_csv)(df, path, columns)
    elif more:
        df.select(*columns).write.mode("append").csv(path, header=True, quote='"', escape='"', emptyValue="")
    else:
        files.write_csv(df, path, columns)


def first(rows: DataFrame, limit: int, index: str) -> DataFrame:
    return rows.filter(F.col(index) <= limit) if limit > 0 else rows


def run(spark: SparkSession, o: argparse.Namespace) -> None:
    ship(spark)
    folder = files.data_dir(o.data_dir, dict(os.environ), default="")
    if folder:
        for name in ("input", "output", "keywords", "results", "before", "snapshots", "rendered", "images", "posts", "progress", "failed_output"):
            if getattr(o, name, ""):
                setattr(o, name, files.data_path(getattr(o, name), folder))
    table = lambda path: spark.read.parquet(path) if path else None
    if o.command == "collect":
        queries = collect.query_plan(files.read_bullets(spark, o.input, "region"), files.read_bullets(spark, o.keywords, "keyword"))
        total = queries.count()
        before = files.read_progress(spark, o.progress) if o.progress else {}
        start, end = resume_range(total, o.start_index, o.end_index, before.get("next_start_index", 1))
        old = None if not o.before else files.read_csv(spark, o.before) if o.before.endswith(".csv") else table(o.before)
        rows = kept(collect.collect_places(slice_rows(queries, "query_index", start, end), table(o.results), old), "places")
        if o.single:
            files.append_csv(rows.orderBy("position"), o.output, PLACES)
        else:
            files.append(rows, o.output, PLACES)
        if o.progress:
            files.write_progress(spark, o.progress, end, total, rows.count())
        return None
    rows = files.read_csv_any(spark, o.input)
    shown = [c for c in rows.columns if c != "source_row"]
    if o.command == "classify":
        venues = classify.classified(first(rows.withColumnRenamed("source_row", "venue_index"), o.limit, "venue_index"))
        found = table(o.results)
        out = kept(classify.with_urls(venues, classify.searched(venues, found) if found is not None else None, table(o.snapshots), only_candidates=not o.check_all), "classified")
        save(out.orderBy("venue_index"), o, [c for c in out.columns if c != "venue_index"])
        print(label_summary(out).first().asDict())
    elif o.command == "filter":
        save(kept_labels(rows).orderBy("source_row"), o, shown)
    elif o.command == "discover":
        chosen = discover.Options(top_n=o.top_n, probe_pages=o.probe_pages, max_home_links=o.max_home_links, max_sitemap_urls=o.max_sitemap_urls, sitemap=not o.no_sitemap, common_paths=not o.no_common_paths, site_search=not o.no_site_search)
        out = kept(discover.discover(first(rows.withColumnRenamed("source_row", "venue_index"), o.limit, "venue_index"), table(o.snapshots), table(o.results), chosen), "discovered")
        save(out.orderBy("venue_index", "rank"), o, CANDIDATES)
        print(discovery_summary(out).first().asDict())
    elif o.command == "sort":
        save(sort_by_ints(rows, ["venue_index", "rank"], "source_row"), o, shown)
    elif o.command in ("extract", "social"):
        extract_pages(spark, o, rows, table)
    elif o.command == "release":
        carry = names(o.pass_through_columns)
        save(release.build(rows, carry, o.fill_missing_end_date, "source_row"), o, [*RELEASE, *[c for c in carry if c not in RELEASE]])


def extract_pages(spark: SparkSession, o: argparse.Namespace, rows: DataFrame, table) -> None:
    """List pages, or social profiles only, slice by slice; after each, its rows and the progress are saved."""
    today = F.lit(o.today).cast("date")
    if o.command == "social":
        pages = files.list_pages(rows)
        nothing = spark.createDataFrame([], "url string, final_url string, status string, text string, error string")
        out, _ = extract.extract_all(pages, nothing, today, extract.Options(social=True, detail="never"), posts=table(o.posts))
        return save(out, o, EVENTS)
    pages = files.list_pages(rows, o.list_url_column)
    total = pages.count()
    before = files.read_progress(spark, o.progress) if o.progress else {}
    start, end = resume_range(total, o.start_index, o.end_index, before.get("next_start_index", 1), auto=not o.no_resume)
    carry = names(o.pass_through_columns)
    chosen = extract.Options(detail=o.detail, render=o.render, ocr=o.ocr, social=bool(o.posts), max_images=o.max_images, page_seconds=o.page_timeout_seconds or None)
    columns = [*EVENTS, *[c for c in carry if c not in EVENTS]]
    saved, lost = (before.get("saved_rows") or 0, before.get("saved_failures") or 0) if start > 1 else (0, 0)
    for a, b in slices(start, end, o.save_every):
        out, failures = extract.extract_all(slice_rows(pages, "page_index", a, b), table(o.snapshots), today, chosen, table(o.rendered), table(o.images), carry, table(o.posts))
        out, failures = kept(out, "outcomes"), kept(failures, "lost")
        save(out, o, columns, more=True)
        if o.failed_output:
            save(failures, o, FAILED_PAGES, more=True, path=o.failed_output)
        saved, lost = saved + out.count(), lost + failures.count()
        if o.progress:
            files.write_progress(spark, o.progress, b, total, saved, lost)


if __name__ == "__main__":
    run(SparkSession.builder.appName("sightline").getOrCreate(), options())
