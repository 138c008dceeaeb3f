"""Exact dedup by a heavy-hitter split.

Misra-Gries summaries, one a partition, name every digest that may be frequent.  Their exact
counts verify them, and the verified winners, at most ``COUNTERS`` rows, are broadcast so that
hot groups are settled on the map side.  All other digests use ordinary shuffled aggregation.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identified, released, stored, with_rows

#: Counters of a summary and the most rows that are ever broadcast.
COUNTERS = 1024


def misra_gries(batches, k: int):
    """At most ``k`` (digest, n) of a stream of digest batches; any digest in over 1/(k+1) of the rows is there."""
    counts: dict[bytes, int] = {}
    for batch in batches:
        for entry in batch.column(0).value_counts().to_pylist():
            key, n = entry["values"], entry["counts"]
            counts[key] = counts.get(key, 0) + n
            if len(counts) > 4 * k:
                counts = shrink(counts, k)
    return shrink(counts, k)


def shrink(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """Subtracts the (k+1)-th largest count from all and keeps what is above zero."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {d: n - cut for d, n in counts.items() if n > cut}


def heavy_digests(digests: DataFrame, k: int) -> DataFrame:
    """(digest, keep_id, group_size) of at most ``k`` digests, counted exactly, that are in over 1/(k+1) of a partition's rows."""

    @released
    def summary(batches):
        found = misra_gries(batches, k)
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["digest", "n"])

    merged = digests.select("digest").mapInArrow(summary, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    named = merged.filter("n > 1").orderBy(F.desc("n"), "digest").limit(k).select("digest")
    return digests.join(F.broadcast(named), "digest", "left_semi").groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).filter("group_size > 1")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row for each input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty, so null and empty texts are one
    group.  Of equal texts the largest doc_id stays.  Rows that repeat that doc_id are all marked
    kept; null ids are kept only in groups without any other id.  Empty table: no rows.
    """
    digests = stored(identified(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest")), "digests")
    heavy = stored(heavy_digests(digests, counters), "heavy")
    tagged = digests.join(F.broadcast(heavy), "digest", "left")
    hot = tagged.filter("group_size is not null")
    cold = tagged.filter("group_size is null").select("doc_id", "digest")
    groups = cold.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    both = hot.select("doc_id", "digest", "keep_id", "group_size").unionByName(cold.join(groups, "digest").select("doc_id", "digest", "keep_id", "group_size"))
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs``, with all columns, of each group of equal texts: that of the largest doc_id,
    null ids last; of rows that repeat both, the one whose columns hash to the least."""
    keep = exact_dedup(docs, id_col, text_col).filter("kept").groupBy("doc_id", F.unhex("text_sha256").alias("digest")).agg(F.count("*").alias("n"))
    rows = with_rows(docs, id_col, text_col).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "row").alias("r")
    k = keep.alias("k")
    kept = rows.join(k, F.col("r.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("r.digest") == F.col("k.digest"))).select("r.doc_id", "r.digest", "r.row", "k.n")
    once = kept.filter("n = 1").select("row")
    again = kept.filter("n > 1").groupBy("doc_id", "digest").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.unionByName(again).select("row.*")
