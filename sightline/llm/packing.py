"""Packing token sequences by best-fit decreasing.

Overlong documents are first cut into full windows.  Their rests are packed by best-fit
decreasing over all documents at once.  Rests of one length are interchangeable, so the plan is
made on the histogram of lengths, ``WINDOW`` numbers however large the input: a segment tree
indexed by remaining capacity finds the tightest open window, and whole runs of equal rests go to
whole runs of equally full windows.  The plan is a short list of ranges; every rest finds its
place by its length and its number among the rests of that length, which two counting passes
give without a sort or a hot key.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import identified, released, stored
from .word_bpe import WordCoder

#: Tokens of a window, and the id that ends a document.
WINDOW, END_ID = 4096, 2


class CapacityTree:
    """Sets of open windows by remaining capacity, and the least capacity that is at least s."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.open = np.zeros(2 * self.size, np.int64)

    def add(self, capacity: int, n: int) -> None:
        i = capacity + self.size
        while i:
            self.open[i] += n
            i >>= 1

    def tightest(self, least: int) -> int:
        """The smallest capacity >= least with an open window, or -1."""
        i = least + self.size
        if self.open[i]:
            return least
        while i > 1:
            if not i & 1 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return -1


def best_fit_decreasing(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(length, first, n, sequence, offset): the rests of that length numbered first ... first + n - 1
    go to sequences sequence ... sequence + n - 1 at that offset.

    Each open window is in one run; runs of a capacity are a stack.  Full windows close."""
    tree, runs, plan, opened = CapacityTree(window), {}, [], 0
    for length in sorted((s for s in counts if s), reverse=True):
        first, left = 0, counts[length]
        while left:
            capacity = tree.tightest(length)
            if capacity < 0:
                # as many in each new window as best fit would stack there
                each = window // length
                n = max(1, left // each)
                take = min(each, left)
                for k in range(take):
                    plan.append((length, first + k * n, n, opened, k * length))
                rest = window - take * length
                if rest:
                    runs.setdefault(rest, []).append((opened, n))
                    tree.add(rest, n)
                opened += n
                first, left = first + take * n, left - take * n
                continue
            start, n = runs[capacity].pop()
            tree.add(capacity, -n)
            used = min(n, left)
            plan.append((length, first, used, start, window - capacity))
            if used < n:
                runs[capacity].append((start + used, n - used))
                tree.add(capacity, n - used)
            rest = capacity - length
            if rest:
                runs.setdefault(rest, []).append((start, used))
                tree.add(rest, used)
            first, left = first + used, left - used
    return plan


def pieces(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens: full windows of every document, then its rest."""
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = f.read()

    @released
    def cut(batches):
        coder = WordCoder.of(spec)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids, off = coder.encode(some.column(1))
                out: list[tuple] = []
                for i, a, b in zip(some.column(0).to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                    own = np.append(ids[a:b], END_ID).astype("<u4")
                    out += [(i, k, min(window, len(own) - k), zlib.crc32(own[k : k + window].tobytes()), len(own)) for k in range(0, len(own), window)]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return identified(docs, id_col, text_col).select("doc_id", "text").mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def numbered(table: DataFrame, key: str) -> DataFrame:
    """``table`` (read from files) with ``nth``: each row's number, from 0, among the rows of its key.

    Rows count up inside their partition; where a partition begins, a second, small table of
    counts by partition and key says.  No task holds the rows of a key."""
    schema = T.StructType([*table.schema.fields, T.StructField("part", T.IntegerType()), T.StructField("inner", T.LongType())])

    @released
    def count(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            out = []
            for v in batch.column(key).to_pylist():
                out.append(seen.get(v, 0))
                seen[v] = out[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(out), pa.int32()), pa.array(out, pa.int64())], [f.name for f in schema])

    rows = stored(table.mapInArrow(count, schema), "numbered")
    before = rows.groupBy(key, "part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    return rows.join(before.select(key, "part", F.coalesce("before", F.lit(0)).alias("before")), [key, "part"]).withColumn("nth", F.col("before") + F.col("inner")).drop("part", "inner", "before")


def pack(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are one token, the end.  Every id is in exactly one piece; sequences hold
    at most ``window`` ids without gaps.  Full windows take the sequence ids after the packed ones.
    """
    table = stored(pieces(docs, vocabulary_path, id_col, text_col, window), "pieces")
    ranked = numbered(table, "length")
    # at most ``window`` rows, whatever the input
    sizes = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit_decreasing(sizes, window)
    by_length: dict[int, list] = {}
    for length, first, n, sequence, offset in plan:
        by_length.setdefault(length, []).append((first, sequence, offset))
    for length, runs in by_length.items():
        runs.sort()
        by_length[length] = tuple(np.array([r[k] for r in runs], np.int64) for k in range(3))

    @released
    def place(batches):
        for batch in batches:
            length, nth = (batch.column(k).to_numpy() for k in ("length", "nth"))
            sequence, offset = np.zeros(len(nth), np.int64), np.zeros(len(nth), np.int64)
            for s in np.unique(length).tolist():
                at = np.flatnonzero(length == s)
                first, to, start = by_length[s]
                run = np.searchsorted(first, nth[at], "right") - 1
                sequence[at], offset[at] = to[run] + nth[at] - first[run], start[run]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return ranked.mapInArrow(place, ", ".join(f"{x} long" for x in [*names, "sequence_id", "offset"]))
