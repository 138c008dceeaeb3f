"""Substring dedup: repeated fixed-length windows of words, by Rabin-Karp hashes counted in Spark.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Every window of ``window`` words of every document has
a Rabin-Karp hash of 93 bits: 61 by one base, 32 by another that is independent of it.  Windows are
counted by hash: a window goes if its hash also stands in a document with a smaller doc_id.

One row a window would shuffle many times the input, so windows travel packed.  A batch of documents
counts its own windows first and sends on those of its least doc_id only, however often it repeats a
window: a window that a third of all documents hold costs one entry a batch.  Entries are dealt by
hash into buckets of bounded size, packed in the order of their documents, and each bucket is counted
in one task.  What it removes goes back packed by block of documents, where texts and removed windows
meet.  Removed windows merge into maximal intervals of words.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOW31, OTHER, POWERS, U64, Rows, even_keys, identified, in_blocks, joined, packed_runs, parts, planes, prefix, ragged, records, released, rolled, spans, stored, unplanes, utf8, words

#: Words of a window, and bytes of text whose windows fill a bucket, or do where there are fewer buckets than
#: shuffle partitions.
WINDOW, BUCKET, LEAST_BUCKET = 50, 12 << 20, 1 << 18
ENTRIES = "bucket int, blocks binary, ids binary, tags binary, sizes binary, places binary, hashes binary"
FOUND = "block int, ids binary, tags binary, sizes binary, places binary"


def window_hashes(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """(row, first word, 61-bit hash, 32-bit hash) of every window of ``size`` words, in order."""
    starts, ends, at = words(data, off)
    count = np.maximum(0, np.diff(at) - size + 1)
    full = np.flatnonzero(count)
    start = ragged(at[full], count[full])
    row = np.repeat(full, count[full])
    found = [rolled(prefix(rolled(prefix(data, powers), starts, ends, powers), powers), start, start + size, powers) for powers in (POWERS, OTHER)]
    return row, (start - at[row]).astype(np.uint32), found[0], (found[1] & U64(0xFFFFFFFF)).astype(np.uint32)


def of_later(ids: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether each window's hash also stands under a smaller id."""
    order = np.argsort(one)
    a, b = one[order], two[order]
    same = a[1:] == a[:-1]
    if (same & (b[1:] != b[:-1])).any():
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        same = a[1:] == a[:-1]
    out = np.zeros(len(ids), bool)
    if same.any():
        head = np.flatnonzero(np.concatenate([[True], ~same | (b[1:] != b[:-1])]))
        sizes = np.diff(np.append(head, len(a)))
        some = np.flatnonzero(np.repeat(sizes > 1, sizes))
        head, sizes = np.append(0, np.cumsum(sizes[sizes > 1]))[:-1], sizes[sizes > 1]
        place = order[some]
        out[place] = ids[place] > np.repeat(np.minimum.reduceat(ids[place], head), sizes)
    return out


def steps(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places as the distance from the one before in a run: small numbers pack well."""
    head = np.cumsum(sizes) - sizes
    out = np.diff(first.astype(np.int64), prepend=0)
    out[head] = first[head]
    return out.astype("<u4")


def places(step: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What ``steps`` was made of."""
    total, head = np.cumsum(step.astype(np.int64)), np.cumsum(sizes.astype(np.int64)) - sizes
    return (total - np.repeat((total - step)[head], sizes)).astype(np.uint32)


def grouped(number: np.ndarray):
    """(number, places) of the entries of each number, in order."""
    order = np.argsort(number, kind="stable")
    head, sizes = packed_runs(number[order])
    ends = np.append(0, np.cumsum(sizes)).tolist()
    for k, i, j in zip(head.tolist(), ends[:-1], ends[1:], strict=True):
        yield k, order[i:j]


def entries(bucket, docs: tuple, row, first, one, two, width: int = 8):
    """Rows of ``ENTRIES``, one a bucket.  docs: block, id and tag of each row; windows come in the order of
    their rows; ``width`` bytes of the first hash go along."""
    out = []
    for number, some in grouped(bucket):
        own, sizes = packed_runs(row[some])
        out.append((number, *(planes(x[own].astype(t)) for x, t in zip(docs, ("<i4", "<i8", "<i8"), strict=True)), planes(sizes.astype("<u4")), planes(steps(first[some], sizes)), planes(one[some].astype("<u8"), width) + planes(two[some].astype("<u4"))))
    return records(out, ENTRIES)


def repeated_windows(table: DataFrame, size: int, window: int = WINDOW, bucket: int = BUCKET) -> DataFrame:
    """``FOUND`` rows: the windows that also start in a document with a smaller doc_id, by block.
    table: (block, doc_id, h, text), of ``size`` bytes."""
    # a bucket's number is the first bits of its hashes; if those are five, seven bytes say the rest
    bits = math.ceil(math.log2(max(1, size / bucket, min(parts(table.sparkSession), size / LEAST_BUCKET))))
    width = 7 if bits >= 5 else 8
    keys = even_keys(1 << bits, parts(table.sparkSession)).astype(np.int32)

    @released
    def count(batches):
        for batch in batches:
            data, off = utf8(batch.column(3))
            docs = tuple(batch.column(k).to_numpy() for k in range(3))
            ids = docs[1]
            got = []
            for i, j in spans(off):
                row, *more = window_hashes(data[off[i] : off[j]], off[i : j + 1] - off[i], window)
                got.append((row + i, *more))
            row, first, one, two = (np.concatenate(x) for x in zip(*got, strict=True)) if got else (np.zeros(0, t) for t in (np.int64, np.uint32, U64, np.uint32))
            later = of_later(ids[row], one, two)
            here = np.flatnonzero(later)
            if len(here):
                # settled in the batch: under a number of the batch's own below zero
                mark = -1 - int(one[0] & LOW31)
                yield from entries(np.full(len(here), mark, np.int32), docs, row[here], first[here], np.zeros(len(here), U64), np.zeros(len(here), np.uint32))
            rest = np.flatnonzero(~later)
            yield from entries(keys[(one[rest] >> U64(61 - bits)).astype(np.int64)], docs, row[rest], first[rest], one[rest], two[rest], width)

    def settle(key, group):
        rows = group.to_pylist()
        sizes, first, one, two = [], [], [], []
        for r in rows:
            sizes.append(unplanes(r["sizes"], len(r["sizes"]) // 4, 4, "<u4"))
            n = int(sizes[-1].sum())
            first.append(places(unplanes(r["places"], n, 4, "<u4"), sizes[-1]))
            wide = len(r["hashes"]) // n - 4
            one.append(unplanes(r["hashes"][: wide * n], n, wide, "<u8"))
            two.append(unplanes(r["hashes"][wide * n :], n, 4, "<u4"))
        sizes, first, one, two = (np.concatenate(x) for x in (sizes, first, one, two))
        block, ids, tags = (joined(rows, c, t) for c, t in (("blocks", "<i4"), ("ids", "<i8"), ("tags", "<i8")))
        row = np.repeat(np.arange(len(ids)), sizes)
        some = np.arange(len(row)) if key[0].as_py() < 0 else np.flatnonzero(of_later(ids[row], one, two))
        out = []
        for number, at in grouped(block[row[some]]):
            own, sizes = packed_runs(row[some[at]])
            out.append((number, planes(ids[own]), planes(tags[own]), planes(sizes.astype("<u4")), planes(steps(first[some[at]], sizes))))
        return pa.Table.from_batches(list(records(out, FOUND)))

    rows = table.filter("doc_id is not null").select("block", "doc_id", "h", "text")
    return stored(rows.mapInArrow(count, ENTRIES).groupBy("bucket").applyInArrow(settle, FOUND), "windows")


def intervals(places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals that windows of ``size`` from ``places`` cover."""
    if not len(places):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.unique(places).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], first[1:] > first[:-1] + size]))
    return first[new], first[np.append(new[1:] - 1, len(first) - 1)] + size


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, bucket: int = BUCKET) -> DataFrame:
    """One row for each input row: doc_id, n_words, n_removed, kept_sha256, kept_text, removed (spans of words).

    Windows are judged on the input.  Null, empty and shorter texts lose nothing; the kept words are
    joined by one space.  Repeats inside a document, and in rows of the same doc_id, stay; rows with a
    null doc_id keep all their words.  Columns other than the two named are not read, whatever their names.
    """
    table, blocks, size = in_blocks(identified(docs, id_col, text_col))
    found = repeated_windows(table, size, window, bucket)
    fields = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string, removed array<struct<first: long, end: long>>"
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "removed"]
    span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def finish(texts: pa.Table, gone: pa.Table) -> pa.Table:
        """A block's texts next to its removed windows."""
        rows, parts_ = Rows(texts["doc_id"].to_pylist(), texts["h"].to_pylist()), gone.to_pylist()
        sizes = joined(parts_, "sizes", "<u4")
        place = places(joined(parts_, "places", "<u4"), sizes)
        row = np.repeat(rows.of(joined(parts_, "ids", "<i8"), joined(parts_, "tags", "<i8")), sizes)
        order = np.lexsort((place, row))
        place = place[order]
        cut, out, at = rows.slices(row, order), [], 0
        for batch in texts.select(["doc_id", "text"]).to_batches():
            data, off = utf8(batch.column(1))
            starts, ends, row_ = words(data, off)
            raw = data.tobytes()
            counts, lost, kept, removed = [], [], [], []
            for i in range(batch.num_rows):
                a, b = int(row_[i]), int(row_[i + 1])
                keep = np.ones(b - a, bool)
                first, end = intervals(place[cut[at + i]], window)
                for x, y in zip(first.tolist(), end.tolist(), strict=True):
                    keep[x:y] = False
                index = a + np.flatnonzero(keep)
                counts.append(b - a)
                lost.append(b - a - len(index))
                kept.append(b" ".join([raw[x:y] for x, y in zip(starts[index].tolist(), ends[index].tolist(), strict=True)]))
                removed.append([{"first": x, "end": y} for x, y in zip(first.tolist(), end.tolist(), strict=True)])
            at += batch.num_rows
            digest = [hashlib.sha256(x).hexdigest() for x in kept]
            out.append(pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), pa.array(digest, pa.string()), pa.array([x.decode() for x in kept], pa.string()), pa.array(removed, span)], names))
        return pa.Table.from_batches(out, pa.schema([*((n, pa.int64()) for n in names[:3]), *((n, pa.string()) for n in names[3:5]), (names[5], span)]))

    texts = table.select("block", "doc_id", "h", "text").repartition(blocks, "block")
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(finish, fields)
