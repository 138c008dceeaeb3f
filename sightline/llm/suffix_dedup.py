"""Suffix-array dedup of bytes by longest-previous-factor arrays.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier: in a document with
a smaller doc_id, or earlier in the same one.  Every decision comes from a longest-previous-factor
array: a string goes if the factor at its start, the longest earlier match, reaches ``WINDOW``.  The
array is read off a suffix array, its LCP array, and the previous and next smaller positions in
suffix order.

No suffix array holds the corpus.  Strings are dealt into buckets so that equal ones meet:

1. The anchor of a string is the k-gram in it with the least hash, common k-grams last.  Equal strings
   have equal anchors, and the strings of one anchor are consecutive: a segment of text holds them.
   Which k-grams are common is estimated on a sample; that decides no result, only where strings meet.
2. A batch of documents settles the segments whose anchors repeat in it by its own array, and
   sends on what starts first in the batch.  In any array, segments of the same bytes stand once: the
   longest previous factors of a later one reach ``window`` at each start, as the first matches it.  So a passage that a third of all documents hold goes on
   once a batch.  Its ends, which differ from document to document, have rare k-grams for anchors.
3. Anchors are counted over all batches.  One that stands nowhere else has no repeats.
4. The segments of the others are dealt by anchor into buckets of bounded size, an array each.  Anchors
   that still have very many segments are settled in parts first, as in 2, until that changes little.

Entries travel packed, by bucket or by block of documents, and texts meet them block by block.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, Lookup, Rows, even_keys, identified, in_blocks, joined, mix, packed_runs, parts, planes, quoted, ragged, records, released, returned, spans, stored, unplanes, utf8

#: Bytes of a repeated string, of the k-grams that route it, and of text in a bucket.
WINDOW, GRAM, BUCKET = 100, 32, 1 << 20
#: Segments of an anchor above which they are settled in parts; anchors that are counted in a task, about.
MOST, COUNTED = 10_000, 1 << 20
#: Sampled documents that hold a common k-gram, and the most common k-grams that are told apart.
HITS, COMMON = 4, 1 << 20
HALF = U64(0xFFFFFFFF)
#: Entries are spans of starts: place, length, anchor.  docs: block, id and tag of each run of entries.
ENTRIES = "bucket int, blocks binary, ids binary, tags binary, sizes binary, places binary, lengths binary, anchors binary"
HELD = "block int, kind int, bytes long, most long, ids binary, tags binary, sizes binary, places binary, lengths binary, anchors binary"
SEGMENTS = "bucket int, blocks binary, ids binary, tags binary, sizes binary, places binary, lengths binary, anchors binary, text binary"
FOUND, KNOWN, MANY = 0, 1, 2


def ranks(keys: np.ndarray) -> np.ndarray:
    """The rank of each key among the distinct ones."""
    order = np.argsort(keys)
    s = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], s[1:] != s[:-1]]))
    return out


def shifted(a: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([a[by:], np.zeros(min(by, len(a)), a.dtype)])


def suffix_array(text: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of ``starts`` in the order of the ``window`` bytes that follow each, and the LCP, at most
    ``window``, of each with the one before it.  Prefix doubling: ranks of 8, 16, 32 ... bytes."""
    base = 8 if window >= 8 else 1
    words_ = np.zeros(len(text), U64)
    for i in range(base):
        words_ = (words_ << U64(8)) | shifted(text, i).astype(U64)
    levels, span = [ranks(words_)], base
    while 2 * span <= window:
        r = levels[-1]
        levels.append(ranks((r.astype(U64) << U64(32)) | shifted(r, span).astype(U64)))
        span *= 2
    r, rest = levels[-1], window - span
    key = (r[starts].astype(U64) << U64(32)) | r[starts + rest].astype(U64)
    order = np.argsort(key, kind="stable")
    a, b = starts[order[:-1]], starts[order[1:]]
    same, last = np.zeros(len(a), np.int64), len(text) - 1
    for r in reversed(levels):
        x, y = np.minimum(a + same, last), np.minimum(b + same, last)
        same += np.where((same + span <= window) & (r[x] == r[y]), span, 0)
        span >>= 1
    on = np.ones(len(a), bool)
    for _ in range(base - 1):
        x, y = np.minimum(a + same, last), np.minimum(b + same, last)
        on &= (same < window) & (text[x] == text[y])
        same += on
    same[key[order[:-1]] == key[order[1:]]] = window
    return order, np.concatenate([[0], same]) if len(order) else same


def previous_smaller(values: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each place, the least LCP between it and the nearest place before it with a smaller value
    (0 if there is none).  lcp[i] is that of places i - 1 and i.  Pointer jumping, all places at once."""
    n = len(values)
    to, low = np.arange(-1, n - 1), lcp.astype(np.int64).copy()
    todo = np.arange(n)
    while True:
        todo = todo[to[todo] >= 0]
        todo = todo[values[to[todo]] > values[todo]]
        if not len(todo):
            break
        via = to[todo]
        low_via, to_via = low[via], to[via]
        low[todo], to[todo] = np.minimum(low[todo], low_via), to_via
    low[to < 0] = 0
    return low


def longest_previous_factors(text: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """For each start, the longest prefix, at most ``window``, that an earlier entry of ``starts`` has too."""
    if not len(starts):
        return np.zeros(0, np.int64)
    order, lcp = suffix_array(text, starts, window)
    before = previous_smaller(order, lcp)
    after = previous_smaller(order[::-1], np.concatenate([[0], lcp[:0:-1]]))[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(before, after)
    return out


def repeated_starts(ids: np.ndarray, tags: np.ndarray, first: np.ndarray, n: np.ndarray, text: np.ndarray, off: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments in the order of (doc_id, first, tag), and for each of their starts, one after another,
    whether its longest previous factor reaches ``window``.  Segment i is text[off[i] : off[i + 1]]."""
    order = np.lexsort((tags, first, ids))
    i, f, m = ids[order], first[order], n[order]
    if not ((i[1:] == i[:-1]) & (f[1:] < f[:-1] + m[:-1])).any():
        # segments of the same bytes stand in the array once, as the first of them
        whole = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(text)])
        same = whole.dictionary_encode().indices.to_numpy()[order]
        _, lead = np.unique(same, return_index=True)
        lead.sort()
        size = np.diff(off)[order[lead]]
        part = text[ragged(off[order[lead]], size)]
        factors = longest_previous_factors(part, ragged(np.cumsum(size) - size, m[lead]), window)
        out = np.ones(int(m.sum()), bool)
        out[ragged((np.cumsum(m) - m)[lead], m[lead])] = factors >= window
        return order, out
    # rows that repeat a doc_id: their starts interleave, and those of equal rows are the same
    starts, own, place = ragged(off[order], m), np.repeat(order, m), ragged(f, m)
    by = np.lexsort((tags[own], place, ids[own]))
    a, b = by[1:], by[:-1]
    new = np.concatenate([[True], (ids[own[a]] != ids[own[b]]) | (tags[own[a]] != tags[own[b]]) | (place[a] != place[b])])
    found = longest_previous_factors(text, starts[by[new]], window) >= window
    out = np.empty(len(by), bool)
    out[by] = found[np.cumsum(new) - 1]
    return order, out


def runs(order: np.ndarray, n: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first start in it, starts, flag) of each run of equal flags in a segment."""
    m = n[order].astype(np.int64)
    own, at = np.repeat(np.arange(len(m)), m), ragged(np.zeros(len(m), np.int64), m)
    new = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (flags[1:] != flags[:-1])])) if len(own) else own
    return order[own[new]], at[new], np.diff(np.append(new, len(own))), flags[new]


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of the k bytes at each place, from the words of eight bytes in them; it decides where strings
    meet and no result."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    word = np.ndarray((len(data),), "<u8", padded, strides=(1,))
    at = [*range(0, k - 7, 8)] + [k - 8] * (k % 8 > 0 and k > 8)
    h = np.zeros(n, U64)
    for i, j in enumerate(at if k >= 8 else [0]):
        x = word[j : j + n] if k >= 8 else word[:n] & U64((1 << (8 * k)) - 1)
        h = (h ^ x) * U64(0x9E3779B97F4A7C15 + 2 * i)
        h ^= h >> U64(29)
    return mix(h)


def anchors(data: np.ndarray, off: np.ndarray, window: int, k: int, common: Lookup) -> tuple[np.ndarray, ...]:
    """(row, first, n, fp) of every anchor: the strings that have it start at first ... first + n - 1 in the row."""
    count = np.maximum(0, np.diff(off) - window + 1)
    if not count.any():
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U64),)
    h = gram_hashes(data, k)
    key = h >> U64(1)
    if len(common.keys):
        key |= (common.find(h) >= 0).astype(U64) << U64(63)
    # upper half of the hash, then the place: the least key is the leftmost of the least
    least, span, wide = (key & ~HALF) | np.arange(len(h), dtype=np.int64).astype(U64), 1, window - k + 1
    while span < wide:
        step = min(span, wide - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    full = np.flatnonzero(count)
    start = ragged(off[full], count[full])
    anchor = (least[start] & HALF).astype(np.int64)
    row = np.repeat(full, count[full])
    change = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]))
    return row[change], start[change] - off[row[change]], np.diff(np.append(change, len(start))), h[anchor[change]]


def grouped(number: np.ndarray):
    """(number, places) of the entries of each number, in order."""
    order = np.argsort(number, kind="stable")
    head, sizes = packed_runs(number[order])
    ends = np.append(0, np.cumsum(sizes)).tolist()
    for k, i, j in zip(head.tolist(), ends[:-1], ends[1:], strict=True):
        yield k, order[i:j]


def pack(docs: tuple, row, first, n, fp) -> tuple:
    """The packed form of entries.  docs: (block,) id, tag of each row; entries of a row follow each other."""
    own, sizes = packed_runs(row)
    kinds = ("<i4", "<i8", "<i8")[3 - len(docs) :]
    return (*(planes(x[own].astype(t)) for x, t in zip(docs, kinds, strict=True)), planes(sizes.astype("<u4")), planes(first.astype("<u4")), planes(n.astype("<u4")), planes(fp.astype("<u8")) if fp is not None else b"")


def entries(bucket, docs: tuple, row, first, n, fp):
    """Rows of ``ENTRIES``, one a bucket."""
    return records([(k, *pack(docs, row[i], first[i], n[i], fp[i])) for k, i in grouped(bucket)], ENTRIES)


class Unpacked:
    """The entries of packed rows: (block,) id and tag of each run, and by entry its run, first, n, fp."""

    def __init__(self, rows: list[dict]):
        sizes = [unplanes(r["sizes"], len(r["sizes"]) // 4, 4, "<u4") for r in rows]
        m = [int(x.sum()) for x in sizes]
        self.ids, self.tags = joined(rows, "ids", "<i8"), joined(rows, "tags", "<i8")
        self.blocks = joined(rows, "blocks", "<i4") if rows and "blocks" in rows[0] else np.zeros(len(self.ids), np.int32)
        self.row = np.repeat(np.arange(len(self.ids)), np.concatenate([np.zeros(0, "<u4"), *sizes]))
        whole = lambda c, size, kind: np.concatenate([np.zeros(0, kind), *(unplanes(r[c], k, size, kind) for r, k in zip(rows, m, strict=True) if r[c])])
        self.first, self.n = whole("places", 4, "<u4").astype(np.int64), whole("lengths", 4, "<u4").astype(np.int64)
        self.fp = whole("anchors", 8, "<u8")
        if len(self.fp) != len(self.n):
            self.fp = np.zeros(len(self.n), U64)


class Repeats:
    """Strings of ``window`` bytes that also start earlier.  table: (block, doc_id, h, text) in ``blocks``
    blocks of ``size`` bytes in all; rows with a null doc_id take no part."""

    def __init__(self, table: DataFrame, blocks: int, size: int, window: int, gram: int, bucket: int, most: int):
        self.rows = table.filter("doc_id is not null").select("block", "doc_id", F.col("h").alias("t"), "text")
        self.blocks, self.window, self.gram, self.bucket, self.most = blocks, window, gram, bucket, most
        #: an anchor stands for some 35 of 100 bytes
        self.buckets = max(1, math.ceil(size / ((window - gram + 2) / 2 * COUNTED)), min(parts(table.sparkSession), size >> 18))
        #: their numbers are dealt to partitions in turn
        self.keys = even_keys(self.buckets, parts(table.sparkSession)).astype(np.int32)

    def common_grams(self) -> Lookup:
        """k-grams that more than about ``most`` / 2 documents hold, by a sample of few documents in ``most``."""
        k = self.gram
        rate = min(1.0, 2 * HITS / self.most)
        drawn = self.rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(1 << 30)) < rate * (1 << 30))

        @released
        def count(batches):
            for batch in batches:
                data, off = utf8(batch.column(0))
                for i, j in spans(off):
                    found = [np.unique(gram_hashes(data[a:b], k)) for a, b in zip(off[i:j].tolist(), off[i + 1 : j + 1].tolist(), strict=True)]
                    keys, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["h", "n"])

        often = drawn.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= HITS).orderBy(F.desc("n"), "h").limit(COMMON)
        return Lookup(np.sort(often.toArrow()["h"].to_numpy().view(U64)))

    def in_batches(self) -> DataFrame:
        """``ENTRIES`` of all anchors, without what its own batch settles; that has a bucket below zero."""
        window, gram, most, buckets, keys, common = self.window, self.gram, self.bucket, self.buckets, self.keys, self.common_grams()

        @released
        def find(batches):
            for batch in batches:
                data, off = utf8(batch.column(3))
                docs = tuple(batch.column(k).to_numpy() for k in range(3))
                _, ids, tags = docs
                got = []
                for i, j in spans(off):
                    row, *more = anchors(data[off[i] : off[j]], off[i : j + 1] - off[i], window, gram, common)
                    got.append((row + i, *more))
                if not got:
                    continue
                row, first, n, fp = (np.concatenate(x) for x in zip(*got, strict=True))
                # segments of anchors that repeat here, by anchor, in pieces of bounded size
                by = np.argsort(fp)
                same = fp[by][1:] == fp[by][:-1]
                some = by[np.concatenate([same, [False]]) | np.concatenate([[False], same])] if len(by) else by
                rest = np.ones(len(fp), bool)
                rest[some] = False
                left, gone = [(row[rest], first[rest], n[rest], fp[rest])], []
                ends = np.cumsum(n[some] + window - 1)
                last = np.append(np.flatnonzero(fp[some][1:] != fp[some][:-1]), len(some) - 1) if len(some) else np.zeros(0, np.int64)
                at = 0
                while at < len(some):
                    room = (ends[at - 1] if at else 0) + most
                    stop = int(last[max(np.searchsorted(last, at), np.searchsorted(ends[last], room, "right") - 1)]) + 1
                    own = some[at:stop]
                    r, f, m, p = row[own], first[own], n[own], fp[own]
                    size = m + window - 1
                    order, flags = repeated_starts(ids[r], tags[r], f, m, data[ragged(off[r] + f, size)], np.append(0, np.cumsum(size)), window)
                    s, a, m, hit = runs(order, m, flags)
                    gone.append((r[s[hit]], f[s[hit]] + a[hit], m[hit]))
                    left.append((r[s[~hit]], f[s[~hit]] + a[~hit], m[~hit], p[s[~hit]]))
                    at = stop
                if sum(len(g[0]) for g in gone):
                    r, f, m = (np.concatenate(x) for x in zip(*gone, strict=True))
                    by = np.lexsort((f, r))
                    yield from entries(np.full(len(r), -1 - int(fp[0] & U64(0x7FFFFFFF)), np.int32), docs, r[by], f[by], m[by], np.zeros(len(r), U64))
                r, f, m, p = (np.concatenate(x) for x in zip(*left, strict=True))
                by = np.lexsort((f, r))
                yield from entries(keys[(mix(p[by]) % U64(buckets)).astype(np.int64)], docs, r[by], f[by], m[by], p[by])

        return self.rows.mapInArrow(find, ENTRIES)

    def counted(self, found: DataFrame) -> DataFrame:
        """``HELD`` rows of ``ENTRIES``, packed by block: found ones, and those of anchors with several segments."""
        window, most = self.window, self.most

        @returned
        def count(key, group):
            e = Unpacked(group.to_pylist())
            if key[0].as_py() < 0:
                some, kind, times = np.arange(len(e.n)), np.full(len(e.n), FOUND), np.zeros(len(e.n), np.int64)
            else:
                _, back, times = np.unique(e.fp, return_inverse=True, return_counts=True)
                times = times[back]
                some = np.flatnonzero(times > 1)
                kind = np.where(times > most, MANY, KNOWN)
            out = []
            for number, i in grouped(e.blocks[e.row[some]].astype(np.int64) * 4 + kind[some]):
                i = some[i]
                out.append((number // 4, number % 4, int((e.n[i] + window - 1).sum()), int(times[i].max()), *pack((e.ids, e.tags), e.row[i], e.first[i], e.n[i], e.fp[i] if number % 4 else None)))
            return pa.Table.from_batches(list(records(out, HELD)))

        return stored(found.groupBy("bucket").applyInArrow(count, HELD), "held")

    def settled(self, held: DataFrame, parts_: int = 0) -> DataFrame:
        """``ENTRIES``: the strings of the segments ``held`` that start earlier, below bucket zero; with
        ``parts_``, an anchor's segments are settled in so many parts, and those that are left follow."""
        window, buckets, keys = self.window, self.buckets, self.keys
        size = held.agg(F.sum("bytes")).first()[0] or 0
        number = max(1, math.ceil(size / self.bucket))
        dealt = even_keys(number, parts(held.sparkSession)).astype(np.int32)

        @returned
        def segments(texts: pa.Table, spans_: pa.Table) -> pa.Table:
            """A block's texts next to its entries: their segments, by bucket."""
            e, rows = Unpacked(spans_.to_pylist()), Rows(texts["doc_id"].to_pylist(), texts["t"].to_pylist())
            data, off = utf8(texts["text"])
            start = off[rows.of(e.ids, e.tags)][e.row] + e.first
            salt = mix(e.ids.view(U64))[e.row] % U64(parts_) if parts_ else np.zeros(len(e.n), U64)
            bucket = dealt[(mix(e.fp + salt * U64(0x9E3779B97F4A7C15)) % U64(number)).astype(np.int64)]
            block = np.full(len(e.ids), texts["block"][0].as_py() if len(texts) else 0, np.int32)
            out = []
            for k, i in grouped(bucket):
                out.append((k, *pack((block, e.ids, e.tags), e.row[i], e.first[i], e.n[i], e.fp[i] if parts_ else None), data[ragged(start[i], e.n[i] + window - 1)].tobytes()))
            return pa.Table.from_batches(list(records(out, SEGMENTS)))

        @returned
        def settle(key, group):
            rows = group.to_pylist()
            e = Unpacked(rows)
            text = np.frombuffer(b"".join(r["text"] for r in rows), np.uint8)
            ids, tags = e.ids[e.row], e.tags[e.row]
            order, flags = repeated_starts(ids, tags, e.first, e.n, text, np.append(0, np.cumsum(e.n + window - 1)), window)
            s, a, m, hit = runs(order, e.n, flags)
            mark = np.where(hit, -1 - key[0].as_py(), keys[(mix(e.fp[s]) % U64(buckets)).astype(np.int64)]).astype(np.int32)
            some = np.arange(len(s)) if parts_ else np.flatnonzero(hit)
            some = some[np.lexsort((e.first[s][some] + a[some], e.row[s][some]))]
            s = s[some]
            return pa.Table.from_batches(list(entries(mark[some], (e.blocks, e.ids, e.tags), e.row[s], e.first[s] + a[some], m[some], e.fp[s])))

        texts = self.rows.repartition(self.blocks, "block")
        return texts.groupBy("block").cogroup(held.groupBy("block")).applyInArrow(segments, SEGMENTS).groupBy("bucket").applyInArrow(settle, ENTRIES)

    def found(self) -> DataFrame:
        """``HELD`` rows of the strings that start earlier too, in runs."""
        held = self.counted(self.in_batches())
        done, many = held.filter(F.col("kind") != MANY), held.filter(F.col("kind") == MANY)
        size, most = many.agg(F.sum("bytes"), F.max("most")).first()
        while size:
            # a part of such an anchor's segments keeps one of each that are equal
            held = self.counted(self.settled(many, math.ceil(most / self.most)))
            many, before = held.filter(F.col("kind") == MANY), size
            done = done.unionByName(held.filter(F.col("kind") != MANY))
            size, most = many.agg(F.sum("bytes"), F.max("most")).first()
            if size and size > before / 2:
                done, size = done.unionByName(many.withColumn("kind", F.lit(KNOWN))), 0
        ends = self.counted(self.settled(done.filter(F.col("kind") == KNOWN)))
        return done.filter(F.col("kind") == FOUND).unionByName(ends)


def intervals(first: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals of bytes that the strings of spans, sorted by their first start, cover."""
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end = np.maximum.accumulate(first + n + window - 1)
    new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]]))
    return first[new], end[np.append(new[1:] - 1, len(end) - 1)]


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET, most: int = MOST, carry: bool = False) -> DataFrame:
    """One row for each input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text, removed.

    Strings are judged on the input and never cross documents; overlaps count.  Null, empty and
    shorter texts lose nothing, and so do rows with a null doc_id.  Rows that repeat a doc_id are told
    apart by the hash of their texts: of strings with one start, the lesser hash is earlier; rows that
    repeat both are alike.  kept_sha256 is of the remaining bytes; kept_text is their text, in which a
    character that is cut in two goes as a whole.  carry: all other columns, as struct ``rest``.
    """
    others = [quoted(c) for c in docs.columns if c not in (id_col, text_col)]
    whole = identified(docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"), F.struct(*others or [F.lit(0).alias("none")]).alias("rest")), "doc_id", "text", "rest")
    table, blocks, size = in_blocks(whole)
    found = Repeats(table, blocks, size, window, gram, bucket, most).found()
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text", "removed", "rest"][: 7 + carry]

    @returned
    def finish(texts: pa.Table, spans_: pa.Table) -> pa.Table:
        """A block's texts next to the strings that go."""
        rows, e = Rows(texts["doc_id"].to_pylist(), texts["h"].to_pylist()), Unpacked(spans_.to_pylist())
        row = rows.of(e.ids, e.tags)[e.row]
        order = np.lexsort((e.first, row))
        cut, out, at = rows.slices(row, order), [], 0
        first_, n_ = e.first[order], e.n[order]
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for batch in texts.select(["doc_id", "text", *["rest"] * carry]).to_batches():
            data, off = utf8(batch.column(1))
            raw = data.tobytes()
            kept, removed = [], []
            for i in range(batch.num_rows):
                begin, pieces = int(off[i]), []
                first, end = intervals(first_[cut[at + i]], n_[cut[at + i]], window)
                for x, y in zip(first.tolist(), end.tolist(), strict=True):
                    pieces.append(raw[begin : int(off[i]) + x])
                    begin = int(off[i]) + y
                kept.append(b"".join([*pieces, raw[begin : int(off[i + 1])]]))
                removed.append([{"first": x, "end": y} for x, y in zip(first.tolist(), end.tolist(), strict=True)])
            at += batch.num_rows
            sizes = np.diff(off)
            columns = [pa.array(sizes), pa.array(sizes - np.array([len(x) for x in kept], np.int64)), pa.array([len(x) for x in removed], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()), pa.array(removed, span)]
            out.append(pa.RecordBatch.from_arrays([batch.column(0), *columns, *batch.columns[2:]], names))
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), span, *([texts.schema.field("rest").type] if carry else [])]
        return pa.Table.from_batches(out, pa.schema(list(zip(names, kinds, strict=True)))) if out else pa.schema(list(zip(names, kinds, strict=True))).empty_table()

    span_ = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    kinds = [*[T.LongType()] * 4, T.StringType(), T.StringType(), span_, whole.schema["rest"].dataType]
    fields = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds[: 7 + carry], strict=True)])
    texts = table.select("block", "doc_id", "h", "text", *["rest"] * carry).repartition(blocks, "block")
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(finish, fields)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs``, all rows and columns, with the repeated strings cut out of its texts; n_chars follows."""
    cut_ = suffix_dedup(docs, carry=True)
    new = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut_.select(*[(new[c] if c in new else F.col("rest").getField(c)).alias(c) for c in docs.columns])
