"""MinHash near-dedup by ProbMinHash, banding and exact verification.

A document's shingles are its runs of five words, weighted by how often they occur.  Each weighted
shingle sends a Poisson process of arrivals at random registers; a register keeps its first
arrival, and an element ends as soon as its next arrival is later than every register's.  Two
signatures agree in a register with a probability of the documents' probability Jaccard.  A document
with repeated shingles has a second signature, over the set of its shingles (all weights 1); two of
those agree with a probability of the plain Jaccard.

Signatures are cut into bands.  A bucket, the documents that share a band, links each member to
three leaders, its least document, its shortest and one drawn by the band, so a bucket of n documents
costs 3n pairs.  (Where one shingle that repeats makes texts similar, the shortest is nearest to all.)  A bucket whose members are then all in one component is settled.  The members of all other
buckets go through an exact search by prefix filtering: shingles have one global order, rare ones
first, and two documents that are similar enough share a shingle among those that come before the
last part of each, however many documents their buckets hold.  Pairs are verified exactly on the
shingles of the whole texts.  Groups are the connected components of the verified links.
"""

from __future__ import annotations

import hashlib
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, forget, identified, mix, prefix, ragged, released, rolled, spans, stored, utf8, with_rows, words
from .components import components

#: Words of a shingle, least similarity of a link, bands, and registers of a band.
SHINGLE, SIMILAR, BANDS, ROWS = 5, 0.8, 32, 4
#: Expected documents that tell which shingles are frequent, and the most of those that are told apart.
#: Both only decide the order of shingles; any order gives the same links.
ORDER_DOCS, ORDER_SHINGLES = 20_000, 1 << 20
#: Words of 64 bits that tell of a set how far it is from another one at least.
PARITY = 16


def shingles(data: np.ndarray, off: np.ndarray, size: int):
    """(row, shingle, weight) of the distinct shingles of each row, sorted.  A row of fewer words has one
    shingle, all its words; one without words has none."""
    starts, ends, at = words(data, off)
    p = prefix(rolled(prefix(data), starts, ends))
    n = np.diff(at)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = ragged(at[:-1], count)
    row = np.repeat(np.arange(len(n)), count)
    value = rolled(p, first, first + np.minimum(size, n[row]))
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])])) if len(row) else np.zeros(0, np.int64)
    return row[new], value[new], np.diff(np.append(new, len(row)))


def same_words(data: np.ndarray, off: np.ndarray) -> list[bytes]:
    """What texts with the same words in the same order, and no others, have in common: a SHA-256."""
    raw = data.tobytes()
    return [hashlib.sha256(b" ".join(raw[i:j].split())).digest() for i, j in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]


def signatures(row: np.ndarray, value: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """(rows, registers): the shingle that arrives first at each register."""
    time = np.full(rows * registers, np.inf)
    held = np.zeros(rows * registers, U64)
    limit = np.full(rows, np.inf)
    clock, alive, drawn, block = np.zeros(len(row)), np.arange(len(row)), 0, 1
    while len(alive):
        # ``block`` more arrivals of every element that is not past its row's registers
        number = np.arange(drawn + 1, drawn + block + 1, dtype=np.int64).astype(U64) * U64(0x9E3779B97F4A7C15)
        z = mix(value[alive][:, None] ^ mix(number)[None, :])
        u = ((z >> U64(11)).astype(np.float64) + 0.5) / float(1 << 53)
        at = clock[alive][:, None] + np.cumsum(-np.log(u) / weight[alive][:, None], axis=1)
        clock[alive] = at[:, -1]
        place = row[alive][:, None] * registers + (mix(z + U64(1)) % U64(registers)).astype(np.int64)
        i, j = np.nonzero(at < limit[row[alive]][:, None])
        t, k, v = at[i, j], place[i, j], value[alive][i]
        np.minimum.at(time, k, t)
        first = time[k] == t
        held[k[first]] = v[first]
        limit = time.reshape(rows, registers).max(1)
        alive = alive[clock[alive] < limit[row[alive]]]
        drawn += block
        block = min(2 * block, 256)
    return held.reshape(rows, registers)


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """(documents, bands): one hash of each run of ``rows`` registers, different for each band."""
    out = np.zeros((len(signature), signature.shape[1] // rows), U64)
    for r in range(rows):
        out = mix(out * U64(0x9E3779B97F4A7C15) + signature[:, r::rows][:, : out.shape[1]])
    return mix(out + np.arange(1, out.shape[1] + 1, dtype=np.int64).astype(U64)[None, :])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of probability Jaccard (on counts) and plain Jaccard of two sorted shingle lists."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    union = len(a[0]) + len(b[0]) - len(both)
    plain = len(both) / union if union else 0.0
    if plain >= SIMILAR or not len(both):
        return plain
    x, y = a[1].astype(float), b[1].astype(float)
    only_x, only_y = x.sum() - x[i].sum(), y.sum() - y[j].sum()
    total = 0.0
    pairs, n = np.unique(np.stack([x[i], y[j]]), axis=1, return_counts=True)
    for (p, q), times in zip(pairs.T, n, strict=True):
        total += times / (np.maximum(x[i] / p, y[j] / q).sum() + only_x / p + only_y / q)
    return max(plain, total)


def packed(value: np.ndarray, weight: np.ndarray) -> bytes:
    """A sorted list of shingles, with its weights if any shingle repeats."""
    many = len(weight) and weight.max() > 1
    return bytes([bool(many)]) + value.astype("<u8").tobytes() + (weight.astype("<u4").tobytes() if many else b"")


def read(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted shingles and weights of a packed list."""
    if raw[0]:
        n = (len(raw) - 1) // 12
        return np.frombuffer(raw, "<u8", n, 1), np.frombuffer(raw, "<u4", n, 1 + 8 * n)
    value = np.frombuffer(raw, "<u8", -1, 1)
    return value, np.ones(len(value), "<u4")


def leading(value: np.ndarray, weight: np.ndarray, frequency: np.ndarray, similar: float) -> np.ndarray:
    """Places of the shingles that a list must share one of with any list at least ``similar`` to it.

    Either similarity is at most the overlap of the two lists' shares, of shingles or of their counts.
    So from the first common shingle on, in the order of (frequency, value), each list holds a share of
    at least ``similar``: it is not in the rest that holds less."""
    order = np.lexsort((value, frequency))
    w = weight[order].astype(float)
    n = len(w)
    return order[((n - np.arange(n)) >= (similar - 1e-9) * n) | (w[::-1].cumsum()[::-1] >= (similar - 1e-9) * w.sum())]


def parity(value: np.ndarray) -> np.ndarray:
    """``PARITY`` whole numbers of 64 bits, a bit for each slot: whether an odd number of shingles falls there.
    Two sets that differ in n shingles differ in n bits at most."""
    odd = np.bincount((mix(value) % U64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def open_pairs(lists: DataFrame, similar: float) -> DataFrame:
    """(a, b): every pair of different labels that may be ``similar``.  lists: (doc_id, label, list)."""
    rate = min(1.0, ORDER_DOCS / max(1, lists.count()))

    @released
    def tokens(batches):
        for batch in batches:
            values = [read(x.as_py())[0] for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, "<u8"), *values]).astype(np.int64))], ["shingle"])

    drawn = lists.filter(F.pmod(F.xxhash64("doc_id", F.lit("order")), F.lit(1 << 30)) < rate * (1 << 30))
    often = drawn.select("list").mapInArrow(tokens, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").orderBy(F.desc("n"), "shingle").limit(ORDER_SHINGLES).toArrow()
    known, number = often["shingle"].to_numpy(), often["n"].to_numpy()
    by = np.argsort(known)
    # the sentinel is no shingle: every search ends at a place
    known, number = np.append(known[by], 1 << 62), np.append(number[by], 0)

    bits = [f"p{i}" for i in range(PARITY)]
    columns = ["doc_id", "label", "rest", "share", "n", "total", *bits]

    @released
    def prefixes(batches):
        for batch in batches:
            rows, values, rests, shares, sizes, sums, odd = [], [], [], [], [], [], []
            for k, x in enumerate(batch.column(2)):
                value, weight = read(x.as_py())
                at = np.searchsorted(known, value.astype(np.int64))
                place = leading(value, weight, np.where(known[at] == value.astype(np.int64), number[at], 0), similar)
                total = weight.sum(dtype=np.int64)
                rows.append(np.full(len(place), k))
                values.append(value[place].astype(np.int64))
                # what stands from a shingle on: how many, and their share of all counts
                rests.append(len(value) - np.arange(len(place)))
                shares.append(1 - (np.cumsum(weight[place]) - weight[place]) / max(1, total))
                sizes.append(np.full(len(place), len(value)))
                sums.append(np.full(len(place), total))
                odd.append(np.broadcast_to(parity(value), (len(place), PARITY)))
            if rows:
                row = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), batch.column(0).take(row), batch.column(1).take(row), *(pa.array(np.concatenate(x)) for x in (rests, shares, sizes, sums)), *map(pa.array, np.ascontiguousarray(np.concatenate(odd).T))], ["shingle", *columns])

    held = stored(lists.select("doc_id", "label", "list").mapInArrow(prefixes, f"shingle long, doc_id long, label long, rest long, share double, n long, total long, {', '.join(f'{p} long' for p in bits)}"), "prefixes")
    shared = held.groupBy("shingle").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("shingle")
    # the shared shingle before, in the list's order: lists that have the same one met there
    before = F.lag("shingle").over(Window.partitionBy("doc_id").orderBy(F.desc("rest")))
    held = stored(held.join(shared, "shingle", "left_semi").withColumn("before", before), "shared")
    x, y = (held.select("shingle", *(F.col(c).alias(c + side) for c in (*columns, "before"))) for side in "xy")
    # All that a pair has in common stands from its first common shingle on: that one's row passes if the
    # pair is similar.  Sets are similar if enough stands there and few enough shingles differ, and no
    # fewer do than parity bits; counts are, if enough of their shares stands there, and the shares that
    # differ, one count of the larger total for each differing shingle at least, are small enough
    both, s = F.col("nx") + F.col("ny"), similar - 1e-9
    apart = reduce(add, [F.bit_count(F.col(f"{p}x").bitwiseXOR(F.col(f"{p}y"))) for p in bits])
    sets = (F.least("restx", "resty") * (1 + s) >= s * both) & (apart * (1 + s) <= (1 - s) * both)
    counts = (F.least("sharex", "sharey") >= s) & (apart <= 2 * (1 - s) * F.greatest("totalx", "totaly"))
    # without repeats both similarities are the same
    alike = sets | (((F.col("totalx") > F.col("nx")) | (F.col("totaly") > F.col("ny"))) & counts)
    met = x.join(y, "shingle").filter("doc_idx < doc_idy and labelx <> labely and not coalesce(beforex = beforey, false)").filter(alike)
    return met.select(F.col("doc_idx").alias("a"), F.col("doc_idy").alias("b")).distinct()


def near_links(docs: DataFrame, reps: DataFrame, size: int, similar: float) -> DataFrame:
    """(a, b): verified links between documents of different word sequences.  reps: (doc_id, length, bands)."""
    held = reps.select("doc_id", "length", F.explode("bands").alias("band"))
    drawn = F.min_by("doc_id", F.xxhash64("doc_id", "band"))
    buckets = held.groupBy("band").agg(F.min("doc_id").alias("one"), drawn.alias("two"), F.min_by("doc_id", "length").alias("three"), F.max("doc_id").alias("last"), F.count("*").alias("n")).filter("one < last").select("band", "one", "two", "three", "n")
    met = stored(held.join(stored(buckets, "buckets"), "band"), "met")
    pairs = met.select("doc_id", F.explode(F.array_distinct(F.array("one", "two", "three"))).alias("leader")).filter("doc_id <> leader")
    pairs = stored(pairs.select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct(), "pairs")
    needed = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "needed")

    @released
    def lists(batches):
        for batch in batches:
            data, off = utf8(batch.column(1))
            ids = batch.column(0).to_numpy()
            for i, j in spans(off):
                row, value, weight = shingles(data[off[i] : off[j]], off[i : j + 1] - off[i], size)
                at = np.searchsorted(row, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([pa.array(ids[i:j]), pa.array([packed(value[a:b], weight[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["doc_id", "list"])

    known = stored(docs.join(needed, "doc_id", "left_semi").select("doc_id", "text").mapInArrow(lists, "doc_id long, list binary"), "lists")

    @released
    def verify(batches):
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            good = np.array([similarity(read(x.as_py()), read(y.as_py())) >= similar for x, y in zip(batch.column(2), batch.column(3), strict=True)], bool)
            yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], ["a", "b"])

    def verified(pairs: DataFrame) -> DataFrame:
        first = pairs.join(known.select(F.col("doc_id").alias("a"), F.col("list").alias("x")), "a")
        both = first.join(known.select(F.col("doc_id").alias("b"), F.col("list").alias("y")), "b")
        return stored(both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long"), "verified")

    links = verified(pairs)
    # a bucket of two is compared in full; one of more is settled if its members are in one component
    linked = components(links)
    labels = stored(linked.withColumnRenamed("node", "doc_id"), "labels")
    named = met.filter("n > 2").join(labels, "doc_id", "left").select("band", "doc_id", F.coalesce("label", "doc_id").alias("label"))
    unsettled = named.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("band")
    left = stored(named.join(unsettled, "band", "left_semi").select("doc_id", "label").distinct(), "left")
    lists_ = stored(known.join(left, "doc_id"), "open")
    more = verified(open_pairs(lists_, similar).join(pairs, ["a", "b"], "left_anti"))
    forget(met, pairs, needed, known, labels, left, lists_)
    return links.unionByName(more)


def near_groups(docs: DataFrame, id_col: str, text_col: str, size: int, similar: float, n_bands: int, rows: int) -> DataFrame:
    """(doc_id, h, class_id, kept) of each input row; h: the hash of its text."""
    table = identified(docs, id_col, text_col)
    registers = n_bands * rows

    @released
    def sign(batches):
        for batch in batches:
            data, off = utf8(batch.column(2))
            for i, j in spans(off):
                part, at = data[off[i] : off[j]], off[i : j + 1] - off[i]
                row, value, weight = shingles(part, at, size)
                keys = bands(signatures(row, value, weight, j - i, registers), rows)
                some = np.isin(np.arange(j - i), row)
                # the signature over the set is the same one where no shingle repeats
                again = np.unique(row[weight > 1])
                own = np.isin(row, again)
                extra = bands(signatures(np.searchsorted(again, row[own]), value[own], np.ones(own.sum()), len(again), registers), rows)
                owner = np.concatenate([np.repeat(np.flatnonzero(some), n_bands), np.repeat(again, n_bands)])
                both = np.concatenate([keys[some].ravel(), extra.ravel()])
                order = np.lexsort((both, owner))
                owner, both = owner[order], both[order]
                # a band that both signatures agree in is listed once
                new = np.append(True, (owner[1:] != owner[:-1]) | (both[1:] != both[:-1])) if len(owner) else np.zeros(0, bool)
                to = np.searchsorted(owner[new], np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], pa.array(same_words(part, at), pa.binary()), pa.array(np.bincount(row, weight, j - i).astype(np.int64)), pa.ListArray.from_arrays(to, pa.array(both[new].view(np.int64)))], ["doc_id", "h", "words", "length", "bands"])

    signed = stored(table.mapInArrow(sign, "doc_id long, h long, words binary, length long, bands array<long>"), "signed")
    first = signed.filter("doc_id is not null").groupBy("words").agg(F.min(F.struct("doc_id", "h")).alias("rep")).select("words", "rep.*")
    # classes meet under the doc_id of their first row; where rows repeat an id, under a hash of their own
    shared = first.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id", F.lit(True).alias("shared"))
    node = F.when(F.col("shared"), F.xxhash64("words", F.lit("class"))).otherwise(F.col("doc_id"))
    classes = stored(first.join(shared, "doc_id", "left").select("words", F.col("doc_id").alias("rep"), F.col("h").alias("rep_h"), node.alias("node")), "classes")
    reps = signed.join(classes.select("words", F.col("rep").alias("doc_id"), F.col("rep_h").alias("h"), "node"), ["words", "doc_id", "h"]).select(F.col("node").alias("doc_id"), "length", "bands")
    texts = table.join(classes.select(F.col("rep").alias("doc_id"), F.col("rep_h").alias("h"), "node"), ["doc_id", "h"]).select(F.col("node").alias("doc_id"), "text")
    labels = stored(components(near_links(texts, reps, size, similar)), "groups")
    linked = stored(classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")), "linked")
    least = linked.groupBy("label").agg(F.min(F.struct("rep", "rep_h")).alias("least"))
    known = linked.join(least, "label").select("words", "least", (F.struct("rep", "rep_h") == F.col("least")).alias("leads"))
    found = signed.select("doc_id", "h", "words").join(known, "words", "left")
    alone = F.col("doc_id").isNull()
    kept = F.col("leads") & (F.struct(F.col("doc_id").alias("rep"), F.col("h").alias("rep_h")) == F.col("least"))
    return found.select("doc_id", "h", F.when(~alone, F.col("least.rep")).alias("class_id"), F.when(alone, True).otherwise(F.coalesce(kept, F.lit(False))).alias("kept"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, similar: float = SIMILAR, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row for each input row: doc_id, class_id (the least doc_id of its group), kept.

    Texts with the same words in the same order are one class, and so are texts without any word
    (null, empty, white space); they meet the others through their first row, that of the least
    (doc_id, hash of text).  Two classes are linked if the probability Jaccard of their shingle counts,
    or the Jaccard of their shingle sets, is at least ``similar``; shorter texts have one shingle.  The
    first row of a group is kept.  Rows that repeat a doc_id are told apart by their texts; rows that
    repeat both are alike.  Rows with a null doc_id are kept with a null class.
    """
    return near_groups(docs, id_col, text_col, size, similar, n_bands, rows).drop("h")


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of ``docs``, with all columns, of each group, and all rows with a null doc_id.  Of rows that
    repeat doc_id and text, the one stays whose columns hash to the least."""
    keep = near_groups(docs, "doc_id", "text", SHINGLE, SIMILAR, BANDS, ROWS).filter("kept and doc_id is not null").groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    rows = with_rows(docs).select("doc_id", "h", "row")
    kept = rows.join(keep, ["doc_id", "h"])
    once = kept.filter("n = 1").select("row")
    again = kept.filter("n > 1").groupBy("doc_id", "h").agg(F.min_by("row", F.xxhash64("row")).alias("row")).select("row")
    return once.unionByName(again).unionByName(rows.filter("doc_id is null").select("row")).select("row.*")
