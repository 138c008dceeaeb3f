"""Exact top-k inner-product search by the three-phase uniform threshold.

The components of the vectors are split into ``LISTS`` dimension blocks; each block is a list of
partial scores, and a score is the sum over the lists.

1. Every list gives its own k best entries a query, of one vector block in ``FIRST``.  Only their
   exact scores are computed; the k-th best of a query bounds its result from below: the cutoff.
2. Each query's cutoff goes to all lists.  A vector that reaches it has at least one partial score
   of cutoff / LISTS, and partial scores that add up to it.  Lists are multiplied in single precision
   (double where numbers are large), and entries that stay below either bound are left out.
3. The exact scores of the entries that are left are resolved in whole numbers, and the k best kept.

Vectors and queries are packed into blocks of bounded size and met block by block on a grid: a
vector block goes to the cells of its row, a query block to those of its column, and cells are as
many as shuffle partitions.  No key holds all blocks, and no side is collected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, quoted, released, stored

#: Lists that a score is the sum of, results a query, rows of a vector block and of a query block, and
#: vector blocks of which the first phase reads one.
LISTS, K, ROWS, QUERIES, FIRST = 4, 5, 4096, 1024, 4


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component, as double; rows with a null id, a null vector,
    an empty one, or one that holds a null or a value that isn't finite are left out."""
    v = F.transform(quoted(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(quoted(id_col).cast("long").alias("vec_id"), v.alias("raw")).filter("vec_id is not null and size(raw) > 0")
    rows = rows.filter(F.coalesce(F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    return rows.select("vec_id", F.transform("raw", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """(dims, ids, data) blocks of at most ``size`` rows of one length, packed where they are."""

    @released
    def pack(batches):
        for batch in batches:
            lists = batch.column(1)
            flat, off = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            off, ids = off - off[0], batch.column(0).to_numpy()
            width = np.diff(off)
            for dims in np.unique(width).tolist():
                at = np.flatnonzero(width == dims)
                for i in range(0, len(at), size):
                    some = at[i : i + size]
                    block = flat[(off[some][:, None] + np.arange(dims)).ravel()]
                    yield pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), pa.array([ids[some].astype("<i8").tobytes()], pa.binary()), pa.array([block.astype("<f8").tobytes()], pa.binary())], ["dims", "ids", "data"])

    return rows.mapInArrow(pack, "dims int, ids binary, data binary")


def matrix(ids: bytes, data: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, "<f8").reshape(-1, dims)


def bounds(dims: int, lists: int) -> list[tuple[int, int]]:
    cut = np.linspace(0, dims, min(lists, dims) + 1).astype(int).tolist()
    return list(zip(cut[:-1], cut[1:], strict=True))


class Tile:
    """A query block next to a vector block: partial scores of all pairs, exact scores of some."""

    def __init__(self, row: dict, lists: int):
        self.own, self.v = matrix(row["ids"], row["data"], row["dims"])
        self.asked, self.q = matrix(row["q_ids"], row["q_data"], row["dims"])
        #: no sum of products is larger
        self.most = float(np.abs(self.q).max(initial=0) * np.abs(self.v).max(initial=0) * row["dims"])
        #: what partial scores may be off by: nothing while all sums are whole numbers that fit
        self.slack = 0.0 if self.most < 2**53 else self.most * 2.0**-40
        kind = np.float32 if self.most < 2**24 else np.float64
        q, v = self.q.astype(kind), self.v.astype(kind)
        self.lists = [q[:, a:b] @ v[:, a:b].T for a, b in bounds(row["dims"], lists)]
        self.same = self.asked[:, None] == self.own[None, :]

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The scores of queries i with vectors j, in whole numbers; those beyond 64 bits are cut to them."""
        if self.most < 2**53:
            return np.einsum("ij,ij->i", self.q[i], self.v[j]).astype(np.int64)
        edge = 2**63 - 1
        pairs = zip(self.q[i].tolist(), self.v[j].tolist(), strict=True)
        return np.array([max(-edge, min(edge, sum(int(x) * int(y) for x, y in zip(a, b, strict=True)))) for a, b in pairs], np.int64)


def best_of_each(i: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each i, ties to the smaller id."""
    order = np.lexsort((ids, np.invert(score), i))
    i = i[order]
    head = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.zeros(0, np.int64)
    place = np.arange(len(i)) - np.repeat(head, np.diff(np.append(head, len(i))))
    return order[place < k]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, lists: int = LISTS, rows: int = ROWS, query_rows: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query (all, if fewer).

    Scores are inner products of floor(scale * x); ties go to the smaller vec_id.  Vectors that are
    null or hold a null or non-finite component take no part; vectors of another length than the
    query aren't compared.  A score beyond 64 bits is cut to them.  Rows that repeat an id count as rows, and a query meets no row of its id.
    """
    blocks = stored(packed(quantised(vectors, id_col, vector_col, scale), rows), "vectors")
    asked = stored(packed(quantised(queries, id_col, vector_col, scale), query_rows).withColumn("q", F.monotonically_increasing_id()), "queries")
    # cells: the larger side is copied to fewer of them
    cells = parts(vectors.sparkSession)
    columns = max(1, round((cells * max(1, asked.count()) / max(1, blocks.count())) ** 0.5))
    columns = min(columns, cells)
    lines = max(1, -(-cells // columns))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def tiles(some: DataFrame, q: DataFrame) -> DataFrame:
        """Each vector block next to each query block of its length."""
        v = some.withColumn("line", F.pmod(F.xxhash64("ids"), F.lit(lines)).cast("int")).withColumn("column", every(columns))
        q = q.withColumnsRenamed({"ids": "q_ids", "data": "q_data"}).withColumn("column", F.pmod(F.xxhash64("q"), F.lit(columns)).cast("int")).withColumn("line", every(lines))
        return q.join(v, ["dims", "line", "column"])

    @released
    def first(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tile = Tile(row, lists)
                named = []
                for p in tile.lists:
                    p[tile.same] = -np.inf
                    top = np.argpartition(p, max(0, p.shape[1] - k), axis=1)[:, -k:] if p.shape[1] > k else np.tile(np.arange(p.shape[1]), (len(p), 1))
                    named.append(top)
                at = np.unique(np.arange(len(tile.asked))[:, None] * len(tile.own) + np.concatenate(named, 1))
                i, j = at // len(tile.own), at % len(tile.own)
                other = ~tile.same[i, j]
                i, j = i[other], j[other]
                score = tile.exact(i, j)
                keep = best_of_each(i, score, tile.own[j], k)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), row["q"])), pa.array(i[keep].astype(np.int32)), pa.array(score[keep])], ["q", "i", "score"])

    @released
    def collect(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tile = Tile(row, lists)
                cut = np.frombuffer(row["cuts"], "<i8")
                # the lowest score stands for all below it
                cut = np.where(cut <= lowest, -np.inf, cut.astype(np.float64))[:, None]
                # no list reaches cutoff / lists, or their sum stays below it: then the score does too
                least = cut / len(tile.lists) - tile.slack
                reached, total = tile.lists[0] >= least, tile.lists[0].astype(np.float64)
                for p in tile.lists[1:]:
                    reached |= p >= least
                    total += p
                i, j = np.nonzero(reached & (total >= cut - tile.slack) & ~tile.same)
                score = tile.exact(i, j)
                keep = best_of_each(i, score, tile.own[j], k)
                yield pa.RecordBatch.from_arrays([pa.array(tile.asked[i[keep]]), pa.array(tile.own[j[keep]]), pa.array(score[keep])], ["query_id", "vec_id", "score"])

    lowest = -(1 << 63) + 1
    some = blocks.filter(F.pmod(F.xxhash64("ids", F.lit("first")), F.lit(FIRST)) == 0)
    near = tiles(some, asked).mapInArrow(first, "q long, i int, score long")
    nth = F.row_number().over(Window.partitionBy("q", "i").orderBy(F.desc("score")))
    cuts = near.withColumn("nth", nth).filter(F.col("nth") <= k).filter(F.col("nth") == k).select("q", "i", F.col("score").alias("cut"))

    @released
    def table(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cut = np.full(len(row["ids"]) // 8, lowest, "<i8")
                for entry in row["found"] or ():
                    cut[entry["i"]] = entry["cut"]
                yield pa.RecordBatch.from_arrays([pa.array([row["q"]], pa.int64()), pa.array([cut.tobytes()], pa.binary())], ["q", "cuts"])

    # at most ``query_rows`` entries a row
    gathered = cuts.groupBy("q").agg(F.collect_list(F.struct("i", "cut")).alias("found"))
    cutoffs = stored(asked.select("q", "ids").join(gathered, "q", "left").mapInArrow(table, "q long, cuts binary"), "cutoffs")
    exact = tiles(blocks, asked.join(cutoffs, "q")).mapInArrow(collect, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return exact.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_fiftieth(embeddings: DataFrame) -> DataFrame:
    """The five best others of every vector whose id is divisible by 50."""
    return top_k(embeddings, embeddings.filter(F.col("vec_id") % 50 == 0))
