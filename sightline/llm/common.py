"""What the operators of this subpackage share: shared storage, Arrow text access and hashing.

Conventions that hold for every operator here
---------------------------------------------
* Only the key and text columns are read by name; others travel in one struct, whatever their names.
* A null text counts as an empty text.  A null ``doc_id`` takes part in no comparison with
  other documents and its row is returned unchanged (exact dedup compares it, as it needs no id).
* Rows that repeat a ``doc_id`` keep one output row each; joins use (doc_id, hash of text).
* Stages of a pipeline that keep one document of a group keep one row, also if rows repeat.
* An empty table gives an empty result of the same schema.
* Tables that cut lineage are written below ``spark.checkpoint.dir``.  ``localCheckpoint`` is
  never used, so a lost executor costs recomputation and never a result.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import forget, kept, ship  # noqa: F401  forget: for what is stored

U64 = np.uint64
#: Bytes of text that one vectorised step works on: its scratch arrays stay near 30 MB and inside the caches.
CHUNK = 1 << 18


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again (see ``session.kept``)."""
    return kept(df, name)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(spark: SparkSession) -> None:
    """Bounds what a Python worker holds at once; the workers get this package."""
    ship(spark)
    for name, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 8 << 20)):
        spark.conf.set(f"spark.sql.execution.arrow.{name}", most)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """(doc_id, h, text): null text is empty; h tells rows apart that share a doc_id.  more: columns to keep."""
    bounded_batches(docs.sparkSession)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(quoted(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"), *more)


def quoted(name: str):
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def with_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, text, row): ``identified`` and all columns as one struct."""
    return identified(docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).alias("text"), F.struct(*[quoted(c) for c in docs.columns]).alias("row")), "doc_id", "text", "row")


#: Bytes of text in a block at most, and at least where there are fewer blocks than shuffle partitions.
BLOCK, LEAST_BLOCK = 24 << 20, 1 << 20


def even_keys(n: int, partitions: int = 0) -> np.ndarray:
    """n numbers that hash partitioning into ``partitions`` (n if not given) deals out in turn: the i-th to
    partition i modulo ``partitions``."""
    partitions = partitions or n
    out, have, at = np.full(n, -1, np.int64), np.zeros(partitions, np.int64), 0
    while (out < 0).any():
        k = np.arange(at, at + max(1024, 4 * n), dtype=np.int64).astype(np.uint32)
        at += len(k)
        place = murmur(k) % partitions
        order = np.argsort(place, kind="stable")
        head = np.searchsorted(place[order], np.arange(partitions))
        turn = np.arange(len(k)) - head[place[order]] + have[place[order]]
        slot = turn * partitions + place[order]
        out[slot[slot < n]] = k[order][slot < n]
        have += np.bincount(place, minlength=partitions)
    return out


def murmur(k: np.ndarray, seed: int = 42) -> np.ndarray:
    """Murmur3 of 32-bit integers, as Spark's hash partitioning has it."""
    turn = lambda x, r: (x << np.uint32(r)) | (x >> np.uint32(32 - r))
    h = np.uint32(seed) ^ (turn(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593))
    h = (turn(h, 13) * np.uint32(5) + np.uint32(0xE6546B64)) ^ np.uint32(4)
    for shift, m in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ (h >> np.uint32(shift))) * np.uint32(m)
    return (h ^ (h >> np.uint32(16))).view(np.int32).astype(np.int64)


def in_blocks(table: DataFrame, block: int = BLOCK) -> tuple[DataFrame, int, int]:
    """(``table`` with ``block``, blocks, bytes of text).  table: (doc_id, h, text, ...).

    Blocks hold about ``block`` bytes.  Their numbers are ones that hash partitioning into as many
    partitions deals to a partition each."""
    size = table.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block), min(parts(table.sparkSession), -(-size // min(block, LEAST_BLOCK))))
    number = F.get(F.split(F.lit(",".join(map(str, even_keys(n)))), ",").cast("array<int>"), F.pmod(F.xxhash64("doc_id", "h"), F.lit(n)).cast("int"))
    return table.withColumn("block", number), n, size


def held_out(column: str, mod: int, rest: int):
    """Whether crc32(id as text) leaves ``rest`` modulo ``mod``; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % mod == rest, F.lit(False))


def released(f):
    """A function over Arrow batches that gives memory back to the system when it ends: a worker stays for
    the next task, and what it keeps counts against its executor."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            release()

    return run


def returned(f):
    """The same for a function over a group, or over two: memory goes back after each group, before the next one's."""

    def run(a, b):  # Spark counts the parameters
        try:
            return f(a, b)
        finally:
            release()

    return run


def release() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not (wide or pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def spans(off: np.ndarray, most: int = CHUNK):
    """Row ranges [i, j) of at most ``most`` bytes, or of a single row that is longer."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, "right")) - 1)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, elementwise."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Hashes are polynomials modulo this prime: two strings of n symbols collide for n of all bases at most.
PRIME = U64((1 << 61) - 1)
LOW30, LOW31 = U64((1 << 30) - 1), U64((1 << 31) - 1)
#: Symbols that one step of a prefix sum takes: its partial sums stay below 2**64.
STEP = 1 << 22


def folded(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    x = (x & PRIME) + (x >> U64(61))
    return x - PRIME * (x >= PRIME)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of numbers below it."""
    a1, a0, b1, b0 = a >> U64(31), a & LOW31, b >> U64(31), b & LOW31
    mid = a1 * b0 + a0 * b1
    return folded(((a1 * b1) << U64(1)) + (mid >> U64(30)) + ((mid & LOW30) << U64(31)) + a0 * b0)


class Powers:
    """Powers of a base modulo PRIME and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, int(PRIME))
        self.up = self.down = np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, b in (("up", self.base), ("down", self.inverse)):
                p = np.ones(1, U64)
                while len(p) < size:
                    p = np.concatenate([p, times(p, U64(pow(b, len(p), int(PRIME))))])
                setattr(self, name, p)
        return self.up, self.down


#: Two bases, for hashes that are independent of each other.
POWERS, OTHER = Powers(0x1D8AF066F5A1C20B), Powers(0x0B3F1E5A9C47D6E5)


def prefix(symbols: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """Rabin-Karp prefix sums: P[i] = sum of symbols[j] * base**j over j < i, modulo PRIME.

    Symbols are bytes (counted from 1, so that leading ones count) or numbers below PRIME."""
    n = len(symbols)
    up, _ = powers.to(n + 1)
    out = np.zeros(n + 1, U64)
    for i in range(0, n, STEP):
        x, b = symbols[i : i + STEP], up[i : min(n, i + STEP)]
        if x.dtype == np.uint8:
            x = x.astype(U64) + U64(1)
            low, high = np.cumsum(x * (b & LOW31)), np.cumsum(x * (b >> U64(31)))
        else:
            x = times(x, b)
            low, high = np.cumsum(x & LOW31), np.cumsum(x >> U64(31))
        high = folded(high)
        out[i + 1 : i + 1 + len(x)] = folded(((high & LOW30) << U64(31)) + (high >> U64(30)) + folded(low) + out[i])
    return out


def rolled(p: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """Hashes, below PRIME, of symbols[start:end]; equal strings have equal hashes wherever they stand."""
    _, down = powers.to(len(p))
    return times(folded(p[end] + (PRIME - p[start])), down[start])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words [^\\x20\\x09-\\x0D]+ and each row's first word (n + 1 offsets)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    space = _SPACE[data]
    inner = off[1:-1]
    inner = inner[inner < len(data)]
    before = np.concatenate([[True], space[:-1]])
    before[inner] = True
    after = np.concatenate([space[1:], [True]])
    after[inner[inner > 0] - 1] = True
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, off)


class Lookup:
    """Places of uint64 values in a sorted array of distinct ones: one probe for nearly all."""

    def __init__(self, keys: np.ndarray, room: int = 2):
        """room: slots for each key, about; more of them take memory and save searches."""
        self.keys = keys
        self.shift = U64(64 - max(4, min(22, int(room * max(1, len(keys))).bit_length())))
        self.slots = np.zeros(1 << (64 - int(self.shift)), np.int32)
        self.slots[self.at(keys)] = np.arange(len(keys), dtype=np.int32)

    def at(self, q: np.ndarray) -> np.ndarray:
        return (q * U64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, q: np.ndarray) -> np.ndarray:
        """The place of each value, or -1."""
        if not len(self.keys):
            return np.full(len(q), -1, np.int32)
        i = self.slots[self.at(q)]
        odd = np.flatnonzero(self.keys[i] != q)
        if len(odd):
            j = np.searchsorted(self.keys, q[odd]).clip(max=len(self.keys) - 1)
            i[odd] = np.where(self.keys[j] == q[odd], j, -1)
        return i


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... for each run, one after another."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(np.asarray(starts, np.int64) - (np.cumsum(lengths) - lengths), lengths)


def planes(values: np.ndarray, size: int = 0) -> bytes:
    """Little-endian integers as ``size`` planes of bytes, the lowest first: what they share compresses well."""
    raw = values.view(np.uint8).reshape(len(values), values.itemsize)
    return np.ascontiguousarray(raw[:, : size or values.itemsize].T).tobytes()


def unplanes(raw: bytes, n: int, size: int, kind: str) -> np.ndarray:
    """The integers that ``planes`` packed; bytes that it left out are zero."""
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, n).T
    return out.reshape(-1).view(kind)


#: Bytes of a record batch that goes back to Spark, about: it holds a batch outside its heap.
BATCH = 4 << 20
TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def records(rows: list[tuple], fields: str):
    """Record batches of bounded size of rows of numbers and bytes.  fields: as in a schema's text."""
    names, kinds = zip(*(f.split() for f in fields.split(", ")), strict=True)
    at = 0
    while at < len(rows) or not at:
        stop, size = at, 0
        while stop < len(rows) and size < BATCH:
            size += 16 + sum(len(x) for x in rows[stop] if isinstance(x, bytes))
            stop += 1
        some = rows[at:stop]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in some], TYPES[kinds[k]]) for k in range(len(names))], list(names))
        at = stop
        if not rows:
            return


class Rows:
    """The rows of a block's texts, by (doc_id, hash of text); rows that repeat both are one."""

    def __init__(self, ids: list, tags: list):
        first: dict[tuple, int] = {}
        self.own = np.array([first.setdefault(k, i) for i, k in enumerate(zip(ids, tags, strict=True))], np.int64)
        self.first, self.n = first, len(self.own)

    def of(self, ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
        return np.array([self.first[k] for k in zip(ids.tolist(), tags.tolist(), strict=True)], np.int64)

    def slices(self, row: np.ndarray, order: np.ndarray) -> list[slice]:
        """Where each row's entries stand among row[order], which is sorted."""
        at = np.searchsorted(row[order], np.arange(self.n + 1))
        return [slice(int(at[i]), int(at[i + 1])) for i in self.own]


def joined(rows: list[dict], name: str, kind: str) -> np.ndarray:
    """The numbers, one a run, that ``planes`` packed in a column, one row's after another's."""
    size = np.dtype(kind).itemsize
    return np.concatenate([np.zeros(0, kind), *(unplanes(r[name], len(r[name]) // size, size, kind) for r in rows)])


def packed_runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value and the length of each run of equal values."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return values[head], np.diff(np.append(head, len(values)))
