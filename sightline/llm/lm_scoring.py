"""Language-model scoring by prediction by partial matching, trained on the whole corpus.

The byte-context trie grows with the corpus, so no task holds it and it is never broadcast:

1. Every training text adds to counts of grams (four context bytes and a byte) and of words.
2. Grams that share their last two context bytes share every trie node from there up, so their
   code lengths come out of one task; only orders 0 and 1, at most 257 + 257 * 258 counts, are
   sent to all.
3. Texts are dealt into blocks of bounded size, one a partition.  A block asks for its own distinct
   grams and words, gets their code lengths and counts by joins, and scores its texts with them.

Words are counted as they are, long ones by their SHA-256, so different words are never one.
Escapes follow method D with symbol exclusion.  Counts are frozen before any text is scored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ppm
from .common import BLOCK, U64, Lookup, held_out, identified, in_blocks, released, spans, stored, utf8

ORDER = 4
WORD, GRAM = 0, 1
#: The longest word that is its own key, and the key of a text's end: a space is in no word.
LONG_WORD, END_KEY = 32, b" "


def word_key(word: bytes) -> bytes:
    return word if len(word) <= LONG_WORD else END_KEY + hashlib.sha256(word).digest()


def word_lists(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The keys of the distinct words of lower-cased rows; each word's row and its place among the keys."""
    column = column.fill_null("") if column.null_count else column
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column))
    coded = lists.flatten().dictionary_encode()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    row = np.repeat(np.arange(len(column)), lists.value_lengths().to_numpy(zero_copy_only=False))
    index = coded.indices.to_numpy(zero_copy_only=False)
    # an empty entry stands for white space at a text's ends
    if b"" in names:
        some = index != names.index(b"")
        row, index = row[some], index[some]
    return [word_key(w) if w else w for w in names], row, index


def lowered_chunks(column: pa.Array):
    """(first row, last row, bytes, offsets) of groups of whole rows, lower-cased."""
    data, off = utf8(column)
    for i, j in spans(off):
        yield i, j, ppm.lowered(data[off[i] : off[j]]), off[i : j + 1] - off[i]


class Tally:
    """Sums by key of a stream, held as sorted arrays that are merged when they have doubled."""

    def __init__(self, most: int = 1 << 21):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.fresh, self.most = 0, most

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.fresh += len(keys)
        if self.fresh > self.most:
            self.merge()
            self.most = max(1 << 21, 2 * self.fresh)

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if len(self.parts) != 1:
            self.parts = [ppm.counted(np.concatenate([p[0] for p in self.parts] or [np.zeros(0, U64)]), np.concatenate([p[1] for p in self.parts] or [np.zeros(0, np.int64)]))]
        self.fresh = len(self.parts[0][0])
        return self.parts[0]


def emit(tally: Tally, words: dict[bytes, int], block: int | None = None, step: int = 200_000):
    """Rows (kind, key, word, n), or (block, kind, key, word) for a block."""
    keys, n = tally.merge()
    found = list(words)
    for kind, size in ((GRAM, len(keys)), (WORD, len(found))):
        for i in range(0, size, step):
            m = min(step, size - i)
            columns = {"block": pa.array(np.full(m, block or 0, np.int32)), "kind": pa.array(np.full(m, kind, np.int8))}
            if kind == GRAM:
                columns |= {"key": pa.array(keys[i : i + m].astype(U64).view(np.int64)), "word": pa.array([b""] * m, pa.binary()), "n": pa.array(n[i : i + m])}
            else:
                columns |= {"key": pa.array(np.zeros(m, np.int64)), "word": pa.array(found[i : i + m], pa.binary()), "n": pa.array([words[w] for w in found[i : i + m]], pa.int64())}
            names = ["kind", "key", "word", "n"] if block is None else ["block", "kind", "key", "word"]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names)


def corpus_counts(rows: DataFrame, order: int) -> DataFrame:
    """(kind, key, word, n): training counts of all words and grams; grams of other texts have n = 0.
    rows: train (boolean), text."""

    @released
    def count(batches):
        gram, words = Tally(), {}
        for batch in batches:
            train = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for i, j, data, off in lowered_chunks(batch.column(1)):
                counts = np.repeat(train[i:j].astype(np.int64), np.diff(off) + 1)
                keys, _ = ppm.grams(data, off, order)
                if counts.all():
                    gram.add(*ppm.distinct(keys))
                else:
                    for learn in (True, False):
                        k, n = ppm.distinct(keys[(counts > 0) == learn])
                        gram.add(k, n * learn)
            if train.any():
                names, _, index = word_lists(batch.column(1).filter(batch.column(0)))
                for w, n in zip(names, np.bincount(index, minlength=len(names)).tolist(), strict=True):
                    if n:
                        words[w] = words.get(w, 0) + n
                words[END_KEY] = words.get(END_KEY, 0) + int(train.sum())
        yield from emit(gram, words)

    return rows.mapInArrow(count, "kind byte, key long, word binary, n long").groupBy("kind", "key", "word").agg(F.sum("n").alias("n"))


def gram_costs(counts: DataFrame, order: int) -> DataFrame:
    """(key, value): log10 probability of each gram's symbol after its context."""
    mask = (1 << (2 * ppm.BITS)) - 1
    low = counts.filter(F.col("n") > 0).groupBy(F.expr(f"key & {mask}").alias("gram")).agg(F.sum("n").alias("n")).toArrow()
    # at most 258 * 257 rows: all pairs of a context symbol and a coded symbol
    low_keys, low_counts = low["gram"].to_numpy().astype(U64), low["n"].to_numpy()
    roots = ppm.Model(1, low_keys, low_counts).levels

    def cost(table: pa.Table) -> pa.Table:
        keys, n = table["key"].to_numpy().view(U64), table["n"].to_numpy()
        bits = Branch(order, keys[n > 0], n[n > 0], roots).bits(keys)
        return pa.table({"key": table["key"], "value": pa.array(-bits * math.log10(2))})

    branch = F.expr(f"shiftright(key, {ppm.BITS}) & {mask}")
    return counts.select("key", "n", branch.alias("branch")).groupBy("branch").applyInArrow(cost, "key long, value double")


class Branch(ppm.Model):
    """The part of the trie below a two-byte context, on top of the given orders 0 and 1."""

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray, roots: list):
        tables = [ppm.counted(keys, counts)]
        for length in range(order, 2, -1):
            k, n = tables[-1]
            tables.append(ppm.counted(k & ppm.gram_mask(length), n))
        self.order, self.levels = order, list(roots)
        for length, (k, n) in enumerate(reversed(tables), 2):
            self.levels.append(ppm.Level(k, n, self.levels[-1], length))


def score(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, block: int = BLOCK) -> DataFrame:
    """One row for each input row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` is a boolean column over doc_id (null: not learned from).  Null and empty texts have
    one token, their end.  ``score`` is the log10 probability of the whole lower-cased text and its
    end under the trie; ``base_score`` that of its words under add-one word counts.  With no
    training text the counts are zero and every symbol is equally likely.
    """
    table = identified(docs, id_col, text_col)
    counts = stored(corpus_counts(table.select(F.coalesce(train, F.lit(False)).alias("train"), "text"), order), "counts")
    totals = counts.filter(F.col("kind") == WORD).agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, kinds = totals["n"] or 0, totals["v"]
    numbered, blocks, _ = in_blocks(table, block)
    costs = gram_costs(counts.filter(F.col("kind") == GRAM).select("key", "n"), order)
    known = counts.filter(F.col("kind") == WORD).select("kind", "key", "word", F.col("n").cast("double").alias("value"))
    values = known.unionByName(costs.select(F.lit(GRAM).cast("byte").alias("kind"), "key", F.lit(b"").alias("word"), "value"))
    dealt = numbered.select("block", "doc_id", "text").repartition(blocks, "block")

    @released
    def wanted(batches):
        tallies: dict[int, tuple[Tally, dict]] = {}
        for batch in batches:
            number = batch.column(0).to_numpy()
            for b in np.unique(number).tolist():
                some = batch.filter(pa.array(number == b)) if (number != b).any() else batch
                gram, words = tallies.setdefault(b, (Tally(), {}))
                for _, _, data, off in lowered_chunks(some.column(2)):
                    gram.add(*ppm.distinct(ppm.grams(data, off, order)[0]))
                words.update(dict.fromkeys(filter(None, word_lists(some.column(2))[0]), 0))
        for b, (gram, words) in tallies.items():
            yield from emit(gram, words | {END_KEY: 0}, b)

    needs = dealt.mapInArrow(wanted, "block int, kind byte, key long, word binary").join(values, ["kind", "key", "word"]).select("block", "kind", "key", "word", "value")

    def rate(texts: pa.Table, found: pa.Table) -> pa.Table:
        kind, key, value = (found[k].to_numpy() for k in ("kind", "key", "value"))
        own = np.flatnonzero(kind == GRAM)
        own = own[np.argsort(key[own].view(U64))]
        grams, cost = Lookup(key[own].view(U64), 8), value[own]
        own = np.flatnonzero(kind == WORD)
        counted = dict(zip(found["word"].take(pa.array(own)).to_pylist(), value[own].tolist(), strict=True))
        rows = []
        for batch in texts.select(["doc_id", "text"]).to_batches():
            names, row, index = word_lists(batch.column(1))
            n = np.array([counted.get(w, 0.0) for w in names], float)[index]
            end = counted.get(END_KEY, 0.0)
            sums = lambda x, last: np.bincount(row, x, batch.num_rows) + last  # noqa: E731, B023
            size = (np.bincount(row, minlength=batch.num_rows) + 1).astype(np.int64)
            bits = [np.zeros(0)]
            for _, _, data, off in lowered_chunks(batch.column(1)):
                keys, at = ppm.grams(data, off, order)
                bits.append(np.add.reduceat(cost[grams.find(keys)], at[:-1]))
            least = total + kinds + 1
            columns = [size, sums(n > 0, end > 0).astype(np.int64), np.full(batch.num_rows, total), sums(np.log10((n + 1) / least), math.log10((end + 1) / least)), np.concatenate(bits)]
            rows.append(pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names_))
        return pa.Table.from_batches(rows, schema) if rows else schema.empty_table()

    names_ = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = pa.schema([*((n, pa.int64()) for n in names_[:4]), *((n, pa.float64()) for n in names_[4:])])
    return dealt.groupBy("block").cogroup(needs.groupBy("block")).applyInArrow(rate, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the scores of every document, learned from those with remainder other than 2 of 7."""
    out = score(docs, ~held_out("doc_id", 7, 2))
    return out.select("doc_id", held_out("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
