"""Language identification by prediction by partial matching.

Each language has a variable-order byte context trie with escape probabilities, fitted on a
bounded sample of labelled texts and then frozen.  A text has the language that codes it in the
fewest bits; the code lengths are exact sums over every byte of the whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import ppm
from .common import Lookup, bounded_batches, held_out, identified, quoted, released, spans, utf8

ORDER = 3
#: Expected labelled texts that are learned from, of a language, at least of any, and of all; the most
#: characters and pieces of each text; the most languages whose list is broadcast; entries of a dense table.
SAMPLE_DOCS, LEAST_DOCS, ALL_DOCS, SAMPLE_CHARS, SAMPLE_PIECES, BROADCAST, DENSE = 1500, 8, 60_000, 20_000, 10, 100_000, 1 << 24
UNKNOWN = "und"


def pieces(text):
    """A text of at most SAMPLE_CHARS characters whole; of a longer one, as many characters in pieces of
    equal length, spread evenly from its start to its end."""
    size, n = SAMPLE_CHARS // SAMPLE_PIECES, F.length(text)
    starts = [F.floor((n - size) * k / (SAMPLE_PIECES - 1)).cast("int") + 1 for k in range(SAMPLE_PIECES)]
    return F.when(n <= SAMPLE_CHARS, F.array(text)).otherwise(F.array(*[F.substring(F.col(text), at, F.lit(size)) for at in starts]))


def fit(labelled: DataFrame, order: int = ORDER, sample: int = SAMPLE_DOCS, total: int = ALL_DOCS) -> dict[str, ppm.Model]:
    """The model of every value of ``lang``, however many there are.  labelled: doc_id, text, lang (rows
    with a null are left out).

    Long texts are learned from pieces, so a language all of whose texts are long has a model too.  The
    sample takes the texts whose hashed id is below a threshold set by the language's count, and the
    least of each language in any case, so it costs no shuffle of texts; what reaches the driver is
    grams, bounded by the sample."""
    spark = labelled.sparkSession
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    rows = labelled.filter("lang is not null and text is not null").select("lang", "text", draw.alias("draw"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    if not sizes:
        return {}
    each = min(sample, max(LEAST_DOCS, total // len(sizes)))
    most = spark.createDataFrame([(r["lang"], max(r["least"], each / r["n"])) for r in sizes], "lang string, most double")
    chosen = rows.join(F.broadcast(most) if len(sizes) <= BROADCAST else most, "lang").filter("draw <= most").select("lang", F.explode(pieces("text")).alias("text"))

    @released
    def count(batches):
        for batch in batches:
            langs = batch.column(0).to_pylist()
            data, off = utf8(batch.column(1))
            by: dict[str, list] = {}
            for i, lang in enumerate(langs):
                by.setdefault(lang, []).append(i)
            for lang, rows_ in by.items():
                text = np.concatenate([data[off[i] : off[i + 1]] for i in rows_])
                keys, _ = ppm.grams(ppm.lowered(text), np.append(0, np.cumsum([off[i + 1] - off[i] for i in rows_])), order)
                k, n = ppm.distinct(keys)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    table = chosen.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    coded = table["lang"].combine_chunks().dictionary_encode()
    number, names = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    by = np.argsort(number, kind="stable")
    cut = np.searchsorted(number[by], np.arange(len(names) + 1))
    gram, n = table["gram"].to_numpy().astype(np.uint64), table["n"].to_numpy()
    return {names[i]: ppm.Model(order, gram[some := by[cut[i] : cut[i + 1]]], n[some]) for i in sorted(range(len(names)), key=names.__getitem__)}


class Scorer:
    """Code lengths of texts under several models.  Where it stays small, a table has those of the grams that
    any model knows; all others are computed once for each distinct gram of a piece of text."""

    def __init__(self, models: dict[str, ppm.Model], order: int = ORDER):
        self.order, self.names, self.models = order, list(models), list(models.values())
        known = np.unique(np.concatenate([m.levels[order].grams.keys for m in self.models])) if models else np.zeros(0, np.uint64)
        known = known if len(known) * len(self.models) <= DENSE else known[:0]
        self.known = Lookup(known)
        self.table = np.stack([m.bits(known) for m in self.models], 1).astype(np.float32) if models else np.zeros((0, 0), np.float32)

    def bits(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """(rows, languages): bits that code each whole row."""
        out = np.zeros((len(off) - 1, len(self.names)))
        for i, j in spans(off):
            part = off[i : j + 1] - off[i]
            keys, at = ppm.grams(ppm.lowered(data[off[i] : off[j]]), part, self.order)
            place = self.known.find(keys)
            odd = np.flatnonzero(place < 0)
            new, back = np.unique(keys[odd], return_inverse=True)
            for k, model in enumerate(self.models):
                cost = self.table[:, k][place].astype(np.float64) if len(self.table) else np.zeros(len(keys))
                if len(new):
                    cost[odd] = model.bits(new).astype(np.float32)[back]
                out[i:j, k] = np.add.reduceat(cost, at[:-1])
        return out


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether each row has a character that Unicode calls a letter."""
    out = np.zeros(len(off) - 1, bool)
    for i, j in spans(off):
        at = off[i : j + 1] - off[i]
        sums = np.concatenate([[0], np.cumsum(_LETTER[data[off[i] : off[j]]], dtype=np.int32)])
        out[i:j] = sums[at[1:]] > sums[at[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in data[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predictions(scorer: Scorer, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language of each text and its share of the likelihood."""
    data, off = utf8(texts)
    names = np.array([*scorer.names, UNKNOWN], object)
    pick, score = np.full(len(off) - 1, len(scorer.names)), np.zeros(len(off) - 1)
    if scorer.names and len(pick):
        bits = scorer.bits(data, off)
        letter = has_letter(data, off)
        pick[letter] = bits.argmin(1)[letter]
        score[letter] = (1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1))[letter]
    return names[pick].tolist(), score


def language_id(docs: DataFrame, models: dict[str, ppm.Model], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, lang_pred, score (the chosen language's share of the
    likelihood, 0 to 1).  Null texts and texts without a letter are ``und`` with score 0, and so is
    all if there is no model.  Ties go to the language that sorts first."""
    scorer = Scorer(models)

    @released
    def predict(batches):
        for batch in batches:
            lang, score = predictions(scorer, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return identified(docs, id_col, text_col).select("doc_id", "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")


def training_rows(docs: DataFrame) -> DataFrame:
    """The labelled rows that may be learned from: crc32(doc_id as text) mod 4 is not 2."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(~held_out("doc_id", 4, 2))


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the other three quarters."""
    return language_id(docs, fit(training_rows(docs))).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def with_language(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which a language is found; rows pass as they are, without a shuffle.
    Where there is no labelled text to learn from, only null texts and texts without a letter go."""
    scorer = Scorer(fit(training_rows(docs)))
    bounded_batches(docs.sparkSession)
    names = docs.columns
    # inside, columns go by their place: Arrow takes any name, the schema's text form doesn't
    plain = docs.select(*[quoted(c).alias(f"c{i}") for i, c in enumerate(names)])
    at = names.index(text_col)

    @released
    def keep(batches):
        for batch in batches:
            if scorer.names:
                lang, _ = predictions(scorer, batch.column(at))
                good = [x != UNKNOWN for x in lang]
            else:
                good = has_letter(*utf8(batch.column(at)))
            yield batch.filter(pa.array(good, pa.bool_()))

    return plain.mapInArrow(keep, plain.schema).toDF(*names)
