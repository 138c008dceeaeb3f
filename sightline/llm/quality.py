"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words.  Each passage is encoded from its own words and
bytes (hashed words, pairs of character classes, shape statistics) by a learned layer; gated attention weighs the
passages, and the weighted mean is scored.  Only documents carry labels, so the attention learns
which passages decide.  The model is fitted on a bounded sample of labelled rows and then scores
every passage of every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, held_out, identified, mix, prefix, released, rolled, spans, utf8, words

PASSAGE = 32
#: Expected labelled documents that are learned from, the most passages of each (spread evenly over it), and passes over them.
SAMPLE, SAMPLE_PASSAGES, EPOCHS = 4000, 64, 30
HIDDEN, ATTENTION, THRESHOLD = 24, 12, 0.3

#: Character classes: lower, upper, beyond ASCII, digit, space, newline, full stop, comma, exclamation mark, bar, other.
CLASSES = 11
_CLASS = np.full(256, 10, np.int64)
for _c, _members in enumerate((range(97, 123), range(65, 91), range(128, 256), range(48, 58), (32, 9), range(10, 14), (46,), (44,), (33,), (124,))):
    _CLASS[list(_members)] = _c
STATS = 6
#: Slots that words are hashed to.
WORDS = 128
DIMS = CLASSES * CLASSES + CLASSES + WORDS + STATS


def passages(data: np.ndarray, off: np.ndarray, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(features, n + 1 offsets): one row of features for each passage; a text without a word has one, all zero."""
    starts, ends, at = words(data, off)
    n = np.diff(at)
    count = np.maximum(1, -(-n // size))
    to = np.append(0, np.cumsum(count))
    out = np.zeros((to[-1], DIMS), np.float32)
    if not len(starts):
        return out, to
    row = np.repeat(np.arange(len(n)), n)
    place = to[row] + (np.arange(len(starts)) - at[row]) // size
    # bytes belong to the passage of the word that they are in or that comes before them
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    head = starts[first]
    tail = np.append(head[1:], len(data))
    doc_end = off[1:][row[first]]
    tail = np.minimum(tail, doc_end)
    own = place[first]
    length = tail - head
    total = np.repeat(own, length)
    index = np.arange(int(length.sum())) + np.repeat(head - (np.cumsum(length) - length), length)
    kind = _CLASS[data[index]]
    single = np.bincount(total * CLASSES + kind, minlength=len(out) * CLASSES).reshape(-1, CLASSES)
    inside = np.flatnonzero(total[1:] == total[:-1])
    pair = np.bincount((total[inside] * CLASSES + kind[inside]) * CLASSES + kind[inside + 1], minlength=len(out) * CLASSES**2).reshape(len(out), -1)
    size_of = np.maximum(1, single.sum(1, keepdims=True))
    hashes = rolled(prefix(data), starts, ends)
    k = np.bincount(place, minlength=len(out)).astype(float)
    some = np.maximum(1, k)
    order = np.lexsort((hashes, place))
    new = np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (place[order][1:] != place[order][:-1])])
    kinds = np.bincount(place[order][new], minlength=len(out))
    again = np.bincount(place[1:][(hashes[1:] == hashes[:-1]) & (place[1:] == place[:-1])], minlength=len(out))
    wide = (ends - starts).astype(float)
    mean = np.bincount(place, wide, len(out)) / some
    spread = np.sqrt(np.maximum(0, np.bincount(place, wide * wide, len(out)) / some - mean * mean))
    out[:, : CLASSES**2] = np.sqrt(pair / size_of)
    out[:, CLASSES**2 : CLASSES**2 + CLASSES] = np.sqrt(single / size_of)
    slot = np.bincount(place * WORDS + (mix(hashes) % U64(WORDS)).astype(np.int64), minlength=len(out) * WORDS).reshape(len(out), -1)
    out[:, -STATS - WORDS : -STATS] = np.sqrt(slot / some[:, None])
    out[:, -STATS:] = np.stack([kinds / some, again / some, mean / 10, spread / 10, np.log1p(k) / 4, np.log1p(size_of[:, 0]) / 8], 1)
    out[k == 0] = 0
    return out, to


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionMIL:
    """score = sigmoid(c . sum_k a_k h_k), h = tanh(W x), a = softmax of w . (tanh(V h) * sigmoid(U h))."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        make = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"W": make(len(mean), HIDDEN), "b": np.zeros(HIDDEN, np.float32), "V": make(HIDDEN, ATTENTION), "v": np.zeros(ATTENTION, np.float32), "U": make(HIDDEN, ATTENTION), "u": np.zeros(ATTENTION, np.float32), "w": make(ATTENTION), "c": make(HIDDEN), "d": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, to: np.ndarray) -> dict:
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"] + p["v"]), sigmoid(h @ p["U"] + p["u"])
        e = (t * g) @ p["w"]
        bag = np.repeat(np.arange(len(to) - 1), np.diff(to))
        e = np.exp(e - np.maximum.reduceat(e, to[:-1])[bag])
        a = e / np.add.reduceat(e, to[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, to[:-1])
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "bag": bag, "y": sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, f: dict, to: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p, h, t, g, a, bag = self.p, f["h"], f["t"], f["g"], f["a"], f["bag"]
        d = ((f["y"] - label) / len(label)).astype(np.float32)
        dz = (d[:, None] * p["c"])[bag]
        da = (dz * h).sum(1)
        de = a * (da - np.add.reduceat(a * da, to[:-1])[bag])
        gate = de[:, None] * p["w"]
        dt, dg = gate * g * (1 - t * t), gate * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
        return {"W": f["x"].T @ dh, "b": dh.sum(0), "V": h.T @ dt, "v": dt.sum(0), "U": h.T @ dg, "u": dg.sum(0), "w": (t * g).T @ de, "c": f["z"].T @ d, "d": d.sum(keepdims=True)}

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, epochs: int, seed: int = 11, batch: int = 64, rate: float = 0.01, decay: float = 1e-4) -> None:
        r, step = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            order = r.permutation(len(bags))
            for i in range(0, len(order), batch):
                some = order[i : i + batch]
                to = np.append(0, np.cumsum([len(bags[k]) for k in some]))
                grad = self.gradients(self.forward(np.concatenate([bags[k] for k in some]), to), to, labels[some])
                step += 1
                for k, v in self.p.items():
                    dv = grad[k] + decay * v
                    first[k] += 0.1 * (dv - first[k])
                    second[k] += 0.001 * (dv * dv - second[k])
                    v -= (rate * (1 - epoch / epochs) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        out = np.zeros(len(off) - 1)
        for i, j in spans(off):
            x, to = passages(data[off[i] : off[j]], off[i : j + 1] - off[i])
            out[i:j] = self.forward(x, to)["y"]
        return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> AttentionMIL | None:
    """Learns from labels (doc_id, label 0 or 1) and the texts of docs (doc_id, text); None without a label.

    The sample takes the labelled ids whose hash is below a threshold, ``sample`` of them in
    expectation, so the broadcast and what reaches the driver stay bounded: at most ``SAMPLE_PASSAGES``
    passages a document.  Scores take all passages."""
    rows = labels.filter("doc_id is not null and label in (0, 1)")
    n = rows.count()
    if not n:
        return None
    draw = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.filter(draw < min(1.0, sample / n)).select("doc_id", F.col("label").cast("int").alias("label"))
    texts = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")

    def some(a: int, b: int) -> np.ndarray:
        return np.unique(np.linspace(a, b - 1, min(b - a, SAMPLE_PASSAGES)).round().astype(np.int64))

    @released
    def encode(batches):
        for batch in batches:
            data, off = utf8(batch.column(2))
            out: list[bytes] = []
            for i, j in spans(off):
                x, to = passages(data[off[i] : off[j]], off[i : j + 1] - off[i])
                out += [x[some(a, b)].astype(np.float16).tobytes() for a, b in zip(to[:-1], to[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc_id", "label", "bag"])

    table = texts.mapInArrow(encode, "doc_id long, label int, bag binary").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    bags = [np.frombuffer(x.as_py(), np.float16).reshape(-1, DIMS).astype(np.float32) for x in table["bag"]]
    if not bags:
        return None
    every = np.concatenate(bags)
    model = AttentionMIL(every.mean(0), every.std(0) + np.float32(0.02))
    model.fit(bags, table["label"].to_numpy().astype(np.float32), epochs)
    return model


def quality(docs: DataFrame, model: AttentionMIL | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each input row: doc_id, score, predicted.  Null and empty texts are one empty passage.
    Without a model every score is 0.5."""

    @released
    def score(batches):
        for batch in batches:
            data, off = utf8(batch.column(1))
            y = model.score(data, off) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(y), pa.array((y >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return identified(docs, id_col, text_col).select("doc_id", "text").mapInArrow(score, "doc_id long, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from the labels of the other four fifths."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")).filter(~held_out("doc_id", 5, 0))
    model = fit(identified(docs).select("doc_id", "text"), known)
    return quality(docs, model).select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted")
