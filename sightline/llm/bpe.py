"""Byte-level BPE encoding and decoding, with tree concatenation for long unsplit text.

A text splits before every white space that follows other characters; no token spans such a
place, so those parts encode on their own.  What stays long without a split is one pre-token, a
plain byte string to which only merges apply.  It is encoded in halves; around each join a window
of tokens is re-encoded and grown until its first token is one the left half has there and its
last token one the right half has there.  A sequence in which each pair of neighbours is the
encoding of its own bytes is the encoding of the whole, so agreement on one token a side proves
the joined sequence exact.

Documents above ``LONG`` bytes are dealt out over tasks in parts and joined by document.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identified, parts, released, stored

#: Bytes above which a document is dealt out in parts, bytes of such a part, and of a leaf of the tree.
LONG, PART, LEAF = 1 << 16, 1 << 14, 1 << 10
#: The pre-token pattern of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_vocabulary(path: str) -> dict:
    """The file's ranks of byte strings and its special tokens, small enough to ship in a closure."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    back = {c: b for b, c in shown.items()}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    return {"ranks": ranks, "special": special}


class Coder:
    """Encodes and decodes whole texts; ``leaf`` bytes is where trees begin."""

    _made: dict = {}

    def __init__(self, vocabulary: dict, leaf: int = LEAF):
        import tiktoken

        self.core = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary["ranks"], special_tokens={})
        self.special, self.leaf = vocabulary["special"], leaf
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.unsplit = regex.compile(r"\S{%d,}" % max(2, leaf // 4))
        size = max([*vocabulary["ranks"].values(), *self.special.values()]) + 1
        self.bytes_of, self.digits = [b""] * size, [b"%d," % i for i in range(size)]
        for token, i in vocabulary["ranks"].items():
            self.bytes_of[i] = token
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.pretoken = regex.compile(PATTERN)

    @classmethod
    def of(cls, vocabulary: dict, leaf: int = LEAF) -> "Coder":
        """One coder a worker process and vocabulary."""
        key = (len(vocabulary["ranks"]), tuple(vocabulary["special"].items()), hash(tuple(list(vocabulary["ranks"])[-64:])), leaf)
        if key not in cls._made:
            cls._made[key] = cls(vocabulary, leaf)
        return cls._made[key]

    def encode(self, text: str) -> list[int]:
        if not self.marks or not any(mark in text for mark in self.special):
            return self.plain(text)
        out, at = [], 0
        for found in self.marks.finditer(text):
            out += self.plain(text[at : found.start()])
            out.append(self.special[found.group()])
            at = found.end()
        return out + self.plain(text[at:])

    def plain(self, text: str) -> list[int]:
        """Encodes a text without special tokens; only parts that hold long unsplit text take the tree."""
        if len(text) < self.leaf // 4 or not self.unsplit.search(text):
            return self.core.encode_ordinary(text)
        out: list[int] = []
        for found in self.pretoken.finditer(text):
            piece = found.group().encode()
            out += self.tree(piece) if len(piece) > self.leaf else self.core._encode_single_piece(piece)
        return out

    def tree(self, piece: bytes) -> list[int]:
        """One long pre-token, by halves."""
        if len(piece) <= self.leaf:
            return self.core._encode_single_piece(piece)
        half = len(piece) // 2
        return self.joined(self.tree(piece[:half]), self.tree(piece[half:]))

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both, from the encodings of either."""
        if not left or not right:
            return left + right
        width = 4
        while True:
            a, b = max(0, len(left) - width), min(len(right), width)
            window = self.core._encode_single_piece(b"".join(self.bytes_of[i] for i in left[a:] + right[:b]))
            start, end = a == 0 or window[0] == left[a], b == len(right) or window[-1] == right[b - 1]
            if start and end:
                return left[:a] + window + right[b:]
            width *= 2

    def decode(self, ids: list[int]) -> bytes:
        """UTF-8 of the decoded text; bytes that are no UTF-8 become U+FFFD."""
        out = b"".join(map(self.bytes_of.__getitem__, ids))
        return out.decode("utf-8", "replace").encode()

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        listed = b"".join(map(self.digits.__getitem__, ids))[:-1]
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(self.decode(ids)).hexdigest()


def cut(text: str, coder: Coder, size: int):
    """(kind, bytes) parts of a long text, in order.  kind 0: encodes on its own; 1: continues the
    pre-token of the part before, to be joined; 2: a special token."""
    spans_, at = [], 0
    for found in coder.marks.finditer(text) if coder.marks else ():
        spans_ += [(0, text[at : found.start()]), (2, found.group())]
        at = found.end()
    for kind, part in [*spans_, (0, text[at:])]:
        if kind == 2:
            yield 2, part.encode()
            continue
        held: list[str] = []
        n = 0
        for found in regex.finditer(r"\s*\S+|\s+", part):
            run = found.group()
            if len(run) > size:
                if held:
                    yield 0, "".join(held).encode()
                    held, n = [], 0
                for token in coder.pretoken.finditer(run):
                    piece = token.group().encode()
                    for i in range(0, len(piece), size):
                        yield (3 if i == 0 else 1), piece[i : i + size]
            else:
                held.append(run)
                n += len(run)
                if n >= size:
                    yield 0, "".join(held).encode()
                    held, n = [], 0
        if held:
            yield 0, "".join(held).encode()


def tree_join(coder: Coder, runs: list[list[int]]) -> list[int]:
    """Joins the encodings of consecutive parts of one pre-token pairwise, like a tree."""
    while len(runs) > 1:
        runs = [coder.joined(runs[i], runs[i + 1]) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
    return runs[0] if runs else []


def encoded(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, part: int = PART, leaf: int = LEAF, with_ids: bool = False) -> DataFrame:
    """One row for each input row: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids.

    Null and empty texts have no tokens.  Special tokens' strings in a text become their ids.
    """
    vocabulary = read_vocabulary(vocabulary_path)
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    names = [f.split()[0] for f in fields.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())][: len(names)]

    def rows(found):
        """found: (doc_id, ids) pairs."""
        coder = Coder.of(vocabulary, leaf)
        out = [(i, *coder.digests(ids), ids)[: len(names)] for i, ids in found]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kinds[k]) for k in range(len(names))], names)

    @released
    def short(batches):
        coder = Coder.of(vocabulary, leaf)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                yield rows((i, coder.encode(text)) for i, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True))

    @released
    def split(batches):
        coder = Coder.of(vocabulary, leaf)
        named = ["doc_id", "row", "k", "kind", "piece"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        made: list[tuple] = []
        size = 0

        def flush():
            return pa.RecordBatch.from_arrays([pa.array([m[c] for m in made], types[c]) for c in range(5)], named)

        for batch in batches:
            for i, row, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                for k, (kind, piece) in enumerate(cut(text, coder, part)):
                    made.append((i, row, k, kind, piece))
                    size += len(piece)
                    if len(made) >= 10_000 or size >= 1 << 22:
                        yield flush()
                        made, size = [], 0
        if made:
            yield flush()

    @released
    def encode_parts(batches):
        coder = Coder.of(vocabulary, leaf)
        for batch in batches:
            ids = []
            for kind, piece in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                got = [coder.special[piece.decode()]] if kind == 2 else coder.plain(piece.decode()) if kind == 0 else coder.tree(piece)
                ids.append(np.array(got, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(ids, pa.binary())], ["doc_id", "row", "k", "kind", "ids"])

    def join(table: pa.Table) -> pa.Table:
        coder = Coder.of(vocabulary, leaf)
        table = table.sort_by("k")
        out: list[int] = []
        open_: list[list[int]] = []
        for kind, raw in zip(table["kind"].to_pylist(), table["ids"].to_pylist(), strict=True):
            ids = np.frombuffer(raw, "<i4").tolist()
            if kind != 1:
                out += tree_join(coder, open_)
                open_ = []
            if kind in (1, 3):
                open_.append(ids)
            else:
                out += ids
        out += tree_join(coder, open_)
        return pa.Table.from_batches([rows([(table["doc_id"][0].as_py(), out)])])

    table = identified(docs, id_col, text_col)
    size = F.octet_length("text")
    brief = table.filter(size <= long).select("doc_id", "text").mapInArrow(short, fields)
    n = parts(docs.sparkSession)
    # the numbers of rows are written before they deal out anything: a task that runs again keeps them
    pieces = stored(table.filter(size > long).select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(split, "doc_id long, row long, k int, kind int, piece binary"), "pieces")
    dealt = pieces.repartition(n, "row", "k").mapInArrow(encode_parts, "doc_id long, row long, k int, kind int, ids binary")
    return brief.unionByName(dealt.groupBy("row").applyInArrow(join, fields))


def vocabulary_path(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)
