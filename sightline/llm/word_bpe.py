"""Token ids of whole texts under a word-level BPE with word ends, encoded word by word.

The vocabulary lower-cases, drops white space and never spans it, so a text's ids are those of its
words one after another.  Each distinct word is encoded once a task.  Words of printable ASCII and
Latin letters take a byte-level merge engine in which a marker byte ends every pre-token (a byte
and the marker merge first, like the vocabulary's single symbols with a word end).  All other
words, and those that hold the marker or a special token, go to the tokenizers library itself.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import ragged

MARK = "\x01"
#: The pre-token pattern of the vocabulary (fixed value).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Words all of whose characters are printable ASCII or Latin-1 letters.
PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: Distinct words that a task keeps; beyond it, it starts anew.
MOST_WORDS = 400_000
END_OF_WORD = "</w>"


class WordCoder:
    _made: dict = {}

    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = json.loads(spec)["model"]["vocab"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        back = {c: b for b, c in shown.items()}
        ranks: dict[bytes, int] = {}
        ends = np.zeros(max(vocab.values()) + 2, bool)
        for token, i in vocab.items():
            ended = token.endswith(END_OF_WORD) and len(token) > len(END_OF_WORD)
            body = token[: -len(END_OF_WORD)] if ended else token
            if all(c in back for c in body):
                ranks[bytes(back[c] for c in body) + MARK.encode() * ended] = i
                ends[i] = ended
        self.ends = ends
        self.core = tiktoken.Encoding("words", pat_str=rf"[^{MARK}\s]+{MARK}", mergeable_ranks=ranks, special_tokens={})
        self.clear()

    @classmethod
    def of(cls, spec: str) -> "WordCoder":
        key = (len(spec), hash(spec))
        if key not in cls._made:
            cls._made[key] = cls(spec)
        return cls._made[key]

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.flat, self.at, self.used = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64), 0

    def add(self, new: list[str]) -> None:
        """Encodes words that aren't there yet."""
        plain = [w for w in new if PLAIN.fullmatch(w) and "<|" not in w]
        odd = list(set(new).difference(plain))
        sizes, ids = [], []
        for k in range(0, len(plain), 4096):
            some = plain[k : k + 4096]
            text = unicodedata.normalize("NFC", " ".join(some)).lower()
            marked = PATTERN.sub(r"\g<0>" + MARK, text)
            got = np.array(self.core.encode_ordinary(marked), np.uint32)
            raw = np.frombuffer(marked.encode(), np.uint8)
            gaps = np.append(np.flatnonzero(raw == 32), len(raw))
            pieces = np.searchsorted(np.flatnonzero(raw == 1), gaps)  # pre-tokens up to each word's end
            last = np.flatnonzero(self.ends[got]) + 1
            bounds = np.append(0, last)[pieces]
            sizes.append(np.diff(bounds, prepend=0))
            ids.append(got)
        if odd:
            found = [np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast(odd, add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in found]))
            ids += found
        if not new:
            return
        got, lengths = np.concatenate(ids), np.concatenate(sizes).astype(np.int64)
        for w in plain + odd:
            self.places[w] = len(self.places)
        if self.used + len(got) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(len(self.flat), len(got)), np.uint32)])
        self.flat[self.used : self.used + len(got)] = got
        self.at = np.concatenate([self.at, self.used + np.cumsum(lengths)])
        self.used += len(got)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows one after another, and the n + 1 offsets of the rows."""
        column = column.fill_null("") if column.null_count else column
        # special tokens are found before letters are lowered, so texts that may hold one stay as they are
        lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column)))
        coded = lists.values.dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.places) + len(names) > MOST_WORDS:
            self.clear()
        # an empty entry stands for white space at a text's ends
        self.add([w for w in names if w and w not in self.places])
        place = np.array([self.places[w] if w else -1 for w in names], np.int64)
        start = np.where(place >= 0, self.at[place], 0) if len(place) else place
        size = np.where(place >= 0, self.at[place + 1] - self.at[place], 0) if len(place) else place
        index = coded.indices.to_numpy(zero_copy_only=False)
        lengths = size[index] if len(index) else np.zeros(0, np.int64)
        ids = self.flat[ragged(start[index], lengths)] if len(index) else np.zeros(0, np.uint32)
        off = np.asarray(lists.offsets.to_numpy(), np.int64) - lists.offsets[0].as_py() if len(column) else np.zeros(1, np.int64)
        return ids, np.append(0, np.cumsum(lengths))[off]
