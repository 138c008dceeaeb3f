"""The pipeline operators against plain Python on small, awkward inputs.

``corpus`` has nulls, empty and blank texts, repeated rows and ids, exact and near copies, shared
passages, periodic and long texts, text without white space, and columns whose names clash with
those that the operators use.
"""

import collections
import hashlib
import importlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from sightline.llm import bpe, components, exact_dedup, language_id, lm_scoring, minhash, packing, ppm, quality, queries, substring_dedup, suffix_dedup, topk, word_bpe

WORD = re.compile("[^\x20\x09-\x0d]+")
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, h int, t string, bands string, spans string, digest string, kept boolean, `a.b` string, `__keep` boolean, block int, row string"


def make_corpus():
    r = random.Random(5)
    vocabulary = ["".join(r.choice(["th", "ing", "er", "on", "é", "ß", "ba", "zu"]) for _ in range(r.randrange(1, 4))) for _ in range(300)]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, bases, texts = say(70), [say(120) for _ in range(4)], []
    for i in range(90):
        kind = i % 9
        if kind == 0:
            texts.append(say(r.randrange(10)) + " " + passage + "\n" + say(r.randrange(30)))
        elif kind == 1:
            texts.append(bases[i % 4])
        elif kind == 2:
            w = bases[i % 4].split()
            w[r.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        elif kind == 3:
            texts.append(r.choice(["a", "ab ", "Thing, "]) * r.randrange(1, 200))
        elif kind == 4:
            texts.append(bases[0][: r.randrange(900)] + say(5) + bases[1][r.randrange(200) :])
        else:
            texts.append(say(r.randrange(1, 60)).title() + ".,!"[i % 3])
    texts += [None, "", " \n\t", "1234 !!", "\x1f", "x" * 3000, passage * 3, "é" * 150, "<|endoftext|> a<|endoftext|>", "<|ENDOFTEXT|> a<|Startoftext|>b", "İΣ ⅷ 가나 ​ á"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    rows += [(1, texts[0]), (1, texts[0]), (7, "other text of a repeated id"), (None, bases[0]), (None, None), (10_000, bases[0])]
    r.shuffle(rows)
    return rows


ROWS = make_corpus()
KNOWN = [(i, t or "") for i, t in ROWS if i is not None]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t, "en" if k % 2 else None, None, k, k, "x", "y", "z", "d", None, "dot", True, 3, "r") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, FIELDS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], FIELDS)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# --- Substring and suffix dedup ---------------------------------------------------------------


def brute_windows(items, size, unit, within):
    """(id, n, n_removed, kept) of every row; an earlier start is in a smaller id, or earlier in the same row."""
    first = {}
    for i, x in sorted(items, key=lambda y: y[0]):
        for s in range(len(x) - size + 1):
            first[tuple(x[s : s + size])] = min(first.get(tuple(x[s : s + size]), (i, s)), (i, s))
    out = []
    for i, x in items:
        keep = [True] * len(x)
        for s in range(len(x) - size + 1):
            f = first[tuple(x[s : s + size])]
            if f[0] < i or within and f < (i, s):
                keep[s : s + size] = [False] * size
        out.append((i, len(x), keep))
    return out


@pytest.mark.parametrize(("window", "bucket"), [(50, 1 << 20), (50, 300), (6, 5000)])
def test_substring_dedup(corpus, window, bucket):
    got = rows(substring_dedup.substring_dedup(corpus, window=window, bucket=bucket).filter("doc_id is not null"), "doc_id", "n_words", "n_removed", "kept_sha256")
    want = [(i, n, n - sum(keep), sha(" ".join(w for w, k in zip(WORD.findall(t), keep, strict=True) if k))) for (i, t), (_, n, keep) in zip(KNOWN, brute_windows([(i, WORD.findall(t)) for i, t in KNOWN], window, "word", False), strict=True)]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize(("bucket", "most"), [(1 << 20, 4000), (2000, 4000), (2000, 3)])
def test_suffix_dedup(corpus, bucket, most):
    items = [(i, t.encode()) for i, t in KNOWN if i != 7]
    got = rows(suffix_dedup.suffix_dedup(corpus.filter("doc_id <> 7"), bucket=bucket, most=most), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    want = []
    for (i, b), (_, n, keep) in zip(items, brute_windows(items, 100, "byte", True), strict=True):
        want.append((i, n, n - sum(keep), len(re.findall(b"\0+", bytes(keep))), sha(bytes(c for c, k in zip(b, keep, strict=True) if k))))
    assert got == sorted(want, key=repr)


def test_longest_previous_factors():
    r = np.random.default_rng(1)
    for size in (1, 2, 40, 400):
        text = r.integers(97, 99, size + 16).astype(np.uint8)
        starts = np.arange(size)
        raw, got = text.tobytes(), suffix_dedup.longest_previous_factors(text, starts, 16)
        for i in range(size):
            assert got[i] == max((next((k for k in range(16) if raw[i + k] != raw[j + k]), 16) for j in range(i)), default=0)


# --- Exact dedup ------------------------------------------------------------------------------


@pytest.mark.parametrize("counters", [1024, 2])
def test_exact_dedup(corpus, counters):
    groups = collections.defaultdict(list)
    for i, t in ROWS:
        groups[t or ""].append(i)
    want = []
    for i, t in ROWS:
        own = groups[t or ""]
        keep = max((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep, sha(t or "")))
    assert rows(exact_dedup.exact_dedup(corpus, counters=counters), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_misra_gries_keeps_what_is_frequent():
    r = random.Random(2)
    stream = [b"hot"] * 300 + [b"warm"] * 150 + [str(r.random()).encode() for _ in range(550)]
    r.shuffle(stream)
    found = exact_dedup.misra_gries([pa.RecordBatch.from_arrays([pa.array(stream[i : i + 37])], ["d"]) for i in range(0, 1000, 37)], 9)
    assert len(found) <= 9 and {b"hot", b"warm"} <= set(found) and found[b"hot"] <= 300


# --- BPE --------------------------------------------------------------------------------------


def test_bpe_round_trip(corpus):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path("byte_bpe_50k.json")
    library, want = Tokenizer.from_file(path), []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    for long, part, leaf in ((1 << 16, 1 << 14, 1 << 10), (100, 40, 16)):
        got = bpe.encoded(corpus, path, long=long, part=part, leaf=leaf)
        assert rows(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_tree_concatenation_of_unsplit_text():
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path("byte_bpe_50k.json")
    library, coder, r = Tokenizer.from_file(path), bpe.Coder(bpe.read_vocabulary(path), 8), random.Random(3)
    for n in (1, 9, 100, 4000):
        for letters in ("a", "ab", "thingeron", "éü가"):
            text = "".join(r.choice(letters) for _ in range(n))
            assert coder.encode(text) == library.encode(text, add_special_tokens=False).ids


# --- Packing ----------------------------------------------------------------------------------


def check_plan(counts, window):
    plan, seen, at = packing.best_fit_decreasing(counts, window), collections.defaultdict(list), collections.defaultdict(list)
    for length, first, n, sequence, offset in plan:
        for k in range(n):
            seen[length].append(first + k)
            at[sequence + k].append((offset, length))
    assert {s: sorted(x) for s, x in seen.items()} == {s: list(range(n)) for s, n in counts.items()}
    for pieces in at.values():
        place = 0
        for offset, length in sorted(pieces):
            assert offset == place
            place += length
        assert place <= window
    assert sorted(at) == list(range(len(at)))
    return len(at)


def test_best_fit_decreasing_matches_one_by_one():
    r = random.Random(4)
    for _ in range(30):
        counts = {r.randrange(1, 33): r.randrange(1, 9) for _ in range(r.randrange(1, 12))}
        free = []
        for s in sorted((s for s, n in counts.items() for _ in range(n)), reverse=True):
            fit = [c for c in free if c >= s]
            if fit:
                free.remove(min(fit))
                free.append(min(fit) - s)
            else:
                free.append(32 - s)
        assert check_plan(counts, 32) == len(free)


@pytest.mark.parametrize("window", [4096, 16])
def test_pack(corpus, window):
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = [r.asDict() for r in packing.pack(corpus, path, window=window).collect()]
    want = collections.Counter()
    for i, t in ROWS:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        for k in range(0, len(ids), window):
            some = ids[k : k + window]
            want[i, k, len(some), zlib.crc32(np.array(some, "<u4").tobytes()), len(ids)] += 1
    assert collections.Counter((g["doc_id"], g["start"], g["length"], g["ids_crc32"], g["doc_tokens"]) for g in got) == want
    by = collections.defaultdict(list)
    for g in got:
        by[g["sequence_id"]].append((g["offset"], g["length"]))
    for pieces in by.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= window
    assert len(by) <= 1.3 * sum(g["length"] for g in got) / window + 1


def test_words_like_the_library():
    from tokenizers import Tokenizer

    path = bpe.vocabulary_path("word_bpe_49k.json")
    library, coder, r = Tokenizer.from_file(path), word_bpe.WordCoder(open(path, encoding="utf-8").read()), random.Random(6)
    texts = ["".join(r.choice(a) for _ in range(r.randrange(60))) for a in ("abcé 'sS", "don't we'll .,!", ["<|endoftext|>", "<|ENDOFTEXT|>", "<|EndOfText|>", "<|startoftext|>", "<|STARTOFTEXT|>", "<|", "|>", " ", "A", "b"], "αΣς あ1", "\x01\x1c\x85 a", "İıſß<|endoftext|>", "ÄÖ¡·•ñ x") for _ in range(40)]
    ids, off = coder.encode(pa.array([*texts, None, "", " "]))
    for i, t in enumerate([*texts, "", "", " "]):
        assert ids[off[i] : off[i + 1]].tolist() == library.encode(t, add_special_tokens=False).ids, t


# --- Language models --------------------------------------------------------------------------


def brute_counts(texts, order):
    counts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for t in texts:
        s = [ppm.START] * order + list(t) + [ppm.END]
        for j in range(order, len(s)):
            for k in range(order + 1):
                counts[k][tuple(s[j - k : j])][s[j]] += 1
    return counts


def brute_score(counts, text, order):
    s, out = [ppm.START] * order + list(text) + [ppm.END], 0.0
    for j in range(order, len(s)):
        gone = set()
        for k in range(order, -1, -1):
            seen = counts[k].get(tuple(s[j - k : j]))
            if not seen:
                continue
            left = {c: n for c, n in seen.items() if c not in gone}
            total = sum(left.values())
            if s[j] in left:
                out += math.log10((2 * left[s[j]] - 1) / (2 * total))
                break
            if left:
                out += math.log10(len(left) / (2 * total))
            gone |= set(seen)
        else:
            out -= math.log10(257 - len(gone))
    return out


def lowered(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def test_lm_scoring(corpus):
    got = {}
    for r in lm_scoring.score(corpus, ~lm_scoring.held_out("doc_id", 7, 2), block=4000).collect():
        got.setdefault((r.doc_id, r.n_tokens), r)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    texts = [(i, lowered(t or "")) for i, t in ROWS]
    train = [t for i, t in texts if not held(i)]
    words = collections.Counter(w for t in train for w in [*WORD.findall(t), None])
    n, v = sum(words.values()), len(words)
    counts = brute_counts([t.encode() for t in train], 4)
    for i, t in texts:
        own = [*WORD.findall(t), None]
        r = got[i, len(own)]
        assert r.train_tokens == n and r.n_known == sum(words[w] > 0 for w in own)
        assert r.base_score == pytest.approx(sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own))
        assert r.score == pytest.approx(brute_score(counts, t.encode(), 4))


def test_lm_without_training(corpus):
    r = lm_scoring.score(corpus.filter("doc_id = 1").limit(1), lm_scoring.F.lit(False)).first()
    assert r.n_known == 0 and r.train_tokens == 0 and r.score == pytest.approx(-math.log10(257) * (len(dict(ROWS)[1].encode()) + 1)) and r.base_score == 0


def test_code_lengths_are_a_distribution():
    data = np.frombuffer(b"the thing in the thin ring", np.uint8)
    keys, _ = ppm.grams(data, np.array([0, 10, 26]), 3)
    model = ppm.Model(3, *ppm.distinct(keys))
    for context in keys[[0, 5, 11]] >> np.uint64(9):
        every = (context << np.uint64(9)) | np.arange(257, dtype=np.uint64)
        assert np.exp2(-model.bits(every)).sum() == pytest.approx(1, abs=1e-9)


def test_language_id(spark, sf, empty):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in language_id.identify_documents(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].lang_pred == truth[i] for i in held) > 0.95 * len(held)
    assert all(got[i].held_out == (i in held) and 0 <= got[i].score <= 1 for i in truth)
    models = language_id.fit(language_id.training_rows(docs))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "der die und"), (None, "the of and")], "doc_id long, text string")
    assert [(r.doc_id, r.lang_pred) for r in language_id.language_id(odd, models).collect()][:3] == [(1, "und"), (2, "und"), (3, "und")]
    assert {r.lang_pred for r in language_id.language_id(odd, {}).collect()} == {"und"}
    mixed = docs.filter("doc_id > 3").union(odd.selectExpr("doc_id", "text", "'de'", "''", "0L"))
    assert sorted(r.doc_id for r in language_id.with_language(mixed).filter("doc_id < 5").collect()) == [4, *[i for i in truth if i == 4]]


def test_language_of_long_texts_only(spark):
    r = random.Random(6)
    say = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(5)) for _ in range(n))
    rows_ = [(i, say("abcdef", 50), "short") for i in range(30)]
    rows_ += [(100 + i, say("uvwxyz", 5000), "long") for i in range(12)] + [(200 + i, say("uvwxyz", 20), "long") for i in range(60) if zlib.crc32(str(200 + i).encode()) % 4 == 2]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    assert all(got.lang_pred == want for got, want in zip(language_id.identify_documents(docs).orderBy("doc_id").collect(), [x[2] for x in rows_], strict=True) if got.held_out)
    cut = spark.createDataFrame([("a" * 20_000,), ("".join(chr(97 + k // 2500) for k in range(50_000)),)], "t string").select(language_id.pieces("t").alias("p")).collect()
    assert cut[0].p == ["a" * 20_000] and [len(x) for x in cut[1].p] == [2000] * 10 and cut[1].p[0] == "a" * 2000 and cut[1].p[-1] == "t" * 2000


def test_language_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, None), (3, "12 !?", None), (4, "é", None)], "doc_id long, text string, lang string")
    assert rows(language_id.with_language(docs), "doc_id") == [(1,), (4,)]


def test_code_lengths_against_brute_force():
    r = random.Random(8)
    texts = ["".join(r.choice("abc ") for _ in range(r.randrange(40))).encode() for _ in range(30)]
    off = np.append(0, np.cumsum([len(t) for t in texts]))
    keys, at = ppm.grams(np.frombuffer(b"".join(texts), np.uint8), off, 3)
    model = ppm.Model(3, *ppm.distinct(keys[: at[20]]))
    counts = brute_counts(texts[:20], 3)
    got = language_id.Scorer({"x": model}).bits(np.frombuffer(b"".join(texts), np.uint8), off)[:, 0]
    assert got == pytest.approx([-brute_score(counts, t, 3) / math.log10(2) for t in texts], rel=1e-5)


# --- Quality ----------------------------------------------------------------------------------


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.op3_quality(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out.values())
    assert all(out[i].held_out for i in held) and sum(out[i].predicted == labels[i] for i in held) >= 0.9 * len(held)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, label int")
    assert quality.fit(odd, none) is None and [r.score for r in quality.quality(odd, None).collect()] == [0.5] * 3


def test_attention_gradients():
    r = np.random.default_rng(0)
    model = quality.AttentionMIL(np.zeros(quality.DIMS, np.float32), np.ones(quality.DIMS, np.float32))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, to, y = r.standard_normal((7, quality.DIMS)) / 8, np.array([0, 3, 4, 7]), np.array([1.0, 0, 1])
    loss = lambda: -np.mean(np.log(np.where(y == 1, p := model.forward(x, to)["y"], 1 - p)))
    grad = model.gradients(model.forward(x, to), to, y)
    for name, value in model.p.items():
        at = tuple(0 for _ in value.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert grad[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-6), name


# --- Near-dedup and components ----------------------------------------------------------------


def counter(t):
    w = WORD.findall(t)
    return collections.Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else collections.Counter()


def similar(a, b):
    both = a.keys() & b.keys()
    if not both:
        return 0.0
    every = a.keys() | b.keys()
    return max(len(both) / len(every), sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in both))


def test_near_dedup(corpus):
    one = {}
    for i, t in sorted(KNOWN):
        one.setdefault(tuple(WORD.findall(t)), i)
    root = {i: i for i in one.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    items = [(i, counter(" ".join(w))) for w, i in one.items()]
    for k, (i, a) in enumerate(items):
        for j, b in items[:k]:
            if similar(a, b) >= 0.8:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    want = [(i, c := find(one[tuple(WORD.findall(t))]), i == c) for i, t in KNOWN] + [(None, None, True)] * 2
    assert rows(minhash.near_dedup(corpus), "doc_id", "class_id", "kept") == sorted(want, key=repr)


def test_near_dedup_rare_pair_in_a_large_bucket(spark):
    r = random.Random(3)
    own = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    template = own(204)
    texts = [template + " " + own(150) for _ in range(3000)]
    texts += [template + " " + own(10) for _ in range(2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert rows(minhash.near_dedup(docs).filter("not kept"), "doc_id", "class_id") == [(3001, 3000)]


def test_near_dedup_of_texts_that_differ_in_repeats(spark):
    r = random.Random(8)
    own = lambda n: " ".join(f"w{r.randrange(10**9)}" for _ in range(n))
    texts, want = [], []
    for times in (60, 200) * 10:
        text, line = own(304), own(10)
        want.append((len(texts) + 1, len(texts)))
        texts += [text, " ".join([text, *[line] * times])]
    assert all(len(a.keys() & b.keys()) >= 0.8 * len(a.keys() | b.keys()) for a, b in zip(map(counter, texts[::2]), map(counter, texts[1::2]), strict=True))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert rows(minhash.near_dedup(docs).filter("not kept"), "doc_id", "class_id") == sorted(want, key=repr)


def test_leading_shingles_of_similar_lists_meet():
    r = np.random.default_rng(4)
    for k in range(300):
        a = np.unique(r.integers(0, 60, 40))
        b = np.unique(np.append(r.permutation(a)[r.integers(0, 8) :], r.integers(0, 60, r.integers(0, 6))))
        x, y = r.integers(1, 2 + k % 4, 60), r.integers(0, 50, 60)
        z = np.where(r.random(60) < 0.2, r.integers(1, 5, 60), x)
        if minhash.similarity((a, x[a]), (b, z[b])) >= 0.8:
            assert set(a[minhash.leading(a, x[a], y[a], 0.8)]) & set(b[minhash.leading(b, z[b], y[b], 0.8)])


def test_probminhash_estimates_probability_jaccard():
    r = random.Random(9)
    for _ in range(5):
        a = collections.Counter({k: r.randrange(1, 4) for k in range(60)})
        b = collections.Counter({k: a[k] if k in a and r.random() < 0.8 else r.randrange(1, 6) for k in range(8, 68)})
        row = np.repeat([0, 1], [len(a), len(b)])
        value = np.array([*a, *b], np.uint64)
        signs = minhash.signatures(row, minhash.mix(value), np.array([*a.values(), *b.values()]), 2, 2048)
        every = a.keys() | b.keys()
        exact = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in a.keys() & b.keys())
        assert np.mean(signs[0] == signs[1]) == pytest.approx(exact, abs=0.06)


def test_components(spark):
    r = random.Random(1)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(60)] + [(900, 901 + i) for i in range(50)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {n.node: n.label for n in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


# --- Top-k ------------------------------------------------------------------------------------


def test_top_k(spark):
    r = random.Random(7)
    vectors = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(0, 330)]
    vectors += [(400 + i, vectors[50][1]) for i in range(40)] + [(500, None), (550, []), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (650, [float("nan")] * 6), (700, [float("inf")] * 6), (750, [1.0, 2.0]), (800, [0.0] * 6), (50, vectors[3][1]), (850, [1e6] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    got = collections.defaultdict(list)
    for x in topk.top_k(df, df.filter("vec_id % 50 = 0"), rows=64, query_rows=3).collect():
        got[x.query_id].append((x.rank, x.vec_id, x.score))
    ids = {i for i, _ in good if i % 50 == 0} - {50}
    for i, q in good:
        if i in ids:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in good if j != i and len(v) == len(q))[:5]
            assert sorted(got[i]) == [(k + 1, j, -s) for k, (s, j) in enumerate(best)]
    assert not got[750] and 500 not in got and len(got[850]) == 5
    huge = spark.createDataFrame([(0, [1e18] * 4), (1, [1e18] * 4), (2, [-1e18] * 4)], "vec_id long, embedding array<double>")
    assert [(x.query_id, x.rank, x.vec_id) for x in topk.top_k(huge, huge.filter("vec_id = 0")).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]


# --- All ---------------------------------------------------------------------------------------


def test_empty_tables(spark, empty):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (
        substring_dedup.substring_dedup(empty), exact_dedup.exact_dedup(empty), quality.score_documents(empty, labels), bpe.encoded(empty, bpe.vocabulary_path("byte_bpe_50k.json")), suffix_dedup.suffix_dedup(empty), topk.nearest_fiftieth(vectors),
        minhash.near_dedup(empty), packing.pack(empty, bpe.vocabulary_path("word_bpe_49k.json")), lm_scoring.score_documents(empty), language_id.identify_documents(empty), suffix_dedup.without_repeats(empty),
    ):
        assert df.count() == 0 and len(df.columns) > 2


def near_classes(items):
    """The class, its least item, of each (id, text) of a list, by brute force."""
    one = {}
    for i, t in sorted(items):
        one.setdefault(tuple(WORD.findall(t)), (i, t))
    root = {x: x for x in one.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    counts = [(x, counter(" ".join(w))) for w, x in one.items()]
    for k, (x, a) in enumerate(counts):
        for y, b in counts[:k]:
            if similar(a, b) >= 0.8:
                low, high = sorted((find(x), find(y)))
                root[high] = low
    return {(i, t): find(one[tuple(WORD.findall(t))]) for i, t in items}


def test_pipeline(spark, corpus):
    """Every stage against plain Python, over all rows: repeated ids and rows, null ids and texts, odd names."""
    from tokenizers import Tokenizer

    pipeline = importlib.import_module("corpus_pipeline")
    assert [n for n, _ in pipeline.STAGES] == ["language id", "exact dedup", "near dedup", "suffix dedup", "packing"]
    docs, columns, got = corpus, corpus.columns, {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, ""), "stage")
        if name != "packing":
            assert docs.columns == columns, name
            got[name] = sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert docs.count() and {r["a.b"] for r in corpus.collect()} == {"dot"}
    want = sorted(((i, t) for i, t in ROWS if t and any(c.isalpha() for c in t)), key=repr)
    assert got["language id"] == want
    last = {}
    for i, t in want:
        last[t] = i if t not in last or last[t] is None else last[t] if i is None else max(i, last[t])
    want = sorted(((i, t) for t, i in last.items()), key=repr)
    assert got["exact dedup"] == want
    classes = near_classes([(i, t) for i, t in want if i is not None])
    want = sorted([x for x in want if x[0] is None or classes[x] == x], key=repr)
    assert got["near dedup"] == want
    known = [(i, t.encode()) for i, t in want if i is not None]
    cut = [(i, bytes(c for c, k in zip(t, keep, strict=True) if k).decode("utf-8", "ignore")) for (i, t), (_, _, keep) in zip(known, brute_windows(known, 100, "byte", True), strict=True)]
    want = sorted([*cut, *[x for x in want if x[0] is None]], key=repr)
    assert got["suffix dedup"] == want
    library = Tokenizer.from_file(bpe.vocabulary_path("word_bpe_49k.json"))
    pieces = collections.Counter()
    for i, t in want:
        ids = [*library.encode(t, add_special_tokens=False).ids, 2]
        pieces.update((i, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes()), len(ids)) for k in range(0, len(ids), 4096))
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in docs.collect()) == pieces


def test_stages_of_repeated_rows(spark):
    rows_ = [(7, "A a"), (7, "B b"), (9, "A a"), (None, "A a"), (None, "C c"), (7, "B b")]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows_)], "doc_id long, text string, `__keep` int")
    assert sorted(map(repr, ((r.doc_id, r.text) for r in exact_dedup.kept_documents(docs).collect()))) == ["(7, 'B b')", "(9, 'A a')", "(None, 'C c')"]
    near = minhash.first_of_each_group(docs)
    assert near.columns == docs.columns
    assert sorted(map(repr, ((r.doc_id, r.text) for r in near.collect()))) == ["(7, 'A a')", "(7, 'B b')", "(None, 'A a')", "(None, 'C c')"]
    assert rows(minhash.near_dedup(docs), "doc_id", "class_id", "kept") == sorted([(7, 7, True), (7, 7, True), (7, 7, True), (9, 7, False), (None, None, True), (None, None, True)], key=repr)


def thue_morse(n, a, b):
    """A word and its complement, of 2**n symbols: polynomials modulo powers of two can't tell them apart."""
    bits = [bin(k).count("1") % 2 for k in range(1 << n)]
    return [a if x else b for x in bits], [b if x else a for x in bits]


def test_different_texts_are_never_equal(spark):
    x, y = ("".join(w) for w in thue_morse(10, "a", "b"))
    say = " ".join(f"w{k}" for k in range(49))
    docs = spark.createDataFrame([(1, f"{say} {x}"), (2, f"{say} {y}")], "doc_id long, text string")
    assert rows(substring_dedup.substring_dedup(docs), "doc_id", "n_removed") == [(1, 0), (2, 0)]
    words = [" ".join(w) for w in thue_morse(10, "yes", "no")]
    docs = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    # their runs of five words are the same, so they are near copies: by similarity, not as one word sequence
    assert all(a != b for a, b in [minhash.same_words(np.frombuffer(" ".join(words).encode(), np.uint8), np.array([0, len(words[0]), len(" ".join(words))]))])
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = spark.createDataFrame([(held + 1, x), (held, y)], "doc_id long, text string")
    known = {r.doc_id: r.n_known for r in lm_scoring.score(docs, lm_scoring.F.col("doc_id") != held).collect()}
    assert known == {held + 1: 2, held: 1}


def test_many_languages(spark):
    rows_ = [(k, f"word{k % 1000} of language {k % 1000} " * 3, f"l{k % 1000:04d}") for k in range(6000)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string").repartition(4)
    models = language_id.fit(language_id.training_rows(docs))
    assert len(models) == 1000 and list(models) == sorted(models)
    some = docs.filter("doc_id % 100 = 0")
    got = {r.doc_id: r.lang_pred for r in language_id.language_id(some, models).collect()}
    assert len(got) == 60 and sum(got[k] == f"l{k % 1000:04d}" for k in got) >= 55


def test_language_prediction_against_brute_force(spark):
    r = random.Random(12)
    rows_ = [(k, "".join(r.choice(("abcd ", "cdef ", "efgh ")[k % 3]) for _ in range(r.randrange(1, 40))), "xyz"[k % 3]) for k in range(90)]
    docs = spark.createDataFrame(rows_, "doc_id long, text string, lang string")
    train = [x for x in rows_ if zlib.crc32(str(x[0]).encode()) % 4 != 2]
    counts = {lang: brute_counts([t.lower().encode() for _, t, own in train if own == lang], 3) for lang in "xyz"}
    for got in language_id.identify_documents(docs).collect():
        text = rows_[got.doc_id][1]
        scores = {lang: brute_score(c, text.encode(), 3) for lang, c in counts.items()}
        if any(c.isalpha() for c in text):
            best = max(scores.values())
            assert scores[got.lang_pred] == pytest.approx(best, abs=1e-3)
            assert got.score == pytest.approx(1 / sum(10 ** (s - best) for s in scores.values()), abs=1e-3)
        else:
            assert (got.lang_pred, got.score) == ("und", 0)


def brute_features(text):
    """One passage after another, by the rules of the quality module's docstring, in plain Python."""
    data = text.encode()
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)]
    out = []
    for k in range(0, max(1, len(found)), quality.PASSAGE):
        some = found[k : k + quality.PASSAGE]
        if not some:
            return [[0.0] * quality.DIMS]
        tail = found[k + quality.PASSAGE][0] if k + quality.PASSAGE < len(found) else len(data)
        kinds = [int(quality._CLASS[c]) for c in data[some[0][0] : tail]]
        words = [data[a:b] for a, b in some]
        pair, single = collections.Counter(zip(kinds, kinds[1:], strict=False)), collections.Counter(kinds)
        row = [math.sqrt(pair[a, b] / len(kinds)) for a in range(quality.CLASSES) for b in range(quality.CLASSES)]
        row += [math.sqrt(single[a] / len(kinds)) for a in range(quality.CLASSES)]
        slots = collections.Counter(int(quality.mix(quality.rolled(quality.prefix(np.frombuffer(w, np.uint8)), np.array([0]), np.array([len(w)])))[0] % np.uint64(quality.WORDS)) for w in words)
        row += [math.sqrt(slots[a] / len(words)) for a in range(quality.WORDS)]
        wide = [len(w) for w in words]
        mean = sum(wide) / len(wide)
        spread = math.sqrt(sum((w - mean) ** 2 for w in wide) / len(wide))
        row += [len(set(words)) / len(words), sum(a == b for a, b in zip(words, words[1:], strict=False)) / len(words), mean / 10, spread / 10, math.log1p(len(words)) / 4, math.log1p(len(kinds)) / 8]
        out.append(row)
    return out


def test_quality_against_brute_force():
    texts = [t or "" for _, t in ROWS]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.append(0, np.cumsum([len(t.encode()) for t in texts]))
    x, to = quality.passages(data, off)
    want = [brute_features(t) for t in texts]
    assert np.diff(to).tolist() == [len(w) for w in want]
    assert x == pytest.approx(np.array([r for w in want for r in w]), abs=1e-4)
    r = np.random.default_rng(3)
    model = quality.AttentionMIL(r.random(quality.DIMS).astype(np.float32), np.full(quality.DIMS, 2, np.float32))
    p = {k: v.astype(float) for k, v in model.p.items()}
    for got, w in zip(model.score(data, off), want, strict=True):
        h = [np.tanh(((np.array(row) - model.mean) / model.scale) @ p["W"] + p["b"]) for row in w]
        e = [float((np.tanh(z @ p["V"] + p["v"]) / (1 + np.exp(-(z @ p["U"] + p["u"])))) @ p["w"]) for z in h]
        a = np.exp(np.array(e) - max(e))
        z = sum(k * v for k, v in zip(a / a.sum(), h, strict=True))
        assert got == pytest.approx(1 / (1 + math.exp(-(z @ p["c"] + p["d"][0]))), abs=1e-3)


def test_near_dedup_of_a_large_group(spark):
    """Classes of many near copies at many distances, against brute force."""
    r = random.Random(21)
    base = [f"w{r.randrange(10**6)}" for _ in range(60)]
    items = []
    for k in range(130):
        w = list(base)
        for _ in range(r.randrange(0, 5)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        items.append((k, " ".join(w)))
    docs = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    classes = near_classes(items)
    assert rows(minhash.near_dedup(docs), "doc_id", "class_id") == sorted(((i, classes[i, t][0]) for i, t in items), key=repr)


def test_against_sql(spark, sf):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        a, b = queries.QUERIES[name](spark, sf).toPandas(), con.sql(sql).df()
        columns = sorted(a.columns)
        assert columns == sorted(b.columns) and [str(a[c].dtype) for c in columns] == [str(b[c].dtype) for c in columns]
        assert sorted(map(tuple, a[columns].astype(str).values.tolist())) == sorted(map(tuple, b[columns].astype(str).values.tolist())), name


def test_memory_goes_back_after_each_group(monkeypatch):
    """A worker settles many groups in a task: what one group took is not kept for the next."""
    import inspect

    from sightline.llm import common

    freed = []
    monkeypatch.setattr(common, "release", lambda: freed.append(True))

    def settle(key, group):
        assert not freed
        return key + group

    def broken(key, group):
        raise ValueError

    f = common.returned(settle)
    # Spark tells (group) from (key, group) by the number of parameters
    assert len(inspect.getfullargspec(f).args) == 2 and f(1, 2) == 3 and freed == [True]
    with pytest.raises(ValueError):
        common.returned(broken)(1, 2)
    assert freed == [True, True]
    assert inspect.getsource(suffix_dedup).count("@returned") == inspect.getsource(suffix_dedup).count(".applyInArrow(") == 4
