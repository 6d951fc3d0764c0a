"""Byte-level BPE, importance resampling and periodic runs against plain versions, and on odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from cellsmith.llm import bpe, resample, runs


def crc(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


# 11 Byte-level BPE.

@pytest.fixture(scope="module")
def library():
    return {p: tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=bpe.read_ranks(p), special_tokens={})
            for p in (bpe.default_path(), bpe.default_path().replace("byte_bpe_50k", "byte_bpe_multi_50k"))}


def test_matches_encode_like_the_library(library):
    rng = random.Random(5)
    for path, lib in library.items():
        ranks = bpe.read_ranks(path)
        vocabulary, tokens = bpe.Vocabulary(ranks), list(ranks)
        for _ in range(4000):
            piece = (b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 5))) if rng.random() < 0.5
                     else bytes(rng.choice(b"aab  \xc3\xa9nthe") for _ in range(rng.randint(1, 40))))
            want = [ranks[piece]] if piece in ranks else lib._core_bpe.encode_single_piece(piece)
            assert vocabulary.encode_match(piece) == want


def test_merges_of_a_small_table_in_rank_order():
    ranks = {bytes([c]): i for i, c in enumerate(b"abc")} | {b"ab": 3, b"bc": 4, b"abc": 5, b"cc": 6, b"bca": 7}

    def merged(piece):  # the rank table applied pair by pair
        parts = [piece[i: i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]

    vocabulary, rng = bpe.Vocabulary(ranks), random.Random(1)
    for _ in range(3000):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 14)))
        assert vocabulary.encode_match(piece) == ([ranks[piece]] if piece in ranks else merged(piece))
    with pytest.raises(ValueError):
        vocabulary.encode_match(b"abx")


def test_bpe_of_tables(spark, small, odd_docs, no_docs, library):
    path = bpe.default_path()
    for docs in (small[0], odd_docs):
        want = []
        for r in docs.select("doc_id", "text").collect():
            ids = library[path].encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(r.text or "")))
        got = [tuple(r) for r in bpe.digest(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe.digest(no_docs).count() == 0


def test_long_texts_are_cut_in_runs(spark, library, monkeypatch):
    text = "it's  a\n\n test of 123 runs " * 30_000  # more than RUN matches
    got = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().ids
    assert got == library[bpe.default_path()].encode_ordinary(text)


# 12 Resampling.

def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, n):
    w = words(text)
    return [" ".join(w[i: i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def test_crcs_of_joined_texts():
    rng = random.Random(2)
    pairs = [(rng.randbytes(rng.randint(0, 40)), rng.randbytes(rng.randint(0, 4000))) for _ in range(50)]
    a, b = (np.array([zlib.crc32(p[i]) for p in pairs], np.uint64) for i in (0, 1))
    got = resample.crc_after(a, b, np.array([len(p[1]) for p in pairs], np.int64))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in pairs]


@pytest.mark.parametrize("limit,block", [(resample.WORDS, resample.BLOCK), (50, 3000), (0, 1)])
def test_features_whatever_the_dictionary_holds(small, monkeypatch, limit, block):
    monkeypatch.setattr(resample, "BLOCK", block)
    texts = [None, "", " ,. ", "Ünï-CODE ß1 漢字🙂", "x" * 300, *small[1].values()]
    dictionary = resample.Dictionary(limit)
    for _ in range(2):  # the second time with a dictionary
        got = [[] for _ in texts]
        for i, size, row, bucket in resample.features(pa.array(texts), dictionary, runs=3, buckets=997):
            for r, b in zip(row.tolist(), bucket.tolist()):
                got[i + r].append(b)
            assert size.tolist() == [len(words(t)) for t in texts[i: i + len(size)]]
        for t, g in zip(texts, got):
            assert sorted(g) == sorted(zlib.crc32(x.encode()) % 997 for x in grams(t, 3))


def test_resampling_odd_rows(spark, odd_docs, no_docs):
    target = spark.createDataFrame([(1, "w1x1 w2x2 target words"), (2, None)], "item_id long, text string")
    docs = odd_docs.unionByName(spark.createDataFrame(
        [(i, "some words " * (10 + i % 3)) for i in range(100, 140)], "doc_id long, text string"), allowMissingColumns=True)
    got = resample.resample(docs, target, least=20, percent=10).collect()
    assert len(got) == docs.count()
    fit = [r for r in got if r.n_features >= 20]
    drawn = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [r.rank for r in drawn] == list(range(1, len(fit) // 10 + 1))
    assert [(r.score, r.doc_id) for r in drawn] == [(r.score, r.doc_id) for r in sorted(fit, key=lambda r: (-r.score, r.doc_id))[: len(drawn)]]
    assert all(r.weight == 0 for r in got if r.n_features == 0)
    assert resample.resample(no_docs, target).count() == 0
    assert resample.resample(docs, target.limit(0)).count() == len(got)


# 13 Runs.

def plain_runs(w, least=runs.LEAST):
    out = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def make(rng):
    k, kind = rng.choice([2, 3, 50]), rng.random()
    base = lambda m: [b"w%d" % rng.randrange(k) for _ in range(m)]
    out, n = [], rng.choice([0, 1, 30, 120, 500])
    u = base(rng.randint(1, 6))
    while len(out) < n:
        if kind < 0.4:
            v = base(rng.choice([1, 2, 7, 20, 49, 60, 100, 130]))
            out += (v * 6)[: int(len(v) * rng.choice([2, 2.2, 3, 5]))] + base(rng.randint(0, 3))
        elif kind < 0.7:  # one period, out of phase
            out += (u * 60)[rng.randint(0, 5):][: rng.randint(20, 260)] + base(rng.random() < 0.3)
        else:
            a = u * rng.randint(5, 40) + base(rng.randint(0, 2))
            out += a * rng.randint(2, 4) + base(rng.randint(0, 3))
    return b" ".join(out[:700])


def test_runs_against_all_lags():
    rng = random.Random(3)
    for _ in range(150):
        texts = [make(rng) for _ in range(rng.randint(1, 6))]
        for t, (got, collapsed) in zip(texts, runs.runs_of_texts(texts)):
            w = t.split()
            want = plain_runs(w)
            assert got == want
            gone = {i for a, n, q in want for i in range(a + q, a + n)}
            assert collapsed == b" ".join(x for i, x in enumerate(w) if i not in gone)


def test_hash_clashes_are_looked_at(monkeypatch):
    """With a useless hash every seed extends too far; the words decide."""
    monkeypatch.setattr(runs, "mix", lambda x: x * np.uint64(0) + np.uint64(1))
    u = [b"u%d" % i for i in range(70)]
    text = b" ".join([b"a", b"b"] + u * 3 + [b"c"])
    found = runs.runs_of_texts([text])[0][0]
    assert all(r in plain_runs(text.split()) for r in found)


def test_planted_runs_of_tables(spark, small, odd_docs, no_docs):
    for docs in (small[0], odd_docs):
        want = []
        for r in docs.select("doc_id", "text").collect():
            w, h = (r.text or "").encode().split(), crc(r.doc_id)
            if h % 10 == 0 and w:
                a, g = h // 10 % len(w), h // 10
                p = 1 + (len(w) - a) // (3 + g % 8)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            found = plain_runs(w) if len(w) < 3000 else runs.runs_of_texts([b" ".join(w)])[0][0]
            best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
            gone = {i for a, n, q in found for i in range(a + q, a + n)}
            want.append((r.doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2],
                         sha("".join(f"{a},{n},{q}\n" for a, n, q in found)),
                         sha(b" ".join(x for i, x in enumerate(w) if i not in gone))))
        got = [tuple(r) for r in runs.digest(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert any(r[1] for r in want) or docs is odd_docs
    assert runs.digest(no_docs).count() == 0


def test_runs_are_an_operator_of_their_own(spark):
    docs = spark.createDataFrame([(1, "x " + "a b c " * 5 + "y", "clash"), (2, None, "clash")], "doc_id long, text string, runs string")
    got = {r.doc_id: r for r in runs.find(docs).collect()}
    assert [tuple(r) for r in got[1].runs] == [(1, 15, 3)] and got[1].collapsed == "x a b c y"
    assert got[2].runs == [] and got[2].collapsed == ""
    assert runs.find(docs).agg(F.sum(F.size("runs"))).first()[0] == 1


def test_words_are_cut_only_where_the_pattern_cuts(library, monkeypatch):
    import pyarrow as pa

    path, rng = bpe.default_path(), random.Random(4)
    blanks = [" ", "  ", "\n", "\t ", " \n", " ", "  ", "  ", "  ", "　", "\x1c ", "\x85 "]
    bits = ["don't", "a1", "'s", "été", "漢字", "...", "<|endoftext|>", "x" * 90, "word", "Word,", "\U0001f642"]
    texts = ["".join(rng.choice(blanks if rng.random() < 0.6 else bits) if i % 2 else rng.choice(bits + [""]) for i in range(60)) for _ in range(300)]
    texts += ["", " ", "  ", " a", "a ", "a  ", "\n ", None, "one two"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    for cache in (400_000, 5):
        monkeypatch.setattr(bpe, "CACHE", cache)
        got = [r["ids"] for b in bpe._encode_task(path, bpe.default_pattern())(iter([batch])) for r in b.to_pylist()]
        assert got == [library[path].encode_ordinary(t or "") for t in texts]


def test_known_words_need_no_pattern(monkeypatch):
    import pyarrow as pa
    import regex

    calls, real = [], regex.compile

    class Counted:
        def __init__(self, pattern):
            self.inner = real(pattern)

        def findall(self, text):
            calls.append(text)
            return self.inner.findall(text)

    monkeypatch.setattr(regex, "compile", Counted)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["so many, many words, " * 500] * 2)], ["doc_id", "text"])
    rows = [r for b in bpe._encode_task(bpe.default_path(), bpe.default_pattern())(iter([batch])) for r in b.to_pylist()]
    assert rows[0]["ids"] == rows[1]["ids"] and sum(map(len, calls)) < 100
