"""Each operator against a brute-force version, and on odd rows."""

import hashlib
import json
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellsmith.llm import (
    attention, chosen_path, common, decontam, licenses, perspectives, raking, ring, syncmers, token_counts, toxicity,
)

SF = "/root/testdata/sf0.001"


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i: i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


# Words and groups.

def test_words_match_the_pattern(monkeypatch):
    texts = ["A bC  déf\tX", None, "", "  ", "one", "two\x0bthree four", "x" * 50, "end"]
    for chunk in (1 << 20, 7):
        monkeypatch.setattr(common, "CHUNK", chunk)
        got = common.Words(pa.array(texts))
        for i, t in enumerate(texts):
            a, b = got.bounds[i], got.bounds[i + 1]
            assert [got.text(k) for k in range(a, b)] == words(t)
        assert got.hash[got.bounds[4]] == common.Words(pa.array(["ONE"])).hash[0]


def test_groups_stream_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.range(200).select((F.col("id") % 9).alias("g"), "id")
        got = common.by_group(rows, "g", lambda g: [{"g": int(g["key"]), "n": len(g["id"])}], "g long, n long").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.g, r.n) for r in got) == [(g, len(range(g, 200, 9))) for g in range(9)]


# 1 License scan.

def test_license_scan(spark, odd_docs, no_docs):
    mit = licenses.TEMPLATES[5][1]
    edited = mit.replace("free of charge", "at no charge")
    df = spark.createDataFrame([
        (1, "x y z Released under the MIT License. more words"), (2, "before " * 700 + mit + " after" * 900), (3, edited),
        (4, "nothing of the kind"), (5, " ".join(mit.split()[:30])), (6, None)], "doc_id long, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan(df).collect()}
    assert got[(1, "MIT-line")] == 1.0 and got[(2, "MIT")] == 1.0 and 0.75 <= got[(3, "MIT")] < 1
    assert {d for d, _ in got} == {1, 2, 3}
    assert licenses.scan(odd_docs).count() == 0 and licenses.scan(no_docs).count() == 0


def test_license_lines_of_the_tables(spark):
    """Every document of the given tables with a license line is found, as the license it names."""
    for sf in ("sf0.001", "sf0.01"):
        df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        want = {r.doc_id for r in df.where(r"text rlike '(?i)(licensed|released) under'").collect()}
        got = licenses.scan(df).collect()
        assert want and want <= {r.doc_id for r in got}
        nc = {r.doc_id for r in df.where("text like '%CC BY-NC 4.0%'").collect()}
        assert nc and nc == {r.doc_id for r in got if r.license == "CC-BY-NC-4.0-line"}


def test_license_templates_do_not_meet_others(spark):
    """Each template is found in its own text; nearly equal notices are told apart."""
    rows = [(i, text) for i, (_, text) in enumerate(licenses.TEMPLATES)]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    want = {i: {name} for i, (name, _) in enumerate(licenses.TEMPLATES)}
    want[6].add("Apache-2.0-line")  # the notice begins with the line
    held = {"MIT-text": {"MIT"}, "ISC-text": {"ISC"}, "Unlicense-text": {"Unlicense"},
            "BSD-text": {"BSD", "BSD-source", "BSD-binary", "BSD-disclaimer"}}  # whole texts hold their notices
    for i, (name, _) in enumerate(licenses.TEMPLATES):
        want[i] |= held.get(name, set())
    assert got == want


def test_whole_license_texts(spark):
    """Found inside long texts wherever they stand and with words changed, but not by their first half."""
    rng = np.random.default_rng(12)
    rows, want = [], {}
    for i, (name, text) in enumerate(licenses.WHOLE):
        w = text.split()
        for j, at in enumerate(rng.integers(0, 4000, 4)):
            s = list(w)
            for k in rng.choice(len(s), j, replace=False):
                s[k] = "other"
            rows.append((10 * i + j, " ".join([*(f"x{v}" for v in rng.integers(0, 999, at)), *s, *(f"y{v}" for v in rng.integers(0, 999, 500))])))
            want[10 * i + j] = name
        rows.append((10 * i + 9, " ".join(w[: len(w) // 2])))
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    assert all(0.75 <= got[i][name] <= 1 for i, name in want.items()) and all(got[i][want[i]] == 1 for i in want if i % 10 == 0)
    assert {name for i, found in got.items() for name in found if i % 10 == 9} <= {n for n, _ in licenses.TEMPLATES if not n.endswith("-text")}


# 2 Toxicity.

def brute_segments(v):
    """Maximal-scoring segments by their definition: the best first, then on both sides."""
    best = max(((sum(v[a:b]), -(b - a), -a, a, b) for a in range(len(v)) for b in range(a + 1, len(v) + 1)), default=None)
    if not best or best[0] <= 0:
        return []
    a, b = best[3], best[4]
    return brute_segments(v[:a]) + [(a, b)] + [(x + b, y + b) for x, y in brute_segments(v[b:])]


def test_segments_match_the_definition():
    rng = np.random.default_rng(1)
    for _ in range(150):
        v = rng.normal(-0.2, 1, rng.integers(0, 14))
        got = [(a, b) for a, b, _ in toxicity.segments(v)]
        assert got == brute_segments(list(v))


def test_toxicity_learns_and_bounds(spark, odd_docs, no_docs):
    rng = np.random.default_rng(5)
    vocab = [f"word{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(600):
        w = list(rng.choice(vocab, 60))
        toxic = int(i % 5 == 0)
        if toxic:
            for k in rng.choice(60, 5, replace=False):
                w[k] = str(rng.choice(["vile", "nasty", "rotten"]))
        rows.append((i, " ".join(w)))
        labels.append((i, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (99999, None), (5, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, lab).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == (r.doc_id % 5 == 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)
    odd = toxicity.toxicity(odd_docs, lab).collect()
    assert len(odd) == 11 and all(r.predicted == 0 for r in odd)
    assert toxicity.toxicity(no_docs, lab).count() == 0
    assert all(r.predicted == 0 for r in toxicity.toxicity(docs, lab.limit(0)).collect())


# 3 Fingerprints.

def test_fingerprints(spark, small):
    df, texts = small
    got = {r.doc_id: r for r in syncmers.fingerprints(df).collect()}
    ids = sorted(texts)
    assert sorted(got) == ids
    for k, i in enumerate(ids):
        t, nxt = texts[i], texts[ids[(k + 1) % len(ids)]]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        mine, other = (syncmers.sketch(syncmers.anchors(syncmers.code_points(x))) for x in (t, edited))
        assert r.fingerprint == syncmers.to_text(mine) and r.edited_fingerprint == syncmers.to_text(other)
        assert r.near_edited == syncmers.likeness(mine, other)
    assert np.mean([r.near_edited for r in got.values()]) > 0.4 > 0.05 > np.mean([r.near_next for r in got.values()])


def test_long_texts_keep_the_anchors_of_a_passage():
    """Two long texts that share three hundred of their words have about that share of anchors in common."""
    rng = np.random.default_rng(9)
    text = lambda n: " ".join("".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(n))
    shared = text(300)
    for _ in range(5):
        x, y = (syncmers.sketch(syncmers.anchors(syncmers.code_points(t))) for t in
                (text(4000) + " " + shared + " " + text(3000), text(4000) + " " + shared + " " + text(3000)))
        assert len(x[0]) > 3 * syncmers.SIZE and abs(syncmers.likeness(x, y) - 300 / 7300) < 0.025
    for n in (40, 400, 4000):  # the same error at every length, less for long texts
        a, b = text(n), text(n)
        whole, half = (syncmers.sketch(syncmers.anchors(syncmers.code_points(t))) for t in (a, a[: len(a) // 2] + b[: len(a) - len(a) // 2]))
        assert abs(syncmers.likeness(whole, half) - 0.5) < 0.2 and syncmers.likeness(whole, whole) == 1


def test_syncmers_by_definition():
    text = "the quick brown fox jumps over the lazy dog " * 3
    c = syncmers.code_points(text)
    inner, _ = syncmers._roll(c)
    w = syncmers.K - syncmers.S + 1
    want = [i for i in range(len(c) - syncmers.K + 1) if min(inner[i: i + w]) in (inner[i], inner[i + w - 1])]
    assert syncmers.anchors(c)[1].tolist() == want


def test_fingerprints_of_odd_rows(spark, odd_docs, no_docs):
    got = syncmers.fingerprints(odd_docs).collect()
    assert len(got) == 11 and syncmers.fingerprints(no_docs).count() == 0
    same = {r.fingerprint for r in got if r.doc_id in (4, 5)}
    assert len(same) == 1 and {r.fingerprint for r in got if r.n_chars == 0} == {""}
    one = syncmers.fingerprints(odd_docs.where("doc_id = 6")).collect()[0]
    assert one.near_next == 1.0


# 4 Sharding.

def brute_ring(docs, cells, nodes, capacity):
    filled, out = [0] * len(capacity), {}
    for pos_cell, rank, key in docs:
        order = [s for c, s in nodes if c >= pos_cell] + [s for _, s in nodes]
        shard = next(s for s in order if filled[s] < capacity[s])
        out[key] = (shard, filled[shard])
        filled[shard] += 1
    return out


def test_ring_places_like_one_key_after_another(spark, small):
    df, texts = small
    cells = 512
    got = ring.shard(df, cells=cells, vnodes=8).collect()
    pos = df.select("doc_id", F.xxhash64(F.lit("key"), F.col("doc_id").cast("string")).alias("p"),
                    F.pmod(F.xxhash64(F.lit("key"), F.col("doc_id").cast("string")), F.lit(cells)).alias("c")).collect()
    order = sorted((r.c, r.p, r.doc_id) for r in pos)
    nodes = ring.ring_nodes(spark, 8, 8, cells)
    want = brute_ring(order, cells, nodes, ring.capacities(len(order), 8, 0.0))
    assert {r.doc_id: (r.shard, r.slot) for r in got} == want
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_ring_laws_and_odd_rows(spark, odd_docs, no_docs):
    got = ring.manifest(odd_docs).collect()
    n = Counter(r.shard for r in got)
    assert len(got) == 11 and max(n.values()) - min(n.get(s, 0) for s in range(8)) <= 1
    assert {r.size for r in got if r.doc_id in (0, 1)} == {1}
    assert ring.manifest(no_docs).count() == 0
    loose = ring.shard(odd_docs, slack=10.0).collect()
    assert all(r.shard == r.owner for r in loose)


# 5 Language model.

def test_gradient():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in attention.initial(np.ones(attention.CLASSES)).items()}
    p["skip"] = rng.normal(0, 0.1, p["skip"].shape)
    inp = rng.integers(0, 50, (3, attention.LENGTH))
    goal = rng.integers(-1, attention.CLASSES, (3, attention.LENGTH))
    _, g = attention.loss_and_gradient(p, inp, goal)
    for name in p:
        at = tuple(rng.integers(0, s) for s in p[name].shape)
        if name in ("emb", "skip"):
            at = (int(inp[1, 4]), at[1])
        step = {k: v.copy() for k, v in p.items()}
        step[name][at] += 1e-4
        up = attention.loss_and_gradient(step, inp, goal)[0]
        step[name][at] -= 2e-4
        down = attention.loss_and_gradient(step, inp, goal)[0]
        assert g[name][at] == pytest.approx((up - down) / 2e-4, rel=2e-2, abs=1e-5), name


def test_attention_is_causal():
    p = attention.initial(np.ones(attention.CLASSES))
    a = np.arange(attention.LENGTH)[None] % 40
    b = a.copy()
    b[0, 9:] = 3
    ha, hb = attention.attend(p, a)[0], attention.attend(p, b)[0]
    assert np.allclose(ha[0, :9], hb[0, :9]) and not np.allclose(ha[0, 9:], hb[0, 9:])


def test_windows_score_every_unit_once():
    rng = np.random.default_rng(2)
    counts = np.ones(attention.UNITS)
    cls = rng.integers(0, attention.CLASSES, attention.UNITS)
    share = rng.random(attention.CLASSES).astype(np.float32)
    model = {"unit_of": np.arange(65536), "class_of": cls, "params": attention.initial(np.ones(attention.CLASSES)),
             "share": attention.shares(np.zeros((attention.UNITS + 1, attention.UNITS)), counts, cls),
             "begins": np.ones(attention.CLASSES), "begin_log": np.log(share)}
    sizes = [1, 5, 12, 13, 40]
    units = rng.integers(2, 500, sum(sizes))
    ends = np.cumsum(sizes)
    firsts = np.flatnonzero(rng.random(len(units)) < 0.5)
    got, begin = attention.window_scores(model, units, ends, firsts)
    wanted = {*firsts.tolist(), *(ends - 1).tolist()}
    at = 0
    for n in sizes:  # a text of its own: one window after another
        seq = units[at: at + n]
        before = np.r_[attention.PAD, seq[:-1]]
        late = attention.LENGTH - attention.STRIDE
        for i in range(n):
            lo = i // attention.STRIDE * attention.STRIDE - late
            lane = [before[k] if 0 <= k < n else attention.PAD for k in range(lo, lo + attention.LENGTH)]
            h, _ = attention.attend(model["params"], np.array([lane]))
            z = attention.log_classes(model["params"], h, np.array([lane]))
            c = cls[seq[i]]
            want = z[0, i - lo, c] + model["share"][before[i], seq[i]]
            assert got[at + i] == pytest.approx(want, rel=1e-4)
            first = np.exp(z[0, i - lo]) * share
            assert begin[at + i] == pytest.approx(np.log(first[c] / first.sum()) if at + i in wanted else 0, rel=1e-4, abs=1e-5)
        at += n


def test_language_model_base_is_exact(spark, small):
    df, texts = small
    got = attention.score_texts(df).collect()
    counts, ends = Counter(), 0
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words(t))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    assert len(got) == len(texts)
    for r in got:
        w = words(texts[r.doc_id])
        want = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) + math.log10((ends + 1) / (n + v + 1))
        assert r.base_score == pytest.approx(want) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(w) + 1, sum(counts[x] > 0 for x in w) + 1)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) and math.isfinite(r.score) and r.score < 0


def test_language_model_knows_words_past_the_head(spark, small, monkeypatch):
    df, _ = small
    whole = {r.doc_id: (r.score, r.base_score, r.n_known) for r in attention.score_texts(df).collect()}
    monkeypatch.setattr(attention, "HEAD", 3)
    for r in attention.score_texts(df).collect():
        score, base, known = whole[r.doc_id]
        assert r.score == pytest.approx(score, rel=1e-5) and r.base_score == pytest.approx(base) and r.n_known == known


def test_pairs_count_over_all_texts_however_cut(monkeypatch):
    import pyarrow as pa

    texts = [f"ab{i} c d{i % 7} e" for i in range(90)] + ["", None]
    path, got = attention.default_path(), []
    for cut, keep in ((2000, 600_000), (7, 5)):
        monkeypatch.setattr(attention, "SLICE", cut)
        monkeypatch.setattr(attention, "KEEP_COUNTS", keep)
        counts = Counter()
        batches = [pa.RecordBatch.from_arrays([pa.array(texts[i: i + 40], pa.string())], ["text"]) for i in range(0, len(texts), 40)]
        for b in attention._gather(path)(iter(batches)):
            for r in b.to_pylist():
                if r["kind"] == 3:
                    counts[r["hash"] >> 16, r["hash"] & 65535] += r["n"]
        got.append(counts)
    sub, want = attention.Subwords(path), Counter()
    for t in texts:
        ids = [x for w in words(t or "") for x in sub.word(w)] + [attention.END_RAW]
        want.update(zip([attention.PAD_RAW, *ids], ids))
    assert got[0] == want and got[1] == want


def test_language_model_of_odd_rows(spark, odd_docs, no_docs):
    got = attention.score_texts(odd_docs).collect()
    assert len(got) == 11 and all(math.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (0, 1, 3)} == {1}
    assert attention.score_texts(no_docs).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    only = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    assert {r.n_known for r in attention.score_texts(only).collect()} == {0}


# 6 Perspectives.

def test_perspectives(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 300, "ann", "bye"), (1, 300, "ann", "bye"),
            (2, 0, "system", "alone"), (3, None, None, "who"), (None, 1, "ann", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS start", "'s' AS segment")
    got = perspectives.perspectives(df).collect()
    views = {}
    for r in sorted(got, key=lambda r: r.start):
        views.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(views) == {(1, "ann"), (1, "bob"), (3, "unknown"), (None, "ann")}
    text = "".join(r.segment for r in views[(1, "bob")])
    assert text == ("<|system|>\nbe kind<|end|>\n<|user name=ann|>\nhi<|end|>\n<|assistant|>\n<|end|>\n"
                    "<|user name=ann|>\nbye<|end|>\n<|user name=ann|>\nbye<|end|>\n")
    for v in views.values():
        whole = "".join(r.segment for r in v)
        for r in v:
            assert whole[r.start: r.end] == r.segment
            if r.trained:
                assert whole[r.mask_start: r.mask_end].endswith("<|end|>\n") and not whole[r.mask_start: r.mask_end].startswith("<|ass")
            assert r.trained == (r.chat_role == "assistant") == (r.mask_start is not None)
    assert perspectives.perspectives(df.limit(0)).count() == 0


def test_perspectives_of_a_hot_dialogue(spark):
    """One dialogue holds most rows, with very long texts and many participants: every span is as in one pass."""
    rng = np.random.default_rng(13)
    rows = [(7, int(t), f"p{int(t) % 5}", "z" * (200_000 if t == 50 else int(rng.integers(0, 40)))) for t in range(3000)]
    rows += [(c, t, "ann" if t % 2 else "bob", "hello") for c in range(20) for t in range(4) if c != 7]
    got = perspectives.perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    spans = {}
    for r in got.select("conv_id", "perspective", "turn", "start", "end").collect():
        spans.setdefault((r.conv_id, r.perspective), []).append((r.turn, r.start, r.end))
    assert len(spans) == 5 + 19 * 2 and sum(map(len, spans.values())) == 5 * 3000 + 19 * 2 * 4
    for (conv, who), found in spans.items():
        at = 0
        turns = sorted(r[1:] for r in rows if r[0] == conv)
        for (turn, start, end), (want, speaker, text) in zip(sorted(found), turns):
            head = "<|assistant|>\n" if speaker == who else f"<|user name={speaker}|>\n"
            assert (turn, start, end) == (want, at, at + len(head) + len(text) + len("<|end|>\n"))
            at = end


# 7 Decontamination.

def edit_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        diag, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            diag, row[j] = row[j], min(diag + (p != t), row[j] + 1, row[j - 1] + 1)
    return min(row)


def test_myers_matches_dynamic_programming():
    rng = np.random.default_rng(3)
    for _ in range(200):
        p = "".join(rng.choice(list("abc"), rng.integers(1, 80)))
        t = "".join(rng.choice(list("abc"), rng.integers(0, 90)))
        assert decontam.myers(p, t) == edit_distance(p, t)


def test_decontamination(spark, odd_docs, no_docs):
    rng = np.random.default_rng(4)
    letters = list("abcdefghij ")
    items = ["".join(rng.choice(letters, 120)).strip() for _ in range(12)] + [None, "", "short", "x" * 30]
    bench = spark.createDataFrame([*enumerate(items), (50, items[0])], "item_id long, text string")
    docs = []
    for i, t in enumerate(items[:12]):
        s = list(t)
        for k in rng.choice(len(s), i, replace=False):
            s[k] = str(rng.choice(list("klmn")))
        docs.append((i, "".join(rng.choice(letters, 300)) + " " + "".join(s).upper() + "\n" + "".join(rng.choice(letters, 200))))
    df = spark.createDataFrame([*docs, (100, "clean text"), (101, None)], "doc_id long, text string")
    norm = {i: decontam.normal(t) for i, t in enumerate(items)} | {50: decontam.normal(items[0])}
    want = {}
    for i, t in [*docs, (100, "clean text"), (101, None)]:
        hits = [(k, edit_distance(p, decontam.normal(t))) for k, p in norm.items() if len(p) >= decontam.MIN_CHARS]
        want[i] = sorted((k, d) for k, d in hits if d <= int(decontam.ERROR * len(norm[k])))
    for chars in (10 ** 6, 400):  # one block, several blocks
        got = {r.doc_id: list(zip(r["items"], r.distances)) for r in decontam.find(df, bench, block_chars=chars).collect()}
        assert got == want
    assert want[3] and want[0] == [(0, 0), (50, 0)]
    twice = decontam.find(df.union(df), bench, block_chars=400).collect()  # repeated documents, several blocks
    assert Counter((r.doc_id, tuple(zip(r["items"], r.distances))) for r in twice) == {(i, tuple(m)): 2 for i, m in want.items()}
    odd = decontam.find(odd_docs, bench, block_chars=400, keep=tuple(odd_docs.columns))
    assert odd.count() == 11 and odd.where("contaminated").count() == 0
    assert set(odd.columns) == set(odd_docs.columns) | {"distances", "contaminated"}
    assert decontam.find(odd_docs, bench).where("contaminated").count() == 0
    assert decontam.find(odd_docs, bench).count() == 11 and decontam.find(no_docs, bench).count() == 0
    assert decontam.find(df, bench.limit(0)).where("contaminated").count() == 0


# 8 Near-duplicates.

def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            n = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                up[max(find(i), find(j))] = min(find(i), find(j))
    return {i: find(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def near_copies(n, seed, size=120, edits=3):
    """A base text and copies with a few words changed."""
    rng = np.random.default_rng(seed)
    base = [f"v{k}" for k in rng.integers(0, 5000, size)]
    out = []
    for _ in range(n):
        w = list(base)
        for k in rng.integers(0, size, rng.integers(0, edits + 1)):
            w[k] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


def check_components(spark, texts):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want, sizes = brute_components(texts)
    got = {r.doc_id: r for r in chosen_path.near_duplicates(df).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_duplicates_small_tables(spark, small):
    check_components(spark, small[1])
    texts = dict(enumerate([t for s in range(12) for t in near_copies(6, s)]))
    check_components(spark, texts)


def test_near_duplicates_large_groups(spark, monkeypatch):
    """Nodes above the leaf size branch, and dense ones are joined in rounds of blocks."""
    monkeypatch.setattr(chosen_path, "LEAF", 24)
    texts = near_copies(150, 77) + near_copies(40, 78, edits=6) + [t for s in range(30) for t in near_copies(2, 100 + s)]
    passage = " ".join(f"p{k}" for k in range(40))
    rng = np.random.default_rng(9)
    texts += [passage + " " + " ".join(f"q{k}" for k in rng.integers(0, 10**6, 60)) for _ in range(80)]
    check_components(spark, dict(enumerate(texts)))


def unlike_copies(n, seed, size=400, edits=10):
    """A text and copies that are near to it (0.77), but not to each other (0.61)."""
    rng = np.random.default_rng(seed)
    base = [f"v{k}" for k in range(size)]
    out = [" ".join(base)]
    for c in range(n):
        w = list(base)
        for k in rng.choice(np.arange(4, size - 4), edits, replace=False):
            w[k] = f"e{c}x{k}"
        out.append(" ".join(w))
    return out


def test_near_duplicates_unlike_copies_of_one_text(spark, monkeypatch):
    """Copies that are linked through one original alone, in a group above the leaf size."""
    monkeypatch.setattr(chosen_path, "LEAF", 200)
    texts = unlike_copies(600, 3)
    check_components(spark, dict(enumerate([*texts[1:], texts[0]])))


def test_nodes_deal_their_blocks_apart(spark):
    rows = spark.range(4000).select(F.lit(1).alias("node"), F.col("id").cast("string").cast("binary").alias("cid"), F.lit(6 * chosen_path.LEAF).alias("size"))
    a, b = ([r.k for r in rows.withColumn("node", F.lit(n).cast("long")).select(chosen_path._block(1).alias("k")).collect()] for n in (5, 6))
    assert set(a) == set(b) == set(range(12))
    assert np.mean(np.array(a) == np.array(b)) == pytest.approx(1 / 12, abs=0.03)


def test_shared_counts_all_pairs():
    rng = np.random.default_rng(12)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(15)]
    sets += [np.unique(rng.integers(0, 5000, 300).astype(np.uint64)) for _ in range(25)]
    got = chosen_path.shared(sets)
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            assert got[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))


def test_near_duplicates_odd_rows(spark, odd_docs, no_docs):
    got = chosen_path.near_duplicates(odd_docs).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got}
    assert all(by[i].kept and by[i].component_id == i and by[i].n_shingles == 0 for i in (0, 1, 3))
    assert by[7].component_id == 2 and by[5].component_id == 4 and by[4].kept and not by[5].kept
    assert by[None].kept and by[None].component_id is None
    assert chosen_path.near_duplicates(no_docs).count() == 0


def test_components(spark):
    rng = np.random.default_rng(6)
    edges = [(f"{a:04d}", f"{a + 1:04d}") for a in range(60)] + [(f"{a:04d}", f"{b:04d}") for a, b in rng.integers(100, 160, (40, 2)) if a != b]
    df = spark.createDataFrame(edges, "a string, b string")
    got = {r.id: r.label for r in chosen_path.components(df).collect()}
    up = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == {k: v for k, v in up.items() if k in got} and {k for k, v in up.items() if k != v} <= set(got)


# 9 Token counts.

def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.default_path())


def test_token_counts(spark, small, odd_docs, no_docs):
    tok = library()
    count = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    df, texts = small
    for r in token_counts.count_tokens(df).collect():
        t = texts[r.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), count(t), count(t) > 1024)
    want = Counter((r.doc_id, len((r.text or "").encode()), count(r.text)) for r in odd_docs.collect())
    for chunk in (token_counts.CHUNK, 500):
        got = token_counts.count_tokens(odd_docs, chunk=chunk, overlap=32).collect()
        assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(no_docs).count() == 0


@pytest.mark.parametrize("chunk, overlap", [(64, 8), (100, 40), (300, 64)])
def test_chunks_splice(chunk, overlap):
    tok = library()
    encode = lambda t: tok.encode(t, add_special_tokens=False)
    rng = np.random.default_rng(8)
    parts = ["word", " the", "  ", "\n\n", "'s", "12", "é", "漢字", "🙂", "<|endoftext|>", "!!", " a", "a" * 150, " " * 90, "x1y"]
    for _ in range(60):
        t = "".join(rng.choice(parts, rng.integers(1, 120)))
        assert token_counts.chunked_count(t, encode, chunk, overlap) == len(encode(t).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_any_tokenizer(small, name):
    """A file of another kind is counted by its library, not by the byte-level pattern."""
    import public_tokenizers

    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        count = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    texts = [None, "", "It's  the THIRD\n\n line, e\u0301t 12", "<|endoftext|> a", *list(small[1].values())[:200], "The word's end. " * 90]
    assert token_counts.counter(path, chunk=500, overlap=32)(texts) == [count(t) if t else 0 for t in texts]


def test_plain_byte_level_files():
    from tokenizers import Tokenizer

    stated = json.loads(Tokenizer.from_file(token_counts.default_path()).to_str())
    assert token_counts.plain_bytes(stated)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": stated["pre_tokenizer"] | {"add_prefix_space": True}},
                   {"pre_tokenizer": None}, {"model": stated["model"] | {"end_of_word_suffix": "</w>"}}):
        assert not token_counts.plain_bytes(stated | change)


# 10 Mixing.

def test_raking_stops_on_the_residual():
    """Margins are met to the tolerance; targets that cannot be met are stated, not passed over."""
    rng = np.random.default_rng(5)
    cells = [(f"a{i}", f"b{j}", float(rng.integers(1, 10 ** int(rng.integers(1, 7))))) for i in range(6) for j in range(9)]
    tokens = np.array([c[2] for c in cells])
    for tolerance in (1e-4, 1e-10):
        w = raking.rake_local(cells, 2, None, 0.7, 5000, tolerance) * tokens
        for d in range(2):
            shares = Counter()
            for c in cells:
                shares[c[d]] += c[2] / tokens.sum()
            goal = raking.tempered(shares, 0.7)
            got = Counter()
            for c, x in zip(cells, w):
                got[c[d]] += x / tokens.sum()
            assert max(abs(got[k] - goal[k]) for k in goal) <= tolerance
    apart = [("x", "u", 10.0), ("y", "v", 10.0)]  # x holds u alone, so the two margins contradict each other
    with pytest.warns(UserWarning, match="off by"):
        raking.rake_local(apart, 2, [{"x": 0.9, "y": 0.1}, {"u": 0.5, "v": 0.5}], 0.7, 20)


def test_given_topics(spark):
    docs = spark.createDataFrame([(1, "plain words", "law"), (2, "a | b", None), (3, None, "law")], "doc_id long, text string, topic string")
    got = raking.with_topic(docs, given="topic").collect()
    assert {(r.doc_id, r.topic, r.n_tokens) for r in got} == {(1, "law", 2), (2, "table", 3), (3, "law", 0)}


def test_raking(spark, odd_docs, no_docs):
    rows = [(i, f"s{i % 3}", "en" if i % 4 else "fr", "prose", 10 + i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic string, n_tokens long")
    goals = [{"s0": 0.5, "s1": 0.3, "s2": 0.2}, {"en": 0.6, "fr": 0.4}, {"prose": 1.0}]
    parts = {}
    for limit in (100_000, 1):  # on the driver, and as tables
        got = raking.mix(df, targets=goals, max_cells=limit).collect()
        assert len(got) == 3000
        total = sum(r.n_tokens * r.probability * r.weight for r in got)
        for col, goal in zip(("source", "lang"), goals):
            for k, share in goal.items():
                part = sum(r.n_tokens * r.probability * r.weight for r in got if r[col] == k)
                assert part / total == pytest.approx(share, abs=2e-3)
        kept = sum(r.n_tokens * r.probability for r in got) / sum(r.n_tokens for r in got)
        assert kept == pytest.approx(raking.KEEP, abs=1e-3)
        assert abs(sum(r.sampled for r in got) / 3000 - np.mean([r.probability for r in got])) < 0.03
        parts[limit] = {r.doc_id: (r.probability, r.sampled) for r in got}
    assert parts[1] == parts[100_000]
    odd = raking.mix(raking.with_topic(odd_docs)).collect()  # its columns probability, topic and n_tokens are replaced
    assert all(isinstance(r.probability, float) and r.topic != "x" for r in odd)
    assert len(odd) == 11 and raking.mix(raking.with_topic(no_docs)).count() == 0


def test_columns_of_the_outputs_names(spark, odd_docs):
    """Kept columns of an output's name are replaced; private names leave them as they are."""
    bench = spark.createDataFrame([(1, "an id is missing here today, says the item")], "item_id long, text string")
    docs = odd_docs.selectExpr("*", "'x' AS passages", "'x' AS _text", "'x' AS __text")
    got = decontam.find(docs, bench, keep=tuple(docs.columns)).collect()
    assert len(got) == 11 and all(r["items"] == [] for r in got) and {r._text for r in got} == {"x"}
    scored = toxicity.score(docs, toxicity.Model(), keep=tuple(docs.columns))
    assert {len(r.passages) for r in scored.collect()} == {0} and len(scored.columns) == len(docs.columns) + 1
    names = common.private(docs.columns, *toxicity.NAMES)
    kept = toxicity.score(docs, toxicity.Model(), keep=tuple(docs.columns), names=names)
    assert {(r.score, r.passages) for r in kept.collect()} == {("x", "x")}


def test_tasks_read_broadcasts_without_the_package():
    """Broadcast values hold plain and numpy values only, so a worker without the package can load them."""
    import pickle
    import subprocess
    import sys
    import tempfile

    train = attention.initial(np.ones(attention.CLASSES))
    for value in (dict(vars(toxicity.Model(scores={"a": 1.0}))), {"params": train, "unit_of": np.zeros(3)}):
        with tempfile.NamedTemporaryFile(suffix=".pkl") as f:
            f.write(pickle.dumps(value))
            f.flush()
            code = f"import pickle; pickle.load(open({f.name!r}, 'rb'))"
            subprocess.run([sys.executable, "-c", code], check=True, cwd=tempfile.gettempdir())


def test_training_windows_hold_every_unit_once():
    sizes = np.array([1, 15, 16, 17, 200])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    raw = np.arange(ends[-1]).astype(np.uint16)
    rows = [np.frombuffer(x, np.uint16) for x in attention._windows(raw, starts, ends).to_pylist()]
    goals = [x for r in rows for x in r[1:].tolist() if x != attention.PAD_RAW]
    assert goals == raw.tolist()
    for r in rows:
        first = int(r[1])
        assert r[0] == (attention.PAD_RAW if first in starts else first - 1)
    assert len(attention._windows(raw[:0], starts[:0], ends[:0])) == 0


def test_training_windows_travel_in_blocks():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["alpha", "Beta,", "x9", "\u00e9t\u00e9", "no\u00a0break", "\u2028line", "a\u00a0\u00a0"], 400)) for _ in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    path = attention.default_path()
    rows = [r for b in attention._gather(path)(iter([batch])) for r in b.to_pylist() if r["kind"] == 1]
    size = 2 * (attention.LENGTH + 1)
    assert sum(r["n"] for r in rows) > 5 * attention.BLOCK > 5 * max(len(rows) - 2 * attention.ROUNDS, 0)
    got, turn = Counter(), {}
    for r in rows:
        assert r["n"] <= attention.BLOCK and len(r["windows"]) == r["n"] * size
        for i in range(r["n"]):
            window = r["windows"][i * size: (i + 1) * size]
            got[window] += 1
            assert turn.setdefault(window, r["hash"]) == r["hash"]
    sub, want = attention.Subwords(path), Counter()
    for t in texts:  # every word encoded alone
        ids = [attention.PAD_RAW, *(x for w in words(t) for x in sub.word(w)), attention.END_RAW]
        ids += [attention.PAD_RAW] * (-(len(ids) - 1) % attention.LENGTH)
        for i in range(0, len(ids) - 1, attention.LENGTH):
            want[np.array(ids[i: i + attention.LENGTH + 1], np.uint16).tobytes()] += 1
    assert got == want and set(turn.values()) == set(range(attention.ROUNDS))


def test_gradient_does_not_depend_on_the_parts(monkeypatch):
    rng = np.random.default_rng(1)
    p = attention.initial(np.ones(attention.CLASSES))
    inp, goal = rng.integers(0, 50, (70, attention.LENGTH)), rng.integers(-1, attention.CLASSES, (70, attention.LENGTH))
    loss, g = attention.loss_and_gradient(p, inp, goal)
    monkeypatch.setattr(attention, "PART", 9)
    other, h = attention.loss_and_gradient(p, inp, goal)
    assert other == pytest.approx(loss) and all(np.allclose(g[k], h[k], atol=1e-6) for k in g)


def test_short_batches_put_the_setting_back(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with pytest.raises(ValueError):
        with attention._short_batches(spark, 7):
            assert spark.conf.get(name) == "7"
            raise ValueError
    assert spark.conf.get(name) == before


def test_rounds_of_windows_are_by_sparks_hash(spark):
    from pyspark.sql import functions as F

    raw = np.random.default_rng(6).integers(0, 65_536, (200, attention.LENGTH + 1)).astype(np.uint16)
    df = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(raw)], "i int, w binary")
    want = [r.h for r in df.select("i", F.xxhash64("w", F.lit(1)).alias("h")).orderBy("i").collect()]
    assert attention._hashes(raw).tolist() == want and len(attention._hashes(raw[:0])) == 0


def test_descent_keeps_its_room_and_asks_for_no_loss(monkeypatch):
    """Steps of a descent share their room, whatever the parts; the parameters are those of plain adaptive steps."""
    rng = np.random.default_rng(3)
    p = attention.initial(np.ones(attention.CLASSES))
    n = 2 * attention.PART + 9
    inp = rng.integers(0, 50, (n, attention.LENGTH))
    goal = rng.integers(-1, attention.CLASSES, inp.shape)
    made, wanted = [], []
    work, step = attention._Work, attention._gradient
    monkeypatch.setattr(attention, "_Work", lambda *a: made.append(work(*a)) or made[-1])
    monkeypatch.setattr(attention, "_gradient", lambda *a: wanted.append(step(*a)) or wanted[-1])
    got = attention.descend(p, inp, goal, 0.01, batch=attention.PART + 5)
    assert len(made) == 1 and wanted == [0.0] * 2
    flat = attention._pack(p).astype(np.float64)
    m, s, order = np.zeros_like(flat), np.zeros_like(flat), np.random.default_rng(0).permutation(n)
    for k, i in enumerate(range(0, n, attention.PART + 5), 1):
        some = order[i: i + attention.PART + 5]
        monkeypatch.setattr(attention, "_gradient", step)
        g = attention._pack(attention.loss_and_gradient(attention._views(flat), inp[some], goal[some])[1])
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        flat -= 0.01 * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.99 ** k)) + 1e-6)
    assert np.abs(attention._pack(got) - flat).max() < 2e-3


def test_counts_are_merged_now_and_then(monkeypatch):
    monkeypatch.setattr(attention, "KEEP_COUNTS", 40)
    rng, want = np.random.default_rng(8), Counter()
    kept, merged = attention._Counts(np.uint64), []
    merge = kept.merge
    monkeypatch.setattr(kept, "merge", lambda: merged.append(1) or merge())
    for _ in range(12):
        keys, n = np.unique(rng.integers(0, 30, 9).astype(np.uint64), return_counts=True)
        kept.add(keys, n)
        want.update(dict(zip(keys.tolist(), n.tolist())))
    assert 0 < len(merged) < 12
    keys, n = kept.taken()
    assert dict(zip(keys.tolist(), n.tolist())) == want and (np.diff(keys.astype(int)) > 0).all()
    assert [len(x) for x in kept.taken()] == [0, 0]


def test_class_scores_are_held_only_where_they_may_pass():
    p = attention.initial(np.ones(attention.CLASSES))
    inp = np.random.default_rng(4).integers(0, attention.UNITS, (5, attention.LENGTH))
    assert not attention._Ready(p, 5).clip
    for name in ("skip", "emb", "out"):
        wide = p | {name: p[name] * 100 + (100 if name == "skip" else 0)}
        assert attention._Ready(wide, 5).clip
        z = attention.logits(wide, attention.attend(wide, inp)[0], inp)
        assert np.abs(z).max() <= attention.MOST_LOGIT
    assert attention._Ready(p | {"out": p["out"] * np.nan}, 5).clip
