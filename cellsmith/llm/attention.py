"""Language-model scores from a small causal self-attention model.

Text is lower-cased (A to Z) and cut into words; a word is the subword ids of
a public byte-level BPE for the word with a space before it, and a text ends
with one end unit.  Units are the ``UNITS`` most frequent ids; a rarer id has its
share of the counts in the unit for all others.

The network's chance of a unit is that of its class given the units before
it, from one layer of causal self-attention with a residual and a term for the
last unit, times its share of the class given the last unit, from smoothed
pair counts.  Classes come from clustering the units by the company they keep.
A word has the product over its units.  The model's chance of a word is
``1 - known`` times that, plus ``known`` times the
network's chance of the class of the word's first unit, among the units
that begin a word or end a text, times the word's share of the training words
of that class.  ``1 - known`` is the share of words seen once among the training tokens, within
``LEAST_KNOWN`` and ``MOST_KNOWN``.  The sum over all words is at most one.

Training, all of it on rows that are not held out: counts of words and of unit
pairs over every text, from which the units are chosen; pairs with other ids count for the unit of all
others.  The network learns from every unit of every text: texts are cut into windows of
``LENGTH`` units, each of which is in one.  It is trained in numpy by
minibatch descent on parts of the windows in parallel and averaged, in
``ROUNDS`` rounds of a share of the windows each.

Scoring: a text's units are cut into windows of ``LENGTH`` inputs that
overlap by ``LENGTH - STRIDE``; each unit is scored once, by the window in which
it is not in the overlap, in batches under the causal mask.

Base score: add-one unigram over words.  The ``HEAD`` most frequent words are
known to every task; rarer words get their counts, for both scores, by a join on their hash, which
no single word can make large.

Cases: null and empty texts are the end alone; without training rows all
counts are 0 and every unit is as likely as any other; repeated rows are
scored alike; null ids count as the empty text in the split; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import Words, id_crc, mix
from cellsmith.session import materialize

RAW_UNITS, UNITS, CLASSES, WIDTH, LENGTH, STRIDE = 50_257, 2048, 32, 16, 16, 12
HEAD, ROUNDS, KEEP_WORDS, MIX = 1 << 18, 3, 1_000_000, 0.9
BATCH, PART, AT_ONCE = 512, 128, 1 << 14  # windows a step of the descent, and at once within it; parameters moved at once
BLOCK = 256  # windows kept in one row
LEAST_KNOWN, MOST_KNOWN, SMOOTH = 0.5, 0.999, 8.0
REPLICA_WINDOWS, MAX_REPLICAS = 100_000, 256
END_RAW, PAD_RAW = 50_256, 65_535
OTHER, END, PAD = 0, 1, UNITS
SLICE, KEEP_COUNTS = 500, 600_000
TOGETHER = 2000  # words encoded in one call
TEXTS = 1000  # texts sent to a worker at once


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Subwords:
    """Subword ids of words by word hash; kept for the life of a worker process."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bpe = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(PAD_RAW + 1, bool)  # ids that begin with a space
        self.begins[[r for b, r in ranks.items() if b[:1] == b" "]] = True
        self.reset()

    def reset(self) -> None:
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.offsets = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def word(self, text: str) -> list[int]:
        return self.bpe.encode_ordinary(" " + text)

    def encode(self, words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words ``which``, one after another, and how many each has.

        Words are encoded together: the pattern cuts before a space that no other blank is next to, so each has the
        ids that it has alone.  Words with blanks of other kinds inside are encoded one by one."""
        flat, sizes = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for k in range(0, len(which), TOGETHER):
            some = which[k: k + TOGETHER]
            text = words.joined(some)
            if len(text.split()) == len(some):
                ids = np.array(self.bpe.encode_ordinary(text), np.uint16)
                sizes.append(np.diff(np.r_[np.flatnonzero(self.begins[ids]), len(ids)]))
            else:
                got = [self.word(words.text(i)) for i in some.tolist()]
                ids = np.array([y for x in got for y in x], np.uint16)
                sizes.append(np.array([len(x) for x in got], np.int64))
            flat.append(ids)
        return np.concatenate(flat), np.concatenate(sizes)

    def slots(self, words: Words, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Slot of each distinct hash (rising); ``first`` is a word with that hash."""
        if len(self.hash) > KEEP_WORDS:
            self.reset()
        at = np.searchsorted(self.hash, hashes)
        known = np.zeros(len(hashes), bool)
        inside = at < len(self.hash)
        known[inside] = self.hash[at[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        if len(new):
            ids, sizes = self.encode(words, first[new])
            base = len(self.offsets) - 1
            self.flat = np.concatenate([self.flat, ids])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
            self.slot = np.insert(self.slot, at[new], np.arange(base, base + len(new), dtype=np.int32))
            self.hash = np.insert(self.hash, at[new], hashes[new])
            at = np.searchsorted(self.hash, hashes)
        return self.slot[at]


def subwords(path: str) -> Subwords:
    kept = sys.__dict__.setdefault("_cellsmith_subwords", {})
    if path not in kept:
        kept[path] = Subwords(path)
    return kept[path]


def spread(flat: np.ndarray, offsets: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated entries of ``slots`` and the size of each."""
    sizes = offsets[slots + 1] - offsets[slots]
    ends = np.cumsum(sizes)
    index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[slots] - (ends - sizes), sizes)
    return flat[index], sizes


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, a place of each, the value's number at every place, and counts (a quick sort, any place will do)."""
    order = np.argsort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[order[1:]] != x[order[:-1]]
    at, inv = np.flatnonzero(new), np.empty(len(x), np.int64)
    inv[order] = np.cumsum(new) - 1
    return x[order[at]], order[at], inv, np.diff(np.append(at, len(x)))


def sequences(words: Words, sub: Subwords, docs: int) -> tuple:
    """Raw ids of all texts with their ends, the end of each text, units per word, and the distinct words."""
    u, first, inv, n = distinct(words.hash)
    slots = sub.slots(words, u, first)  # may add to the tables read below
    ids, sizes = spread(sub.flat, sub.offsets, slots[inv])
    doc = np.repeat(np.arange(docs), np.diff(words.bounds))
    ends = np.cumsum(np.bincount(doc, sizes, docs).astype(np.int64) + 1)
    raw = np.full(int(ends[-1]) if docs else 0, END_RAW, np.uint16)
    inner = np.ones(len(raw), bool)
    inner[ends - 1] = False
    raw[inner] = ids
    return raw, ends, sizes, doc, (u, inv, n)


def word_starts(sizes: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Position of the first unit of every word among all ``n`` units."""
    inner = np.ones(n, bool)
    inner[ends - 1] = False
    return np.flatnonzero(inner)[np.cumsum(sizes) - sizes] if len(sizes) else np.zeros(0, np.int64)


# Training rows.  kind 0: a word's count, 1: up to BLOCK windows of the round in ``hash``, 2: the texts, 3: a pair's count,
# 4: the words that begin with an id.

GATHERED = "kind int, hash long, n long, windows binary"


class _Counts:
    """Counts by key; what is added is merged when there is much of it, not for every slice anew."""

    def __init__(self, kind):
        self.keys, self.n, self.more, self.held = np.zeros(0, kind), np.zeros(0, np.int64), [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        """``keys`` are distinct and rise."""
        self.more.append((keys, n))
        self.held += len(keys)
        if 2 * self.held > KEEP_COUNTS:
            self.merge()

    def merge(self) -> None:
        keys, n = (np.concatenate(x) for x in zip((self.keys, self.n), *self.more))
        order = np.argsort(keys, kind="stable")  # quick on runs that rise
        keys = keys[order]
        first = np.flatnonzero(np.r_[np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])
        self.keys, self.n = keys[first], np.add.reduceat(n[order], first) if len(keys) else n
        self.more, self.held = [], 0

    def taken(self) -> tuple[np.ndarray, np.ndarray]:
        """All counts, by rising key; none are left."""
        self.merge()
        out = self.keys, self.n
        self.keys, self.n = self.keys[:0], self.n[:0]
        return out


def _gather(path: str):
    def rows(kind, hashes, n, windows=None):
        size = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(size, kind, np.int32)), pa.array(hashes), pa.array(n),
             pa.nulls(size, pa.binary()) if windows is None else windows], ["kind", "hash", "n", "windows"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def words_seen():
            keys, n = kept.taken()
            return rows(0, keys.view(np.int64), n)

        def pairs_seen():
            keys, n = pairs.taken()
            return rows(3, keys.astype(np.int64), n)

        sub = subwords(path)
        kept, pairs, begin = _Counts(np.uint64), _Counts(np.uint32), np.zeros(PAD_RAW + 1, np.int64)
        for whole in batches:
            for k in range(0, whole.num_rows, SLICE):
                batch = whole.slice(k, SLICE)
                words = Words(batch.column("text"))
                raw, ends, sizes, _, (u, _, n) = sequences(words, sub, batch.num_rows)
                kept.add(u, n)
                starts = np.r_[0, ends[:-1]]
                before = np.r_[np.uint16(PAD_RAW), raw[:-1]]
                before[starts] = PAD_RAW
                pairs.add(*np.unique(before.astype(np.uint32) << np.uint32(16) | raw, return_counts=True))
                begin += np.bincount(raw[word_starts(sizes, ends, len(raw))], minlength=PAD_RAW + 1)
                yield rows(1, *_blocks(_windows(raw, starts, ends)))
                yield rows(2, np.zeros(1, np.int64), np.array([batch.num_rows], np.int64))
                if len(kept.keys) > KEEP_COUNTS:
                    yield words_seen()
                if len(pairs.keys) > KEEP_COUNTS:
                    yield pairs_seen()
        yield words_seen()
        yield pairs_seen()
        at = np.flatnonzero(begin)
        yield rows(4, at, begin[at])

    return task


def _windows(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Every text cut into windows of ``LENGTH`` raw ids, so that each id is in one; the first id of a row is what
    stands before the window."""
    count = -(-(ends - starts) // LENGTH)
    ahead = np.cumsum(count) - count
    lanes = np.full((int(count.sum()), LENGTH), PAD_RAW, np.uint16)
    lanes.ravel()[np.arange(len(raw)) + np.repeat(ahead * LENGTH - starts, ends - starts)] = raw
    out = np.full((len(lanes), LENGTH + 1), PAD_RAW, np.uint16)
    out[:, 1:] = lanes
    out[1:, 0] = lanes[:-1, -1]
    out[ahead, 0] = PAD_RAW
    offsets = np.arange(len(out) + 1, dtype=np.int32) * (2 * (LENGTH + 1))
    return pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(offsets), pa.py_buffer(out)])


def _hashes(raw: np.ndarray, seed: int = 42) -> np.ndarray:
    """``xxhash64(window, 1)`` of every row of ``LENGTH + 1`` raw ids, as Spark gives it, so that a window's round does not
    depend on where it is dealt."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x, n):
        return x << np.uint64(n) | x >> np.uint64(64 - n)

    def mixed(h):
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        return h ^ h >> np.uint64(32)

    data = np.ascontiguousarray(raw).view(np.uint8)
    long = data.shape[1] // 32 * 32
    longs = np.ascontiguousarray(data[:, :long]).view(np.uint64)
    with np.errstate(over="ignore"):
        start = np.uint64(seed)
        lanes = [np.full(len(raw), x) for x in (start + p1 + p2, start + p2, start, start - p1)]
        for i in range(longs.shape[1]):
            lanes[i % 4] = turned(lanes[i % 4] + longs[:, i] * p2, 31) * p1
        h = sum(turned(x, n) for x, n in zip(lanes, (1, 7, 12, 18)))
        for x in lanes:
            h = (h ^ turned(x * p2, 31) * p1) * p1 + p4
        h = h + np.uint64(data.shape[1])
        for i in range(long, data.shape[1]):
            h = turned(h ^ data[:, i].astype(np.uint64) * p5, 11) * p1
        h = mixed(h) + p5 + np.uint64(4)  # the seed of the 1
        return mixed(turned(h ^ p1, 23) * p2 + p3).view(np.int64)


def _blocks(windows: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The windows dealt to rounds by their hash, in the order they come, and cut into blocks: round, windows and ids of each."""
    raw = np.frombuffer(windows.buffers()[2] or b"", np.uint16).reshape(len(windows), LENGTH + 1)
    turn = _hashes(raw) % ROUNDS
    order = np.argsort(turn, kind="stable")
    size = np.bincount(turn, minlength=ROUNDS)
    n = np.concatenate([np.diff(np.r_[np.arange(0, m, BLOCK), m]) for m in size.tolist()]).astype(np.int64)
    offsets = (np.r_[0, np.cumsum(n)] * raw.itemsize * (LENGTH + 1)).astype(np.int32)
    data = pa.py_buffer(raw[order])
    return np.repeat(np.arange(ROUNDS), -(-size // BLOCK)), n, pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), data])


# The network.

SHAPES = (("emb", (UNITS + 1, WIDTH)), ("pos", (LENGTH, WIDTH)), ("q", (WIDTH, WIDTH)), ("k", (WIDTH, WIDTH)),
          ("v", (WIDTH, WIDTH)), ("o", (WIDTH, WIDTH)), ("out", (WIDTH, CLASSES)), ("skip", (UNITS + 1, CLASSES)),
          ("bias", (CLASSES,)))
CAUSAL = np.tril(np.ones((LENGTH, LENGTH), np.float32))
# Attention scores and class scores are held within these, so that their exponentials need no maximum.
MOST_SCORE, MOST_LOGIT = 30.0, 60.0
SCORED, LEAST_SUM = 256, np.float32(1e-37)  # windows scored at once; no sum is below


def initial(class_counts: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for name, shape in SHAPES:
        scale = {"emb": 0.3, "pos": 0.1}.get(name, 0.0 if name in ("skip", "bias") else 1 / np.sqrt(WIDTH))
        p[name] = (rng.standard_normal(shape) * scale).astype(np.float32)
    p["bias"] = np.log((class_counts + 1) / (class_counts.sum() + CLASSES)).astype(np.float32)
    return p


_ONES = {np.dtype(kind).char: np.ones(max(WIDTH, LENGTH, CLASSES), kind) for kind in (np.float32, np.float64)}


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums over the last axis, as a product (it is short, and a reduction over it slow)."""
    return (x.reshape(-1, x.shape[-1]) @ _ONES[x.dtype.char][: x.shape[-1]]).reshape(*x.shape[:-1], 1)


def _weights(q: np.ndarray, x: np.ndarray, late: int = 0, out: np.ndarray | None = None) -> np.ndarray:
    """Causal attention weights of the queries ``q`` (times the keys' matrix, scaled) on the states ``x``."""
    s = np.matmul(q, x.transpose(0, 2, 1), out=out)
    np.clip(s, -MOST_SCORE, MOST_SCORE, out=s)
    np.exp(s, out=s)
    s *= CAUSAL[late:]
    total = _sums(s)
    s *= np.divide(1, total, out=total)
    return s


def _folded(q: np.ndarray, k: np.ndarray, v: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Both products of the attention, each as one matrix: the scores' and the values'."""
    return np.concatenate([q @ k.T * q.dtype.type(1 / np.sqrt(WIDTH)), v @ o], 1)


class _Ready:
    """What scoring with parameters that do not change needs of them, and room for ``rows`` windows from lane ``late`` on."""

    def __init__(self, p: dict, rows: int, late: int = 0):
        self.folded, self.skip = _folded(p["q"], p["k"], p["v"], p["o"]), p["skip"] + p["bias"]
        # Attention is a mean, so a class score is no further from 0 than the furthest of each of its terms together.
        values = self.folded[:, WIDTH:] @ p["out"]
        terms = p["emb"] @ p["out"] + self.skip, p["pos"] @ p["out"], p["emb"] @ values, p["pos"] @ values
        self.clip = not sum(float(np.abs(t).max()) for t in terms) < 0.99 * MOST_LOGIT  # also when not a number
        kind, lanes = self.skip.dtype, LENGTH - late
        self.x, self.y = np.empty((rows, LENGTH, WIDTH), kind), np.empty((rows, LENGTH, 2 * WIDTH), kind)
        self.s, self.h = np.empty((rows, lanes, LENGTH), kind), np.empty((rows, lanes, WIDTH), kind)
        self.z, self.after = np.empty((rows, lanes, CLASSES), kind), np.empty((rows, lanes, CLASSES), kind)


def attend(p: dict, inp: np.ndarray, late: int = 0, ready: _Ready | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hidden states of input units ``(batch, LENGTH)`` from lane ``late`` on, causal, and the attention weights."""
    ready, n = ready or _Ready(p, len(inp), late), len(inp)
    x, y = np.take(p["emb"], inp, 0, mode="clip", out=ready.x[:n]), ready.y[:n]
    x += p["pos"]
    np.matmul(x.reshape(-1, WIDTH), ready.folded, out=y.reshape(-1, 2 * WIDTH))
    s = _weights(y[:, late:, :WIDTH], x, late, ready.s[:n])
    h = np.matmul(s, y[..., WIDTH:], out=ready.h[:n])
    h += x[:, late:]
    return h, s


def logits(p: dict, h: np.ndarray, inp: np.ndarray, ready: _Ready | None = None) -> np.ndarray:
    """Class scores, held within ``MOST_LOGIT``."""
    ready, n = ready or _Ready(p, len(inp), LENGTH - inp.shape[1]), len(inp)
    z = ready.z[:n]
    np.matmul(h.reshape(-1, WIDTH), p["out"], out=z.reshape(-1, CLASSES))
    z += np.take(ready.skip, inp, 0, mode="clip", out=ready.after[:n])
    return np.clip(z, -MOST_LOGIT, MOST_LOGIT, out=z) if ready.clip else z


def log_classes(p: dict, h: np.ndarray, inp: np.ndarray) -> np.ndarray:
    z = logits(p, h, inp)
    z -= np.log(_sums(np.exp(z)))
    return z


def _rows_sum(order: np.ndarray, first: np.ndarray, to: np.ndarray, values: np.ndarray, work: np.ndarray, out: np.ndarray) -> None:
    """Sums of rows into the rows ``to`` of ``out``; ``order`` puts those of one sum together, ``first`` is where each begins.

    Two columns (their number is even) are added at once, as one complex number."""
    pairs = np.complex64 if values.dtype == np.float32 else np.complex128
    rows = np.take(values.view(pairs), order, 0, mode="clip", out=work[: len(order)].view(pairs))
    out[:] = 0
    out[to] = np.add.reduceat(rows, first).view(values.dtype)


# The parameters as one array, in this order.
_ENDS = np.cumsum([int(np.prod(shape)) for _, shape in SHAPES]).tolist()


def _views(flat: np.ndarray) -> dict[str, np.ndarray]:
    return {name: flat[a:b].reshape(shape) for (name, shape), a, b in zip(SHAPES, [0, *_ENDS], _ENDS)}


def _pack(p: dict) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name, _ in SHAPES])


class _Work:
    """Room for the steps of a descent over up to ``rows`` windows, kept from step to step so that none is asked for anew."""

    def __init__(self, rows: int, kind):
        lanes, part = rows * LENGTH, min(rows, PART)
        room = {"d": (lanes, CLASSES), "dx": (lanes, WIDTH), "sorted": (lanes, CLASSES), "skip": (UNITS + 1, CLASSES),
                "x": (part, LENGTH, WIDTH), "y": (part, LENGTH, 2 * WIDTH), "dy": (part, LENGTH, 2 * WIDTH), "h": (part, LENGTH, WIDTH),
                "a": (part, LENGTH, LENGTH), "da": (part, LENGTH, LENGTH), "t": (part, LENGTH, LENGTH), "more": (part, LENGTH, WIDTH),
                "after": (part * LENGTH, CLASSES)}
        self.__dict__.update((name, np.empty(shape, kind)) for name, shape in room.items())


def _gradient(p: dict, inp: np.ndarray, goal: np.ndarray, g: dict, work: _Work, with_loss: bool = False) -> float:
    """The gradient of the mean class loss over ``goal`` (``-1``: not scored) goes to ``g``; the loss is worked out only if asked for.

    ``PART`` windows are worked on at once, so that what is in between stays in the cache."""
    kind, loss = p["emb"].dtype.type, 0.0
    units, to = inp.astype(np.intp).ravel(), goal.ravel()
    used = np.flatnonzero(to >= 0)
    n = max(1, len(used))
    hit = used * CLASSES + to[used]
    unused = np.flatnonzero(to < 0)
    edges = np.arange(0, len(to) + PART * LENGTH, PART * LENGTH)
    bounds, gaps = np.searchsorted(used, edges).tolist(), np.searchsorted(unused, edges).tolist()
    one, scale = kind(1 / n), kind(1 / np.sqrt(WIDTH))
    skip, folded = np.add(p["skip"], p["bias"], out=work.skip), _folded(p["q"], p["k"], p["v"], p["o"])
    d_out, d_folded = np.zeros_like(p["out"].T), np.zeros_like(folded.T)
    every, rows = work.d.ravel(), len(units)
    for k, i in enumerate(range(0, len(inp), PART)):
        batch = min(PART, len(inp) - i)
        lanes = slice(i * LENGTH, (i + batch) * LENGTH)
        unit, b = units[lanes], batch * LENGTH
        x, y, a, da, dy, t, more = (room[:batch] for room in (work.x, work.y, work.a, work.da, work.dy, work.t, work.more))
        np.take(p["emb"], unit, 0, mode="clip", out=x.reshape(b, WIDTH))
        x += p["pos"]
        flat, h = x.reshape(b, WIDTH), work.h[:batch].reshape(b, WIDTH)
        np.matmul(flat, folded, out=y.reshape(b, 2 * WIDTH))
        q, v = y[..., :WIDTH], y[..., WIDTH:]
        _weights(q, x, out=a)
        np.matmul(a, v, out=work.h[:batch])
        h += flat
        d = np.matmul(h, p["out"], out=work.d[lanes])
        d += np.take(skip, unit, 0, mode="clip", out=work.after[:b])
        np.clip(d, -MOST_LOGIT, MOST_LOGIT, out=d)
        some = slice(bounds[k], bounds[k + 1])
        if with_loss:
            loss -= float(every[hit[some]].sum())
        np.exp(d, out=d)
        total = _sums(d)
        if with_loss:
            loss += float(np.log(total.ravel()[used[some] - lanes.start]).sum())
        np.divide(one, total, out=total)
        if gaps[k] < gaps[k + 1]:
            total[unused[gaps[k]: gaps[k + 1]] - lanes.start] = 0
        d *= total
        every[hit[some]] -= one
        d_out += d.T @ h
        dh = np.matmul(d, p["out"].T, out=work.dx[lanes])
        dc = dh.reshape(batch, LENGTH, WIDTH)
        np.matmul(dc, v.transpose(0, 2, 1), out=da)
        da *= a
        da -= np.multiply(a, _sums(da), out=t)  # through the softmax
        np.matmul(da, x, out=dy[..., :WIDTH])
        np.matmul(a.transpose(0, 2, 1), dc, out=dy[..., WIDTH:])
        d_folded += dy.reshape(b, 2 * WIDTH).T @ flat
        dc += np.matmul(da.transpose(0, 2, 1), q, out=more)
        dh += np.matmul(dy.reshape(b, 2 * WIDTH), folded.T, out=more.reshape(b, WIDTH))
    g["out"][:] = d_out.T
    scores, values = d_folded[:WIDTH].T * scale, d_folded[WIDTH:].T
    g["q"][:], g["k"][:], g["v"][:], g["o"][:] = scores @ p["k"], scores.T @ p["q"], values @ p["o"].T, p["v"].T @ values
    order = np.argsort(units.astype(np.uint16), kind="stable")  # sorted by digits, as 64-bit values are not
    unit = units[order]
    first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    to = unit[first]
    dx = work.dx[:rows]
    _rows_sum(order, first, to, work.d[:rows], work.sorted, g["skip"])
    _rows_sum(order, first, to, dx, work.sorted.ravel()[: dx.size].reshape(dx.shape), g["emb"])
    g["bias"][:] = np.ones(UNITS + 1, kind) @ g["skip"]  # every lane is after some unit
    g["pos"][:] = (np.ones(len(inp), kind) @ dx.reshape(len(inp), -1)).reshape(LENGTH, WIDTH)
    return loss / n


def loss_and_gradient(p: dict, inp: np.ndarray, goal: np.ndarray) -> tuple[float, dict]:
    """Mean class loss over ``goal`` (``-1``: not scored) and its gradient."""
    g, kind = {name: np.empty_like(p[name]) for name, _ in SHAPES}, p["skip"].dtype
    p = {name: p[name].astype(kind, copy=False) for name, _ in SHAPES}
    return _gradient(p, inp, goal, g, _Work(len(inp), kind), with_loss=True), g


def descend(p: dict, inp: np.ndarray, goal: np.ndarray, rate: float, batch: int = BATCH, seed: int = 0) -> dict:
    """One pass of minibatch descent with adaptive steps."""
    flat = _pack(p)
    m, s, g, t = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat), np.empty(AT_ONCE, flat.dtype)
    now, grown, work = _views(flat), _views(g), _Work(min(batch, len(inp)), flat.dtype)
    cuts = [slice(a, a + AT_ONCE) for a in range(0, len(flat), AT_ONCE)]
    order = np.random.default_rng(seed).permutation(len(inp))
    for step, i in enumerate(range(0, len(order), batch), 1):
        _gradient(now, inp[order[i: i + batch]], goal[order[i: i + batch]], grown, work)
        # m is ten times the mean of the gradients, s a hundred times that of their squares.
        root = float(np.sqrt(0.01 / (1 - 0.99 ** step)))
        for at in cuts:
            a, b, c = m[at], s[at], t[: len(m[at])]
            a *= 0.9
            a += g[at]
            b *= 0.99
            b += np.multiply(g[at], g[at], out=c)
            np.sqrt(b, out=c)
            c += 1e-6 / root
            np.divide(a, c, out=c)
            c *= 0.1 * rate / (1 - 0.9 ** step) / root
            flat[at] -= c
    return now


# A model is a dict of arrays, so that workers need nothing of this package to read it:
# unit_of (unit of a raw id), rare (log share of an id among all others), class_of (class of a unit), params, share (log share of a unit in its
# class, after each unit), begins (training words by class of the first unit; the end's class: texts)
# and begin_log (log share of a class that begins a word or is the end).


def clusters(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Class of each unit from its left and right neighbours; other and end have their own."""
    total = max(1.0, float(pairs.sum()))
    m = np.outer(pairs.sum(1) / total, pairs.sum(0)).astype(np.float32)
    np.divide(pairs, m, out=m, where=m > 0)
    np.log(np.maximum(m, 1, out=m), out=m)  # positive pointwise information
    m = np.concatenate([m, m.T], 1)
    rng = np.random.default_rng(3)
    y = rng.standard_normal((m.shape[1], 16)).astype(np.float32)
    for _ in range(4):
        y = np.linalg.qr(m.T @ (m @ y))[0]
    x = m @ y
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-6
    n = CLASSES - 2
    top = np.argsort(-counts, kind="stable")[:n]
    centre = x[top].copy()
    weight = np.sqrt(counts + 1)
    for _ in range(12):
        near = (x @ centre.T).argmax(1)
        for c in range(n):
            if (near == c).any():
                centre[c] = (x[near == c] * weight[near == c, None]).sum(0)
        centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-6
    near = (x @ centre.T).argmax(1) + 2
    near[OTHER], near[END] = 0, 1
    return near.astype(np.int64)


def shares(pairs: np.ndarray, counts: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """Log share of each unit within its class after each unit (the last row: after nothing)."""
    member = np.zeros((UNITS, CLASSES), np.float32)
    member[np.arange(UNITS), class_of] = 1
    plain = (counts + 0.5) / ((counts + 0.5) @ member)[class_of]
    in_class = pairs @ member  # (previous, class)
    out = (pairs + SMOOTH * plain).astype(np.float32)
    out /= (in_class[:, class_of] + SMOOTH).astype(np.float32)
    return np.log(out, out=out)


def rare_shares(id_count: np.ndarray, unit_of: np.ndarray) -> np.ndarray:
    """Log share of a raw id in the unit of all others, from the ids' counts; 0 for ids with a unit of their own."""
    other = unit_of[:RAW_UNITS] == OTHER
    out = np.zeros(PAD_RAW + 1)
    out[:RAW_UNITS][other] = np.log((id_count[other] + 0.5) / (id_count[other] + 0.5).sum())
    return out


def _train_task(model, round_no: int, rate: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        p, n, held, size = m["params"], 0, [], 0
        unit_of = m["unit_of"].astype(np.int16)
        goal_of = np.append(m["class_of"], -1).astype(np.int16)

        def learn(p: dict, rows: list[bytes]) -> dict:
            raw = np.frombuffer(b"".join(rows), np.uint16).reshape(-1, LENGTH + 1)
            raw = raw[np.argsort(mix(raw[:, :4].astype(np.uint64).sum(1)), kind="stable")]
            u = unit_of[raw]
            return descend(p, u[:, :-1], goal_of[u[:, 1:]], rate, seed=round_no)

        for batch in batches:
            n += sum(batch.column("n").to_pylist())
            for row in batch.column("windows"):
                held.append(row.as_py())
                size += len(held[-1]) // (2 * (LENGTH + 1))
                if size >= REPLICA_WINDOWS:  # a task holds no more, however many come to it
                    p, held, size = learn(p, held), [], 0
        if held:
            p = learn(p, held)
        if n:
            flat = np.concatenate([p[n].ravel() for n, _ in SHAPES])
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["n", "params"])

    return task


def train(windows: DataFrame, unit_of: np.ndarray, pairs: np.ndarray, begin: np.ndarray) -> dict:
    """A model from blocks of windows (``turn`` the round, ``n`` windows, their raw ids), pair counts ``(UNITS + 1, UNITS)``
    and counts of words by first raw id (at the end's id: texts)."""
    spark = windows.sparkSession
    counts = pairs.sum(0)
    class_of = clusters(pairs[:UNITS], counts)
    class_counts = np.bincount(class_of, pairs.sum(0), CLASSES)
    begins = np.bincount(class_of[np.minimum(unit_of[:RAW_UNITS], UNITS - 1)], begin[:RAW_UNITS], CLASSES)
    with np.errstate(divide="ignore"):
        begin_log = np.maximum(np.log(np.minimum(1, begins / np.maximum(1, np.maximum(class_counts, begins)))), -1e3)
    model = {"unit_of": unit_of, "class_of": class_of, "params": initial(class_counts), "begins": begins,
             "share": shares(pairs, counts, class_of), "begin_log": begin_log.astype(np.float32)}
    if not pairs.sum():
        return model
    n = windows.agg(F.sum("n")).first()[0] or 0
    replicas = int(max(1, min(MAX_REPLICAS, n // REPLICA_WINDOWS)))
    for r in range(ROUNDS):
        part = windows.where(F.col("turn") == r).select("n", "windows")
        sent = spark.sparkContext.broadcast({name: model[name] for name in ("unit_of", "class_of", "params")})
        # One row of parameters per replica, at most MAX_REPLICAS.
        got = part.repartition(replicas).mapInArrow(
            _train_task(sent, r, 0.01 / (1 + r)), "n long, params binary").collect()
        weight = np.array([g.n for g in got], float)
        if not len(weight):
            continue
        mean = sum(np.frombuffer(g.params, np.float32) * w for g, w in zip(got, weight / weight.sum())).astype(np.float32)
        del got  # not held while the next round's come
        at = 0
        for name, shape in SHAPES:
            size = int(np.prod(shape))
            model["params"][name] = mean[at: at + size].reshape(shape)
            at += size
        sent.unpersist()
    return model


# Scoring.

def window_scores(model: dict, units: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Natural log chance of each unit, and of its class among units that begin a word or end a text.

    ``units`` holds all texts, ``ends`` their ends; the second is given for the places ``firsts``
    (the first units of words) and the ends alone."""
    n, p = len(units), model["params"]
    starts = np.r_[0, ends[:-1]]
    before = np.empty(n, np.int64)
    before[1:] = units[:-1]
    before[starts] = PAD
    share = model["share"]
    out = np.take(share.ravel(), before * share.shape[1] + units, mode="clip").astype(np.float64)
    late = LENGTH - STRIDE
    count = -(-(ends - starts) // STRIDE)
    total = int(count.sum())
    # Every text in lanes of its own, a multiple of STRIDE; a window is a row of lanes with the last of the row before.
    ahead = np.cumsum(count) - count
    place = np.arange(n) + np.repeat(ahead * STRIDE - starts, ends - starts)
    inp = np.full((total + 1, STRIDE), PAD, np.int16)
    inp[1:].ravel()[place] = before
    inp = np.concatenate([inp[:-1, STRIDE - late:], inp[1:]], 1)
    inp[ahead, :late] = PAD
    goal = np.zeros(total * STRIDE, np.int16)
    goal[place] = model["class_of"].astype(np.int16)[units]
    got = np.empty((total * STRIDE, 2), np.float32)
    both = np.stack([np.ones(CLASSES, np.float32), np.exp(model["begin_log"])], 1)
    ready, first = _Ready(p, min(SCORED, total), late), np.arange(min(SCORED, total) * STRIDE) * CLASSES
    for i in range(0, total, SCORED):
        at = inp[i: i + SCORED].astype(np.intp)
        z = logits(p, attend(p, at, late, ready)[0], at[:, late:], ready).reshape(-1, CLASSES)
        lanes = slice(i * STRIDE, i * STRIDE + len(z))
        right = np.take(z.ravel(), first[: len(z)] + goal[lanes], mode="clip")
        sums = np.matmul(np.exp(z, out=z), both, out=got[lanes])
        np.log(np.maximum(sums, LEAST_SUM, out=sums), out=sums)
        np.subtract(right[:, None], sums, out=sums)
    out += np.take(got[:, 0], place, mode="clip")
    begin = np.zeros(n)
    for some in (firsts, ends - 1):
        to = place[some]
        begin[some] = got[to, 1] + model["begin_log"][goal[to]]
    return out, begin


def word_scores(units: np.ndarray, begin: np.ndarray, sizes: np.ndarray, ends: np.ndarray, share: np.ndarray,
                known: float = MIX) -> tuple[np.ndarray, np.ndarray]:
    """Natural log chance of each text, and of each word by its units alone.

    ``units`` and ``begin`` are by unit as from ``window_scores``; ``sizes`` and
    ``share`` (the word's share of its class, 0 when not known here) by word; ``known`` is the weight of
    known words."""
    both = lambda net, part: np.log((1 - known) * np.exp(net) + known * part + 1e-300)
    total = both(units[ends - 1], np.exp(begin[ends - 1]))
    if not len(sizes):
        return total, np.zeros(0)
    first = word_starts(sizes, ends, len(units))
    is_end = np.zeros(len(units), bool)
    is_end[ends - 1] = True
    net = np.add.reduceat(units[~is_end], np.cumsum(sizes) - sizes)
    total += np.bincount(np.searchsorted(ends, first, "right"), both(net, np.exp(begin[first]) * share), len(ends))
    return total, both(net, 0.0)


def _score_task(path: str, model, head):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sub, m, (head_hash, head_log) = subwords(path), model.value, head.value
        rid = TaskContext.get().partitionId() << 40
        for whole in batches:
            for k in range(0, whole.num_rows, SLICE):
                batch = whole.slice(k, SLICE)
                docs = batch.num_rows
                words = Words(batch.column("text"))
                raw, ends, sizes, doc, (u, inv, _) = sequences(words, sub, docs)
                per_doc = np.diff(words.bounds)
                at = np.searchsorted(head_hash, u)
                got = at < len(head_hash)
                got[got] = head_hash[at[got]] == u[got]
                value = np.zeros(len(u))
                value[got] = head_log[at[got]]
                base = np.bincount(doc, value[inv], docs)
                known = np.bincount(doc, got[inv], docs).astype(np.int64)
                tail = np.flatnonzero(~got[inv])
                units = m["unit_of"][raw]
                firsts = word_starts(sizes, ends, len(raw))
                net, begin = window_scores(m, units, ends, firsts)
                net += m["rare"][raw]
                group = m["class_of"][units[firsts]]
                share = np.where(got, 10.0 ** value - 1, 0.0)[inv] / np.maximum(1, m["begins"][group])
                score, spelled = word_scores(net, begin, sizes, ends, share, m["known"])
                # A word past the head: its chance among known words for each training word, over its chance so far.
                lift = begin[firsts[tail]] - np.log(np.maximum(1, m["begins"][group[tail]])) - spelled[tail] + np.log(m["known"])
                rids = rid + np.arange(docs)
                rid += docs
                t = len(tail)
                none = np.r_[np.zeros(docs, bool), np.ones(t, bool)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.r_[rids, rids[doc[tail]]]),
                    pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(t, pa.int64())]),
                    pa.array(np.r_[per_doc + 1, np.zeros(t, np.int64)], pa.int64(), mask=none),
                    pa.array(np.r_[known, np.zeros(t, np.int64)], pa.int64(), mask=none),
                    pa.array(np.r_[base, np.zeros(t)], pa.float64(), mask=none),
                    pa.array(np.r_[score / np.log(10), np.zeros(t)], pa.float64(), mask=none),
                    pa.array(np.r_[np.zeros(docs, np.int64), u.view(np.int64)[inv[tail]]], pa.int64(), mask=~none),
                    pa.array(np.r_[np.zeros(docs), lift].astype(np.float32), pa.float32(), mask=~none)],
                    ["rid", "doc_id", "n_tokens", "n_known", "base", "score", "hash", "lift"])

    return task


@contextmanager
def _short_batches(spark, rows: int = TEXTS):
    """At most ``rows`` rows in an Arrow batch of the jobs run inside, as both sides hold a batch of texts in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def score_texts(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row."""
    spark = docs.sparkSession
    path = path or default_path()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    held = F.pmod(id_crc(), F.lit(7)) == 2
    with _short_batches(spark):
        got = materialize(rows.where(~held).select("text").mapInArrow(_gather(path), GATHERED), "lm-gather")
    counts = got.where("kind = 0").groupBy("hash").agg(F.sum("n").alias("c"))
    vocabulary = materialize(counts, "lm-words")
    windows = got.where("kind = 1").select(F.col("hash").alias("turn"), "n", "windows")
    ends = got.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    total, distinct, once = vocabulary.agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1)).first()
    n, v = (total or 0) + ends, distinct + (1 if ends else 0)
    # HEAD rows at most.
    top = vocabulary.orderBy(F.desc("c"), "hash").limit(HEAD).toArrow()
    head_hash = top.column("hash").to_numpy().astype(np.int64).view(np.uint64)
    head_count = top.column("c").to_numpy()
    order = np.argsort(head_hash)
    head = spark.sparkContext.broadcast((head_hash[order], np.log10(head_count[order] + 1)))

    # Pairs of raw ids; the sum keeps the ids that are units, at most (UNITS + 1) ** 2 rows.
    pairs = got.where("kind = 3").groupBy(F.shiftright("hash", 16).cast("int").alias("a"), F.pmod("hash", F.lit(65536)).cast("int").alias("b")).agg(F.sum("n").alias("n"))
    pairs = materialize(pairs, "lm-pairs")
    ids = pairs.where(F.col("b") != END_RAW).groupBy("b").agg(F.sum("n").alias("n")).toArrow()  # a row per raw id
    id_count = np.zeros(RAW_UNITS)
    id_count[ids.column("b").to_numpy()] = ids.column("n").to_numpy()
    best = [int(x) for x in np.argsort(-id_count, kind="stable")[:UNITS - 2] if id_count[x]]
    unit_of = np.zeros(PAD_RAW + 1, np.int64)
    unit_of[best] = np.arange(2, 2 + len(best))
    unit_of[END_RAW], unit_of[PAD_RAW] = END, PAD
    names = [*best, END_RAW, PAD_RAW]
    named = [(int(x), int(unit_of[x])) for x in names]

    def units(column, out):
        return F.broadcast(spark.createDataFrame(named, f"{column} int, {out} long"))

    # Every pair counts; ids that are no units count as the unit of all others.
    few = pairs.join(units("a", "ua"), "a", "left").join(units("b", "ub"), "b", "left")
    few = few.groupBy(F.coalesce("ua", F.lit(OTHER)).cast("short").alias("ua"), F.coalesce("ub", F.lit(OTHER)).cast("short").alias("ub"))
    few = few.agg(F.sum("n").cast("float").alias("n")).toArrow()
    table = np.zeros((UNITS + 1, UNITS + 1), np.float32)
    table[few.column("ua").to_numpy(), few.column("ub").to_numpy()] = few.column("n").to_numpy()
    del few
    firsts = got.where("kind = 4").groupBy("hash").agg(F.sum("n").alias("n")).toArrow()  # a row per raw id
    begin = np.zeros(PAD_RAW + 1)
    begin[firsts.column("hash").to_numpy()] = firsts.column("n").to_numpy()
    begin[END_RAW] = ends
    made = train(windows, unit_of, table[:, :UNITS], begin)
    made["rare"] = rare_shares(id_count, unit_of)
    # The chance of a new word is the share of words seen once.
    made["known"] = float(min(MOST_KNOWN, max(LEAST_KNOWN, 1 - (once or 0) / n))) if n else MIX
    model = spark.sparkContext.broadcast(made)

    schema = "rid long, doc_id long, n_tokens long, n_known long, base double, score double, hash long, lift float"
    with _short_batches(spark):
        scored = materialize(rows.mapInArrow(_score_task(path, model, head), schema), "lm-scores")
    tail = scored.where("hash is not null").select("rid", "hash", "lift").join(vocabulary, "hash")
    # log(1 + exp(x)), x the word's chance among known words over its chance by its units alone.
    x = F.col("lift").cast("double") + F.log(F.col("c"))
    more = (F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x)))) / F.lit(float(np.log(10)))
    tail = tail.groupBy("rid").agg(F.count("*").alias("_k"), F.sum(F.log10(F.col("c") + 1)).alias("_b"), F.sum(more).alias("_m"))
    out = scored.where("hash is null").drop("hash", "lift").join(tail, "rid", "left")
    end_log = float(np.log10(ends + 1))
    base = F.col("base") + F.coalesce("_b", F.lit(0.0)) + F.lit(end_log) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))
    known = F.col("n_known") + F.coalesce("_k", F.lit(0)) + F.lit(1 if ends else 0)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", known.cast("long").alias("n_known"),
                      F.lit(int(n)).cast("long").alias("train_tokens"), base.alias("base_score"),
                      (F.col("score") + F.coalesce("_m", F.lit(0.0))).alias("score"))
