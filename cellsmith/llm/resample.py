"""Importance resampling towards a target: hashed n-gram buckets by an Aho-Corasick dictionary.

Words are runs of letters, digits and non-ASCII bytes; A to Z are
lower-cased and every other byte is a delimiter.  A task keeps a dictionary of
the distinct words it has met, each bounded by a delimiter on both sides, in an
automaton whose payloads are the word's CRC-32 and byte length.  A scan over a
block of texts emits the payloads.  Stretches the scan has no word for are cut
into words directly, and those enter the dictionary, which is
rebuilt when the new ones outnumber a part of it.  ``WORDS`` bounds the dictionary;
words beyond it, and words of more than ``LONG`` bytes, are always cut directly, with the same
result.

A feature of ``n`` words is the words joined by one space.  Its CRC follows
from the payloads of adjacent words: the CRC of a concatenation is the first
CRC, moved on by the second's length, xor the second.  The bucket is the CRC
modulo ``BUCKETS``.

Buckets are counted over all documents (``s`` of ``S``) and all target texts
(``t`` of ``T``); tasks send their sums by bucket, at most ``BUCKETS`` rows each.
The gain of a bucket is ``floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B))))`` and
a document's weight the floored mean over its features.  Documents of at
least ``LEAST`` words get ``weight + floor(-1000 ln(-ln u))``, ``u`` from a hash of the
id, and the greatest ``PERCENT`` percent are drawn: a sample without replacement in proportion to
``exp(weight / 1000)``.  Ranks come from a range exchange of the drawn scores,
not from one task.

Cases: null and empty texts have no features and weight 0; words of any length count; repeated
rows are drawn alike, ordered among themselves by weight and feature count;
a null id hashes as the empty text; empty tables give no
counts, so every gain is that of the other table's share; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import string_buffers
from cellsmith.session import materialize

BUCKETS, RUNS, LEAST, PERCENT, SEED = 10_000, 1, 20, 10, 2024
WORDS, LONG, BLOCK = 200_000, 120, 1 << 21

# Bytes of words, lower-cased; every other byte is a space.
_MAP = np.full(256, 0x20, np.uint8)
for _a, _b in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _MAP[_a:_b] = np.arange(_a, _b)
_MAP[0x41:0x5B] = np.arange(0x61, 0x7B)
_WORD = re.compile(rb"[^ ]+")


def _times(rows: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Product of a GF(2) matrix (image of every bit) and 32-bit values."""
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where(x >> np.uint64(bit) & np.uint64(1), rows[bit], np.uint64(0))
    return out


def crc_after(a: np.ndarray, b: np.ndarray, b_size: np.ndarray) -> np.ndarray:
    """CRC-32 of the concatenations of texts with CRCs ``a`` and ``b``."""
    out, size = a.astype(np.uint64), b_size.copy()
    # One zero byte shifts the register by eight; row ``i`` is the image of bit ``i``.
    rows = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint64)  # fixed value: the CRC-32 polynomial
    for _ in range(3):
        rows = _times(rows, rows)
    while size.any():
        odd = (size & 1).astype(bool)
        out[odd] = _times(rows, out[odd])
        rows = _times(rows, rows)
        size >>= 1
    return out ^ b.astype(np.uint64)


class Dictionary:
    """Delimiter-bounded words with payloads ``crc << 8 | length``, and the scan."""

    def __init__(self, limit: int = WORDS):
        self.limit, self.size, self.fresh, self.auto = limit, 0, {}, None
        self.known: dict[bytes, int] = {}

    def _rebuild(self) -> None:
        import ahocorasick

        self.known.update(self.fresh)
        self.fresh.clear()
        self.auto = ahocorasick.Automaton()
        for word, payload in self.known.items():
            self.auto.add_word(f" {word.decode('latin-1')} ", payload)
        self.auto.make_automaton()

    def _add(self, word: bytes) -> int:
        crc = zlib.crc32(word)
        if len(word) <= LONG and len(self.known) + len(self.fresh) < self.limit:
            self.fresh[word] = crc << 8 | len(word)
        return crc

    def scan(self, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, byte length and CRC of every word of ``block``, which begins and ends with a space."""
        starts = sizes = crcs = np.zeros(0, np.int64)
        if self.auto is not None:
            flat = np.fromiter(chain.from_iterable(self.auto.iter(block.decode("latin-1"))), np.int64)
            payload = flat[1::2]
            sizes, crcs = payload & 255, payload >> 8
            starts = flat[0::2] - sizes
        # Gaps: from the delimiter behind a word to the delimiter before the next one.
        solid = np.cumsum(np.frombuffer(block, np.uint8) != 0x20)
        lo, hi = np.r_[0, starts + sizes], np.r_[starts, len(block)]
        open_ = np.flatnonzero(solid[hi - 1] > solid[lo])
        rest = []
        for a, b in zip(lo[open_].tolist(), hi[open_].tolist()):
            rest += [(m.start(), m.end() - m.start(), self._add(m[0])) for m in _WORD.finditer(block, a, b)]
        if len(self.fresh) > 2000 + len(self.known) // 2:
            self._rebuild()
        if rest:
            more = np.array(rest, np.int64)
            starts, sizes, crcs = (np.concatenate([x, more[:, i]]) for i, x in enumerate((starts, sizes, crcs)))
            order = np.argsort(starts, kind="stable")
            starts, sizes, crcs = starts[order], sizes[order], crcs[order]
        return starts, sizes, crcs


def features(column: pa.Array, words: Dictionary, runs: int = RUNS, buckets: int = BUCKETS) -> Iterator[tuple]:
    """``(first row, words per row, row of each feature, bucket of each feature)`` for runs of whole texts."""
    data, offsets = string_buffers(column)
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + BLOCK, "right")) - 1)
        cuts = offsets[i: j + 1] - offsets[i]
        block = np.insert(_MAP[data[offsets[i]: offsets[j]]], cuts, 0x20)  # a delimiter at every edge of a text
        starts, sizes, crcs = words.scan(block.tobytes())
        row = np.searchsorted(cuts + np.arange(len(cuts)), starts, "right") - 1
        crc, found = crcs.astype(np.uint64), []
        for k in range(runs):
            if k:  # the run of k words, one space, and the word behind it
                spaced = crc_after(crc[:-1], np.full(len(crc) - 1, zlib.crc32(b" "), np.uint64), np.ones(len(crc) - 1, np.int64))
                crc = crc_after(spaced, crcs[k:].astype(np.uint64), sizes[k:])
            same = np.flatnonzero(row[: len(row) - k] == row[k:])
            found.append((row[same], (crc[same] % np.uint64(buckets)).astype(np.int64)))
            if len(crc) < 2:
                break
        yield (i, np.bincount(row, minlength=j - i), np.concatenate([r for r, _ in found]),
               np.concatenate([b for _, b in found]))
        i = j


def _count_task(runs: int, buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, sums = Dictionary(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, bucket in features(batch.column("text"), words, runs, buckets):
                sums += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    return task


def bucket_counts(docs: DataFrame, text: str = "text", runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Number of features by bucket over all rows."""
    sent = docs.select(F.col(text).alias("text")).mapInArrow(_count_task(runs, buckets), "bucket long, n long")
    got = sent.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most ``buckets`` rows
    out = np.zeros(buckets, np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gain of each bucket from its counts in the documents and in the target."""
    import math

    total_s, total_t, b = int(s.sum()), int(t.sum()), len(s)
    return np.array([math.floor(1000 * math.log((x + 1) * (total_s + b) / ((y + 1) * (total_t + b))))
                     for y, x in zip(s.tolist(), t.tolist())], np.int64)


def _weigh_task(gain: np.ndarray, runs: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Dictionary()
        for batch in batches:
            n_words, n_features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for i, size, row, bucket in features(batch.column("text"), words, runs, len(gain)):
                at = slice(i, i + len(size))
                n_words[at] = size
                n_features[at] = np.bincount(row, minlength=len(size))
                np.add.at(total[at], row, gain[bucket])
            weight = total // np.maximum(1, n_features)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words), pa.array(n_features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])

    return task


def weigh(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, doc_id: str = "doc_id",
          text: str = "text", target_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight`` per row of ``docs``."""
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_weigh_task(gain, runs), "doc_id long, n_words long, n_features long, weight long")


def scored(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """``rows`` of ``weigh`` with ``score``: the weight plus a fixed random number of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(u))))


def resample(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, least: int = LEAST,
             percent: int = PERCENT, seed: int = SEED, **columns) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per row; ``rank`` is null for documents not drawn."""
    spark = docs.sparkSession
    rows = materialize(scored(weigh(docs, target, runs, buckets, **columns), seed), "resample")
    fit = F.col("n_words") >= least
    take = rows.where(fit).count() * percent // 100
    order = [F.desc("score"), F.asc("doc_id"), F.asc("weight"), F.asc("n_features")]
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Written once, so that both uses see the same positions.
    placed = materialize(rows.where(fit).repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_at", F.monotonically_increasing_id()), "resample-order")
    sizes = {r.p: r.n for r in placed.groupBy(F.shiftright("_at", 33).alias("p")).agg(F.count("*").alias("n")).collect()}
    ahead, before = [], 0  # one number a partition
    for p in range(max(sizes, default=0) + 1):
        ahead.append(before)
        before += sizes.get(p, 0)
    first = F.element_at(F.lit(np.array(ahead, np.int64)), F.shiftright("_at", 33).cast("int") + 1)
    place = first + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = placed.withColumn("rank", F.when(place <= take, place))
    out = ranked.drop("_at").unionByName(rows.where(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select("doc_id", "n_features", "weight", F.col("score").cast("long").alias("score"), F.col("rank").cast("long").alias("rank"))


ORACLE = f"""
WITH tab AS MATERIALIZED (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
  lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
texts AS (SELECT 0 AS kind, doc_id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 1, item_id, coalesce(text, '') FROM benchmark),
words AS MATERIALIZED (SELECT kind, doc_id, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
bytes AS (SELECT w, list_transform(range(1, len(h) + 1, 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT) AS b
  FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words)),
crc AS MATERIALIZED (SELECT w, xor(list_reduce(list_prepend(4294967295, b),
  lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % {BUCKETS} AS bucket FROM bytes, tab),
hits AS MATERIALIZED (SELECT kind, doc_id, bucket FROM words JOIN crc USING (w)),
sums AS (SELECT bucket, sum((kind = 0)::INT) AS s, sum((kind = 1)::INT) AS t FROM hits GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + {BUCKETS}))::DOUBLE
  / ((s + 1) * (sum(t) OVER () + {BUCKETS}))::DOUBLE))::BIGINT AS gain FROM sums),
per AS (SELECT doc_id, count(*) AS n, sum(gain) AS g FROM hits JOIN gain USING (bucket) WHERE kind = 0 GROUP BY doc_id),
d AS (SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(floor(g::DOUBLE / n), 0)::BIGINT AS weight,
  ('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT AS h FROM documents d LEFT JOIN per USING (doc_id)),
e AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM d),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * {PERCENT} // 100 AS take
  FROM e WHERE n_features >= {LEAST})
SELECT e.doc_id, n_features, weight, score, CASE WHEN place <= take THEN place END AS rank FROM e LEFT JOIN r USING (doc_id)
"""
