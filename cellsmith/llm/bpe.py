"""Byte-level BPE by backtracking over an Aho-Corasick automaton, and decoding.

A text is cut by the vocabulary's pattern; every match is encoded for itself.
Its bytes are mapped to the 256 characters of Latin-1, and one pass of an
automaton over all tokens gives the longest token that begins at each
position.  The encoding is built from left to right: take the longest
token that may follow the last one, else the next shorter token that is its
prefix; if none may, the last token goes, its start of the rest is marked dead,
and its own next shorter prefix is tried.  Every position is marked dead at
most once, so the work is linear in the match.

Two tokens may be neighbours when merging by rank would leave the edge
between them: undoing the later merge of the two sides step by step must never
show a pair of pieces at the edge that merges earlier.  That test is
memoised by pair.  A token's last merge is found from the ranks when the vocabulary is
loaded; a token that merging would not build from its bytes (none in the
given file) is no candidate, but stands when a whole match equals it, as in the
library.  So the ids are those of merging by rank, with no search over merges.

With the vocabulary's own pattern a match begins before every space that has no blank
before it, so a text is first split there.  A worker keeps the ids of up to ``CACHE`` such words and as many matches, of at
most ``SHORT`` characters; a known word needs no pattern.  Decoding concatenates the bytes of the ids.

Cases: null and empty texts have no ids and decode to no bytes; texts and
matches of any length are encoded whole; strings of special tokens are
ordinary text; repeated rows give repeated rows; null ids stay null; an empty table
gives an empty result; other columns are ignored.  Bytes without a token of
their own raise a ``ValueError``.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE, SHORT, PAIRS = 400_000, 64, 2_000_000
# A space behind a blank of any kind, and one that is not.  These are all blanks of the pattern, and a few more.
BLANK_SPACE, WORD_SPACE = [chr(c) + " " for c in range(sys.maxunicode + 1) if chr(c).isspace()], re.compile(r"(?<=\S) ")
ROWS, RUN = 400, 1 << 16  # texts handled together; matches of a text taken at once


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """The automaton, merges and neighbour test of a rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.size = {t: len(b) for b, t in ranks.items()}
        self.merged: dict[tuple[int, int], int] = {}  # pair -> the token it merges to
        self.halves: dict[int, tuple[int, int]] = {}  # token -> the pair of its last merge
        self.fits: dict[tuple[int, int], bool] = {}
        top = max(ranks.values(), default=0) + 1
        self.flat = np.frombuffer(b"".join(b for b, _ in sorted(ranks.items(), key=lambda x: x[1])), np.uint8)
        sizes = np.zeros(top, np.int64)
        sizes[list(self.size)] = list(self.size.values())
        self.offsets = np.r_[0, np.cumsum(sizes)]
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                self._learn(token, rank)
        self.fits.clear()
        auto = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1 and rank in self.halves:
                auto.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        if len(auto):
            auto.make_automaton()
        self.auto = auto
        self.single = [ranks.get(bytes([b]), -1) for b in range(256)]
        self.shorter = [-1] * top  # token -> its longest proper prefix that is a candidate
        self.lengths = sizes.tolist()
        for token, rank in ranks.items():
            for n in range(len(token) - 1, 0, -1):
                r = ranks.get(token[:n])
                if r is not None and (n == 1 or r in self.halves):
                    self.shorter[rank] = r
                    break

    def _learn(self, token: bytes, rank: int) -> None:
        """The pair of earlier tokens that merging leaves before this token's own merge."""
        for n in range(1, len(token)):
            a, b = self.ranks.get(token[:n], rank), self.ranks.get(token[n:], rank)
            if a < rank and b < rank and all(len(t) == 1 or self.ranks[t] in self.halves for t in (token[:n], token[n:])) \
                    and self._edge_stays(a, b):
                self.merged[a, b] = rank
                self.halves[rank] = (a, b)
                return

    def _edge_stays(self, a: int, b: int) -> bool:
        """Would merging by rank leave an edge between the bytes of ``a`` and of ``b``?

        ``a`` and ``b`` are undone from the latest merge on.  A pair met at the
        edge would have been merged if its rank is below those of the merges
        undone so far, which came later in time."""
        limit = sys.maxsize
        while True:
            if self.merged.get((a, b), sys.maxsize) < limit:
                return False
            left, right = self.halves.get(a), self.halves.get(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                limit, a = a, left[1]
            else:
                limit, b = b + 1, right[0]  # of equal merges the left one comes first

    def neighbours(self, a: int, b: int) -> bool:
        fits = self.fits.get((a, b))
        if fits is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            fits = self.fits[a, b] = self._edge_stays(a, b)
        return fits

    def encode_match(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        single = self.single
        longest = [single[b] for b in piece]
        longest.append(-1)
        # Longer tokens come by rising end, so the last one at a start is the longest.
        for end, (rank, less) in self.auto.iter(piece.decode("latin-1")) if self.halves else ():
            longest[end - less] = rank
        lengths, shorter, fits = self.lengths, self.shorter, self.fits
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + lengths[token]
                if not dead[end]:
                    if last < 0:
                        break
                    fit = fits.get((last, token))
                    if self.neighbours(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at]
            elif out:
                dead[at] = 1
                token = out.pop()
                last = out[-1] if out else -1
                at -= lengths[token]
            else:
                raise ValueError(f"no token for the bytes {piece[:16]!r}")
        return out

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows, whose ids are ``ids[bounds[i]:bounds[i + 1]]``, and the end of each row."""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        ends = np.r_[0, np.cumsum(sizes)]
        index = np.arange(ends[-1]) + np.repeat(self.offsets[ids] - ends[:-1], sizes)
        return self.flat[index], ends[bounds]


def load(path: str) -> tuple[Vocabulary, dict, dict]:
    """The vocabulary of a rank file with the known words and matches, once per worker process."""
    kept = sys.__dict__.setdefault("_cellsmith_bpe", {})
    if path not in kept:
        kept[path] = (Vocabulary(read_ranks(path)), {}, {})
    return kept[path]


def _encode_task(path: str, pattern: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        cut = regex.compile(pattern)
        vocabulary, known_words, known = load(path)
        own, encode = pattern == default_pattern(), vocabulary.encode_match

        def fresh(piece: str) -> bytes:
            """Ids of a match, four bytes each."""
            return array("i", encode(piece.encode("utf-8"))).tobytes()

        def match(piece: str) -> bytes:
            ids = fresh(piece)
            if len(piece) <= SHORT:
                if len(known) >= CACHE:
                    known.clear()
                known[piece] = ids
            return ids

        def matches(text: str) -> Iterator[bytes]:
            if len(text) <= RUN:
                yield b"".join([known.get(p) or match(p) for p in cut.findall(text)])
                return
            found = (m[0] for m in cut.finditer(text))
            while run := list(islice(found, RUN)):
                yield b"".join([known.get(p) or match(p) for p in run])

        def word(after: str) -> bytes:
            """Ids of a space and what is up to the next."""
            if len(after) > SHORT:
                return b"".join(matches(" " + after))
            found = [" " + after] if after.isascii() and after.isalpha() else cut.findall(" " + after)
            if len(found) == 1:  # kept as a word, not as a match again
                ids = known.get(found[0]) or fresh(found[0])
            else:
                ids = b"".join([known.get(p) or match(p) for p in found])
            if len(known_words) >= CACHE:
                known_words.clear()
            known_words[after] = ids
            return ids

        def encoded(text: str) -> Iterator[bytes]:
            if not own:
                yield from matches(text)
                return
            pieces = WORD_SPACE.split(text) if any(b in text for b in BLANK_SPACE) else text.split(" ")
            yield from matches(pieces[0])
            del pieces[0]
            yield b"".join([known_words.get(p) or word(p) for p in pieces])

        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                batch = whole.slice(k, ROWS)
                runs, sizes = [], []
                for text in batch.column("text").to_pylist():
                    n = 0
                    for ids in encoded(text) if text else ():
                        runs.append(np.frombuffer(ids, np.int32))
                        n += len(runs[-1])
                    sizes.append(n)
                flat = np.concatenate(runs) if runs else np.zeros(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return task


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """``doc_id, ids`` per row; ``path`` is the rank file on every worker."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encode_task(path or default_path(), pattern or default_pattern()), f"doc_id {kind}, ids array<int>")


def _decode_task(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load(path)[0]
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                batch = whole.slice(k, ROWS)
                ids = batch.column("ids")
                flat = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                data, ends = vocabulary.decode(flat, np.r_[0, np.cumsum(lengths)])
                out = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), ids, out.cast(pa.binary())], ["doc_id", "ids", "bytes"])

    return task


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, bytes``: the ids of ``encode`` with the bytes they stand for."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "ids").mapInArrow(
        _decode_task(path or default_path()), f"doc_id {kind}, ids array<int>, bytes binary")


def digest(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: texts encoded, then decoded from their ids."""
    rows = decode(encode(docs, path, pattern), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(decimal, 256).alias("ids_sha256"), F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))
