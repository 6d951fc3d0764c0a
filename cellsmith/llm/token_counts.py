"""Token counts with overlap resynchronisation for huge documents.

A text of up to ``chunk`` characters is counted whole.  A longer one is
encoded in chunks of ``chunk`` characters that overlap by ``overlap``, each
with character offsets and pre-token numbers.  Byte-level BPE cuts a text
into pre-tokens from left to right, and what follows a pre-token edge depends
on the text behind it alone.  So once two neighbouring chunks share an edge,
they agree from there on; the edge counts as stable when the left chunk has
two more whole pre-tokens and ``MARGIN`` characters behind it, beyond the
reach of its own cut-off end.  Tokens before the edge are the left chunk's,
those behind it the right chunk's.  Without a shared stable edge (a long run
without pre-token edges), the overlap doubles until there is one or the
chunk reaches the end of the text.

Whole texts are counted by pre-token: a worker keeps the counts of pre-tokens
it has met, and the library encodes the others.  That is done for texts of
ASCII and Latin letters, where the pre-token pattern is the same in Python as in
the library; texts with any other character, or with an added token's string,
are encoded whole.

Both ways rest on the plain byte-level pre-tokens.  A tokenizer file that states
anything else (a normaliser, another pattern, a space put before the text, BPE
dropout or word affixes) has every text encoded whole by the library, as have
``.model`` files, which the sentencepiece library reads.

Cases: null and empty texts have 0 bytes and 0 tokens; a text of any length
is counted to its end; repeated ids give repeated rows; null ids stay null;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

CHUNK, OVERLAP, MARGIN, LIMIT = 1 << 15, 256, 32, 1024
CACHE = 1_000_000
# Fixed value: the byte-level pre-token pattern, for the characters of SAFE.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
UNSAFE = re.compile("[^\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿĀ-ž]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def plain_bytes(stated: dict) -> bool:
    """True when a tokenizer file, read as JSON, has the byte-level pre-tokens that ``PIECE`` finds and nothing besides."""
    model, pre = stated.get("model") or {}, stated.get("pre_tokenizer") or {}
    return (stated.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")))


def load(path: str):
    """The tokenizer of a file, its cache, the pattern of its added tokens and whether it is plain byte-level,
    once per worker process."""
    kept = sys.__dict__.setdefault("_cellsmith_tokenizers", {})
    if path not in kept:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        added = re.compile("|".join(re.escape(t.content) for t in tok.get_added_tokens_decoder().values()) or "(?!)")
        kept[path] = (tok, {}, added, plain_bytes(json.loads(tok.to_str())))
    return kept[path]


def _edges(enc, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Character and token positions of the pre-token edges of an encoded chunk."""
    begins = np.array([o[0] for o in enc.offsets], np.int64) + start
    words = np.array([-1 if w is None else w for w in enc.word_ids], np.int64)
    new = np.flatnonzero(np.r_[True, words[1:] != words[:-1]]) if len(words) else np.zeros(0, np.int64)
    return begins[new], new


def chunked_count(text: str, encode: Callable, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of ``text`` by overlapping chunks spliced at stable edges."""
    total, at = 0, 0  # ``at``: an edge up to which tokens are counted
    start, wide = 0, overlap
    enc = encode(text[:chunk])
    while start + chunk < len(text):
        end = start + chunk
        chars, tokens = _edges(enc, start)
        stable = (chars[:-2] >= at) & (chars[2:] + MARGIN <= end) if len(chars) > 2 else np.zeros(0, bool)
        left = dict(zip(chars[:-2][stable].tolist(), tokens[:-2][stable].tolist()))
        nxt = max(end - wide, start + 1)
        right = encode(text[nxt: nxt + chunk])
        rc, rt = _edges(right, nxt)
        shared = [(c, t) for c, t in zip(rc.tolist(), rt.tolist()) if c > nxt and c in left]
        if not shared:
            if nxt <= start + 1:  # one chunk without a stable edge: a longer chunk
                chunk *= 2
                enc = encode(text[start: start + chunk])
                continue
            wide *= 2
            continue
        c, t = shared[0]
        first = int(tokens[np.searchsorted(chars, at)]) if at > start else 0
        total += left[c] - first
        at, start, enc, wide = c, nxt, right, overlap
    chars, tokens = _edges(enc, start)
    first = int(tokens[np.searchsorted(chars, at)]) if at > start else 0
    return total + len(enc.ids) - first


def _pieces_counter(path: str) -> Callable[[list], list]:
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode([t or "" for t in texts], num_threads=1)]


def counter(path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Callable[[list], list]:
    if path.endswith(".model"):
        return _pieces_counter(path)
    tok, cache, added, plain = load(path)
    if not plain:
        return lambda texts: [len(tok.encode(t, add_special_tokens=False).ids) if t else 0 for t in texts]

    def encode(text: str):
        return tok.encode(text, add_special_tokens=False)

    def count(texts: list) -> list:
        out, todo, pieces_of = [0] * len(texts), set(), {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if len(text) > chunk:
                out[i] = chunked_count(text, encode, chunk, overlap)
            elif UNSAFE.search(text) or added.search(text):
                out[i] = len(encode(text).ids)
            else:
                pieces_of[i] = PIECE.findall(text)
                todo.update(p for p in pieces_of[i] if p not in cache)
        if todo:
            if len(cache) + len(todo) > CACHE:
                cache.clear()
                todo = {p for pieces in pieces_of.values() for p in pieces}
            names = list(todo)
            for j in range(0, len(names), 4096):
                part = names[j: j + 4096]
                cache.update(zip(part, [len(e.ids) for e in tok.encode_batch_fast(part, add_special_tokens=False)]))
        for i, pieces in pieces_of.items():
            out[i] = sum(map(cache.__getitem__, pieces))
        return out

    return count


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK,
                 overlap: int = OVERLAP, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per row; ``path`` is the tokenizer file on every worker."""
    path = path or default_path()
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path, chunk, overlap)
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                texts = batch.column("text").to_pylist()
                sizes = pa.compute.binary_length(batch.column("text")).fill_null(0).cast(pa.int64())
                n = np.array(count(texts), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), sizes, pa.array(n), pa.array(n > limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(task, schema)
