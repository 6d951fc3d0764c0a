"""Benchmark decontamination: pigeonhole pieces, then bit-parallel edit distance.

Texts are compared lower-cased with white space runs as one space.  An item
of ``m`` characters may differ by up to ``e = floor(error * m)`` edits.  It is
split into ``e + 1`` pieces; whatever ``e`` edits do, one piece stays whole,
so every passage within the budget has an exact piece hit.  All pieces are
found in one pass with an Aho-Corasick automaton.  Around each hit, the least
edit distance of the item to any substring is computed with Myers'
bit-parallel algorithm; overlapping windows of an item are joined first.

Items come in blocks of about ``BLOCK_CHARS`` characters; a block's automaton
goes to all tasks and every document is read against each block.  One block,
the usual case, needs no shuffle.  With more, a pass per block writes its
hits under the text's SHA-256 and then gives its block up, so the driver and a task
hold one block at a time however large the benchmark is; the hits of all
blocks are joined to the documents by that digest, each digest dealt over
``SALT`` parts so that copies of one text need not meet in one task.

Cases: null and empty texts match nothing; null and empty items, and items
shorter than ``MIN_CHARS`` after normalising, are no evidence and match
nothing; an item text given twice is reported with both ids; repeated documents
give repeated rows; an empty benchmark finds nothing; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellsmith.llm.common import private
from cellsmith.session import materialize

ERROR, MIN_CHARS, BLOCK_CHARS, SALT = 0.08, 24, 8_000_000, 16


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, error: float) -> tuple[int, list[tuple[int, str]]]:
    """Error budget and ``(offset, piece)`` list of a normalised item."""
    budget = int(error * len(item))
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return budget, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(pattern: str, text: str, masks: dict[str, int] | None = None) -> int:
    """Least edit distance of ``pattern`` to any substring of ``text``."""
    if masks is None:
        masks = char_masks(pattern)
    m = len(pattern)
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
            if score < best:
                best = score
        ph = (ph << 1) & full
        pv = ((mh << 1) & full) | (full & ~(xv | ph))
        mv = ph & xv
    return best


def char_masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def automaton(items: list[tuple[int, str]], error: float):
    """Aho-Corasick automaton over all pieces, and ``(ids, budget, text)`` per distinct item text."""
    import ahocorasick

    texts: dict[str, list[int]] = {}
    for item_id, text in items:
        texts.setdefault(text, []).append(item_id)
    table, found = [], {}
    for k, (text, ids) in enumerate(texts.items()):
        budget, parts = pieces(text, error)
        table.append((ids, budget, text))
        for offset, piece in parts:
            found.setdefault(piece, []).append((k, offset))
    auto = ahocorasick.Automaton()
    for piece, where in found.items():
        auto.add_word(piece, (len(piece), where))
    auto.make_automaton()
    return auto, table


def matches(text: str, auto, table: list, masks: dict) -> list[tuple[int, int]]:
    """``(table row, distance)`` of each item within its budget in a normalised text."""
    spans: dict[int, list[tuple[int, int]]] = {}
    for end, (size, where) in auto.iter(text):
        start = end - size + 1
        for k, offset in where:
            budget, m = table[k][1], len(table[k][2])
            a = max(0, start - offset - budget)
            b = start - offset + m + budget
            runs = spans.setdefault(k, [])
            if runs and a <= runs[-1][1] and a >= runs[-1][0]:
                runs[-1] = (runs[-1][0], max(runs[-1][1], b))
            else:
                runs.append((a, b))
    out = []
    for k, runs in spans.items():
        _, budget, item = table[k]
        best = len(item)
        for a, b in runs:
            part = text[a:b]
            if item in part:
                best = 0
                break
            if k not in masks:
                masks[k] = char_masks(item)
            best = min(best, myers(item, part, masks[k]))
        if best <= budget:
            out.append((k, best))
    return out


def blocks(benchmark: DataFrame, item_id: str, text: str, chars: int) -> DataFrame:
    """Normalised items with a block number; a block has about ``chars`` characters."""
    t = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+", " "))
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"), F.length(t).alias("_n"))
    # Blocks are by hash, so no running sum over the items is needed.
    total = rows.agg(F.sum("_n")).first()[0] or 0
    n = max(1, -(-2 * total // chars)) if total > chars else 1
    return rows.select("item_id", "text", F.pmod(F.xxhash64("text"), F.lit(n)).alias("block")), n


NAMES = ("items", "distances", "contaminated")


def find(docs: DataFrame, benchmark: DataFrame, error: float = ERROR, min_chars: int = MIN_CHARS,
         block_chars: int = BLOCK_CHARS, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", keep: tuple = (), names: tuple = NAMES) -> DataFrame:
    """All rows of ``docs`` with ``items`` (sorted ids found), ``distances`` and ``contaminated``.

    ``keep`` names columns to pass through (the whole row, for filtering).  ``names`` are the names of
    the three; a kept column of such a name is replaced."""
    items, distances, contaminated = names
    keep = [c for c in keep if c.lower() not in {n.lower() for n in names}] or [F.col(doc_id).alias("doc_id")]
    body, salt = private([*docs.columns, *names], "text", "salt")
    parted, n = blocks(benchmark, item_id, item_text, block_chars)
    rows = docs.select(*keep, F.col(text).alias(body))
    if n == 1:
        rows = _pass(_unmatched(rows, items, distances), _block(parted, 0, min_chars), error, body, items, distances)
    else:
        rows = docs.select(*keep, F.col(text).alias(body), F.pmod(F.xxhash64(doc_id), F.lit(SALT)).cast("int").alias(salt))
        rows = _by_blocks(rows, materialize(parted, "items"), n, min_chars, error, body, salt, items, distances)
    return rows.drop(body, salt).withColumn(contaminated, F.size(items) > 0)


def _unmatched(rows: DataFrame, items: str, distances: str) -> DataFrame:
    return rows.select("*", F.array().cast("array<long>").alias(items), F.array().cast("array<int>").alias(distances))


def _block(parted: DataFrame, block: int, min_chars: int) -> list[tuple[int, str]]:
    """One block of normalised items, about ``block_chars`` characters by the choice of their number."""
    got = [(r.item_id, normal(r.text)) for r in parted.where(F.col("block") == block).collect()]
    return sorted((i, t) for i, t in got if i is not None and len(t) >= min_chars)


def _by_blocks(rows: DataFrame, parted: DataFrame, n: int, min_chars: int, error: float,
               body: str, salt: str, items: str, distances: str) -> DataFrame:
    key, pairs = private([*rows.columns, items, distances], "key", "pairs")
    keyed = rows.withColumn(key, F.sha2(body, 256))
    texts = keyed.where(F.col(body).isNotNull()).select(body, key)
    hits = None
    for b in range(n):
        got = _block(parted, b, min_chars)
        if not got:
            continue
        found = _pass(_unmatched(texts, items, distances), got, error, body, items, distances)
        # Equal texts have equal hits, so any row of a digest stands for it.
        part = materialize(found.where(F.size(items) > 0).groupBy(key).agg(
            F.first(F.arrays_zip(items, distances)).alias(pairs)), "hits")
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        return _unmatched(rows, items, distances)
    # At most a list per block under each digest.
    hits = hits.groupBy(key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(pairs)))).alias(pairs))
    hits = hits.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    joined = keyed.join(hits, [key, salt], "left")
    return joined.select(*rows.columns, *[
        F.coalesce(F.col(pairs)[name], F.array().cast(kind)).alias(name)
        for name, kind in ((items, "array<long>"), (distances, "array<int>"))])


def _pass(rows: DataFrame, block: list, error: float, body: str, items: str, distances: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    if not block:
        return rows
    schema = to_arrow_schema(rows.schema)
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, table = automaton(sent.value, error)
        masks: dict = {}
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                batch = whole.slice(k, 500)
                ids, far = [], []
                for text, a, b in zip(*(batch.column(c).to_pylist() for c in (body, items, distances))):
                    got = sorted({*zip(a, b), *((i, d) for r, d in matches(normal(text), auto, table, masks) for i in table[r][0])})
                    ids.append([i for i, _ in got])
                    far.append([d for _, d in got])
                cols = [batch.column(f.name) if f.name not in (items, distances)
                        else pa.array(ids if f.name == items else far, f.type) for f in schema]
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return rows.mapInArrow(task, rows.schema)
