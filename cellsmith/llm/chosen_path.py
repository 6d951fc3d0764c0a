"""Near-duplicate join by chosen paths, and its components.

Sets are the distinct five-word shingles of whole texts.  Equal sets form a
class; a class is joined once.  Every class has ``T`` minwise tokens.  In each
of ``TREES`` independent trees, a node sends each of its classes to
``BRANCH`` children, chosen among the ``T`` tokens by a hash of the node; the
child is named by the token.  Two classes of similarity ``j`` stay together
in a child with chance ``j`` each.  At ``j = 0.75`` and two children a
tree loses a pair with chance at most 0.111 however deep it goes (the least
root of ``q = (0.25 + 0.75 q)^2``), so four trees lose at most 2e-4.  The
bound is for branching; a pair in a leaf or dense node is lost only if it
agrees in fewer than ``LEAST_AGREE`` tokens.

A node of at most ``LEAF`` classes is compared exhaustively: pairs whose
minwise tokens agree often enough (four standard deviations below the
threshold) are checked on the full sets, most similar first, skipping pairs
that are linked already; the node yields a spanning forest of true links.

A larger node branches.  If a child keeps ``DENSE`` of its parent, its classes
are mostly alike and more branching would not part them; all its pairs are
compared in three passes, each on full sets.  First it is dealt out by hash
into blocks of ``LEAF / 2``, by a hash of node and class, so that no two nodes
part the same pairs, each compared exhaustively like a node.  Then the
best linked class of each component found so far, at most ``HUBS`` a node, is
compared with every block.  Last, every class outside the node's largest
component is compared with all classes of the node, block by block, but for
pairs that another dense node compares.  The only
pairs never compared are those that true links have put into one component, so
a dense node loses none; no task sees more than about ``LEAF`` classes.  The
last pass grows with the classes left over times the node's size.

Full sets are made for the candidates alone, in a second reading of the
texts; their ids are broadcast up to ``SMALL_IDS`` rows and joined by shuffle
beyond.

Components are found by alternating large-star and small-star steps on
tables in the shared folder.  Links found later are contracted by the components known
before; a pass is left out when no dense node holds two components.

Cases: null, empty and wordless texts have an empty set, are their own
component and kept; fewer than five words make one shingle; repeated rows
share a component; a null id takes part, and is a component's name only if it
has no other id; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellsmith.llm.common import Words, by_group, mix, shingle_sets, shuffle_parts, within
from cellsmith.session import materialize

SHINGLE, T, TREES, BRANCH, LEAF, DENSE, HUBS = 5, 64, 4, 2, 1200, 0.6, 256
NUM, DEN = 75, 100  # link: DEN * intersection >= NUM * union
LEAST_AGREE = 34  # of T = 64: four standard deviations under 0.75
MANY = 2000  # pairs of a cluster, from which intersections are counted together
SMALL_IDS = 2_000_000

_SEEDS = mix(np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_A, _B = _SEEDS[:T] | np.uint64(1), _SEEDS[T:]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``T`` minwise 32-bit tokens per set; an empty set has all ones."""
    out = np.full((len(sets), T), 0xFFFFFFFF, np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    i = 0
    while i < len(full):  # in runs that fit the cache
        j, n = i, 0
        while j < len(full) and (j == i or n + len(sets[full[j]]) <= 30_000):
            n += len(sets[full[j]])
            j += 1
        x = np.concatenate([sets[k] for k in full[i:j]])
        at = np.cumsum([0] + [len(sets[k]) for k in full[i: j - 1]])
        for t in range(T):
            out[full[i:j], t] = np.minimum.reduceat(((x * _A[t] + _B[t]) >> np.uint64(32)).astype(np.uint32), at)
        i = j
    return out


def _sets_task(with_sets: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 400):
                batch = whole.slice(k, 400)
                sets = shingle_sets(Words(batch.column("text")), SHINGLE)
                cid = pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary())
                sig = pa.array([r.tobytes() for r in signatures(sets)], pa.binary())
                if with_sets:
                    yield pa.RecordBatch.from_arrays(
                        [cid, pa.array([s.tobytes() for s in sets], pa.binary()), sig], ["cid", "elements", "sig"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), cid, sig],
                        ["doc_id", "n_shingles", "cid", "sig"])

    return task


def _children(rows: DataFrame, seed: int) -> DataFrame:
    """``BRANCH`` distinct child nodes of each ``(node, cid, sig)`` row."""
    first = F.pmod(F.xxhash64(F.lit(seed), "node"), F.lit(T))
    step = F.lit(1) + F.pmod(F.xxhash64(F.lit(seed + 1), "node"), F.lit(T - 1))
    picks = F.array(*[F.pmod(first + F.lit(i) * step, F.lit(T)).cast("int") for i in range(BRANCH)])
    rows = rows.withColumn("_pick", F.explode(picks))
    token = F.substring(F.col("sig"), F.col("_pick") * 4 + 1, F.lit(4))
    return rows.withColumn("node", F.xxhash64(F.lit(seed + 2), "node", "_pick", token)).drop("_pick", "sig")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes with two classes or more, with the node's ``size``."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes, "node")


def agreement(sig: np.ndarray) -> np.ndarray:
    """Number of agreeing tokens for all pairs of a block."""
    out = np.zeros((len(sig), len(sig)), np.int16)
    for t in range(sig.shape[1]):
        c = sig[:, t]
        out += c[:, None] == c[None, :]
    return out


def _find(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if DEN * min(len(a), len(b)) < NUM * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return DEN * shared >= NUM * (len(both) - shared)


def shared(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets (upper triangle)."""
    m = len(sets)
    x, row = np.concatenate(sets), np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(x, kind="stable")
    x, row = x[order], row[order]
    first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    times = np.diff(np.r_[first, len(x)])
    out = np.zeros((m, m), np.float32)
    for k in range(2, 9):  # elements of few sets, pair by pair
        rows = row[first[times == k][:, None] + np.arange(k)]
        for a in range(k - 1):
            at = (rows[:, a, None] * m + rows[:, a + 1:]).ravel()
            if len(at):
                out += np.bincount(at, minlength=m * m).reshape(m, m)
    often = np.flatnonzero(times > 8)
    for i in range(0, len(often), 2048):
        part = often[i: i + 2048]
        has = np.zeros((m, len(part)), np.float32)
        for c, (a, n) in enumerate(zip(first[part].tolist(), times[part].tolist())):
            has[row[a: a + n], c] = 1
        out += has @ has.T
    return out


def _apart(group: dict) -> tuple[np.ndarray, np.ndarray]:
    """Known component of each member, and the pairs to compare.

    Members of one component are not compared, nor are those of one ``side`` other than 0."""
    names: dict[bytes, int] = {}
    known = np.array([names.setdefault(x or c, len(names)) for x, c in zip(group["label"].to_pylist(), group["cid"].to_pylist())])
    side = group["side"].to_numpy(zero_copy_only=False)
    return known, (known[:, None] != known) & ((side[:, None] != side) | (side == 0))


def _candidates(agree: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.nonzero(np.triu((agree >= LEAST_AGREE) & apart, 1))
    order = np.argsort(-agree[i, j], kind="stable")
    return i[order], j[order]


def _clusters(group: dict) -> Iterator[dict]:
    """Groups of candidates within a leaf, named by their members."""
    cids, labels, sides = (group[c].to_pylist() for c in ("cid", "label", "side"))
    sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint32).reshape(len(cids), T)
    up = list(range(len(cids)))
    for i, j in zip(*(x.tolist() for x in _candidates(agreement(sig), _apart(group)[1]))):
        up[_find(up, i)] = _find(up, j)
    members: dict[int, list[int]] = {}
    for i in range(len(cids)):
        members.setdefault(_find(up, i), []).append(i)
    for m in members.values():
        if len(m) > 1:
            names = b"".join(sorted(cids[i] for i in m))
            name = int.from_bytes(hashlib.blake2b(names, digest_size=8).digest(), "little", signed=True)
            for i in m:
                yield {"cluster": name, "cid": cids[i], "label": labels[i], "side": sides[i]}


def _links(group: dict) -> Iterator[dict]:
    """Spanning links of a cluster, on full sets."""
    cids = group["cid"].to_pylist()
    sets = [np.frombuffer(x, np.uint64) for x in group["elements"].to_pylist()]
    sig = np.frombuffer(b"".join(group["sig"].to_pylist()), np.uint32).reshape(len(cids), T)
    known, apart = _apart(group)
    i, j = _candidates(agreement(sig), apart)
    many = len(i) > MANY
    if many:
        both, n = shared(sets)[i, j].astype(np.int64), np.array([len(s) for s in sets])
        true = DEN * both >= NUM * (n[i] + n[j] - both)
        i, j = i[true], j[true]
    up = list(range(len(cids)))
    for i, j in zip(i.tolist(), j.tolist()):
        a, b = _find(up, int(known[i])), _find(up, int(known[j]))
        if a != b and (many or linked(sets[i], sets[j])):
            up[a] = b
            yield {"a": min(cids[i], cids[j]), "b": max(cids[i], cids[j])}


def _split_open(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    leaf = rows.where(F.col("size") <= LEAF)
    dense = rows.where((F.col("size") > LEAF) & (F.col("size") >= DENSE * F.col("parent")))
    branch = rows.where((F.col("size") > LEAF) & (F.col("size") < DENSE * F.col("parent")))
    return leaf, dense, branch


def _block(step):
    """Block of a class in its dense node, of ``LEAF / 2`` classes; each node deals its own way."""
    return F.pmod(F.xxhash64(F.lit(step), "node", "cid"), _blocks("size"))


def _blocks(size: str):
    return F.ceil(F.col(size) / F.lit(LEAF // 2))


def leaves(classes: DataFrame, trees: int = TREES) -> tuple[DataFrame, DataFrame | None]:
    """``(node, cid)``: groups of at most ``LEAF`` classes to compare exhaustively; and
    ``(node, cid, size, block)`` of the dense nodes, whose blocks are among the groups."""
    far = float(1 << 62)
    roots = classes.select(F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("node"), "cid", "sig")
    roots = roots.withColumn("node", F.xxhash64(F.lit("root"), "node"))
    now = materialize(_sized(_children(roots, 11)).withColumn("parent", F.lit(far)), "nodes")
    found, crowds = [], []
    for step in range(1, 60):
        leaf, dense, branch = _split_open(now)
        found.append(leaf.select("node", "cid"))
        big = {r.d for r in now.where(F.col("size") > LEAF).select(
            (F.col("size") >= DENSE * F.col("parent")).alias("d")).distinct().collect()}
        nxt = None
        if False in big:
            rows = branch.select("node", "cid", F.col("size").cast("double").alias("_size")).join(classes, "cid")
            nxt = _sized(_children(rows, 100 * step)).withColumnRenamed("_size", "parent").select("node", "cid", "size", "parent")
        if True in big:
            rows = dense.select("node", "cid", "size", _block(step).alias("block"))
            found.append(rows.select(F.xxhash64("node", "block").alias("node"), "cid"))
            crowds.append(rows)
        if nxt is None:
            break
        now = materialize(nxt, "nodes")
    else:
        raise RuntimeError("nodes remain after 60 levels")
    return reduce(DataFrame.unionByName, found), reduce(DataFrame.unionByName, crowds) if crowds else None


def _compare(groups: DataFrame, classes: DataFrame, sets_of) -> DataFrame:
    """Spanning links ``(a, b)`` of groups ``(node, cid, label, side)``."""
    grouped = groups.join(classes, "cid")
    clusters = by_group(grouped, "node", _clusters, "cluster long, cid binary, label binary, side int").distinct()
    clusters = materialize(clusters, "clusters")
    # One set a class: ids may stand on several rows.  The join uses the same exchange.
    full = sets_of(clusters.select("cid").distinct()).dropDuplicates(["cid"])
    return materialize(by_group(clusters.join(full, "cid"), "cluster", _links, "a binary, b binary").distinct(), "links")


def _labelled(crowds: DataFrame, edges: DataFrame, label: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes of dense nodes with the ``label`` of their component, and each
    ``(node, label)`` with its number of classes and its best linked class."""
    ends = edges.select(F.col("a").alias("cid")).unionByName(edges.select(F.col("b").alias("cid")))
    label = label.select(F.col("id").alias("cid"), "label").join(ends.groupBy("cid").agg(F.count("*").alias("degree")), "cid", "left")
    rows = materialize(crowds.join(label, "cid", "left"), "crowds")
    parts = rows.where("label is not null").groupBy("node", "label").agg(
        F.count("*").alias("n"), F.max(F.struct("degree", "cid"))["cid"].alias("hub"))
    return rows.drop("degree"), materialize(parts, "parts")


def _hub_groups(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Every block of a dense node with the node's hubs; the classes of a node's only component stay away."""
    hubs = parts.groupBy("node", F.pmod(F.xxhash64("label"), F.lit(HUBS)).alias("h")).agg(
        F.max(F.struct("n", "label", "hub")).alias("m")).select("node", F.col("m.hub").alias("cid"), F.col("m.label").alias("label"))
    size = F.broadcast(rows.select("node", "size").distinct())
    hubs = hubs.join(size, "node").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), _blocks("size") - 1)))
    only = parts.groupBy("node").agg(F.min("label").alias("only"), F.max("label").alias("last")).where("only = last").drop("last")
    rows = rows.join(only, "node", "left").where(~F.coalesce(F.coalesce("label", "cid") == F.col("only"), F.lit(False))).drop("only")
    both = rows.withColumn("side", F.lit(1)).unionByName(hubs.withColumn("side", F.lit(2)))
    return both.select(F.xxhash64(F.lit("hub"), "node", "block").alias("node"), "cid", "label", "side")


def _rest_groups(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Every class outside its dense node's largest component with every block of the node.

    Trees and children hold much the same crowd.  A class is at home in the largest of its dense
    nodes, and two classes of one home are compared there alone: where most classes are
    at home in another node, only the others meet every block."""
    home = F.max(F.struct("size", "node")).over(Window.partitionBy("cid"))  # at most a row per node of each tree
    rows = rows.withColumn("home", home["node"])
    best = parts.groupBy("node").agg(F.max(F.struct("n", "label"))["label"].alias("best"))
    most = rows.groupBy("node", "home").count().groupBy("node").agg(F.max(F.struct("count", "home"))["home"].alias("most"))
    # A row per dense node, each of more than LEAF classes.
    rows = rows.join(most.join(best, "node", "left"), "node")
    inside = F.coalesce(F.coalesce("label", "cid") == F.col("best"), F.lit(False))
    rows = rows.withColumn("out", F.when(F.col("most") == F.col("node"), ~inside).otherwise(F.col("home") != F.col("most")))
    rows = materialize(rows.drop("home", "most", "best"), "rest")
    left = rows.where("out").groupBy("node").agg(F.count("*").alias("rest"))
    rows = rows.join(left, "node")
    mine = F.pmod(F.xxhash64(F.lit("rest"), "node", "cid"), _blocks("rest"))
    ones = rows.where("out").withColumn("part", mine).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), _blocks("size") - 1))).withColumn("side", F.lit(1))
    last = F.when(F.col("out"), mine).otherwise(_blocks("rest") - 1)  # two that are left over meet in the lower part
    others = rows.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("side", F.lit(2))
    both = ones.unionByName(others)
    return both.select(F.xxhash64(F.lit("rest"), "node", "part", "block").alias("node"), "cid", "label", "side")


def _open(rows: DataFrame) -> bool:
    """True when a dense node holds classes of different components, or classes without one."""
    name = F.coalesce("label", "cid")
    return bool(rows.groupBy("node").agg((F.min(name) != F.max(name)).alias("open")).where("open").limit(1).count())


def links(classes: DataFrame, sets_of, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """Spanning links ``(a, b)`` between class ids of ``classes (cid, sig)``, and the components
    ``(id, label)`` they make.

    ``sets_of(cids)`` gives ``(cid, elements, sig)`` of the class ids asked for."""
    groups, crowds = leaves(classes, trees)
    groups = groups.withColumn("label", F.lit(None).cast("binary")).withColumn("side", F.lit(0))
    edges = _compare(groups, classes, sets_of)
    label = components(edges)
    for more in (_hub_groups, _rest_groups) if crowds is not None else ():
        rows, parts = _labelled(crowds, edges, label)
        if not _open(rows):
            break
        found = _compare(more(rows, parts), classes, sets_of)
        if found.isEmpty():
            continue
        edges, label = edges.unionByName(found), joined(label, found)
    return edges.distinct(), label


def components(edges: DataFrame) -> DataFrame:
    """``(id, label)``: the least id of each id's component; ids without an edge are left out.

    A round is a large-star and a small-star step, one exchange each: the
    exchange by ``u`` serves the removal of repeats and the least neighbour."""
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v")
    n = shuffle_parts(edges.sparkSession)
    least = F.min("v").over(Window.partitionBy("u"))
    now, mark = pairs, None
    for _ in range(60):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.repartition(n, "u").dropDuplicates(["u", "v"]).select("u", "v", F.least("u", least).alias("m"))
        large = large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.repartition(n, "u").dropDuplicates(["u", "v"]).select("u", "v", least.alias("m"))
        # Every neighbour but the least goes to the least; the id itself does once, in the least one's row.
        small = small.select(F.when(F.col("v") > F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        now = materialize(small, "cc")
        state = now.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(state) == mark:
            return now.select(F.col("u").alias("id"), F.col("v").alias("label"))  # a star for each component
        mark = tuple(state)
    raise RuntimeError("components did not settle")


def joined(label: DataFrame, found: DataFrame) -> DataFrame:
    """The components ``(id, label)`` after further links, found on the contracted graph alone."""
    known = label.select(F.col("id").alias("_id"), "label")
    for end in ("a", "b"):
        found = found.join(known, F.col(end) == F.col("_id"), "left").withColumn(end, F.coalesce("label", end)).drop("_id", "label")
    merged = components(found.select("a", "b")).select(F.col("id").alias("_id"), F.col("label").alias("_to"))
    old = label.join(merged, F.col("label") == F.col("_id"), "left").select("id", F.coalesce("_to", "label").alias("label"))
    # Labels are ids of their components; classes that had no link yet are ids of the contracted graph.
    return materialize(old.unionByName(merged.select(F.col("_id").alias("id"), F.col("_to").alias("label"))), "labels")


def near_duplicates(docs: DataFrame, trees: int = TREES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    base = materialize(rows.mapInArrow(_sets_task(False), "doc_id long, n_shingles long, cid binary, sig binary"), "sets-of-docs")
    classes = materialize(base.where("n_shingles > 0").groupBy("cid", "sig").agg(F.min("doc_id").alias("least")), "classes")

    def sets_of(cids: DataFrame) -> DataFrame:
        ids = materialize(classes.join(cids, "cid").select(F.col("least").alias("_id")).distinct(), "ids")
        ids = F.broadcast(ids) if within(ids, SMALL_IDS) else ids
        part = rows.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        return part.mapInArrow(_sets_task(True), "cid binary, elements binary, sig binary")

    _, label = links(classes.select("cid", "sig"), sets_of, trees)
    label = label.select(F.col("id").alias("cid"), "label")
    named = classes.select("cid", "least").join(label, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    names = named.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = named.join(names, "label").select("cid", "component_id")
    out = base.select("doc_id", "n_shingles", "cid").join(by_class, "cid", "left")
    out = out.withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
