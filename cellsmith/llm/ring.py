"""Sharding: a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal cells.  Every shard owns ``vnodes`` virtual
nodes placed by hash at cell edges; a key belongs to the first virtual node
clockwise of its position.  Keys are placed in ring order.  A key whose shard
is full continues clockwise to the next shard with room, so no shard exceeds
its capacity.  With ``slack=0`` the capacities add up to the row count, so
counts differ by at most one; a larger slack moves fewer keys off their arc.

Because placement goes in ring order, it follows from the row count of each
cell alone: a cell's rows, ranked by position, split into a few runs, each on
one shard.  The driver sees ``cells`` counts, never rows; rows find their run
by a join with the run table, which has at most ``cells + shards`` rows.

Cases: null text has size 1 and crc 0; empty text likewise; a null id hashes
as the empty text; equal ids are ranked by text crc and size; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARDS, VNODES, CELLS = 8, 64, 1 << 13
SCHEMA = "cell long, from_rank long, to_rank long, shard int, slot_base long"


def ring_nodes(spark, shards: int, vnodes: int, cells: int) -> list[tuple[int, int]]:
    """``(cell, shard)`` of every virtual node in ring order: ``shards * vnodes`` rows."""
    ids = spark.range(shards * vnodes, numPartitions=1)
    shard = (F.col("id") % shards).cast("int")
    place = F.pmod(F.xxhash64(F.lit("vnode"), F.col("id")), F.lit(cells))
    rows = ids.select(place.alias("cell"), shard.alias("shard"), "id").collect()
    return [(r.cell, r.shard) for r in sorted(rows, key=lambda r: (r.cell, r.id))]


def place_runs(counts: dict[int, int], nodes: list[tuple[int, int]], capacity: list[int]) -> list[tuple]:
    """Runs ``(cell, from_rank, to_rank, shard, slot_base)`` by ring-order placement."""
    room, filled, runs = list(capacity), [0] * len(capacity), []
    at = 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        left, rank, v = counts[cell], 0, at
        while left:
            shard = nodes[v % len(nodes)][1]
            take = min(left, room[shard])
            if take:
                runs.append((cell, rank, rank + take, shard, filled[shard]))
                room[shard] -= take
                filled[shard] += take
                rank, left = rank + take, left - take
            v += 1
    return runs


def capacities(total: int, shards: int, slack: float) -> list[int]:
    if slack:
        return [-(-int(total * (1 + slack)) // shards) + 1] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def shard(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0, cells: int = CELLS,
          doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot, owner``; ``owner`` is the shard of the key's own arc."""
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    pos = F.xxhash64(F.lit("key"), key)
    cell = F.pmod(pos, F.lit(cells))
    counts = {r.cell: r.n for r in docs.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}
    nodes = ring_nodes(spark, shards, vnodes, cells)
    runs = place_runs(counts, nodes, capacities(sum(counts.values()), shards, slack))
    owners, at = {}, 0
    for c in sorted(counts):
        while at < len(nodes) and nodes[at][0] < c:
            at += 1
        owners[c] = nodes[at % len(nodes)][1]
    table = spark.createDataFrame([(*r, owners[r[0]]) for r in runs], SCHEMA + ", owner int")
    assert len(runs) <= cells + shards  # proven bound of the broadcast
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        pos.alias("_pos"), cell.alias("cell"))
    order = Window.partitionBy("cell").orderBy("_pos", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("_rank", F.row_number().over(order).cast("long") - 1)
    hit = (F.col("_rank") >= F.col("from_rank")) & (F.col("_rank") < F.col("to_rank"))
    placed = ranked.join(F.broadcast(table.withColumnRenamed("cell", "_cell")), (F.col("cell") == F.col("_cell")) & hit)
    slot = F.col("slot_base") + F.col("_rank") - F.col("from_rank")
    return placed.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"), "owner")


def manifest(docs: DataFrame, **options) -> DataFrame:
    """The shard manifest under the law ``rows``: counts at most one apart."""
    return shard(docs, **options).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "owner")
