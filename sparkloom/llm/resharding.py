"""Resharding by minimum-cost flow.

The rows of each old shard fall into blocks, whose number follows the rows', by a
hash of their id. Only the block sizes reach the driver (``n_old * blocks`` numbers). A
minimum-cost flow from old shards to new ones, whose costs are bytes moved, says
how many bytes go from each shard to each other; whole blocks then realise the
flow. Slots come from row counts of the blocks and a window inside each block,
so no task ever holds a shard.

Null, empty and odd input: a null text has no bytes (size 1); a null id hashes
like any other value; very long texts count in bytes like any other; ties in the
order of a block are between equal rows; an empty table gives an empty result;
repeated rows each get a place of their own; other columns are ignored, or kept
as they are by a rewrite.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

BLOCK_ROWS = 50_000
LEAST_BLOCKS = 256
MOST_SIZES = 1_000_000


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Units sent from each supplier to each receiver at the least total cost.

    Successive shortest paths with node potentials on the bipartite network;
    the capacities must hold the supplies.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the new capacities can't hold the old shards")
    flow = [[0] * m for _ in range(n)]
    left, room = list(supply), list(capacity)
    pot = [0] * (n + m)
    while any(left):
        dist: list[float] = [float("inf")] * (n + m)
        prev = [-1] * (n + m)
        heap = []
        for i in range(n):
            if left[i]:
                dist[i] = 0
                heap.append((0, i))
        heapq.heapify(heap)
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            if u < n:
                steps = ((n + j, cost[u][j]) for j in range(m))
            else:
                steps = ((i, -cost[i][u - n]) for i in range(n) if flow[i][u - n])
            for v, c in steps:
                e = d + c + pot[u] - pot[v]
                if e < dist[v]:
                    dist[v], prev[v] = e, u
                    heapq.heappush(heap, (e, v))
        ends = [n + j for j in range(m) if room[j] and dist[n + j] < float("inf")]
        end = min(ends, key=lambda v: dist[v] + pot[v])
        far = dist[end]
        pot = [p + min(d, far) for p, d in zip(pot, dist, strict=True)]
        path, v = [end], end
        while prev[v] >= 0:
            v = prev[v]
            path.append(v)
        path.reverse()
        amount = min(left[path[0]], room[end - n])
        for a, b in zip(path, path[1:], strict=False):
            if a >= n:
                amount = min(amount, flow[b][a - n])
        for a, b in zip(path, path[1:], strict=False):
            if a < n:
                flow[a][b - n] += amount
            else:
                flow[b][a - n] -= amount
        left[path[0]] -= amount
        room[end - n] -= amount
    return flow


def even_capacities(total: int, n: int) -> list[int]:
    """Capacities that differ by one at most and add up to ``total``."""
    return [total // n + (k < total % n) for k in range(n)]


def assign_blocks(blocks: dict[tuple[int, int], int], flow: list[list[int]]) -> dict[tuple[int, int], int]:
    """A new shard for each (old shard, block), so that bytes follow the flow.

    Blocks go from large to small, each to the receiver whose share of the flow
    is the least filled; what is over or short carries on to the next old shard.
    """
    out: dict[tuple[int, int], int] = {}
    carry = [0] * (len(flow[0]) if flow else 0)
    for i, row in enumerate(flow):
        need = {j: x + carry[j] for j, x in enumerate(row) if x}
        need = need or {i % len(row): 0}
        own = sorted((k for k in blocks if k[0] == i), key=lambda k: (-blocks[k], k))
        for k in own:
            j = max(need, key=lambda j: (need[j], j == i, -j))
            out[k] = j
            need[j] -= blocks[k]
        for j, x in need.items():
            carry[j] = x
    return out


def reshard(
    docs: DataFrame,
    old_shard: Column,
    n_new: int,
    *,
    n_old: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int | None = None,
    capacities: list[int] | None = None,
    cost: list[list[int]] | None = None,
    whole: bool = False,
) -> tuple[DataFrame, list[list[int]]]:
    """Place every row in a new shard; also returns the bytes sent between shards.

    ``old_shard`` (0 to ``n_old - 1``) is where a row lies now. ``capacities``
    are the new shards' bytes (even ones by default) and ``cost`` the price of a
    byte from an old shard to a new one (0 to stay, 1 to move). An old shard has
    ``blocks`` blocks, by default as many as keep them at ``BLOCK_ROWS`` rows each
    if all lie in one shard; the driver holds ``n_old * blocks`` sizes, a million
    at most. Columns: id, size, text_crc32, old_shard, shard, slot; with ``whole``
    also ``row``, a struct of the columns of ``docs``.
    """
    spark = docs.sparkSession
    bytes_ = F.encode(F.coalesce(docs[text_col], F.lit("")), "utf-8")
    row = [F.struct(*(docs[c] for c in docs.columns)).alias("row")] if whole else []
    rows = cut(
        docs.select(
            docs[id_col].alias("doc_id"),
            (F.octet_length(bytes_) + 1).cast("long").alias("size"),
            F.crc32(bytes_).alias("text_crc32"),
            old_shard.cast("int").alias("old_shard"),
            *row,
        )
    )
    blocks = blocks or min(max(LEAST_BLOCKS, rows.count() // BLOCK_ROWS), MOST_SIZES // n_old)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)).cast("int"))
    found = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    sizes = {(r.old_shard, r.block): r.bytes for r in found}
    supply = [sum(v for k, v in sizes.items() if k[0] == i) for i in range(n_old)]
    capacities = capacities or even_capacities(sum(supply), n_new)
    cost = cost or [[int(i != j) for j in range(n_new)] for i in range(n_old)]
    flow = min_cost_flow(supply, capacities, cost)
    to = assign_blocks(sizes, flow)
    first, plan = [0] * n_new, []
    for r in sorted(found, key=lambda r: (r.old_shard, r.block)):
        j = to[r.old_shard, r.block]
        plan.append((r.old_shard, r.block, j, first[j]))
        first[j] += r.n
    layout = spark.createDataFrame(plan, "old_shard int, block int, shard int, first long")
    # the shard follows from the other two; with it, a choice of shards is made before the sort
    inside = Window.partitionBy("old_shard", "block", "shard").orderBy("doc_id", "size", "text_crc32")
    # at most a million short rows: small enough to send to every executor
    placed = rows.join(F.broadcast(layout), ["old_shard", "block"]).withColumn("slot", F.col("first") + F.row_number().over(inside) - 1)
    return placed.select("doc_id", "size", "text_crc32", "old_shard", "shard", F.col("slot").cast("long").alias("slot"), *(["row"] if whole else [])), flow


def rewrite_affected(placed: DataFrame, flow: list[list[int]], path: str) -> list[int]:
    """Write anew the shards that lose or gain rows, one folder each; returns them.

    ``placed`` comes from :func:`reshard` with ``whole``. Shards that keep exactly
    their rows aren't touched. Rows lie in the order of their slots; repeated rows
    are written as often as they come. The folders' name is ``shard``, with
    underscores before it if the documents have such a column.
    """
    sent = [(i, j) for i, own in enumerate(flow) for j, x in enumerate(own) if x and i != j]
    hit = sorted({s for pair in sent for s in pair})
    name = "shard"
    while name in placed.schema["row"].dataType.names:
        name = "_" + name
    out = placed.where(F.col("shard").isin(hit)).select("row.*", F.col("shard").alias(name), F.col("slot").alias("__slot"))
    part = F.floor(F.col("__slot") / 1_000_000).alias("__part")
    out.withColumn("__part", part).repartition(name, "__part").sortWithinPartitions(name, "__slot").drop("__slot", "__part").write.partitionBy(name).mode("overwrite").parquet(path)
    return hit


def op7_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in 8 shards by their source; 8 shards of even bytes are wanted."""
    docs = table(spark, sf_dir, "documents")
    old = F.pmod(F.crc32(F.encode(F.coalesce(F.col("source"), F.lit("")), "utf-8")), F.lit(8))
    placed, _ = reshard(docs, old, 8, n_old=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
