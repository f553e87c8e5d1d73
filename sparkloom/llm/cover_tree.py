"""Near-duplicate embeddings by dual traversal of cover trees.

Equal vectors are collapsed first, with their number. The others are dealt to
cells around a few centres, in farthest-first order, which are the top of the
tree; a large cell is dealt on to blocks of bounded size. Each block holds a
cover tree: nested levels whose radii halve, every node with its true covering
radius. Pairs of cells, and then pairs of nodes, are dropped if their centres
are further apart than both radii and the threshold allow; what reaches the
leaves is tested in double precision, so exactly the pairs at or above the
threshold link.

Tasks return for each vector its number of links and one edge into a class of
the task, never the pairs; classes are joined by distributed components.

Null, empty and odd input: a vector that is null, empty, zero or holds a null or
non-finite component links with nothing and is a class by itself; vectors of
different lengths link with nothing of another length; repeated rows link with
one another; a null id has a null class; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, forget, lean, lean_group, table
from .components import components

BLOCK_ROWS = 4096
MOST_CELLS = 1024
SAMPLE_ROWS = 4096
TILE = 512
HOT_ROWS = 1 << 16
MOST_HOT = 10_000
MOST_SIDE = 16  # blocks along a side of the tiles of block pairs: two sides of some megabytes a block in a task
MARGIN = 1e-5  # of single-precision bounds


def usable(vec: Column) -> Column:
    """Is a vector neither null, empty nor zero, with finite components only?"""
    d = F.transform(vec, lambda x: x.cast("double"))
    fine = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vec.isNotNull() & (F.size(vec) > 0) & fine & F.exists(d, lambda x: x != 0.0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def alone(x: np.ndarray, radius: float) -> np.ndarray:
    """Is a point further than ``radius`` from every other one? In doubt, no."""
    low = x.astype(np.float32)
    bar = 1 - radius * radius / 2 - MARGIN
    out = np.zeros(len(x), bool)
    for at in range(0, len(x), TILE):
        out[at : at + TILE] = ((low[at : at + TILE] @ low.T) >= bar).sum(1) <= 1
    return out


def net(x: np.ndarray, center: int, radius: float) -> tuple[list[int], np.ndarray]:
    """Points, the first of which is ``center``, within ``radius`` of one of which lie all;
    and for each point the number of the one it belongs to. Points that are near no other one
    stand for themselves; of the rest the farthest come first."""
    owner = np.zeros(len(x), np.int64)
    gap = distance(x @ x[center])
    chosen = [center]
    far = gap > radius
    if far.sum() > 2 * TILE:
        single = np.flatnonzero(far & alone(x, radius))
        owner[single] = np.arange(1, len(single) + 1)
        chosen += single.tolist()
        far[single] = False
    open_ = np.flatnonzero(far)
    gap = gap[open_]
    rows = x[open_]
    while len(open_):
        k = int(gap.argmax())
        chosen.append(int(open_[k]))
        d = distance(rows @ rows[k])
        nearer = d < gap
        nearer[k] = True
        owner[open_[nearer]] = len(chosen) - 1
        gap = np.minimum(gap, d)
        stay = gap > radius
        stay[k] = False
        if not stay.all():
            open_, gap, rows = open_[stay], gap[stay], rows[stay]
    return chosen, owner


class CoverTree:
    """Nodes in breadth-first order: centre, covering radius, and the range of their children."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.center, self.radius, self.first, self.last = [0], [0.0], [0], [0]
        members: list[np.ndarray] = [np.arange(len(x))]
        scale = [float(distance(x @ x[0]).max(initial=0.0))]
        self.radius[0] = scale[0]
        k = 0
        while k < len(self.center):
            own, r = members[k], scale[k]
            members[k] = np.zeros(0, np.int64)
            if len(own) > 1:
                rows = x[own]
                at = int(np.flatnonzero(own == self.center[k])[0])
                if r <= 1e-7:
                    chosen, owner = list(range(len(own))), np.arange(len(own))
                else:
                    chosen, owner = net(rows, at, r / 2)
                self.first[k] = len(self.center)
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(1, len(chosen)))
                for c, part in zip(chosen, np.split(order, cuts), strict=True):
                    reach = float(distance(rows[part] @ rows[c]).max()) if len(part) > 1 else 0.0
                    self.center.append(int(own[c]))
                    self.radius.append(reach)
                    self.first.append(0)
                    self.last.append(0)
                    members.append(own[part])
                    scale.append(min(reach, r / 2))
                self.last[k] = len(self.center)
            k += 1
        self.center, self.radius, self.first, self.last = np.array(self.center, np.int32), np.array(self.radius), np.array(self.first, np.int32), np.array(self.last, np.int32)

    def arrays(self) -> list[bytes]:
        return [self.center.astype("<i4").tobytes(), self.radius.astype("<f8").tobytes(), self.first.astype("<i4").tobytes(), self.last.astype("<i4").tobytes()]

    @classmethod
    def load(cls, x: np.ndarray, parts: list[bytes]) -> CoverTree:
        tree = cls.__new__(cls)
        tree.x = x
        tree.center, tree.radius, tree.first, tree.last = (np.frombuffer(b, t) for b, t in zip(parts, ("<i4", "<f8", "<i4", "<i4"), strict=True))
        return tree

    def below(self, node: int) -> np.ndarray:
        """The children of a node; of a leaf, itself."""
        return np.arange(self.first[node], self.last[node]) if self.last[node] else np.array([node])


def near_tiles(one: CoverTree, two: CoverTree, left: np.ndarray, right: np.ndarray, low: dict, reach: float, half: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of nodes (from ``left`` and ``right``) that the covering radii don't rule out.

    With ``half`` both are the same list, and each pair comes once: the product has only the upper triangle.
    """
    ra, rb = one.radius[left].astype(np.float32), two.radius[right].astype(np.float32)
    xb = low[id(two)][two.center[right]].T
    widest = float(rb.max(initial=0.0))
    for at in range(0, len(left), TILE):
        rows, r = left[at : at + TILE], ra[at : at + TILE]
        first = at if half else 0
        near = low[id(one)][one.center[rows]] @ xb[:, first:]
        bound = float(r.max(initial=0.0)) + widest + reach
        i, j = np.nonzero(near >= np.float32(1 - bound * bound / 2 - MARGIN))
        if bound > reach:
            each = r[i] + rb[first + j] + np.float32(reach)
            some = near[i, j] >= 1 - each * each / 2 - np.float32(MARGIN)
            i, j = i[some], j[some]
        if half:
            some = i <= j
            i, j = i[some], j[some]
        yield rows[i], right[first + j]


def dual(one: CoverTree, two: CoverTree, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of points (indices into both trees) whose cosine is ``cosine`` or more.

    With ``same`` the trees are one and the same, and each pair comes once.
    """
    reach = float(np.sqrt(2 - 2 * cosine))
    work = [(0, 0)]
    low = {id(t): t.x.astype(np.float32) for t in (one, two)}
    while work:
        a, b = work.pop()
        itself = same and a == b
        left, right = one.below(a), two.below(b)
        if len(left) == 1 and itself and not one.last[a]:
            continue
        # leaves have no radius: pairs of them need one comparison, and the bounds of the others are tighter by themselves
        sides = [(x[t.last[x] == 0], x[t.last[x] > 0]) for t, x in ((one, left), (two, right))]
        for m in (0, 1):
            for n in (0, 1):
                if itself and m > n or not len(sides[0][m]) or not len(sides[1][n]):
                    continue
                for p, q in near_tiles(one, two, sides[0][m], sides[1][n], low, reach, itself and m == n):
                    if m or n:
                        work.extend(zip(p.tolist(), q.tolist(), strict=True))
                        continue
                    u, v = one.center[p], two.center[q]
                    if same:
                        apart = u != v
                        u, v = u[apart], v[apart]
                    for s in range(0, len(u), 100_000):
                        us, vs = u[s : s + 100_000], v[s : s + 100_000]
                        hit = np.einsum("ij,ij->i", one.x[us], two.x[vs]) >= cosine
                        if hit.any():
                            yield us[hit], vs[hit]


def classes_of(nodes: int, edges: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least node reachable from each node."""
    label = np.arange(nodes)
    moved = True
    while moved:
        moved = False
        for u, v in edges:
            low = np.minimum(label[u], label[v])
            if (label[u] != low).any() or (label[v] != low).any():
                np.minimum.at(label, u, low)
                np.minimum.at(label, v, low)
                moved = True
        label = label[label]
    return label


def near_pairs(vectors: DataFrame, *, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = BLOCK_ROWS, most_cells: int = MOST_CELLS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row for each vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    reach = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("vec")).withColumn("ok", usable(F.col("vec")) & F.col("vec_id").isNotNull())
    one = cut(rows.where("ok").groupBy("vec").agg(F.min("vec_id").alias("id"), F.count("*").alias("times")).withColumn("dim", F.size("vec")))
    found = one.groupBy("dim").agg(F.count("*").alias("n"), F.sum("times").alias("rows")).collect()  # a row for each length
    dims, total = {r["dim"]: r["n"] for r in found}, sum(r["rows"] for r in found)
    wide = {"float": "<f4"}.get(one.schema["vec"].dataType.elementType.typeName(), "<f8")
    centers: dict[int, np.ndarray] = {}
    for dim, n in dims.items():
        cells = min(most_cells, -(-n // block_rows))
        if cells == 1:
            centers[dim] = np.eye(1, dim)
            continue
        share = min(1.0, sample_rows / n)
        drawn = one.where(F.col("dim") == dim).where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(F.xxhash64("vec"), "id").limit(sample_rows).select("vec").collect()
        x = unit(np.array([r["vec"] for r in drawn], np.float64)) if drawn else np.eye(1, dim)
        chosen, _ = net(x[: max(cells * 4, 64)], 0, 0.0)
        centers[dim] = x[chosen[:cells]]

    @lean
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec, dim = batch.column(0), batch.column(3).to_numpy()
            cell, gap = np.zeros(len(dim), np.int32), np.zeros(len(dim))
            offsets, flat = np.append(0, np.cumsum(dim)), vec.flatten().to_numpy(zero_copy_only=False)
            for d in np.unique(dim).tolist():
                own = np.flatnonzero(dim == d)
                near = unit(flat[offsets[own][:, None] + np.arange(d)]) @ centers[d].T
                cell[own] = near.argmax(1)
                gap[own] = distance(near.max(1))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), vec, batch.column(3), pa.array(cell), pa.array(gap)], ["id", "times", "vec", "dim", "cell", "gap"])

    schema = one.select("id", "times", "vec", "dim").schema.add("cell", "integer").add("gap", "double")
    dealt = cut(one.select("vec", "id", "times", "dim").mapInArrow(assign, schema))
    sizes = dealt.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()  # a row for each cell
    cells = spark.createDataFrame([(r["dim"], r["cell"], -(-r["n"] // block_rows)) for r in sizes], "dim int, cell int, blocks long")
    reachable = []
    for d in dims:
        own = [r for r in sizes if r["dim"] == d]
        apart = distance(centers[d] @ centers[d].T)
        reachable += [(d, a["cell"], b["cell"]) for a in own for b in own if a["cell"] <= b["cell"] and apart[a["cell"], b["cell"]] <= a["radius"] + b["radius"] + reach + MARGIN]
    placed = dealt.join(F.broadcast(cells), ["dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))

    @lean_group
    def grow(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        dim = key[0].as_py()
        raw = group["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(wide)
        tree = CoverTree(unit(raw))
        cols = [pa.array([k.as_py()], t) for k, t in zip(key, (pa.int32(), pa.int32(), pa.int64()), strict=True)]
        blobs = [group["id"].to_numpy().astype("<i8").tobytes(), group["times"].to_numpy().astype("<i8").tobytes(), raw.tobytes(), *tree.arrays()]
        return pa.Table.from_arrays([*cols, pa.array([blobs], pa.list_(pa.binary()))], ["dim", "cell", "block", "parts"])

    blocks = cut(placed.select("dim", "cell", "block", "id", "times", "vec").groupBy("dim", "cell", "block").applyInArrow(grow, "dim int, cell int, block long, parts array<binary>"), blobs=True)
    forget(dealt)
    pairs = spark.createDataFrame(reachable, "dim int, ca int, cb int")
    # blocks are numbered along their cells; a task has the pairs of one tile of the grid of all blocks, so
    # a block travels once for each row or column of tiles, not for each pair
    order = Window.partitionBy("dim").orderBy("cell", "block")
    index = cut(blocks.select("dim", "cell", "block").withColumn("at", F.row_number().over(order) - 1))  # a row for each block
    side = max(1, min(MOST_SIDE, int(index.count() / math.sqrt(8 * spark.sparkContext.defaultParallelism))))
    name = lambda s: index.select("dim", F.col("cell").alias(f"c{s}"), F.col("at").alias(f"at_{s}"))
    pairs = cut(pairs.join(name("a"), ["dim", "ca"]).join(name("b"), ["dim", "cb"]).select("dim", F.least("at_a", "at_b").alias("at_a"), F.greatest("at_a", "at_b").alias("at_b")).distinct().withColumn("ga", F.floor(F.col("at_a") / side)).withColumn("gb", F.floor(F.col("at_b") / side)))
    tiles = pairs.select(F.col("dim").alias("td"), F.col("ga").alias("ta"), F.col("gb").alias("tb")).distinct()
    wanted = tiles.select("td", "ta", "tb", F.explode(F.array_distinct(F.array("ta", "tb"))).alias("g"))
    placed = blocks.join(index, ["dim", "cell", "block"]).select(F.col("dim").alias("td"), "at", F.floor(F.col("at") / side).alias("g"), "parts").join(wanted, ["td", "g"]).select("td", "ta", "tb", "at", "parts")

    @lean_group
    def traverse(key: tuple, todo: pa.Table, held: pa.Table) -> pa.Table:
        dim, sides = key[0].as_py(), {}
        for at, parts in zip(held["at"].to_pylist(), held["parts"], strict=True):
            parts = parts.as_py()
            x = unit(np.frombuffer(parts[2], wide).reshape(-1, dim))
            sides[at] = (np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], "<i8"), CoverTree.load(x, parts[3:]))
        first, size = {}, 0
        for at in sorted(sides):
            first[at] = size
            size += len(sides[at][0])
        all_ids = np.concatenate([sides[at][0] for at in sorted(sides)])
        links, label = np.zeros(size, np.int64), np.arange(size)
        for a, b in sorted(zip(todo["at_a"].to_pylist(), todo["at_b"].to_pylist(), strict=True)):
            times, others = sides[a][1], sides[b][1]
            for u, v in dual(sides[a][2], sides[b][2], cosine, a == b):
                own, far = u + first[a], v + first[b]
                links += np.bincount(own, others[v], size).astype(np.int64) + np.bincount(far, times[u], size).astype(np.int64)
                fresh = label[own] != label[far]
                if fresh.any():
                    label = classes_of(size, [(label[own][fresh], label[far][fresh])])[label]
        some = np.flatnonzero(links)
        # the least id of a class stands for it
        low = np.full(size, np.iinfo(np.int64).max)
        np.minimum.at(low, label, all_ids)
        return pa.table({"id": pa.array(all_ids[some]), "links": pa.array(links[some]), "hub": pa.array(low[label[some]])})

    met = pairs.groupBy("dim", "ga", "gb").cogroup(placed.groupBy("td", "ta", "tb")).applyInArrow(traverse, "id long, links long, hub long")
    found = cut(met)
    forget(blocks, index, pairs)
    classes = components(found.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = one.select("vec", "id", "times").join(counts, "id", "left").join(classes, F.col("id") == F.col("node"), "left")
    known = cut(known.select(F.col("vec").alias("v"), "times", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id")))
    # a vector that very many rows have isn't joined by its hash: there are at most MOST_HOT of these
    hot = known.where(F.col("times") > max(HOT_ROWS, total // MOST_HOT)).select(F.col("v").alias("hv"), F.col("n_links").alias("hn"), F.col("component_id").alias("hc"))
    told = rows.where("ok").join(F.broadcast(hot), F.col("vec") == F.col("hv"), "left")
    good = told.where("hv IS NOT NULL").select("vec_id", F.col("hn").alias("n_links"), F.col("hc").alias("component_id"))
    good = good.unionByName(told.where("hv IS NULL").join(known, F.col("vec") == F.col("v")).select("vec_id", "n_links", "component_id"))
    bad = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(table(spark, sf_dir, "embeddings"))
