"""Nearest neighbours by inner product with score-aware quantisation.

A product quantiser with 16 codewords for each pair of dimensions is fitted to
the anisotropic loss, which weighs the part of a residual parallel to its vector
``eta`` times as much as the rest: that part is what falsifies large scores. A
code is four bits; two share a byte. A query scans codes by adding up entries of
its tables, one for each byte; the best of the scan, and all that the codes can't
tell from them, are reranked by exact inner products in double precision.

The codebooks are fitted on the driver on a bounded sample (``sample_rows``);
every row is coded and scanned. A task has one block of queries and a group of
blocks of codes with their vectors, and keeps the best for each query over all of
them, so no candidate is shuffled but these.

Null, empty and odd input: a vector that is null, empty, zero or holds a null or
non-finite component, or whose id is null, takes no part; vectors of each length
are searched by themselves; equal scores go to smaller ids; repeated rows are
candidates each, though never of a query with their id, and a query that repeats
is answered once, for its least vector of a length; with fewer candidates
than wanted all are returned; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, lean_group, table
from .cover_tree import usable

CODEWORDS = 16
THRESHOLD = 0.2
SAMPLE_ROWS = 10_000
CODE_BLOCK = 8_192  # rows that one task codes
GROUP_BLOCKS = 16  # blocks of codes that a task scans, with their vectors
QUERY_BLOCK = 2_048


class Codebook:
    """Codewords by pair of dimensions: (pairs, 16, 2); a last odd dimension is padded with zero."""

    def __init__(self, dim: int, words: np.ndarray, eta: float):
        self.dim, self.words, self.eta = dim, words, eta
        self.error = 0.0  # root mean square of a residual's component

    def split(self, x: np.ndarray) -> np.ndarray:
        """(pairs, rows, 2)"""
        if x.shape[1] % 2:
            x = np.pad(x, ((0, 0), (0, 1)))
        return np.ascontiguousarray(x.reshape(len(x), -1, 2).transpose(1, 0, 2))

    def encode(self, x: np.ndarray, sweeps: int = 2) -> np.ndarray:
        """Codes (pairs, rows) by coordinate descent on the anisotropic loss."""
        parts = self.split(x)
        norm = np.maximum((x.astype(np.float64) ** 2).sum(1), 1e-300)
        codes = np.empty(parts.shape[:2], np.uint8)
        along = np.empty(parts.shape[:2])  # each pair's share of <residual, x>
        for m, part in enumerate(parts):
            codes[m] = ((part[:, None] - self.words[m][None]) ** 2).sum(2).argmin(1)
            along[m] = ((part - self.words[m][codes[m]]) * part).sum(1)
        total = along.sum(0)
        for _ in range(sweeps):
            for m, part in enumerate(parts):
                codes[m], along_m = self.best(m, part, total - along[m], norm)
                total += along_m - along[m]
                along[m] = along_m
        return codes

    def best(self, m: int, part: np.ndarray, rest: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gap = part[:, None] - self.words[m][None]
        lengthwise = (gap * part[:, None]).sum(2)
        loss = (gap**2).sum(2) + (self.eta - 1) * (rest[:, None] + lengthwise) ** 2 / norm[:, None]
        code = loss.argmin(1)
        return code.astype(np.uint8), lengthwise[np.arange(len(part)), code]

    def tables(self, queries: np.ndarray) -> np.ndarray:
        """(queries, bytes, 256): the inner product of a query with both codewords of a byte."""
        each = np.einsum("mqd,mkd->qmk", self.split(queries), self.words)
        if each.shape[1] % 2:
            each = np.pad(each, ((0, 0), (0, 1), (0, 0)))
        both = each[:, 1::2, :, None] + each[:, ::2, None, :]
        return both.reshape(len(queries), -1, 256).astype(np.float32)


def packed(codes: np.ndarray) -> np.ndarray:
    """(bytes, rows) with the first of two codes in the low four bits."""
    if len(codes) % 2:
        codes = np.vstack([codes, np.zeros((1, codes.shape[1]), np.uint8)])
    return codes[::2] | codes[1::2] << 4


def fit(x: np.ndarray, *, rounds: int = 6, threshold: float = THRESHOLD, seed: int = 5) -> Codebook:
    """Codebooks for the rows of ``x``: least-squares updates that take the parallel part into account."""
    rng, dim = np.random.default_rng(seed), x.shape[1]
    eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
    book = Codebook(dim, np.zeros((0, CODEWORDS, 2)), eta)
    parts = book.split(x.astype(np.float64))
    book.words = np.stack([part[rng.choice(len(part), CODEWORDS, replace=len(part) < CODEWORDS)] for part in parts])
    book.words += rng.normal(scale=1e-6, size=book.words.shape) * max(1e-12, float(np.abs(x).mean()))
    for turn in range(rounds):
        plain = turn < 3  # ordinary k-means first
        book.eta = 1.0 if plain else eta
        codes = book.encode(x, 0 if plain else 1)
        norm = np.maximum((x.astype(np.float64) ** 2).sum(1), 1e-300)
        along = np.stack([((part - book.words[m][codes[m]]) * part).sum(1) for m, part in enumerate(parts)])
        total = along.sum(0)
        for m, part in enumerate(parts):
            rest = total - along[m]
            w = (book.eta - 1) / norm
            for k in range(CODEWORDS):
                own = codes[m] == k
                if not own.any():
                    book.words[m, k] = part[rng.integers(len(part))]
                    continue
                p = part[own]
                left = own.sum() * np.eye(2) + (p * w[own, None]).T @ p
                right = p.sum(0) + ((rest[own] + (p**2).sum(1)) * w[own]) @ p
                book.words[m, k] = np.linalg.solve(left, right)
    book.eta = eta
    codes = book.encode(x)
    book.error = float(np.sqrt(np.mean([(part - book.words[m][codes[m]]) ** 2 for m, part in enumerate(parts)])))
    return book


class Lists:
    """The ``k`` best candidates of some queries so far, by exact inner products, over block after block of codes."""

    def __init__(self, qids: np.ndarray, queries: np.ndarray, book: Codebook, k: int, least: int):
        self.qids, self.queries, self.tables, self.k, self.least = qids, queries, book.tables(queries), k, least
        # what a score by codes may be off by
        self.margins = 2 * book.error * np.sqrt((queries**2).sum(1))
        self.held = [(np.zeros(0, np.int64), np.zeros(0)) for _ in qids]

    def scan(self, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray) -> None:
        """Rerank the block's best ``least`` by codes, and all that the codes can't tell from the ``k`` best so far."""
        for i, (qid, query, tab, margin) in enumerate(zip(self.qids.tolist(), self.queries, self.tables, self.margins.tolist(), strict=True)):
            near = tab[0][codes[0]]
            for b in range(1, len(codes)):
                near += tab[b][codes[b]]
            bar = -np.inf
            if len(near) > self.least:
                bar = np.partition(near, len(near) - self.least)[len(near) - self.least]
                best = self.held[i][1]
                if len(best) == self.k:
                    bar = min(bar, best.min() - margin)
                else:  # nothing to compare with yet: the block's own best
                    bar = min(bar, np.partition(near, len(near) - self.k)[len(near) - self.k] - margin)
            own = np.flatnonzero((near >= bar) & (ids != qid))
            # sums by row: equal vectors have equal scores
            score = (vectors[own].astype(np.float64) * query).sum(1)
            all_ids, all_scores = np.append(self.held[i][0], ids[own]), np.append(self.held[i][1], score)
            top = np.lexsort((all_ids, -all_scores))[: self.k]
            self.held[i] = all_ids[top], all_scores[top]


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, least: int = 160, id_col: str = "vec_id", vec_col: str = "embedding", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The ``k`` best candidates found for each query: query_id, rank, vec_id, score.

    Of each block of codes the ``least`` best are reranked, and all that the quantisation
    error can't tell from the ``k`` best, however many they are.
    ``is_query`` is a condition on ``vectors``; all rows are candidates, but not for their own id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("vec"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = cut(rows.where(usable(F.col("vec")) & F.col("vec_id").isNotNull()).withColumn("dim", F.size("vec")))
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("asked")).collect()  # a row for each length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books, layout, cores = {}, [], spark.sparkContext.defaultParallelism
    wide = {"float": "<f4"}.get(rows.schema["vec"].dataType.elementType.typeName(), "<f8")
    for r in sizes:
        dim, n = r["dim"], r["n"]
        share = min(1.0, 1.2 * sample_rows / n)
        drawn = rows.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) <= int(share * (1 << 30)))).orderBy(F.xxhash64("vec"), "vec_id").limit(sample_rows).select("vec").collect()
        books[dim] = fit(np.array([x["vec"] for x in drawn], np.float64)) if drawn else Codebook(dim, np.zeros(((dim + 1) // 2, CODEWORDS, 2)), 1.0)
        blocks = -(-n // CODE_BLOCK)
        # queries in as few blocks as fit, but enough for all cores: each block of them reads all codes
        asked = max(-(-r["asked"] // QUERY_BLOCK), min(2 * cores, -(-r["asked"] // 64)), 1)
        layout.append((dim, blocks, asked, -(-blocks // GROUP_BLOCKS)))
    sheet = F.broadcast(spark.createDataFrame(layout, "dim int, blocks long, asked long, groups long"))  # a row for each length
    rows = rows.join(sheet, "dim")

    def matrix(column: pa.Array, dim: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)

    @lean_group
    def code(key: tuple, group: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        group = group.sort_by("vec_id")
        column = group["vec"].combine_chunks()
        # of equal vectors, more than k besides the query can't be among the k nearest
        alike = np.unique(matrix(column, dim), axis=0, return_inverse=True)[1].ravel()
        order = np.argsort(alike, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(alike[order]) > 0))
        place = np.arange(len(order)) - np.repeat(heads, np.diff(np.append(heads, len(order))))
        kept = pa.array(np.sort(order[place <= k]))
        column, group = column.take(kept), group.take(kept)
        codes = np.hstack([packed(books[dim].encode(matrix(column.slice(at, 4096), dim))) for at in range(0, len(column), 4096)])
        raw = column.flatten().to_numpy(zero_copy_only=False).astype(wide)
        blobs = [pa.array([x.tobytes()]) for x in (group["vec_id"].to_numpy().astype("<i8"), codes, raw)]
        return pa.table([pa.array([dim], pa.int32()), pa.array([key[1].as_py()], pa.int64()), *blobs], names=["dim", "block", "ids", "codes", "vectors"])

    @lean_group
    def scan(key: tuple, codes: pa.Table, asked: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        queries, out = asked["vec"].combine_chunks(), [[], [], []]
        for at in range(0, len(queries), 64):  # tables of a few queries at a time
            lists = Lists(asked["vec_id"].to_numpy()[at : at + 64], matrix(queries.slice(at, 64), dim), books[dim], k, least)
            for ids, blob, raw in zip(codes["ids"], codes["codes"], codes["vectors"], strict=True):
                ids = np.frombuffer(ids.as_buffer(), "<i8")
                lists.scan(ids, np.frombuffer(blob.as_buffer(), np.uint8).reshape(-1, len(ids)), np.frombuffer(raw.as_buffer(), wide).reshape(-1, dim))
            for qid, (ids, score) in zip(lists.qids.tolist(), lists.held, strict=True):
                out[0].append(np.full(len(ids), qid))
                out[1].append(ids)
                out[2].append(score)
        return pa.table([np.concatenate([*x, np.zeros(0, t)]) for x, t in zip(out, (np.int64, np.int64, np.float64), strict=True)], names=["query_id", "vec_id", "score"])

    coded = cut(rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks"))).select("dim", "block", "vec_id", "vec").groupBy("dim", "block").applyInArrow(code, "dim int, block long, ids binary, codes binary, vectors binary"), blobs=True)
    numbers = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    # a task has one block of queries and a group of blocks of codes, and keeps one list a query for them all
    codes = coded.join(sheet, "dim").withColumn("grp", F.floor(F.col("block") / GROUP_BLOCKS).cast("long")).withColumn("q", numbers("asked")).select("dim", "q", "grp", "ids", "codes", "vectors")
    once = rows.where("is_query").groupBy("dim", "vec_id", "asked", "groups").agg(F.min("vec").alias("vec"))
    asked = once.withColumn("q", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("asked"))).withColumn("grp", numbers("groups")).select("dim", "q", "grp", "vec_id", "vec")
    found = codes.groupBy("dim", "q", "grp").cogroup(asked.groupBy("dim", "q", "grp")).applyInArrow(scan, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth vector is a query, against all."""
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors["vec_id"] % 20 == 0)
