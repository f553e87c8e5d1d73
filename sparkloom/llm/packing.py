"""Best-fit packing of documents into sequences by exact-complement hashing.

Documents become pieces of at most ``capacity`` tokens. Only the number of pieces
of each length (``capacity`` numbers at most) reaches the driver. There a plan is
made of patterns, each a few lengths that share a sequence and the number of
sequences alike: longest pieces first, a gap is filled exactly by one, two or
three lengths whose sum hashes to it and that are still available; where none
are, the longest piece that fits goes in and the rest of the gap is tried again.
Every piece has a rank among those of its length, and the plan maps ranges of
ranks to sequences, so placing the pieces needs no sort and no group.

Null, empty and odd input: a null text is an empty one, which has the end token
alone; repeated rows are packed one by one; an empty table gives an empty
result; very long texts are cut into pieces, the first of which may be shorter;
pieces of equal length are alike, and the order of rows decides between them;
the string of one of the tokenizer's added tokens in a text is that token, as in
the tokenizer itself; other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, lean, table

TOKENIZER = "byte_bpe_50k.json"
END = 2
PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, part int, rank long"


def byte_level() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


def encoder(path: str) -> tiktoken.Encoding:
    """A fast encoder with the vocabulary, and so the ids, of a byte-level tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    to = byte_level()
    ranks = {bytes(to[c] for c in word): n for word, n in spec["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece of ``n`` tokens; the first one may be shorter."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenize_pieces(docs: DataFrame, *, tokenizer: str, capacity: int = 1024, end: int = END, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """The pieces of every document; ``rank`` counts those of a length in each partition ``part``."""
    schema = PIECES.format(id=docs.schema[id_col].dataType.simpleString()) + (", ids binary" if with_ids else "")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        tail = np.array([end], "<u4")
        for batch in batches:
            at, piece, start, length, crc, rank, data = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = enc.encode_to_numpy(text.as_py() or "", allowed_special="all")
                raw = np.concatenate([ids.astype("<u4", copy=False), tail]).tobytes()
                for k, (s, n) in enumerate(cuts(len(raw) // 4, capacity)):
                    own = raw[4 * s : 4 * (s + n)]
                    at.append(row)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    rank.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        data.append(own)
            cols = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(at), pa.int32()), pa.array(rank, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            if with_ids:
                cols.append(pa.array(data, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


class Complements:
    """Sums of one, two and three available lengths, looked up by the gap they fill."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()

    def single(self, gap: int) -> tuple[int, ...]:
        return (gap,) if self.left[gap] > 0 else ()

    def pair(self, gap: int, most: int | None = None) -> tuple[int, ...]:
        """The pair with sum ``gap`` whose larger length (``most`` at most) is the largest."""
        high = np.arange(min(gap - 1, most or gap), (gap - 1) // 2, -1)
        if not len(high):
            return ()
        low = gap - high
        fits = (self.left[high] > 0) & (self.left[low] > (high == low))
        k = int(fits.argmax())
        return (int(high[k]), int(low[k])) if fits[k] else ()

    def triple(self, gap: int) -> tuple[int, ...]:
        for a in np.flatnonzero(self.left[: gap - 1])[::-1]:
            if 3 * a < gap:
                break
            a = int(a)
            self.left[a] -= 1
            rest = self.pair(gap - a, a)
            self.left[a] += 1
            if rest:
                return (a, *rest)
        return ()

    def exact(self, gap: int) -> tuple[int, ...]:
        return self.single(gap) or (self.pair(gap) if gap > 1 else ()) or (self.triple(gap) if gap > 2 else ())

    def best_fit(self, gap: int) -> int:
        fits = np.flatnonzero(self.left[: gap + 1])
        return int(fits[-1]) if len(fits) else 0


def plan_sequences(counts: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """(number of sequences, lengths in each), for ``counts`` of pieces by length."""
    index, plan = Complements(counts), []
    left = index.left
    for longest in range(capacity, 0, -1):
        while left[longest] > 0:
            items = [longest]
            left[longest] -= 1
            gap = capacity - longest
            while gap > 0:
                found = index.exact(gap) or ((index.best_fit(gap),) if index.best_fit(gap) else ())
                if not found:
                    break
                for x in found:
                    left[x] -= 1
                    items.append(x)
                    gap -= x
            used = {x: items.count(x) for x in items}
            more = min(int(left[x]) // m for x, m in used.items())
            for x, m in used.items():
                left[x] -= more * m
            plan.append((1 + more, items))
    return plan


def rank_ranges(plan: list[tuple[int, list[int]]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, (first rank, pieces in a sequence, first sequence, first offset) by rank."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for times, items in plan:
        offset = 0
        for x in dict.fromkeys(items):
            m = items.count(x)
            out.setdefault(x, []).append((given.get(x, 0), m, sequence, offset))
            given[x] = given.get(x, 0) + times * m
            offset += m * x
        sequence += times
    return out


def pack(pieces: DataFrame, *, capacity: int = 1024) -> DataFrame:
    """Give every piece of :func:`tokenize_pieces` (read twice: a cut table) a sequence_id and an offset."""
    hist = cut(pieces.groupBy("part", "length").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for r in hist.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r.length] = r.n
    ranges = rank_ranges(plan_sequences(counts, capacity))
    # at most a few patterns for each length, whatever the size of the corpus
    table_ = {x: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for x, rows in ranges.items()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = hist.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    # a row for each partition and length: it grows with the input, so it is never broadcast
    ranked = pieces.join(first.hint("shuffle_hash"), ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first")).drop("first", "part")
    out = ranked.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    @lean
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(length[order])) + 1) if len(order) else ():
                x = int(length[own[0]])
                start, m, seq, off = table_[x]
                k = np.searchsorted(start, rank[own], "right") - 1
                n = rank[own] - start[k]
                sequence[own] = seq[k] + n // m[k]
                offset[own] = off[k] + (n % m[k]) * x
            cols = {f.name: batch.column(f.name) for f in out.fields[:-2]}
            yield pa.RecordBatch.from_pydict(cols | {"sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return ranked.mapInArrow(place, out)


def pack_documents(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = 1024, with_ids: bool = False, **names: str) -> DataFrame:
    """Tokenize, cut and pack; with ``with_ids`` each piece carries its ids (binary, little-endian unsigned 32-bit)."""
    pieces = cut(tokenize_pieces(docs, tokenizer=tokenizer or public_tokenizers.path(TOKENIZER), capacity=capacity, with_ids=with_ids, **names))
    return pack(pieces, capacity=capacity)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
