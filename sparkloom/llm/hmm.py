"""Language-model scoring with a hidden Markov model.

States emit word classes and classes emit words. The most frequent words, ``top``
at most, are classes of their own (of words that are about as frequent, all or
none), all others fall into ``buckets`` by a hash, and a word's share of its
bucket comes from its count; so the trained tables stay small while every count
covers all training texts. Baum-Welch runs as Spark jobs: each partition sums its expected counts, an aggregation adds them up, and
the driver only sees classes times states numbers. A text's score is the exact
likelihood from the scaled forward recursion.

The texts are read once, into chunks of word numbers with a vocabulary of 64-bit
word hashes, sorted; that table is cut and serves every later pass. Vocabularies
are cut at hash ranges, each range is summed by one task, and the counts of all
texts go back to the chunks by a join, never as a broadcast.

Null, empty and odd input: a null text is an empty one, which has the end token
alone; very long texts are scored whole; unseen words have a share of their
bucket; with nothing to learn from, the tables are even ones; repeated rows get
the same score; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chains import forward, forward_backward, time_major
from .common import crc_mod, cut, forget, lean, lean_group, table

SMOOTH = 0.1
CHUNK_TOKENS = 1_500_000
JOINT_TOKENS = 2_000_000
GROUP_TOKENS = 200_000
RANGE_WORDS = 500_000


class Numbers(dict):
    """A number for every key, in the order of first use."""

    def __missing__(self, key: bytes) -> int:
        n = self[key] = len(self)
        return n


def planes(x: np.ndarray) -> bytes:
    """32-bit numbers, bytes of the same rank together, for the compression of files and shuffles."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def numbers(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def chunks(docs: DataFrame, held: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of some documents each: ids, held flags, lengths (with the end), tokens, vocabulary, training counts.

    Token 0 is the end; token k is the k-th least hash of the vocabulary.
    """
    kind = docs.schema[id_col].dataType
    arrow = {"long": pa.int64(), "integer": pa.int32(), "string": pa.string()}.get(kind.typeName(), pa.int64())
    schema = f"chunk long, doc_ids array<{kind.simpleString()}>, held array<boolean>, lengths array<int>, tokens binary, vocab binary, trained binary, ends long"

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids = Numbers()
        doc_ids, flags, lengths, tokens, size = [], [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal chunk, size
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
            order = np.argsort(hashes)
            place = np.empty(len(ids) + 1, np.uint32)
            place[order] = np.arange(1, len(ids) + 1)
            place[-1] = 0
            flat = place[np.concatenate(tokens)]
            learn = np.repeat(~np.array(flags, bool), lengths)
            counts = np.bincount(flat[learn], minlength=len(ids) + 1)
            row = [[chunk], [doc_ids], [flags], [lengths], [planes(flat)], [hashes[order].tobytes()], [planes(counts[1:])], [int(counts[0])]]
            kinds = [pa.int64(), pa.list_(arrow), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            out = pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], ["chunk", "doc_ids", "held", "lengths", "tokens", "vocab", "trained", "ends"])
            chunk += 1
            size = 0
            ids.clear()
            for x in (doc_ids, flags, lengths, tokens):
                x.clear()
            return out

        end = np.array([-1], np.int32)
        for batch in batches:
            for doc, flag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = (text.as_py() or b"").lower().split()  # on bytes: ASCII letters and white space alone
                doc_ids.append(doc)
                flags.append(bool(flag))
                lengths.append(len(words) + 1)
                tokens += [np.fromiter(map(ids.__getitem__, words), np.int32, len(words)), end]
                size += len(words) + 1
                if size >= CHUNK_TOKENS:
                    yield close()
        if doc_ids:
            yield close()

    return docs.select(docs[id_col].alias("doc_id"), held.alias("held"), docs[text_col].cast("binary").alias("text")).mapInArrow(run, schema)


def count_words(data: DataFrame, *, top: int, buckets: int) -> DataFrame:
    """Training counts of all words, by hash range.

    For each chunk and range a row with the counts of the chunk's words, in
    order; and for each range a row with chunk -1: its number of words in all and
    of different ones, both by bucket, and its ``top`` words.
    """
    total = data.agg(F.sum(F.octet_length("vocab") / 8)).first()[0] or 0
    bits = max(1, int(total // RANGE_WORDS).bit_length())

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, vocab, trained in zip(*(batch.column(i) for i in range(3)), strict=True):
                h, n = np.frombuffer(vocab.as_py(), np.uint64), numbers(trained.as_py())
                edges = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                some = [r for r in range(1 << bits) if edges[r] < edges[r + 1]]
                if some:
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([chunk.as_py()] * len(some)), pa.array([h[edges[r] : edges[r + 1]].tobytes() for r in some]), pa.array([planes(n[edges[r] : edges[r + 1]]) for r in some])], ["range", "chunk", "hashes", "own"])

    @lean_group
    def add(key: tuple, group: pa.Table) -> pa.Table:
        hs = [np.frombuffer(x.as_py(), np.uint64) for x in group["hashes"]]
        h, back = np.unique(np.concatenate(hs), return_inverse=True)
        n = np.bincount(back, np.concatenate([numbers(x.as_py()) for x in group["own"]]), len(h)).astype(np.int64)
        every = n[back]
        ends = np.cumsum([len(x) for x in hs])
        known = n > 0
        slot = (h[known] % np.uint64(buckets)).astype(np.int64)
        best = np.lexsort((h, -n))[:top]
        best = best[n[best] > 0]
        rows = len(hs) + 1
        return pa.table({
            "chunk": pa.array([*group["chunk"].to_pylist(), -1], pa.int64()),
            "range": pa.array([key[0].as_py()] * rows, pa.int32()),
            "counts": pa.array([*(x.astype("<i8").tobytes() for x in np.split(every, ends[:-1])), None], pa.binary()),
            "sizes": pa.array([None] * len(hs) + [np.bincount(slot, n[known], buckets).astype(np.int64).tolist()], pa.list_(pa.int64())),
            "kinds": pa.array([None] * len(hs) + [np.bincount(slot, minlength=buckets).tolist()], pa.list_(pa.int64())),
            "words": pa.array([None] * len(hs) + [[{"h": a, "n": b} for a, b in zip(h[best].view(np.int64).tolist(), n[best].tolist(), strict=True)]], pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))),
        })

    dealt = data.select("chunk", "vocab", "trained").mapInArrow(deal, "range int, chunk long, hashes binary, own binary")
    return dealt.groupBy("range").applyInArrow(add, "chunk long, range int, counts binary, sizes array<long>, kinds array<long>, words array<struct<h:long,n:long>>")


class Classes:
    """The class of a word hash: its own for the top words, else a bucket; the end token is class 0."""

    def __init__(self, top: np.ndarray, buckets: int):
        self.top, self.buckets, self.size = np.sort(top), buckets, 1 + len(top) + buckets

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Of the end token and a vocabulary."""
        out = np.zeros(len(hashes) + 1, np.int32)
        out[1:] = 1 + len(self.top) + (hashes % np.uint64(self.buckets)).astype(np.int32)
        if len(self.top):
            k = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
            out[1:] = np.where(self.top[k] == hashes, 1 + k, out[1:])
        return out


def groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Documents from long to short, some at a time."""
    order, at = np.argsort(-lengths, kind="stable"), 0
    while at < len(order):
        stop = at + max(1, int(np.searchsorted(np.cumsum(lengths[order[at:]]), GROUP_TOKENS)))
        yield order[at:stop]
        at = stop


def chains_of(tokens: np.ndarray, lengths: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The elements of some chains, time-major, and how many chains reach each step."""
    size = lengths[own]
    alive, place = time_major(size)
    flat = np.arange(size.sum()) + np.repeat((np.cumsum(lengths) - lengths)[own] - (np.cumsum(size) - size), size)
    return tokens[flat[place]], alive


def joint(items: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Some chunks at a time, so that their long documents share the steps; an item ends with its tokens."""
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item[-1])
        if size >= JOINT_TOKENS:
            yield held
            held, size = [], 0
    if held:
        yield held


def train(data: DataFrame, classes: Classes, prior: np.ndarray, *, states: int, rounds: int, strength: float = 2000.0, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[float]]:
    """start, move and emit (state by class) after some rounds of Baum-Welch; the log likelihood before each.

    ``prior`` is the share of every class among the training tokens; each state's
    emissions start from it with noise and are smoothed towards it.
    """
    rng = np.random.default_rng(seed)
    k, c = states, classes.size
    start = np.full(k, 1 / k)
    move = np.full((k, k), 0.5 / k) + np.eye(k) * 0.5
    emit = prior * rng.gamma(2.0, size=(k, c))
    emit /= emit.sum(1, keepdims=True)
    likelihoods = []
    wanted = data.select("held", "lengths", "tokens", "vocab")
    schema = "cls long, " + ", ".join(f"s{j} double" for j in range(k))
    for _ in range(rounds):
        out = np.ascontiguousarray(emit.T, np.float32)  # a copy goes with each job: classes times states numbers

        @lean
        def expect(batches: Iterator[pa.RecordBatch], start=start.astype(np.float32), move=move.astype(np.float32), out=out) -> Iterator[pa.RecordBatch]:
            total = np.zeros((c + k + 2, k))

            def read() -> Iterator[tuple]:
                for batch in batches:
                    for held, lengths, raw, vocab in zip(*(batch.column(i) for i in range(4)), strict=True):
                        learn, lengths = ~np.asarray(held.as_py(), bool), np.asarray(lengths.as_py(), np.int64)
                        cls = classes.of(np.frombuffer(vocab.as_py(), np.uint64))[numbers(raw.as_py())]
                        yield lengths[learn], cls[np.repeat(learn, lengths)]

            for some in joint(read()):
                lengths, cls = np.concatenate([x for x, _ in some]), np.concatenate([x for _, x in some])
                del some
                for part in groups(lengths):
                    own, alive = chains_of(cls, lengths, part)
                    gamma, moves, logs = forward_backward(start, move, out[own], alive)
                    for j in range(k):
                        total[:c, j] += np.bincount(own, gamma[:, j], c)
                    total[c : c + k] += moves
                    total[c + k] += gamma[: alive[0]].sum(0)
                    total[c + k + 1, 0] += logs.sum()
            some = np.flatnonzero(total.any(1))
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), *(pa.array(total[some, j]) for j in range(k))], ["cls", *(f"s{j}" for j in range(k))])

        found = wanted.mapInArrow(expect, schema).groupBy("cls").agg(*(F.sum(f"s{j}").alias(f"s{j}") for j in range(k))).toPandas()
        total = np.zeros((c + k + 2, k))
        total[found["cls"].to_numpy(np.int64)] = found.drop(columns="cls").to_numpy()
        likelihoods.append(float(total[c + k + 1, 0]))
        emit = total[:c].T + strength * prior
        emit /= emit.sum(1, keepdims=True)
        move = total[c : c + k] + 0.1
        move /= move.sum(1, keepdims=True)
        start = total[c + k] + 0.1
        start /= start.sum()
    return start, move, emit, likelihoods


def score_documents(docs: DataFrame, held: Column, *, id_col: str = "doc_id", text_col: str = "text", top: int = 8192, buckets: int = 8192, states: int = 6, rounds: int = 4) -> DataFrame:
    """One row for each document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts for which ``held`` is true are scored but never learned from.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    data = cut(chunks(docs, held, id_col=id_col, text_col=text_col), blobs=True)
    counted = cut(count_words(data, top=top, buckets=buckets), blobs=True)
    whole = counted.where("chunk < 0")
    # the driver sees `top` words at most, and `buckets` sums: the least count that makes a word one of them comes first
    frequent = whole.select(F.explode("words").alias("w")).select("w.*")
    step = F.floor(F.log2("n") * 32).cast("int")
    counts, least = {r["step"]: r["k"] for r in frequent.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect()}, 1 << 20
    for one in sorted(counts, reverse=True):
        if sum(k for s, k in counts.items() if s >= one) > top:
            break
        least = one
    best = frequent.where(step >= least).collect()
    classes = Classes(np.array([r["h"] for r in best], np.int64).view(np.uint64), buckets)
    own = len(best)
    size, kinds = np.zeros(classes.size), np.zeros(classes.size)
    for r in whole.select(F.posexplode(F.arrays_zip("sizes", "kinds")).alias("slot", "x")).groupBy("slot").agg(F.sum("x.sizes").alias("n"), F.sum("x.kinds").alias("v")).collect():
        size[1 + own + r["slot"]], kinds[1 + own + r["slot"]] = r["n"], r["v"]
    ends = data.agg(F.sum("ends")).first()[0] or 0
    n, v = int(size.sum()) + ends, int(kinds.sum()) + (ends > 0)
    size[0] = ends
    for r in best:
        h = np.array([r["h"]], np.int64).view(np.uint64)
        size[classes.of(h)[1]] = r["n"]
        slot = 1 + own + int(h[0] % np.uint64(buckets))
        size[slot] -= r["n"]
        kinds[slot] -= 1
    bottom = size + SMOOTH * (kinds + 1)
    prior = bottom / bottom.sum()
    start, move, emit, _ = train(data, classes, prior, states=states, rounds=rounds)
    out = np.ascontiguousarray(emit.T)
    counts = counted.where("chunk >= 0").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("range", "counts"))).alias("c")).select("chunk", F.col("c.counts").alias("counts"))
    both = data.join(counts, "chunk", "left").select("doc_ids", "held", "lengths", "tokens", "vocab", "counts")
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    @lean
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple]:
            for batch in batches:
                for doc_ids, flags, lengths, raw, vocab, counts in zip(*(batch.column(i) for i in range(6)), strict=True):
                    lengths, tokens = lengths.values.to_numpy().astype(np.int64), numbers(raw.as_py())
                    c = np.concatenate([np.array([ends], np.int64), *(np.frombuffer(x, "<i8") for x in counts.as_py() or ())])
                    cls = classes.of(np.frombuffer(vocab.as_py(), np.uint64))
                    base = np.log10((c + SMOOTH) / (n + SMOOTH * (v + 1)))
                    within = np.where(cls <= own, 0.0, np.log10((c + SMOOTH) / bottom[cls]))
                    begins = np.cumsum(lengths) - lengths
                    known, base, within = (np.add.reduceat(x[tokens], begins) for x in ((c > 0).astype(np.int64), base, within))
                    yield doc_ids.values, flags.values, lengths, known, base, within, cls[tokens]

        for some in joint(read()):
            lengths, cls = np.concatenate([x[2] for x in some]), np.concatenate([x[6] for x in some])
            logs = np.zeros(len(lengths))
            for part in groups(lengths):
                own_, alive = chains_of(cls, lengths, part)
                logs[part] = forward(start, move, out[own_], alive)[2]
            at = 0
            for doc_ids, flags, size_, known, base, within, _ in some:
                mine = logs[at : at + len(size_)] / np.log(10) + within
                at += len(size_)
                yield pa.RecordBatch.from_arrays([doc_ids, flags, pa.array(size_), pa.array(known), pa.array(np.full(len(size_), n, np.int64)), pa.array(base), pa.array(mine)], names)

    scored = cut(both.mapInArrow(score, schema))
    forget(data, counted)
    return scored


def op10_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from nine in ten documents, by their ids; all are scored."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, crc_mod(docs["doc_id"], 10) == 0)
