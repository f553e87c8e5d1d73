"""N-gram Jaccard join with vertical partitioning.

The distinct five-word shingles of a text, as 64-bit hashes, are sorted by one
global order: common shingles last, by hash otherwise. Two sets with a Jaccard
similarity of 3/4 or more share a shingle in their prefixes, the first quarter
of that order. Prefixes are dealt out by hash range; each range counts what
pairs of texts share in it by itself, and the partial counts are summed per
pair, which rules out most of them. For all pairs that are left the order is cut
into fragments and every set into segments: the overlap of a pair is counted in
each fragment by itself, and the partial overlaps are summed, exactly.

Only classes are asked for, so a pair inside a class that is already known isn't
compared. Where more than ``GROUP`` texts share a common shingle, they don't meet
in pairs at all but hubs drawn for each shingle, in some turns; only texts that
are still in different classes then meet each other, in the cells of a grid. No
group of copies is expanded into its pairs, and none is gathered in one task:
postings of very common shingles are dealt by text, and salted where they meet.

The texts are read once, into chunks of word numbers with a vocabulary of 64-bit
word hashes; shingles are made from these when needed.

Null, empty and odd input: a null or empty text, or one without words, has an
empty set and links with nothing; a text of fewer than five words has its whole
sequence as its one shingle; very long texts are read whole; ties in the order
are settled by hash; repeated rows link as equal texts do; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, forget, lean, lean_group, table
from .components import components
from .hmm import Numbers, numbers, planes

WORDS = 5
FRAGMENTS = 4
SLOT_BITS = 28
COMMON = 16  # a slot with more shingles than this is common
MOST_COMMON = 1 << 22  # common slots that are told apart, the most frequent ones
GROUP = 256
PAIRS_AT_ONCE = 300_000
CHUNK_WORDS = 500_000
RANGE_POSTINGS = 300_000
BROADCAST_ROWS = 500_000  # 8 MB
BIN_TEXTS = 1_000  # texts whose pairs a task compares in one fragment
HOT = 1 << 14  # shingles of slots as common as this go to hubs without being gathered
SALT_TEXTS = 1 << 16  # texts of a common shingle among which a task picks a hub
SALTS = 16
BEST = 3  # earlier texts that each one is compared with in a round
CELL_TEXTS = 2_048  # texts of a common shingle that meet as pairs in a task, twice


def shingles(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a sequence of word hashes."""
    if not len(words):
        return words
    p = np.uint64(0x9E3779B97F4A7C15)
    span = min(size, len(words))
    h = words[: len(words) - span + 1].copy()
    for k in range(1, span):
        h = h * p + words[k : len(words) - span + 1 + k]
    h += np.uint64(span)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h.sort()
    return h[np.append(True, h[1:] != h[:-1])]


def read_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS) -> DataFrame:
    """Chunks of some documents each: their rows, ids, hashes, set sizes, representatives, digests of their sets, and words.

    The representative of a document is the first one of its chunk with the same
    words; only that one has words here: ``lengths`` of them in ``tokens``, which
    are places in ``vocab``.
    """
    kind = docs.schema[id_col].dataType
    arrow = {"long": pa.int64(), "integer": pa.int32(), "string": pa.string()}.get(kind.typeName(), pa.int64())
    schema = f"docs array<struct<row:long,doc_id:{kind.simpleString()},text_hash:long,n:int,rep:long,length:int,mark:binary>>, tokens binary, vocab binary"
    item = pa.struct([("row", pa.int64()), ("doc_id", arrow), ("text_hash", pa.int64()), ("n", pa.int32()), ("rep", pa.int64()), ("length", pa.int32()), ("mark", pa.binary())])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 36
        ids, first, own, tokens, total = Numbers(), {}, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal total
            vocab = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
            words, at = vocab[flat], 0
            sizes: dict[int, int] = {}
            for x in own:
                if x["length"]:
                    found = shingles(words[at : at + x["length"]], size)
                    sizes[x["row"]], x["mark"] = len(found), xxhash.xxh3_128_digest(found.tobytes())
                    at += x["length"]
                x["n"] = sizes.get(x["rep"], 0)
            out = pa.RecordBatch.from_arrays([pa.array([own], pa.list_(item)), pa.array([planes(flat)]), pa.array([vocab.tobytes()])], ["docs", "tokens", "vocab"])
            ids.clear()
            first.clear()
            own.clear()
            tokens.clear()
            total = 0
            return out

        for batch in batches:
            for doc, text, mark in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = text.as_py() or b""
                words = raw.lower().split()  # on bytes: ASCII letters and white space alone
                rep = first.setdefault(xxhash.xxh3_128_digest(b" ".join(words)), row) if words else row
                fresh = len(words) if rep == row else 0
                if fresh:
                    tokens.append(np.fromiter(map(ids.__getitem__, words), np.int32, fresh))
                own.append({"row": row, "doc_id": doc, "text_hash": mark, "rep": rep, "length": fresh, "mark": None})
                row += 1
                total += fresh + 1
                if total >= CHUNK_WORDS:
                    yield close()
        if own:
            yield close()

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("binary").alias("text"), F.xxhash64(docs[text_col]).alias("text_hash")).mapInArrow(run, schema)


def sets_of(batches: Iterator[pa.RecordBatch], size: int = WORDS, pick=None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, set sizes, sorted sets end to end) of some texts at a time, those that ``pick`` chooses by row.

    The batches have rows, lengths, tokens and vocab of chunks.
    """
    for batch in batches:
        for rows, lengths, raw, vocab in zip(*(batch.column(i) for i in range(4)), strict=True):
            rows, lengths = rows.values.to_numpy(), lengths.values.to_numpy().astype(np.int64)
            some = lengths > 0
            if pick is not None:
                some &= pick(rows)
            if not some.any():
                continue
            words = np.frombuffer(vocab.as_py(), np.uint64)[numbers(raw.as_py())]
            begins = np.cumsum(lengths) - lengths
            which = np.flatnonzero(some)
            for at in range(0, len(which), 1000):
                own = which[at : at + 1000]
                sets = [shingles(words[begins[i] : begins[i] + lengths[i]], size) for i in own.tolist()]
                yield rows[own], np.fromiter(map(len, sets), np.int64, len(sets)), np.concatenate(sets)


def texts_of(chunks: DataFrame) -> DataFrame:
    return chunks.select(F.col("docs.row").alias("rows"), F.col("docs.length").alias("lengths"), "tokens", "vocab")


def common_slots(chunks: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots (first ``SLOT_BITS`` bits of a hash) of common shingles, sorted, and how common they are (1 to 63).

    Every partition sends its slots, sorted, as steps of a byte each; ranges of
    slots are summed by a task each. At most ``MOST_COMMON`` slots come back: the
    least common ranks, if they hold too many, count as not common.
    """
    ranges = 1 << max(8, int(total // (8 * RANGE_POSTINGS)).bit_length())
    wide = (1 << SLOT_BITS) // ranges

    @lean
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            slots = np.sort(np.concatenate(held))
            edges = np.searchsorted(slots, np.arange(0, (1 << SLOT_BITS) + 1, wide))
            out = [[], [], []]
            for r in range(ranges):
                own = slots[edges[r] : edges[r + 1]].astype(np.int64)
                if len(own):
                    steps = np.diff(own, prepend=r * wide)
                    out[0].append(r)
                    out[1].append(np.minimum(steps, 255).astype(np.uint8).tobytes())
                    out[2].append(steps[steps >= 255].astype("<u4").tobytes())
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1]), pa.array(out[2])], ["range", "steps", "far"])

        for _, _, h in sets_of(batches):
            held.append((h >> np.uint64(64 - SLOT_BITS)).astype(np.uint32))
            size += len(h)
            if size >= 1_500_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    @lean_group
    def add(key: tuple, group: pa.Table) -> pa.Table:
        counts = np.zeros(wide, np.int64)
        for raw, far in zip(group["steps"], group["far"], strict=True):
            steps = np.frombuffer(raw.as_py(), np.uint8).astype(np.int64)
            steps[steps == 255] = np.frombuffer(far.as_py(), "<u4")
            counts += np.bincount(np.cumsum(steps), minlength=wide)
        some = np.flatnonzero(counts > COMMON)
        rank = np.minimum(63, 1 + np.floor(2 * np.log2(counts[some] / COMMON))).astype(np.uint8)
        return pa.table({"range": pa.array([key[0].as_py()], pa.int32()), "slots": pa.array([(some + key[0].as_py() * wide).astype("<u4").tobytes()]), "ranks": pa.array([rank.tobytes()]), "kinds": pa.array([np.bincount(rank, minlength=64).tolist()], pa.list_(pa.int64()))})

    found = cut(texts_of(chunks).mapInArrow(send, "range int, steps binary, far binary").groupBy("range").applyInArrow(add, "range int, slots binary, ranks binary, kinds array<long>"))
    # 64 numbers say which ranks are few enough to be told apart everywhere
    kinds = {r["rank"]: r["n"] for r in found.select(F.posexplode("kinds").alias("rank", "n")).groupBy("rank").agg(F.sum("n").alias("n")).collect()}
    least, told = 64, 0
    while least > 1 and told + kinds.get(least - 1, 0) <= MOST_COMMON:
        least -= 1
        told += kinds.get(least, 0)

    @lean
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, slots, ranks in zip(*(batch.column(i) for i in range(3)), strict=True):
                rank = np.frombuffer(ranks.as_py(), np.uint8)
                own = rank >= least
                if own.any():
                    yield pa.RecordBatch.from_arrays([pa.array([r.as_py()], pa.int32()), pa.array([np.frombuffer(slots.as_py(), "<u4")[own].tobytes()]), pa.array([rank[own].tobytes()])], ["range", "slots", "ranks"])

    # five bytes a slot
    best = sorted(found.select("range", "slots", "ranks").mapInArrow(choose, "range int, slots binary, ranks binary").collect(), key=lambda r: r["range"])
    forget(found)
    return np.frombuffer(b"".join(bytes(r["slots"]) for r in best), "<u4"), np.frombuffer(b"".join(bytes(r["ranks"]) for r in best), np.uint8)


def prefix_size(n: np.ndarray) -> np.ndarray:
    return n - (3 * n + 3) // 4 + 1


def squeeze(x: np.ndarray) -> bytes:
    """64-bit numbers, bytes of the same rank together: what is shuffled is compressed by Spark."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def expand(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def mixed(x: np.ndarray, parts: int) -> np.ndarray:
    return (((x * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def pieces(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, places of its elements) of all parts that have any."""
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        if edges[p] < edges[p + 1]:
            yield p, order[edges[p] : edges[p + 1]]


def prefixes(chunks: DataFrame, slots: np.ndarray, ranks: np.ndarray, parts: int) -> DataFrame:
    """The prefixes of all sets, dealt to ``parts`` by shingle: hashes, rows, set sizes, and how many of a prefix are common."""
    very_common = 1 + math.floor(2 * math.log2(HOT / COMMON))

    @lean
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            h, row, n, common, very = (np.concatenate(x) for x in zip(*held, strict=True))
            out = [[], [], [], [], []]
            # a shingle that very many texts have isn't gathered: its postings are dealt by text
            part = np.where(very, parts + mixed(row.astype(np.uint64), parts), mixed(h, parts))
            for p, own in pieces(part, 2 * parts):
                own = own[np.argsort(h[own])]
                for col, x in zip(out, (p, squeeze(h[own]), squeeze(row[own]), planes(n[own]), planes(common[own])), strict=True):
                    col.append(x)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *map(pa.array, out[1:])], ["part", "h", "row", "n", "common"])

        for rows, n, h in sets_of(batches):
            rank = np.zeros(len(h), np.int64)
            if len(slots):
                s = (h >> np.uint64(64 - SLOT_BITS)).astype(np.uint32)
                k = np.minimum(np.searchsorted(slots, s), len(slots) - 1)
                rank = np.where(slots[k] == s, ranks[k], 0).astype(np.int64)
            order = np.argsort((np.repeat(np.arange(len(n)) << 6, n)) + rank, kind="stable")
            place = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
            front = place < np.repeat(prefix_size(n), n)
            hot = (rank[order] > 0) & front
            common = np.add.reduceat(hot.astype(np.int64), np.cumsum(n) - n)
            # the top bit of a size tells if the shingle itself is common
            marked = (np.repeat(n, n) | (hot.astype(np.int64) << 31))[front].astype(np.uint32)
            held.append((h[order][front], np.repeat(rows, n)[front], marked, np.repeat(common, n)[front], (rank[order] >= very_common)[front]))
            size += int(front.sum())
            if size >= 800_000:
                yield flush()
                held.clear()
                size = 0
        if held:
            yield flush()

    return texts_of(chunks).mapInArrow(post, "part int, h binary, row binary, n binary, common binary")


class Tally:
    """Distinct pair numbers with how often they came, held in bounded pieces."""

    def __init__(self):
        self.pairs, self.times, self.held, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, pairs: np.ndarray) -> None:
        self.held.append(pairs)
        self.size += len(pairs)
        if self.size > PAIRS_AT_ONCE:
            self.fold()

    def fold(self) -> None:
        new, c = np.unique(np.concatenate(self.held), return_counts=True)
        self.held, self.size = [], 0
        self.pairs, back = np.unique(np.append(self.pairs, new), return_inverse=True)
        self.times = np.bincount(back, np.append(self.times, c), len(self.pairs)).astype(np.int64)

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if self.held:
            self.fold()
        return self.pairs, self.times


def pair_pieces(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, c: np.ndarray, slack: np.ndarray, parts: int) -> list[list]:
    """Columns part, a, b, na, nb, c, slack of counted pairs, dealt to ``parts`` by pair."""
    cols: list[list] = [[], [], [], [], [], [], []]
    for p, own in pieces(mixed(a.astype(np.uint64) * np.uint64(31) + b.astype(np.uint64), parts), parts):
        for col, v in zip(cols, (p, squeeze(a[own]), squeeze(b[own]), planes(na[own]), planes(nb[own]), planes(c[own]), planes(slack[own])), strict=True):
            col.append(v)
    return cols


def meet(posted: DataFrame, parts: int) -> DataFrame:
    """What is shared in each range: rows of ``kind`` 0 have pairs of texts with the number of shingles
    they share there, dealt to ``parts`` by pair; rows of kind 1 have common shingles that more than ``GROUP`` texts share.
    """

    @lean_group
    def join(key: tuple, group: pa.Table) -> pa.Table:
        names = ["kind", "part", "a", "b", "na", "nb", "c", "slack"]
        if key[0].as_py() >= parts:  # postings of very common shingles
            k, none = group.num_rows, pa.nulls(group.num_rows, pa.binary())
            return pa.table([pa.array([1] * k, pa.int32()), pa.array([0] * k, pa.int32()), group["h"], group["row"], group["n"], none, none, none], names=names)
        h, row = (np.concatenate([expand(x.as_py()) for x in group[c]]) for c in ("h", "row"))
        n, common = (np.concatenate([numbers(x.as_py()) for x in group[c]]) for c in ("n", "common"))
        order = np.argsort(h, kind="stable")
        h, row, n, common = h[order], row[order].astype(np.int64), n[order], common[order].astype(np.int64)
        hot, n = n >> np.uint32(31) > 0, (n & np.uint32(0x7FFFFFFF)).astype(np.int64)
        texts, first, place = np.unique(row, return_index=True, return_inverse=True)
        begins = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = np.diff(np.append(begins, len(h)))
        large = (sizes > GROUP) & hot[begins]
        tally = Tally()
        for s in np.unique(sizes[~large & (sizes > 1)]).tolist():
            at = begins[~large & (sizes == s)]
            i, j = np.triu_indices(s, 1)
            step = max(1, PAIRS_AT_ONCE // len(i))
            for k in range(0, len(at), step):
                some = place[at[k : k + step, None] + np.arange(s)]
                x, y = some[:, i].ravel(), some[:, j].ravel()
                size = n[first[x]], n[first[y]]
                fits = 4 * np.minimum(*size) >= 3 * np.maximum(*size)
                tally.add(np.minimum(x, y)[fits] * len(texts) + np.maximum(x, y)[fits])
        pairs, times = tally.whole()
        x, y = first[pairs // len(texts)], first[pairs % len(texts)]
        cols = pair_pieces(row[x], row[y], n[x], n[y], times, np.minimum(common[x], common[y]), parts)
        kinds = [0] * len(cols[0])
        many = np.repeat(large, sizes)
        if many.any():
            kinds.append(1)
            for col, v in zip(cols, (0, squeeze(h[many]), squeeze(row[many]), planes(n[many]), None, None, None), strict=True):
                col.append(v)
        return pa.table([pa.array(kinds, pa.int32()), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=names)

    return posted.groupBy("part").applyInArrow(join, "kind int, part int, a binary, b binary, na binary, nb binary, c binary, slack binary")


def summed(met: DataFrame) -> DataFrame:
    """Pairs (a, b) with the shingles c that their prefixes share, where these can suffice for a link."""

    @lean_group
    def add(group: pa.Table) -> pa.Table:
        a, b = (np.concatenate([expand(x.as_py()) for x in group[c]]).astype(np.int64) for c in ("a", "b"))
        na, nb, c, slack = (np.concatenate([numbers(x.as_py()) for x in group[k]]).astype(np.int64) for k in ("na", "nb", "c", "slack"))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        heads = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        c = np.add.reduceat(c[order], heads)
        a, b, na, nb, slack = a[heads], b[heads], na[order][heads], nb[order][heads], slack[order][heads]
        # outside the prefix that ends first, a set has this many left
        rest = np.maximum((3 * na + 3) // 4, (3 * nb + 3) // 4) - 1
        fits = 7 * (c + slack + rest) >= 3 * (na + nb)
        return pa.table({"a": a[fits], "b": b[fits], "c": c[fits]})

    return met.where("kind = 0").select("part", "a", "b", "na", "nb", "c", "slack").groupBy("part").applyInArrow(add, "a long, b long, c long")


def large_groups(met: DataFrame, parts: int) -> DataFrame:
    """(row, n, hashes): for each text its prefix shingles that many texts share."""

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, row, n in zip(*(batch.column(i) for i in range(3)), strict=True):
                h, row, n = expand(h.as_py()), expand(row.as_py()), numbers(n.as_py())
                for p, own in pieces(mixed(row, parts), parts):
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([squeeze(h[own])]), pa.array([squeeze(row[own])]), pa.array([planes(n[own])])], ["part", "h", "row", "n"])

    @lean_group
    def gather(group: pa.Table) -> pa.Table:
        h, row = (np.concatenate([expand(x.as_py()) for x in group[c]]) for c in ("h", "row"))
        n = np.concatenate([numbers(x.as_py()) for x in group["n"]]) & np.uint32(0x7FFFFFFF)
        order = np.lexsort((h, row))
        h, row, n = h[order], row[order].astype(np.int64), n[order]
        heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        return pa.table({"row": pa.array(row[heads]), "n": pa.array(n[heads], pa.int32()), "hashes": pa.array([x.tobytes() for x in np.split(h, heads[1:])], pa.binary())})

    dealt = met.where("kind = 1").select("a", "b", "na").mapInArrow(deal, "part int, h binary, row binary, n binary")
    return dealt.groupBy("part").applyInArrow(gather, "row long, n int, hashes binary")


def postings(posts: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, row, n, label) of the shingles of :func:`large_groups`."""

    @lean
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(x.as_py(), np.int64) for x in batch.column(2)]
            if sets:
                k = np.fromiter(map(len, sets), np.int64, len(sets))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), *(pa.array(np.repeat(batch.column(c).to_numpy(), k)) for c in (0, 1, 3))], ["h", "row", "n", "label"])

    return labelled(posts, labels, "row", "label").select("row", "n", "hashes", "label").mapInArrow(spread, "h long, row long, n int, label long")


def columns(group: pa.Table, *names: str) -> list[np.ndarray]:
    return [group[c].to_numpy().astype(np.int64) for c in names]


def runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal keys."""
    if not len(keys[0]):
        return []
    fresh = np.zeros(len(keys[0]), bool)
    fresh[0] = True
    for x in keys:
        fresh[1:] |= x[1:] != x[:-1]
    heads = np.append(np.flatnonzero(fresh), len(fresh))
    return list(zip(heads[:-1].tolist(), heads[1:].tolist(), strict=True))


def segments(chunks: DataFrame, wanted: DataFrame, *, fragments: int = FRAGMENTS, most_bits: int = 26) -> DataFrame:
    """(row, n, fragment, segment) of the sets whose rows are in ``wanted``, and of few others.

    A fragment is a range of the order of hashes; a segment is the part of a set
    in it. A bounded bit table picks the texts before anything is joined; where it
    is full, it merely lets more of them through.
    """
    slots = 1 << min(most_bits, max(16, (16 * wanted.count()).bit_length()))
    block = 1 << 16

    def slot(rows: np.ndarray) -> np.ndarray:
        return ((rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & (slots - 1)

    @lean
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(slots, bool)
        for batch in batches:
            own[slot(batch.column(0).to_numpy())] = True
        for k in range(0, slots, block):
            if own[k : k + block].any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([np.packbits(own[k : k + block]).tobytes()])], ["block", "bits"])

    @lean_group
    def either(group: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in group["bits"]])
        return pa.table({"block": group["block"][:1], "bits": pa.array([whole.tobytes()])})

    bits = np.zeros(slots // 8, np.uint8)
    for r in wanted.select("row").mapInArrow(mark, "block long, bits binary").groupBy("block").applyInArrow(either, "block long, bits binary").collect():
        bits[r["block"] // 8 : (r["block"] + block) // 8] = np.frombuffer(r["bits"], np.uint8)

    @lean
    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pick(rows: np.ndarray) -> np.ndarray:
            s = slot(rows)
            return (bits[s >> 3] >> (7 - (s & 7)).astype(np.uint8)) & 1 > 0

        edges = np.array([k * ((1 << 64) // fragments) for k in range(1, fragments)], np.uint64)
        for rows, n, h in sets_of(batches, pick=pick):
            out = [x.tobytes() for own in np.split(h, np.cumsum(n)[:-1]) for x in np.split(own, np.searchsorted(own, edges))]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(rows, fragments)), pa.array(np.repeat(n, fragments), pa.int32()), pa.array(np.tile(np.arange(fragments), len(rows)), pa.int32()), pa.array(out, pa.binary())], ["row", "n", "fragment", "segment"])

    return texts_of(chunks).mapInArrow(cut_up, "row long, n int, fragment int, segment binary")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct()


def linked(pairs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Those of the pairs (a, b), a cut table, that link, by vertical partitioning.

    Every set is cut into segments, one for each fragment of the order; a task
    counts what the pairs of a bin share in one fragment, and these partial
    overlaps are summed for each pair. Texts that pairs connect share a bin, so
    that each goes there once; where they are too many, their pairs are dealt to
    several bins by the end that is in fewer pairs, so that a text in very many
    pairs comes once to each of these, and no bin has them all.
    """
    near = components(pairs.select("a", "b"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("row")).groupBy("row").agg(F.count("*").alias("k"))
    degree = cut(labelled(ends, near.select(F.col("node").alias("row"), F.col("component").alias("label")), "row", "block"))
    forget(near)
    bins = max(1, -(-degree.count() // BIN_TEXTS))
    splits = degree.groupBy(F.col("block").alias("_of")).agg(F.ceil(F.count("*") / BIN_TEXTS).alias("splits"))
    da, db = (degree.select(F.col("row").alias(c), F.col("k").alias(f"k{c}"), *(["block"] if c == "a" else [])) for c in ("a", "b"))
    known = pairs.select("a", "b").join(da, "a").join(db, "b").join(splits, F.col("block") == F.col("_of"))
    fewer = F.col("ka") <= F.col("kb")
    known = known.select("block", "splits", F.when(fewer, F.col("a")).otherwise(F.col("b")).alias("own"), F.when(fewer, F.col("b")).otherwise(F.col("a")).alias("hub"))
    placed = cut(known.select("own", "hub", F.pmod(F.xxhash64("block", F.pmod(F.xxhash64("own"), F.col("splits"))), F.lit(bins)).alias("bin")))
    need = cut(placed.select(F.col("bin").alias("to"), F.explode(F.array("own", "hub")).alias("row")).distinct())
    few = F.broadcast(need) if need.count() <= BROADCAST_ROWS else need
    sets = segments(chunks, degree).join(few, "row").select("to", "fragment", "row", "n", "segment")
    todo = placed.select("bin", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("part"), "own", "hub")

    @lean_group
    def overlap(left: pa.Table, right: pa.Table) -> pa.Table:
        own, hub = columns(left, "own", "hub")
        row, n = columns(right, "row", "n")
        order = np.argsort(row)
        sets = right["segment"].combine_chunks()
        edges = sets.buffers()[1]
        edges = np.frombuffer(edges, np.int32)[sets.offset : sets.offset + len(sets) + 1] // 8
        flat = np.frombuffer(sets.buffers()[2] or b"", np.uint64)
        # places of the hashes among the distinct ones, set after set
        place, first = np.unique(flat[edges[0] : edges[-1]], return_inverse=True)[1], edges - edges[0]
        x, y = (order[np.searchsorted(row[order], v)] for v in (own, hub))
        by = np.argsort(y, kind="stable")
        x, y, c = x[by], y[by], np.zeros(len(by), np.int64)
        marked = np.zeros(int(place.max(initial=-1)) + 1, bool)
        for s, e in runs(y):
            mine = place[first[y[s]] : first[y[s] + 1]]
            marked[mine] = True
            size = first[x[s:e] + 1] - first[x[s:e]]
            begin = np.cumsum(size) - size
            hit = marked[place[np.arange(size.sum()) + np.repeat(first[x[s:e]] - begin, size)]]
            total = np.append(0, np.cumsum(hit))
            c[s:e] = total[begin + size] - total[begin]
            marked[mine] = False
        some = c > 0
        return pa.table([pa.array(v) for v in (row[x[some]], row[y[some]], n[x[some]], n[y[some]], c[some])], names=["a", "b", "na", "nb", "c"])

    counted = todo.groupBy("bin", "part").cogroup(sets.groupBy("to", "fragment")).applyInArrow(overlap, "a long, b long, na long, nb long, c long")
    whole = counted.groupBy("a", "b", "na", "nb").agg(F.sum("c").alias("c"))
    out = cut(whole.where("100 * c >= 75 * (na + nb - c)").select("a", "b"))
    forget(degree, placed, need)
    return out


def labelled(rows: DataFrame, labels: DataFrame, col: str, name: str) -> DataFrame:
    """With the class of the row in ``col``; a row that isn't in ``labels`` is a class by itself."""
    own = labels.select(F.col("row").alias("_row"), F.col("label").alias("_label"))
    return rows.join(own, F.col(col) == F.col("_row"), "left").withColumn(name, F.coalesce("_label", col)).drop("_row", "_label")


def hub_pairs(posts: DataFrame, labels: DataFrame, parts: int, salts: int, turn: int) -> DataFrame:
    """Pairs (a, b, c) of texts and hubs of other classes that share c shingles of which these are hubs.

    In turn 0 a text is as good a hub for every shingle, later each shingle draws
    anew. The texts of a shingle are dealt to ``salts`` tasks, each of which picks
    a hub; these hubs meet the hub of all.
    """

    def pick(group: pa.Table, key: str, send: bool) -> pa.Table:
        h, row, n, label = columns(group, "h", "row", "n", "label")
        order = np.lexsort((row, group[key].to_numpy(), h))
        h, row, n, label, salt = h[order], row[order], n[order], label[order], group[key].to_numpy()[order]
        out, heads = [], []
        for s, e in runs(h, salt):
            draw = np.uint64((int(h[s]) ^ turn * 0x9E3779B97F4A7C15) & (1 << 64) - 1) if turn else np.uint64(0)
            k = s + int((((row[s:e].astype(np.uint64) ^ draw) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(20)).argmin())
            heads.append(k)
            some = s + np.flatnonzero((label[s:e] != label[k]) & (4 * np.minimum(n[s:e], n[k]) >= 3 * np.maximum(n[s:e], n[k])))
            out.append(np.stack([row[some], np.full(len(some), row[k])]))
        pairs, c = np.unique(np.concatenate(out, axis=1), axis=1, return_counts=True) if out else (np.zeros((2, 0), np.int64), np.zeros(0, np.int64))
        k = np.array(heads if send else [], np.int64)
        none = np.zeros(len(c), np.int64)
        cols = [np.append(none, h[k]), np.append(pairs[0], row[k]), np.append(pairs[1], n[k]), np.append(c, label[k])]
        return pa.table([pa.array([0] * len(c) + [1] * len(k), pa.int32()), *map(pa.array, cols)], names=["kind", "h", "a", "b", "c"])

    schema = "kind int, h long, a long, b long, c long"
    dealt = postings(posts, labels).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts))).withColumn("part", F.pmod(F.xxhash64("h", "salt"), F.lit(parts)))
    found = dealt.groupBy("part").applyInArrow(lambda g: pick(g, "salt", salts > 1), schema)
    if salts > 1:
        found = cut(found)
        heads = found.where("kind = 1").select("h", F.col("a").alias("row"), F.col("b").alias("n"), F.col("c").alias("label"), F.pmod(F.xxhash64("h"), F.lit(parts)).alias("part"))
        found = found.unionByName(heads.withColumn("all", F.lit(0)).groupBy("part").applyInArrow(lambda g: pick(g, "all", False), schema))
    return found.where("kind = 0").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("c").alias("c"))


def open_pairs(posts: DataFrame, labels: DataFrame, parts: int) -> DataFrame:
    """Pairs (a, b, c) across classes that share enough of these shingles to link.

    A pair that shares other prefix shingles too has been decided before. The
    texts of a shingle with several classes are dealt to a grid of cells, two of
    whose sides meet in each, so that none gathers them all.
    """
    all_ = cut(postings(posts, labels))
    opened = all_.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("k")).where("low <> high")
    opened = opened.select(F.col("h").alias("oh"), F.ceil(F.col("k") / CELL_TEXTS).alias("sides"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    mine = all_.withColumn("s2", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(opened, (F.col("h") == F.col("oh")) & (F.col("s2") == F.col("s")))
    mine = mine.withColumn("side", F.pmod(F.xxhash64("row", F.lit(1)), F.col("sides"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
    mine = mine.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other")).withColumn("part", F.pmod(F.xxhash64("h", "i", "j"), F.lit(parts)))

    @lean_group
    def across(group: pa.Table) -> pa.Table:
        h, row, n, label, side, i, j = columns(group, "h", "row", "n", "label", "side", "i", "j")
        order = np.lexsort((row, j, i, h))
        h, row, n, label, side, i, j = (x[order] for x in (h, row, n, label, side, i, j))
        texts, first, place = np.unique(row, return_index=True, return_inverse=True)
        tally = Tally()
        for s, e in runs(h, i, j):
            for k in range(s, e - 1):
                rest = slice(k + 1, e)
                some = (label[rest] != label[k]) & (4 * np.minimum(n[rest], n[k]) >= 3 * np.maximum(n[rest], n[k]))
                if i[k] != j[k]:  # texts of one side meet in a cell of their own
                    some &= side[rest] != side[k]
                if some.any():
                    tally.add(place[k] * len(texts) + place[rest][some])
        pairs, times = tally.whole()
        x, y = pairs // max(1, len(texts)), pairs % max(1, len(texts))
        cols = pair_pieces(texts[x], texts[y], n[first[x]], n[first[y]], times, np.zeros(len(x), np.int64), parts)
        return pa.table([pa.array([0] * len(cols[0]), pa.int32()), pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["kind", "part", "a", "b", "na", "nb", "c", "slack"])

    met = mine.select("part", "h", "row", "n", "label", "side", "i", "j").groupBy("part").applyInArrow(across, "kind int, part int, a binary, b binary, na binary, nb binary, c binary, slack binary")
    return summed(met)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hub_turns: int = 2, rounds: int = 2) -> DataFrame:
    """One row for each document: row, doc_id, text_hash, n_shingles, component_id, label.

    ``component_id`` is the least id that links reach, ``text_hash`` is xxhash64 of the text.
    ``label`` is a row number and tells classes apart, as ids may be null or repeated.
    """
    chunks = cut(read_texts(docs, id_col=id_col, text_col=text_col), blobs=True)
    head = chunks.select(F.explode("docs").alias("d")).select("d.*").drop("length")
    total = head.where("rep = row").agg(F.sum("n")).first()[0] or 0
    slots, ranks = common_slots(chunks, total)
    parts = max(12, total // 4 // RANGE_POSTINGS)
    met = cut(meet(prefixes(chunks, slots, ranks, parts), parts), blobs=True)
    close, large = cut(summed(met)), cut(large_groups(met, parts))
    forget(met)
    # equal sets are one class before anything is compared; the first row stands for it
    own = head.where("rep = row and n > 0").select("row", "mark")
    same = own.groupBy("mark").agg(F.min("row").alias("label"), F.count("*").alias("k")).where("k > 1")
    labels = cut(own.join(same, "mark").where("row <> label").select("row", "label"))
    alone = labelled(labelled(close, labels, "a", "la"), labels, "b", "lb").where("la <> lb")
    alone = cut(alone.groupBy(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).agg(F.max("c").alias("c")))
    posts = cut(large.join(labels.select("row"), "row", "left_anti"))
    forget(large)

    def apart(pairs: DataFrame) -> DataFrame:
        return labelled(labelled(pairs, labels, "a", "la"), labels, "b", "lb").where("la <> lb").select("a", "b", "c")

    def join_classes(todo: DataFrame) -> None:
        """Compare pairs, a cut table, and join the classes of those that link."""
        nonlocal labels
        if not todo.isEmpty():
            found = linked(todo, chunks)
            links = labelled(labelled(found, labels, "a", "la"), labels, "b", "lb")
            classes = components(links.select(F.col("la").alias("a"), F.col("lb").alias("b")))
            moved = labelled(labels, classes.select(F.col("node").alias("row"), F.col("component").alias("label")), "label", "now").select("row", F.col("now").alias("label"))
            fresh = classes.join(labels, F.col("node") == F.col("row"), "left_anti").select(F.col("node").alias("row"), F.col("component").alias("label"))
            state = cut(moved.unionByName(fresh))
            forget(labels, classes, found)
            labels = state
        forget(todo)

    def settle(pairs: DataFrame) -> None:
        """Compare all pairs (a, b, c) that don't come to be inside a class: in some rounds each text with the few
        earlier ones that it shares most with, of those in other classes; then all that are left."""
        pairs = cut(pairs)
        left = cut(apart(pairs))
        forget(pairs)
        for _ in range(rounds):
            if left.isEmpty():
                break
            nth = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("c"), "a"))
            best = cut(left.withColumn("nth", nth).where(F.col("nth") <= BEST).select("a", "b"))
            rest = cut(left.join(best, ["a", "b"], "left_anti"))
            forget(left)
            join_classes(best)
            left = cut(apart(rest))
            forget(rest)
        join_classes(left)

    # texts that share rare shingles and those that share common ones with hubs, then what is still apart
    texts = posts.count()
    salts = max(1, -(-texts // SALT_TEXTS))
    if not texts:
        settle(alone)
    for turn in range(hub_turns if texts else 0):
        found = hub_pairs(posts, labels, parts, salts, turn)
        settle(found if turn else found.unionByName(alone).groupBy("a", "b").agg(F.max("c").alias("c")))
    if texts:
        settle(open_pairs(posts, labels, parts))
    forget(close, posts, alone)
    named = labelled(head, labels, "rep", "label")
    # a table of its own: Spark can then split the join where one class holds very many texts
    least = cut(named.groupBy("label").agg(F.min("doc_id").alias("component_id")))
    return named.join(least, "label").select("row", "doc_id", "text_hash", F.col("n").cast("long").alias("n_shingles"), "component_id", "label")


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
