"""Personal data by bootstrapped contextual extraction.

Fixed patterns find emails, addresses, cards and phone numbers; these base spans
are kept as they are. They are also seeds: the words around them are lexical
patterns. A graph joins patterns with the values seen in them, seeds and other
identifier-like strings alike, be they like one kind or just words with digits;
Spark scores it in turns: a pattern is as good as the values it holds, a value
as good as its best patterns. Strings in contexts of high-scored patterns become
further spans of that kind.

Null, empty and odd input: a null text is an empty one and has no spans; very
long texts are scanned whole, in time linear in their length whatever runs of
digits, letters or matches they hold; of patterns that tell equally of a string
the kind listed last wins; repeated rows get the same spans; copies of a text
add nothing to the evidence, as values count once for each pattern; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, forget, lean, table

KINDS = ("email", "ip", "card", "phone")
#: Fixed values of the contract. Runs are taken whole and never from their middle, which finds the
#: same spans in time linear in the text; emails are found from their @ for the same reason.
BASE = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
LOCAL = "".join(map(chr, [*range(48, 58), *range(65, 91), *range(97, 123)])) + "._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: What else may be an identifier of a kind, if its context says so.
AT = re.compile(r"@|\(at\)|\[at\]")
SPELT = re.compile(r" ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)*+")
LOOSE = {
    "ip": re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}:?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "card": re.compile(r"(?<![0-9A-Za-z+.-])[0-9]{4}(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}(?![0-9A-Za-z])"),
    "phone": re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)|0?[0-9]{2,4})[\x20./-][0-9]{2,4}(?:[\x20./-][0-9]{2,5}){1,3}(?![0-9A-Za-z])"),
}
#: A word with a digit, of any other shape: whose kind it is, only patterns can say.
TOKEN = re.compile(r"(?<!\S)[^\s0-9]{0,32}+[0-9]\S{3,63}+(?!\S)")
ANY = -1
SALTS = 16
MOST_TOLD = 100_000  # patterns of some tens of characters that go to every task


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        short = [x.lstrip("0") for x in found.split(".")]
        return all(len(x) <= 3 and int(x or "0") <= 255 for x in short)
    if kind == "card":
        digits = found.replace(" ", "").replace("-", "")
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= sum(map(found.count, "0123456789")) <= 15


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the base pattern ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, leftmost, not overlapping."""
    at, sign = 0, text.find("@")
    while sign >= 0:
        head = text[at:sign]
        start = at + len(head.rstrip(LOCAL))
        found = DOMAIN.match(text, sign + 1) if start < sign else None
        if found:
            yield start, found.end()
        at = found.end() if found else sign + 1
        sign = text.find("@", at)


def spelt_emails(text: str) -> Iterator[tuple[int, int]]:
    """Emails without a dot, with spaces, or with at and dot spelt out."""
    at = 0
    for sign in AT.finditer(text):
        if sign.start() < at:
            continue
        head = text[at : sign.start()]
        near = head[:-1] if head.endswith(" ") else head
        start = at + len(near.rstrip(LOCAL))
        found = SPELT.match(text, sign.end()) if start < at + len(near) else None
        if found:
            yield start, found.end()
        at = found.end() if found else sign.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start and kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    for k, kind in enumerate(KINDS):
        if kind == "email" or kind == "phone" and "+" not in text:
            continue
        out += [(m.start(), k, m.end()) for m in BASE[kind].finditer(text) if valid(kind, m[0])]
    return sorted(out)


class Taken:
    """Places of a text that spans cover."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts: list[int] = []
        self.stops: list[int] = []
        for s, _, e in sorted(spans):
            if self.stops and s < self.stops[-1]:
                self.stops[-1] = max(e, self.stops[-1])
            else:
                self.starts.append(s)
                self.stops.append(e)

    def touch(self, start: int, stop: int) -> bool:
        k = bisect_left(self.starts, stop)
        return k > 0 and self.stops[k - 1] > start


def loose_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Identifier-like spans that touch no base span, nor one another within a kind; those of kind ``ANY`` touch no other."""
    taken = Taken(base)
    out = [(s, 0, e) for s, e in spelt_emails(text) if not taken.touch(s, e)]
    for k, kind in enumerate(KINDS):
        if kind != "email":
            out += [(m.start(), k, m.end()) for m in LOOSE[kind].finditer(text) if not taken.touch(m.start(), m.end())]
    taken = Taken(base + out)
    for m in TOKEN.finditer(text):
        word = m[0].rstrip(".,;:!?)]}\"'")
        bare = word.lstrip("([{\"'")
        stop = m.start() + len(word)
        start = stop - len(bare)
        if len(bare) >= 5 and not taken.touch(start, stop):
            out.append((start, ANY, stop))
    return sorted(out)


def contexts(text: str, start: int, stop: int) -> list[str]:
    """The lexical patterns around a span: two words before it, and one on either side."""
    left = text[max(0, start - 80) : start].lower().split()
    right = text[stop : stop + 40].lower().split()
    l2 = " ".join(left[-2:]) if len(left) > 1 else "^ " + "".join(left)
    l1, r1 = (left[-1] if left else "^"), (right[0] if right else "$")
    return [f"{l2} _", f"{l1} _ {r1}"]


def scan(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """One row for each document: rid, the columns ``keep``, base spans, and all candidates with their contexts."""
    found = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32())]))
    cand = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("stop", pa.int32()), ("seed", pa.bool_()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))

    at_text = keep.index(text_col) if text_col in keep else len(keep)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            base, other = [], []
            for cell in batch.column(at_text):
                text = cell.as_py() or ""
                b = base_spans(text)
                base.append([{"start": s, "kind": k, "stop": e} for s, k, e in b])
                other.append([
                    {"start": s, "kind": k, "stop": e, "seed": seed, "value": text[s:e], "patterns": contexts(text, s, e)}
                    for seed, spans in ((True, b), (False, loose_spans(text, b)))
                    for s, k, e in spans
                ])
            rids = pa.array(range(rid, rid + len(base)), pa.int64())
            rid += len(base)
            yield pa.RecordBatch.from_arrays([rids, *batch.columns[: len(keep)], pa.array(base, found), pa.array(other, cand)], ["rid", *keep, "base", "candidates"])

    kept = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    schema = f"rid long, {kept}base array<struct<start:int,kind:int,stop:int>>, candidates array<struct<start:int,kind:int,stop:int,seed:boolean,value:string,patterns:array<string>>>"
    more = () if text_col in keep else (docs[text_col].alias("__text"),)
    return docs.select(*(docs[c] for c in keep), *more).mapInArrow(run, schema)


def bootstrap(candidates: DataFrame, *, rounds: int = 3, least_seeds: int = 8, confident: float = 0.9) -> DataFrame:
    """Patterns (kind, pattern) that end above ``confident`` with ``least_seeds`` scored values or more.

    ``candidates`` has kind, value, seed and patterns. Distinct edges are the
    graph; each round is two aggregations of it.
    """
    edges = cut(candidates.select("kind", "value", "seed", F.explode("patterns").alias("pattern")).groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed")))
    score = F.when(F.col("seed"), 1.0).otherwise(0.0)
    scored = edges.withColumn("score", score)
    good = None
    for _ in range(rounds):
        # all kinds of values in a pattern weigh against each one of them
        total = scored.groupBy("pattern").agg(F.count("*").alias("values"))
        mine = scored.where(F.col("kind") >= 0).groupBy("pattern", "kind").agg(F.sum(F.col("score").cast("decimal(20,12)")).cast("double").alias("mass")).where(F.col("mass") >= least_seeds)
        conf = mine.join(total, "pattern").withColumn("confidence", F.col("mass") / F.col("values"))
        fresh = cut(conf.where(F.col("confidence") >= confident).select("pattern", "kind", "confidence"))
        forget(good)
        good = fresh
        best = told(edges, good, F.xxhash64("value")).groupBy("kind", "value").agg(F.max(F.struct("confidence", "told")).alias("best"))
        scored = edges.join(best, ["kind", "value"], "left").select("pattern", F.coalesce("best.told", "kind").alias("kind"), "value", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best.confidence", F.lit(0.0))).alias("score"))
    forget(edges)
    return good


def told(rows: DataFrame, good: DataFrame, by: Column) -> DataFrame:
    """``rows`` (pattern, kind and others) with the kind that good patterns tell, and their confidence.

    A value with a shape of its own is of that kind or none. One pattern may hold
    values all over the corpus, so both sides are salted.
    """
    spread = good.select(F.col("pattern").alias("p"), F.col("kind").alias("told"), "confidence", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    return rows.withColumn("salt", F.pmod(by, F.lit(SALTS)).cast("int")).join(spread, (F.col("pattern") == F.col("p")) & (F.col("salt") == F.col("s")) & ((F.col("kind") == F.col("told")) | (F.col("kind") == ANY))).drop("p", "s", "salt")


def find_personal_data(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", **settings: float) -> DataFrame:
    """One row for each document: the columns ``keep``, base and spans (arrays of start, kind, stop; code points, end exclusive)."""
    rows = cut(scan(docs, keep=keep, text_col=text_col))
    seen = rows.select("rid", F.explode("candidates").alias("c")).select("rid", "c.*")
    good = bootstrap(seen, **settings)
    loose = seen.where("not seed").select("rid", "start", "kind", "stop", F.explode("patterns").alias("pattern"))
    one = told(loose, good, F.xxhash64("rid", "start")).groupBy("rid", "start", "stop", "kind").agg(F.max(F.struct("confidence", "told")).alias("best"))
    more = one.groupBy("rid").agg(F.collect_set(F.struct("start", F.col("best.told").alias("kind"), "stop")).alias("more"))
    none = F.array().cast(rows.schema["base"].dataType)
    return rows.join(more, "rid", "left").select(*keep, "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end by start, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_kind(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def told_spans(text: str, good: dict[tuple[str, int], float]) -> list[tuple[int, int, int]]:
    """All spans of a text, those that good patterns tell among them."""
    base = base_spans(text)
    more = set()
    for start, kind, stop in loose_spans(text, base):
        found = [(good[p, k], k) for p in contexts(text, start, stop) for k in ((kind,) if kind != ANY else range(len(KINDS))) if (p, k) in good]
        if found:
            more.add((start, max(found)[1], stop))
    return sorted(base + list(more))


def redact_texts(docs: DataFrame, *, text_col: str = "text", **settings: float) -> DataFrame:
    """``docs`` with every span of the texts replaced by its kind.

    Texts are scanned for evidence and then, by the patterns found, once more:
    that is cheaper than to shuffle or keep them. Patterns go to every task if
    they are few (``MOST_TOLD``); otherwise spans join the texts.
    """
    seen = scan(docs, keep=(), text_col=text_col).select(F.explode("candidates").alias("c")).select("c.*")
    good = bootstrap(seen, **settings)
    columns = docs.columns
    if good.count() > MOST_TOLD:
        found = find_personal_data(docs, keep=tuple(columns), text_col=text_col, **settings).select(*columns, "spans")
        known = None
    else:
        found, known = docs, {(r["pattern"], r["kind"]): r["confidence"] for r in good.collect()}
    forget(good)
    at = columns.index(text_col)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column(at)]
            if known is None:
                spans = [[(v["start"], v["kind"], v["stop"]) for v in x.as_py()] for x in batch.column(len(columns))]
            else:
                spans = (told_spans(x, known) if x else [] for x in texts)
            out = pa.array([redact(x, own) for x, own in zip(texts, spans, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], out, *batch.columns[at + 1 : len(columns)]], columns)

    return found.mapInArrow(run, docs.schema)


def redact(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with every span replaced by its kind; of overlapping spans the first one names it."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for start, kind, stop in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    counts = [count_kind(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


