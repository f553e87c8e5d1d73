"""Language ID by a linear-chain conditional random field.

Every word of a text is a position of the chain, its label a language. Features
of a word are its character n-grams (those that touch the word's ends are its
affixes) and the word itself (the lexicon); they are hashed into one weight
table. Transitions between labels are learned with them, on sequences spliced
from texts in several languages, by gradient steps on the exact likelihood. A
whole text is labelled by forward-backward, so code-switched texts get shares of
languages; the one with the largest share is the text's.

The model is fitted on the driver on a bounded sample of labelled rows: about
``sample_docs`` documents of each language, with their whole texts. Prediction
reads whole texts.

Null, empty and odd input: a text that is null or has no letter is ``und`` with
score 0, however long it is; unlabelled rows teach nothing; without any labelled
row all is ``und``; equal shares go to the language that sorts first; repeated
rows get the same answer; very long texts are one chain, read whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, MapType, StringType

from .chains import forward_backward, time_major
from .common import crc_mod, lean, table

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
BITS = 17
LONGEST = 4
GROUP_WORDS = 200_000
SOME_WORDS = 8_192
GROUP_CHARS = 3_000_000  # of texts that are labelled at once


def word_features(vocab: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of every word: all ids in a row, and where each word's begin."""
    marked = "".join(f"^{w}$" for w in vocab)
    codes = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, vocab), np.int64, len(vocab)) + 2
    ends = np.cumsum(sizes)
    begins = ends - sizes
    word = np.repeat(np.arange(len(vocab)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(codes))  # characters from here to the word's end
    p, mix = np.uint64(1_000_003), np.uint64(0x9E3779B97F4A7C15)
    own, ids = [], []
    rolled = np.zeros(len(codes), np.uint64)
    for n in range(1, LONGEST + 1):
        rolled[: len(codes) - n + 1] = rolled[: len(codes) - n + 1] * p + codes[n - 1 :]
        fits = left >= n
        ids.append(((rolled[fits] + np.uint64(n)) * mix) >> np.uint64(64 - BITS))
        own.append(word[fits])
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(begins, sizes).astype(np.uint64)
    whole = np.add.reduceat(codes * (place * mix + p), begins) if len(vocab) else np.zeros(0, np.uint64)
    ids.append((whole * mix) >> np.uint64(64 - BITS))
    own.append(np.arange(len(vocab)))
    ids_, own_ = np.concatenate(ids).astype(np.int64), np.concatenate(own)
    order = np.argsort(own_, kind="stable")
    return ids_[order], np.searchsorted(own_[order], np.arange(len(vocab)))


@dataclass
class Model:
    """Weights of hashed features, of transitions and of first labels."""

    labels: list[str]
    weights: np.ndarray
    move: np.ndarray
    start: np.ndarray

    def emissions(self, vocab: list[str]) -> np.ndarray:
        out = np.zeros((len(vocab), len(self.labels)), np.float32)
        for at in range(0, len(vocab), SOME_WORDS):  # a word has some forty features
            ids, begins = word_features(vocab[at : at + SOME_WORDS])
            score = np.add.reduceat(self.weights[ids], begins, axis=0)
            score -= score.max(1, keepdims=True)
            out[at : at + SOME_WORDS] = np.exp(np.maximum(score, -30.0))
        return out


def fit(samples: Iterable[tuple[str, str]], *, length: int = 32, sequences: int = 4000, epochs: int = 4, batch: int = 64, rate: float = 0.15, seed: int = 17) -> Model:
    """A model of (language, text) samples, by Adagrad on the likelihood of spliced sequences."""
    texts = [(lang, LETTERS.findall(text.lower())) for lang, text in sorted(samples)]
    texts = [(lang, ws) for lang, ws in texts if ws]
    labels = sorted({lang for lang, _ in texts})
    k, rng = len(labels), np.random.default_rng(seed)
    model = Model(labels, np.zeros((1 << BITS, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32))
    if k < 2:
        return model
    vocab: dict[str, int] = {}
    by = {lang: [np.array([vocab.setdefault(w, len(vocab)) for w in ws]) for one, ws in texts if one == lang] for lang in labels}
    ids, begins = word_features(list(vocab))
    counts = np.diff(np.append(begins, len(ids)))
    words, truth = np.zeros((sequences, length), np.int64), np.zeros((sequences, length), np.int64)
    for s in range(sequences):  # one to three passages, of any languages
        edges = [0, *sorted(rng.choice(np.arange(4, length - 3), rng.integers(0, 3), replace=False)), length]
        for a, b in zip(edges, edges[1:], strict=False):
            y = int(rng.integers(k))
            text = by[labels[y]][rng.integers(len(by[labels[y]]))]
            at = int(rng.integers(max(1, len(text) - (b - a) + 1)))
            words[s, a:b] = np.resize(text[at : at + b - a], b - a)
            truth[s, a:b] = y
    steps = [[model.weights, np.zeros_like(model.weights)], [model.move, np.zeros_like(model.move)], [model.start, np.zeros_like(model.start)]]
    alive, eye = np.full(length, batch), np.eye(k, dtype=np.float32)
    for _ in range(epochs):
        for rows in np.split(rng.permutation(sequences)[: sequences // batch * batch], sequences // batch):
            w, y = words[rows].T.ravel(), truth[rows].T  # time-major
            span = counts[w]
            feats = ids[np.repeat(begins[w], span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)]
            score = np.add.reduceat(model.weights[feats], np.cumsum(span) - span, axis=0)
            out = np.exp(np.maximum(score - score.max(1, keepdims=True), -30.0))
            gamma, moves, _ = forward_backward(np.exp(model.start), np.exp(model.move), out, alive)
            wrong = (eye[y.ravel()] - gamma) / batch
            seen = np.zeros((k, k), np.float32)
            np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1.0)
            flat = np.repeat(wrong, span, axis=0)
            grad = np.stack([np.bincount(feats, flat[:, j], 1 << BITS) for j in range(k)], 1).astype(np.float32)
            for (value, memory), g in zip(steps, (grad, (seen - moves) / batch, (eye[y[0]] - gamma[:batch]).mean(0)), strict=True):
                memory += g * g
                value += rate * g / np.sqrt(memory + 1e-8)
    return model


def spoken(text: str | None) -> list[str]:
    """The words of a text; none if it has no letter."""
    found = LETTERS.findall(text.lower()) if text else []
    # a run may be of signs like fractions alone, which are numeric but neither digits nor letters
    return found if any(c.isalpha() for w in found for c in w) else []


def label_shares(model: Model, texts: Iterable[str | None]) -> Iterator[tuple[int, np.ndarray | None]]:
    """(row, share of each label among the text's words; None without letters), by chains of like length."""
    vocab: dict[str, int] = {}
    table_ = np.zeros((0, len(model.labels)), np.float32)
    move, start = np.exp(model.move), np.exp(model.start)
    rows, chains = [], []
    for row, text in enumerate(texts):
        found = spoken(text)
        if not found:
            yield row, None
            continue
        if not model.labels:
            yield row, np.zeros(0)
            continue
        rows.append(row)
        chains.append(np.fromiter((vocab.setdefault(w, len(vocab)) for w in found), np.int32, len(found)))
    table_ = model.emissions(list(vocab))
    lengths = np.fromiter(map(len, chains), np.int64, len(chains))
    order, at = np.argsort(-lengths, kind="stable"), 0
    while at < len(order):
        stop = at + max(1, int(np.searchsorted(np.cumsum(lengths[order[at:]]), GROUP_WORDS)))
        own = order[at:stop]
        alive, place = time_major(lengths[own])
        words = np.concatenate([chains[i] for i in own])[place]
        gamma, _, _ = forward_backward(start, move, table_[words], alive)
        share, t = np.zeros((len(own), len(model.labels))), 0
        for n in alive.tolist():
            share[:n] += gamma[t : t + n]
            t += n
        share /= share.sum(1, keepdims=True)
        for i, s in zip(own, share, strict=True):
            yield rows[i], s
        at = stop


def some_rows(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have up to ``most`` characters together, or one row each."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield at, stop
        at = stop


def sample(docs: DataFrame, labelled: Column, *, text_col: str, lang_col: str, sample_docs: int) -> list[tuple[str, str]]:
    """About ``sample_docs`` documents of each language, chosen by a hash of the text; whole texts."""
    known = docs.where(labelled & docs[lang_col].isNotNull() & docs[text_col].isNotNull() & (F.length(docs[text_col]) > 0)).select(docs[lang_col].alias("lang"), docs[text_col].alias("text"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row for each language
    if not sizes:
        return []
    scale = 1 << 30
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, sample_docs / n) * scale))))
    known = known.withColumn("h", F.xxhash64("text")).where(F.pmod("h", F.lit(scale)) < F.element_at(share, F.col("lang")))
    # the share keeps this near sample_docs rows a language; the limit is the documented bound
    got = known.dropDuplicates(["lang", "h"]).orderBy("h").limit(2 * sample_docs * len(sizes)).collect()
    return [(r["lang"], r["text"]) for r in got]


def identify(docs: DataFrame, labelled: Column, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = 250, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (the id column by default), lang_pred, score, shares (language to share of words) and spoken (has the text a letter?).

    The rows for which ``labelled`` holds may be learned from.
    """
    keep = keep or (id_col,)
    model = fit(sample(docs, labelled, text_col=text_col, lang_col=lang_col, sample_docs=sample_docs))
    schema = docs.select(*(docs[c] for c in keep)).schema.add("lang_pred", "string").add("score", "double").add("shares", MapType(StringType(), DoubleType())).add("spoken", "boolean")
    names = [f.name for f in schema.fields]
    at_text = keep.index(text_col) if text_col in keep else len(keep)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at, stop in some_rows(whole.column(at_text), GROUP_CHARS):
                batch = whole.slice(at, stop - at)
                pred, score, shares, speaks = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows, [[] for _ in range(batch.num_rows)], [False] * batch.num_rows
                for row, share in label_shares(model, (x.as_py() for x in batch.column(at_text))):
                    if share is not None:
                        speaks[row] = True
                        if model.labels:
                            pred[row], score[row] = model.labels[int(share.argmax())], float(min(1.0, share.max()))
                            shares[row] = list(zip(model.labels, share.tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64())), pa.array(speaks, pa.bool_())], names)

    more = () if text_col in keep else (docs[text_col].alias("__text"),)
    return docs.select(*(docs[c] for c in keep), *more).mapInArrow(run, schema)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from documents outside the held-out quarter, predicted for all."""
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), 4) == 2
    got = identify(docs, crc_mod(docs["doc_id"], 4) != 2)
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score")


