"""The pipeline's stages on the smallest tables and on odd input."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from sparkloom.llm import common, pii
from tests.llm.test_llm import DOCS, ODD, brute_components, brute_targets


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    out["documents"] = docs.collect()
    for name, stage in pipeline.STAGES:
        docs = common.cut(stage(spark, docs, sf_dir))
        out[name] = docs.collect()
        if name != pipeline.STAGES[-1][0]:
            assert tuple(docs.columns) == pipeline.COLUMNS
    return out


def test_language_keeps_clean_documents(stages):
    kept = {r["doc_id"] for r in stages["language_id"]}
    assert kept == {r["doc_id"] for r in stages["documents"] if r["text"] and re.search(r"[^\W\d_]", r["text"])}


def test_one_document_of_each_class_stays(stages):
    want = {c for _, _, c in brute_components([r.asDict() for r in stages["language_id"]])}
    assert Counter(r["doc_id"] for r in stages["ngram_jaccard"]) == Counter(want)
    before = {r["doc_id"]: r for r in stages["language_id"]}
    assert all(before[r["doc_id"]] == r for r in stages["ngram_jaccard"])


def test_personal_data_goes_and_documents_stay(stages):
    before = {r["doc_id"]: r for r in stages["ngram_jaccard"]}
    assert Counter(r["doc_id"] for r in stages["personal_data"]) == Counter(list(before))
    for r in stages["personal_data"]:
        assert pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if not pii.base_spans(before[r["doc_id"]]["text"]):
            assert r["text"] == before[r["doc_id"]]["text"]


def test_mix_meets_its_targets(stages):
    size, longest = Counter(), Counter()
    for r in stages["personal_data"]:
        n = len(r["text"].encode().split())
        size[r["source"]] += n
        longest[r["source"]] = max(longest[r["source"]], n)
    goal, taken = brute_targets(dict(size)), Counter()
    for r in stages["entropy_mixing"]:
        taken[r["source"]] += len(r["text"].encode().split())
    assert all(abs(taken[s] - goal[s]) <= max(0.01 * goal[s], longest[s]) for s in goal)
    assert max(Counter(r["doc_id"] for r in stages["entropy_mixing"]).values()) <= 2


def test_sequences_are_full(stages):
    at = defaultdict(list)
    for r in stages["best_fit_packing"]:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in at.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 1024
    whole = sum(r["length"] for r in stages["best_fit_packing"])
    assert len(at) <= 1.03 * math.ceil(whole / 1024) + 1
    assert Counter(r["doc_id"] for r in stages["best_fit_packing"] if r["piece"] == 0) == Counter(r["doc_id"] for r in stages["entropy_mixing"])


def test_odd_input(spark, sf_dir):
    odd = spark.createDataFrame(ODD, DOCS)
    for docs in (odd, odd.limit(0)):
        for name, stage in pipeline.STAGES:
            docs = common.cut(stage(spark, docs, sf_dir))
            if name == "ngram_jaccard" and docs.count():
                assert sorted(r["doc_id"] for r in docs.select("doc_id").collect()) == [5, 7, 8, 9]
    assert docs.where(F.lit(True)).count() == 0


def test_classes_without_ids_of_their_own_stay_apart(spark, sf_dir):
    words = [" ".join(f"w{n}x{k}" for k in range(9)) for n in range(6)]
    data = [(None, words[0]), (None, words[1]), (None, words[1]), (7, words[2]), (7, words[3]), (7, words[3]), (8, words[3]), (None, words[4]), (9, words[4]), (7, words[5])]
    docs = spark.createDataFrame([(i, x, "en", "a", len(x)) for i, x in data], "doc_id long, text string, lang string, source string, n_chars long")
    got = pipeline.near_duplicates(spark, docs, sf_dir).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=str) == sorted(zip((None, None, 7, 7, 9, 7), words, strict=True), key=str)


def test_texts_stay_where_no_language_was_learned(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*pipeline.COLUMNS).withColumn("lang", F.lit(None).cast("string"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 34 !!"), (-4, "é")], "doc_id long, text string").select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("a").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    docs = docs.unionByName(odd)
    want = sorted(r["doc_id"] for r in docs.collect() if r["text"] and re.search(r"[^\W\d_]", r["text"]))
    got = pipeline.language_id(spark, docs, sf_dir).collect()
    assert sorted(r["doc_id"] for r in got) == want and {r["lang"] for r in got} == {"und"} and -4 in want
