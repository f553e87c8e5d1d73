"""The corpus pipeline: language ID, n-gram Jaccard join, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of documents. Columns beyond these are dropped, nulls in any
of them are kept, and an empty table passes through as one. Very long texts are
read, redacted and packed whole. Repeated rows stay as often as they come but in
the near-duplicate stage, where one of them is the document that stays, and of
rows alike in id and text the first by source, language and length; the mix
takes copies of that one. Ties are settled as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkloom.llm import jaccard, language, mixing, packing, pii
from sparkloom.llm.common import crc_mod, cut, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: No stage's method can be written in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def as_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("n_chars").cast("long"))


def with_rows(docs: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """Documents joined to a table with one row for each (doc_id, text_hash); of repeated rows the first stays."""
    found = found.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    met = docs.withColumn("_own", F.xxhash64("text")).join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_hash")), how)
    one = Window.partitionBy("doc_id", "_own").orderBy("source", "lang", "n_chars")
    return met.withColumn("_nth", F.row_number().over(one)).where("_nth = 1")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in no language (null, or without a letter) go; a missing lang is filled in, with und if none was learned."""
    docs = as_documents(docs)
    got = language.identify(docs, crc_mod(docs["doc_id"], 4) != 2, keep=COLUMNS)

    # without a labelled text nothing is learned, and all predictions are unknown
    unknown = F.col("lang_pred") == language.UNKNOWN
    return got.where(~unknown | F.col("spoken")).select("doc_id", "text", F.coalesce("lang", "lang_pred").alias("lang"), "source", "n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, one with the least id."""
    docs = as_documents(docs)
    found = cut(jaccard.near_duplicates(docs))
    alone = found.where("n_shingles = 0").select("doc_id", "text_hash")
    first = found.where("n_shingles > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("x")).select("x.doc_id", "x.text_hash")
    return with_rows(docs, first.unionByName(alone).distinct()).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by its kind; all documents stay."""
    return pii.redact_texts(as_documents(docs)).withColumn("n_chars", F.length("text").cast("long"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document comes as often as the mix takes it."""
    docs = as_documents(docs)
    taken = mixing.mix(docs.withColumn("text_hash", F.xxhash64("text")), id_cols=("doc_id", "text_hash"))
    taken = taken.groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies")).where("copies > 0")
    return with_rows(docs, taken).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def packing_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    return packing.pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard", near_duplicates),
    ("personal_data", personal_data),
    ("entropy_mixing", mixing_sources),
    ("best_fit_packing", packing_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs)
    return docs
