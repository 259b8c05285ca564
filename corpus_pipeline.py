"""From raw documents to packed training sequences.

``STAGES`` are applied in order; each works on all rows its predecessor kept, which
are written to the shared folder and read again in between, so that a lost executor
costs one stage at most. All but the last return the columns of documents. A null
text, id, language or source, repeated rows, extra columns and an empty table are
treated as each operator's description says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseforge.llm import langid, mixing, packing, repeats, similar
from pulseforge.llm.common import pick, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. The model learns from the language
    labels of the documents themselves, outside the held-out fifth. Documents
    without letters, and those no language fits better than all others together,
    go."""
    model = langid.fit(pick(docs, "doc_id", "lang", "text"), langid.learnt(docs))
    return langid.recognised(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each class of near-duplicates."""
    return similar.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand in them or in others more than
    once. A text that loses nothing stays as it is; one that does has its words
    left joined by one blank, and may be empty. ``n_chars`` follows the text."""
    rows = repeats.remove_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.emit(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents and their places in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language identification", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources", mixture),
    ("best-fit packing", sequences),
]

#: Naive Bayes, LSH and tokenizing are not expressible in SQL; the tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
