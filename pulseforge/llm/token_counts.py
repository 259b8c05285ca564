"""Exact histogram of encoded lengths, and what it answers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseforge.llm import running, tokens
from pulseforge.llm.common import blocks, written


def lengths(docs: DataFrame, text: str = "text", end_token: bool = True) -> DataFrame:
    """``n_tokens`` of each text (null: no text), its end token included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.encoder()
        for _, column in blocks(batches, "text"):
            yield pa.record_batch({"n_tokens": pa.array([len(encoder.ids(t)) + end_token for t in column.to_pylist()], pa.int64())})

    return docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(count, "n_tokens long")


def histogram(docs: DataFrame, text: str = "text", end_token: bool = True) -> DataFrame:
    """One row per encoded length with its documents, and suffix sums over longer ones.

    Columns: ``n_tokens``; ``n_docs`` of that length; ``tokens`` in them;
    ``docs_from``, ``tokens_from`` (documents at least as long, and their
    tokens); ``total_tokens`` of the corpus; ``truncated_tokens`` (tokens kept
    when every document is cut to this length); ``quantile`` (share of documents
    no longer than this). A null text counts as empty; repeated rows count each;
    an empty table gives no rows. The table has as many rows as there are
    distinct lengths, however many documents there are.
    """
    # Written, as it is read several times: texts are encoded once.
    rows = written(lengths(docs, text, end_token).groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    rows = rows.withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    rows = running.suffix_sums(rows, "n_tokens", {"n_docs": "docs_from", "tokens": "tokens_from"})
    total = rows.agg(F.sum("n_docs").alias("_docs"), F.sum("tokens").alias("total_tokens"))
    rows = rows.join(F.broadcast(total))  # one row
    kept = F.col("total_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return rows.select(
        "n_tokens", "n_docs", "tokens", "docs_from", "tokens_from", "total_tokens", kept.alias("truncated_tokens"),
        ((F.col("_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("_docs")).alias("quantile"),
    )


def at_limits(table: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Tokens kept, documents cut and tokens lost for context limits, from a
    ``histogram``: the suffix sums of the shortest length above a limit tell how many
    documents it cuts, and what they hold. A limit above all lengths cuts nothing."""
    total = F.coalesce(F.max("total_tokens"), F.lit(0))

    def entry(limit: int) -> Column:
        above = F.min(F.when(F.col("n_tokens") > limit, F.struct("n_tokens", "docs_from", "tokens_from")))
        cut = F.coalesce(above["docs_from"], F.lit(0))
        kept = total - F.coalesce(above["tokens_from"], F.lit(0)) + limit * cut
        return F.struct(F.lit(limit).cast("long").alias("context_limit"), cut.alias("docs_cut"), kept.alias("tokens_kept"), (total - kept).alias("tokens_lost"))

    return table.agg(F.array(*[entry(int(x)) for x in sorted(set(limits))]).alias("_limits")).select(F.inline("_limits"))


def quantiles(table: DataFrame, shares: Sequence[float]) -> DataFrame:
    """The shortest length that at least each share of documents does not exceed."""
    reached = lambda x: F.min(F.when(F.col("quantile") >= x, F.col("n_tokens")))
    entries = [F.struct(F.lit(float(x)).alias("share"), reached(float(x)).alias("n_tokens")) for x in shares]
    return table.agg(F.array(*entries).alias("_shares")).select(F.inline("_shares")).where("n_tokens is not null")


def op1_token_length_histogram(spark, sf_dir: str) -> DataFrame:
    """The length histogram of all documents, end tokens included."""
    return histogram(spark.read.parquet(f"{sf_dir}/documents.parquet"))
