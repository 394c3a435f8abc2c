"""Operator 7: exact token-length histogram and the answers it gives.

One pass encodes every whole text and counts documents by length inside the
task, so a task sends one row per distinct length. Lengths are summed up in one
small shuffle. Running sums go over the lengths from the largest down (suffix
sums), in two levels of ``SPAN`` lengths, so no task holds all lengths at once;
only one row per span meets in one place.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrix.llm.common import stored, text_batches
from attrix.llm.encoding import encoder, vocabulary_path

SPAN = 1024


def length_histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(n_tokens, docs): how many rows encode to each length. Null and empty texts count as length 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, counts = encoder(tokenizer), Counter()
        for _, texts in text_batches(batches, [], "text"):
            counts.update(len(enc.encode(t)) // 4 for t in texts)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())],
                                         names=["n_tokens", "docs"])
    return (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "n_tokens long, docs long")
            .groupBy("n_tokens").agg(F.sum("docs").alias("docs")))


def with_suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with sums over all longer documents, per length:

    ``docs_from``/``tokens_from``: documents of at least this length and their
    tokens; ``truncated_total``: tokens kept when every document is cut to this
    length; ``lost_tokens``: the rest; ``share_within``: share of documents of
    at most this length (their quantile).
    """
    h = stored(histogram.withColumn("span", F.floor(F.col("n_tokens") / SPAN)), "length-histogram")
    spans = h.groupBy("span").agg(F.sum("docs").alias("d"), F.sum(F.col("docs") * F.col("n_tokens")).alias("t"))
    later = Window.orderBy(F.desc("span")).rowsBetween(Window.unboundedPreceding, -1)  # one row per span
    spans = spans.select("span", F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"),
                         F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"))
    total = h.agg(F.sum("docs").alias("all_docs"), F.sum(F.col("docs") * F.col("n_tokens")).alias("all_tokens"))
    inside = Window.partitionBy("span").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = (h.join(spans, "span")
           .withColumn("docs_from", F.sum("docs").over(inside) + F.col("d_after"))
           .withColumn("tokens_from", F.sum(F.col("docs") * F.col("n_tokens")).over(inside) + F.col("t_after"))
           .join(F.broadcast(total)))  # one row
    kept = F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return out.select(
        "n_tokens", "docs", "docs_from", "tokens_from", kept.alias("truncated_total"),
        (F.col("all_tokens") - kept).alias("lost_tokens"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("docs")) / F.col("all_docs")).alias("share_within"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_over, kept_tokens, lost_tokens) for any context limits, from the suffix sums.

    ``limits`` is a stated list; each row of ``sums`` answers the limits of its
    own stretch, so the work is the histogram's size times the list's.
    """
    each = sums.withColumn("limit", F.explode(F.array(*(F.lit(int(x)) for x in limits))))
    over = F.col("n_tokens") > F.col("limit")
    docs = F.coalesce(F.sum(F.when(over, F.col("docs"))), F.lit(0))
    cut = F.coalesce(F.sum(F.when(over, F.col("docs") * (F.col("n_tokens") - F.col("limit")))), F.lit(0))
    total = F.sum(F.col("docs") * F.col("n_tokens"))
    return each.groupBy("limit").agg(docs.alias("docs_over"), (total - cut).alias("kept_tokens"), cut.alias("lost_tokens"))


def length_quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, n_tokens): the smallest length that at least ``share`` of the documents do not exceed."""
    each = sums.withColumn("share", F.explode(F.array(*(F.lit(float(x)) for x in shares))))
    return each.where("share_within >= share").groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    return with_suffix_sums(length_histogram(docs, tokenizer or vocabulary_path("byte_bpe_50k.json")))
