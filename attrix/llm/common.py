"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from attrix.session import scratch_path, ship  # noqa: F401  (the operators take ship from here)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    This cuts the lineage with files that survive a lost executor, and freezes
    the rows: later readers see one and the same result of the plan above.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positions(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with ``pos``, its rows' places from 0 in the global order of ``order``.

    A range sort numbers the rows of each partition; what comes before a partition
    is a running sum over one row per partition. The rows are written, so they
    keep their places.
    """
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = stored(sorted_.select("*", F.monotonically_increasing_id().alias("__at")), name)
    part = F.shiftright("__at", 33).alias("__part")
    counts = at.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")
    starts = counts.select("__part", (before - F.shiftleft("__part", 33)).alias("__start"))
    return (at.withColumn("__part", part).join(F.broadcast(starts), "__part")
            .withColumn("pos", F.col("__at") + F.col("__start")).drop("__at", "__part", "__start"))


def chunks(rows: list, size_of: Callable[[object], int], limit: int) -> Iterator[list]:
    """Consecutive slices of ``rows`` whose sizes sum to about ``limit``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def text_batches(batches: Iterator[pa.RecordBatch], columns: list[str], text: str,
                 limit: int = 4 << 20) -> Iterator[tuple[list[list], list[str | None]]]:
    """Cut Arrow batches into slices of about ``limit`` characters of text.

    Yields the values of ``columns`` (one list per column) and the texts.
    """
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_pylist()
        at = size = 0
        for i, n in enumerate(lengths):
            size += n
            if size >= limit or i + 1 == len(lengths):
                part = batch.slice(at, i + 1 - at)
                yield [part.column(c).to_pylist() for c in columns], part.column(text).to_pylist()
                at, size = i + 1, 0


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of ``edges``; component = smallest node reachable.

    Minimum-label propagation with pointer jumping, so the number of rounds
    grows with the logarithm of the longest path. Every round is two equi-joins
    and a map-side combined minimum; labels are written to the shared scratch
    folder between rounds. Nothing but the count of changed labels reaches the
    driver. Edges may repeat, point either way or join a node with itself;
    rows with a null end are ignored.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = stored(e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-edges")
    labels = stored(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "v"), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("label").alias("near")))
        better = (labels.join(near, "node")
                  .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        step = stored(better.join(target, "label")
                      .select("node", "old", F.least("label", "next").alias("label")), "cc-labels")
        changed = step.where("old <> label").limit(1).count()
        labels = step.select("node", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")
