"""Keep a keyed feature table current from a stream.

A streaming aggregation (``groupBy(key).agg(...)`` in update mode) keeps one
state row per key in Spark's state store, partitioned by key; each
micro-batch emits the keys whose aggregates changed, with their full current
values. ``foreachBatch`` merges those rows into the feature table by key
(``attrix.sources.features.write_features(mode="merge")``).

Replaying a micro-batch after a failure writes the same full values again,
and a merge by key is idempotent, so recovery from the checkpoint gives the
same table. The checkpoint lives under the shared scratch folder.

The table is created under a manifest: a micro-batch rewrites the key buckets
of its keys only, and old versions go every ``EXPIRE_EVERY`` batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from attrix.session import scratch_path
from attrix.sources import features as FT

#: key buckets of a table that a stream keeps
MERGE_BUCKETS = 16
EXPIRE_EVERY = 10
EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")


def read_event_stream(spark: SparkSession, directory: str, file_glob: str = "events*.parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", file_glob))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def usage_features(events: DataFrame, key: str = "customerID") -> DataFrame:
    """Per-user usage aggregates that a stream can maintain incrementally
    (distinct counts are not incremental, so active days are left out)."""
    return events.groupBy(F.col("user_id").alias(key)).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.round(F.col("value") * F.lit(100.0)).cast("bigint")).alias("cents"),
        F.max("value").alias("max_value"))


def upsert_stream(aggregates: DataFrame, table: str, keys: Sequence[str] | str,
                  checkpoint: str | None = None, available_now: bool = True,
                  create: bool = True) -> StreamingQuery:
    """Start a query that merges each micro-batch of ``aggregates`` into
    ``table`` (created with the aggregate's schema when missing)."""
    spark = aggregates.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    if create and not spark.catalog.tableExists(table):
        FT.create_feature_table(spark, table, keys, schema=aggregates.schema,
                                description="maintained by a streaming upsert", merge_buckets=MERGE_BUCKETS)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        FT.write_features(batch.sparkSession, table, batch, mode="merge")
        if batch_id % EXPIRE_EVERY == EXPIRE_EVERY - 1:
            FT.expire_versions(batch.sparkSession, table)

    w = (aggregates.writeStream.outputMode("update").foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "stream_ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
