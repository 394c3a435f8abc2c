"""Streaming upsert: the table equals the batch aggregate, and re-running
from the same checkpoint after new files adds them exactly once."""

import shutil

from pyspark.sql import functions as F

from attrix.session import scratch_path
from attrix.sources import features as FT
from attrix.streaming import read_event_stream, upsert_stream, usage_features
from tests.conftest import SF_SMALL


def test_stream_matches_batch_and_resumes(spark):
    src = scratch_path(spark, "stream_src")
    import os

    os.makedirs(src)
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    part1 = events.filter(F.col("event_id") % 2 == 0)
    part2 = events.filter(F.col("event_id") % 2 == 1)
    part1.coalesce(1).write.parquet(f"{src}/b1")
    shutil.copy(next(p for p in _files(f"{src}/b1")), f"{src}/events_1.parquet")
    name = "usage_" + os.path.basename(src).replace("-", "_")
    ckpt = scratch_path(spark, "ckpt")
    q = upsert_stream(usage_features(read_event_stream(spark, src)), name, "customerID", ckpt)
    q.awaitTermination()
    part2.coalesce(1).write.parquet(f"{src}/b2")
    shutil.copy(next(p for p in _files(f"{src}/b2")), f"{src}/events_2.parquet")
    q = upsert_stream(usage_features(read_event_stream(spark, src)), name, "customerID", ckpt)
    q.awaitTermination()
    got = FT.read_features(spark, name)
    want = usage_features(events)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def _files(d):
    import glob

    return sorted(glob.glob(f"{d}/*.parquet"))
