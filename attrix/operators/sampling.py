"""Reproducible sampling and stratified splitting by key hash.

``DataFrame.sample`` depends on partitioning (the same seed keeps different
rows after a repartition); both operators here depend only on the key and
the seed, so reruns, recomputation after executor loss, and other engines
select the same rows.

Stratified split without a per-label window over all rows: a window
``PARTITION BY label`` would put each class in a single task. Instead:

1. hash each key to 32 bits; the top 16 bits pick a bucket;
2. count rows per (label, bucket): partial aggregation, at most
   ``n_labels * 2**16`` output rows;
3. running counts over that small table give, per bucket, how many rows of
   the class sort before it, and the per-class target ``floor(n * fraction)``;
4. rows in buckets wholly below the target go to train, wholly above to
   validation, by a null-safe join with the small table, whose strategy AQE
   picks from its measured size;
5. only rows of the one boundary bucket per class are ranked, by
   ``(hash, key)``, in a window partitioned by (label, bucket).

The result equals ``row_number() OVER (PARTITION BY label ORDER BY hash, key)
<= floor(n * fraction)``. Rows whose label is null are a class of their own; a
null key is hashed like an empty one and ranked before it. No row is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrix.functions.hashing import seeded_hash32, seeded_hash60

BUCKET_BITS = 16


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Rows whose seeded 60-bit key hash lies below ``fraction`` of its range."""
    return df.filter(seeded_hash60(key, seed) < F.lit(sample_limit(fraction)))


def sample_limit(fraction: float) -> int:
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must lie in 0..1, not {fraction}")
    return round(fraction * (1 << 60))


def stratified_split(df: DataFrame, key: str, label: str, train_fraction: float, seed: int,
                     split_col: str = "split") -> DataFrame:
    """Add ``split`` = 'train' / 'validation', stratified by ``label``."""
    tagged = (df.withColumn("__h", seeded_hash32(key, seed))
                .withColumn("__b", F.shiftright(F.col("__h"), 32 - BUCKET_BITS)))
    counts = tagged.groupBy(F.col(label).alias("__label"), F.col("__b").alias("__bucket")).agg(F.count(F.lit(1)).alias("__n"))
    by_bucket = Window.partitionBy("__label").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    per_label = Window.partitionBy("__label")
    cum = counts.select("__label", "__bucket", "__n", F.coalesce(F.sum("__n").over(by_bucket), F.lit(0)).alias("__before"),
                        F.floor(F.sum("__n").over(per_label) * F.lit(float(train_fraction))).alias("__k"))
    j = tagged.join(cum, F.col(label).eqNullSafe(F.col("__label")) & (F.col("__b") == F.col("__bucket")), "inner")
    lo = F.col("__before")
    hi = F.col("__before") + F.col("__n")
    k = F.col("__k")
    clear = (j.filter((hi <= k) | (lo >= k))
              .withColumn(split_col, F.when(hi <= k, F.lit("train")).otherwise(F.lit("validation"))))
    rank = Window.partitionBy(label, "__b").orderBy("__h", key)
    edge = (j.filter((lo < k) & (k < hi))
             .withColumn("__rn", F.row_number().over(rank))
             .withColumn(split_col, F.when(lo + F.col("__rn") <= k, F.lit("train"))
                         .otherwise(F.lit("validation")))
             .drop("__rn"))
    out = clear.unionByName(edge)
    return out.drop("__h", "__b", "__label", "__bucket", "__before", "__n", "__k")


def split_frames(df: DataFrame, key: str, label: str, train_fraction: float, seed: int
                 ) -> tuple[DataFrame, DataFrame]:
    s = stratified_split(df, key, label, train_fraction, seed)
    return (s.filter(F.col("split") == "train").drop("split"),
            s.filter(F.col("split") == "validation").drop("split"))
