"""Feature lookups: join keyed feature tables onto a base DataFrame.

A training set is a lazily joined DataFrame: ``base LEFT JOIN features USING
(key)`` for each lookup, then excluded columns dropped. The join strategy is
Spark's: with AQE on, a feature side that turns out small at run time is
broadcast (its size is measured, not assumed); otherwise both sides are
shuffled on the key and sort-merge joined, and AQE splits skewed partitions.
Feature tables are unique by key (checked when written), so a lookup never
changes the number of base rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class FeatureLookup:
    """Which feature table to join, on which key, and which features to take.

    ``table`` is a catalog name or a path to a parquet feature table; a
    DataFrame may be given directly as ``df``. ``feature_names=None`` takes
    every non-key column.
    """

    table: str | None = None
    lookup_key: str | Sequence[str] = "customerID"
    feature_names: Sequence[str] | None = None
    df: DataFrame | None = field(default=None, compare=False)

    @property
    def keys(self) -> list[str]:
        return [self.lookup_key] if isinstance(self.lookup_key, str) else list(self.lookup_key)

    def load(self, spark: SparkSession) -> DataFrame:
        if self.df is not None:
            return self.df
        from attrix.sources.features import read_features

        return read_features(spark, self.table)

    def features(self, spark: SparkSession) -> DataFrame:
        df = self.load(spark)
        names = self.feature_names
        if names is None:
            names = [c for c in df.columns if c not in self.keys]
        return df.select(*self.keys, *names)

    def spec(self) -> dict:
        return {"table": self.table, "lookup_key": self.keys,
                "feature_names": list(self.feature_names) if self.feature_names else None}


def _as_list(x: str | Iterable[str] | None) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


@dataclass
class TrainingSet:
    base: DataFrame
    lookups: list[FeatureLookup]
    label: str | None
    exclude_columns: list[str]

    def load_df(self, keep_keys: bool = False, salted: bool = False) -> DataFrame:
        """The joined rows. ``keep_keys`` retains the lookup keys (needed to
        split, sample and explain by key) even when they are excluded.
        ``salted`` splits keys that hold a large share of the base rows
        (``lookup_features_salted``)."""
        spark = self.base.sparkSession
        out = self.base
        taken = set(out.columns)
        for lk in self.lookups:
            feats = lk.features(spark)
            new = [c for c in feats.columns if c not in lk.keys]
            clash = sorted(taken.intersection(new))
            if clash:
                raise ValueError(f"feature names already present in the training set: {clash}")
            if salted:
                out = lookup_features_salted(out, feats, lk.keys)
            else:
                out = out.join(feats, on=lk.keys, how="left")
            taken.update(new)
        drop = list(self.exclude_columns)
        if keep_keys:
            keys = {k for lk in self.lookups for k in lk.keys}
            drop = [c for c in drop if c not in keys]
        if self.label and self.label not in out.columns:
            raise ValueError(f"label column {self.label!r} not found")
        return out.drop(*drop)

    def spec(self) -> dict:
        return {"lookups": [lk.spec() for lk in self.lookups], "label": self.label,
                "exclude_columns": self.exclude_columns}


def create_training_set(base: DataFrame, lookups: FeatureLookup | Iterable[FeatureLookup],
                        label: str | None = None,
                        exclude_columns: str | Iterable[str] | None = None) -> TrainingSet:
    """Declare a training set (nothing runs until ``load_df`` is acted on)."""
    lks = [lookups] if isinstance(lookups, FeatureLookup) else list(lookups)
    return TrainingSet(base, lks, label, _as_list(exclude_columns))


def lookup_features(base: DataFrame, features: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One left lookup of a feature DataFrame by key."""
    keys = [key] if isinstance(key, str) else list(key)
    return base.join(features, on=keys, how="left")


HOT_KEY_SHARE = 0.01
SALTS = 32


def lookup_features_salted(base: DataFrame, features: DataFrame, key: str | Sequence[str],
                           hot_share: float = HOT_KEY_SHARE, salts: int = SALTS,
                           hot_keys: DataFrame | None = None) -> DataFrame:
    """Left lookup that splits hot keys instead of sending each to one task.

    1. Keys holding more than ``hot_share`` of the base rows: given as
       ``hot_keys``, or found by one map-side combined count. There are fewer
       than ``1 / hot_share`` of them, so the list is broadcast.
    2. Base rows of hot keys get a salt in 0..salts-1, a hash of the whole row,
       so a recomputed task gives a row the same salt again. Rows with a null
       key, which meet no feature row, are spread in the same way.
    3. Feature rows of hot keys are repeated once per salt (only those few
       keys grow); other feature rows keep salt 0.
    4. Equi-join on (key, salt).
    Every base row still meets exactly the feature row of its key, so the
    result equals the plain left join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if hot_keys is None:
        counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
        total = counts.select(F.sum("__n")).scalar()
        hot_keys = counts.filter(F.col("__n") > total * F.lit(float(hot_share)))
    hot = F.broadcast(hot_keys.select(*keys).withColumn("__hot", F.lit(True)))
    no_key = functools.reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    spread = F.pmod(F.xxhash64(*base.columns), F.lit(salts)).cast("int")
    b = (base.join(hot, keys, "left")
             .withColumn("__salt", F.when(F.col("__hot") | no_key, spread).otherwise(F.lit(0)))
             .drop("__hot"))
    f = (features.join(hot, keys, "left")
                 .withColumn("__salt", F.explode(F.when(
                     F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
                 .drop("__hot"))
    return b.join(f, [*keys, "__salt"], "left").drop("__salt")
