"""Mergeable column profiles: the state of a table version, kept and merged later.

A state is one row per column with exact counts, extremes and sum, a distinct
sketch (HyperLogLog) and a rank sketch (KLL). Its size does not depend on the
rows, so the profile of many versions comes from their states alone, without
reading a version again. Bounds, for any number of merged states:

* distinct values: relative standard error 1.04 / sqrt(2 ^ ``LOG_REGISTERS``), under 1 %;
* quantiles: rank error 2.296 / ``RANK_SIZE`` ^ 0.9021 of the rows, about half a percent, at 99 %.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.operators.profile import NUMERIC_TYPES, QUARTILES

LOG_REGISTERS = 14
RANK_SIZE = 800
DISTINCT_BOUND = 4 * 1.04 / 2 ** (LOG_REGISTERS / 2)
RANK_BOUND = 3 * 2.296 / RANK_SIZE ** 0.9021
STATE = ["n_rows", "n_values", "min_value", "max_value", "sum_value", "distinct_state", "rank_state"]


def profile_states(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """(*by, column_name, data_type, *STATE): the states of all columns, per group of ``by``, in one pass.

    Numbers and booleans (as 0/1) have extremes, sum and rank sketch, which are
    null for other types and for columns without values. NaN counts as a value,
    is the largest, and is left out of the rank sketch. States are combined per
    task, so a group with most rows is no hot key. An empty table has no rows
    here when ``by`` is given, else one row of zeros per column.
    """
    cols = list(columns) if columns is not None else [c for c in df.columns if c not in by]
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, c in enumerate(cols):
        t, x = types[c], F.col(c)
        number = (x.cast("int") if isinstance(t, T.BooleanType) else x).cast("double")
        if not isinstance(t, (*NUMERIC_TYPES, T.BooleanType)):
            number = F.lit(None).cast("double")
        # -0.0 and 0.0 are one value
        plain = (x.cast("double") + F.lit(0.0)).cast("string") if isinstance(t, (T.FloatType, T.DoubleType)) else x.cast("string")
        aggs += [F.count(x).alias(f"n{i}"), F.min(number).alias(f"lo{i}"), F.max(number).alias(f"hi{i}"),
                 F.sum(number).alias(f"s{i}"), F.hll_sketch_agg(plain, F.lit(LOG_REGISTERS)).alias(f"d{i}"),
                 F.kll_sketch_agg_double(F.when(~F.isnan(number), number), F.lit(RANK_SIZE)).alias(f"r{i}")]
    rows = F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.lit(types[c].simpleString()).alias("data_type"), F.col("__rows").alias("n_rows"),
        *[F.col(f"{short}{i}").alias(name) for short, name in zip(["n", "lo", "hi", "s", "d", "r"], STATE[1:])])
        for i, c in enumerate(cols)])
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(rows))


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of the same columns as one, per group of ``by``; merged states merge again."""
    return states.groupBy(*by, "column_name", "data_type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("sum_value").alias("sum_value"),
        F.hll_union_agg("distinct_state").alias("distinct_state"), F.kll_merge_agg_double("rank_state").alias("rank_state"))


def profile_of(states: DataFrame, probs: Sequence[float] = QUARTILES) -> DataFrame:
    """The states' profile: counts, extremes and mean as they are, distinct values and quantiles estimated."""
    keys = [c for c in states.columns if c not in STATE]
    ends = F.array(*[F.lit(float(p)) for p in probs])
    filled = F.col("rank_state").isNotNull() & (F.kll_sketch_get_n_double("rank_state") > 0)
    return states.select(
        *keys, "n_rows", (F.col("n_rows") - F.col("n_values")).alias("n_nulls"),
        F.hll_sketch_estimate("distinct_state").alias("n_distinct"), "min_value", "max_value",
        _mean().alias("mean_value"), F.when(filled, F.kll_sketch_get_quantile_double("rank_state", ends)).alias("quantiles"))


def _mean() -> Column:
    return F.when(F.col("n_values") > 0, F.col("sum_value") / F.col("n_values"))


def save_states(states: DataFrame, root: str, version: int) -> None:
    """Write the states of one table version to its own folder under ``root``.

    A repeated write of a version replaces that version only, so a rerun after a
    lost job counts nothing twice.
    """
    states.coalesce(1).write.mode("overwrite").parquet(f"{root}/version={int(version)}")


def load_states(spark: SparkSession, root: str, versions: Sequence[int] | None = None) -> DataFrame:
    """The stored states with their ``version``; all versions, or those listed."""
    all_ = spark.read.parquet(root)
    return all_ if versions is None else all_.where(F.col("version").isin([int(v) for v in versions]))
