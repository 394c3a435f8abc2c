"""Registered query: the profile of several table versions from their stored states."""

from __future__ import annotations

from pyspark.sql import functions as F

from attrix.functions.rounding import significant, significant_sql
from attrix.operators import profile as P
from attrix.operators import profile_state as S
from attrix.plans.catalog import register
from attrix.plans.frames import tbl
from attrix.session import scratch_path

VERSIONS = 4
COLUMNS = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_quantity": "double", "l_extendedprice": "double",
           "l_discount": "double", "l_returnflag": "string", "l_shipdate": "timestamp_ntz"}


def _sql() -> str:
    parts = []
    for c, t in COLUMNS.items():
        number = t in ("bigint", "double")
        figures = (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, "
                   f"{significant_sql(f'avg(CAST({c} AS DOUBLE))')} AS mean_value" if number else
                   "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, CAST(NULL AS DOUBLE) AS mean_value")
        parts.append(f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
                     f"{figures}, true AS distinct_within, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS quartiles_within FROM lineitem")
    return "\nUNION ALL\n".join(parts)


@register("profile_from_states", _sql())
def q_profile_from_states(spark, sf_dir):
    """Lineitem in four versions; each version's states are stored, and the profile is merged from the
    stored states alone. The estimates are then held against exact counts of the whole table."""
    items = tbl(spark, sf_dir, "lineitem").select("l_linenumber", *COLUMNS)
    root = scratch_path(spark, "profile-states")
    for v in range(VERSIONS):
        S.save_states(S.profile_states(items.where(F.col("l_linenumber") % VERSIONS == v), list(COLUMNS)), root, v)
    merged = S.profile_of(S.merge_states(S.load_states(spark, root)))

    exact = P.data_profile(items, list(COLUMNS), exact_distinct=True, reread=True).select("column_name", F.col("n_distinct").alias("exact"))
    numeric = [c for c, t in COLUMNS.items() if t in ("bigint", "double")]
    guess = {r["column_name"]: r["quantiles"] for r in merged.where(F.col("quantiles").isNotNull()).collect()}  # one row per column
    # a quantile is within its bound if its place among the rows, from the first to the last of its equals, reaches p +- bound
    checks = [F.struct(F.lit(c).alias("column_name"),
                       ((F.count(F.when(F.col(c) < F.lit(q), 1)) <= (p + S.RANK_BOUND) * F.count(c))
                        & (F.count(F.when(F.col(c) <= F.lit(q), 1)) >= (p - S.RANK_BOUND) * F.count(c))).alias("ok"))
              for c in numeric for p, q in zip(P.QUARTILES, guess.get(c, []))]
    ranks = (items.agg(F.array(*checks).alias("x")).select(F.inline("x"))
             .groupBy("column_name").agg(F.min("ok").alias("quartiles_within")))
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return (merged.join(exact, "column_name").join(ranks, "column_name", "left")
            .select("column_name", "data_type", "n_rows", "n_nulls", "min_value", "max_value", significant("mean_value").alias("mean_value"),
                    (off <= F.greatest(F.lit(1.0), F.col("exact") * S.DISTINCT_BOUND)).alias("distinct_within"), "quartiles_within"))
