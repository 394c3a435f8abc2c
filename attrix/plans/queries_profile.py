"""Registered queries: profiling, deterministic preprocessing, metrics on
fixed scores, best trial, promotion gate, group difference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrix.functions.metrics import accuracy, log_loss
from attrix.functions.rounding import decimals, decimals_sql, significant, significant_sql
from attrix.operators import explain as X
from attrix.operators import profile as P
from attrix.operators.preprocess import (
    BOOLEAN_FEATURES,
    CATEGORICAL_FEATURES,
    NUMERIC_FEATURES,
    impute_columns,
    standardise_columns,
)
from attrix.operators.tuning import ACCURACY_GATE, best_trial, draw_params, promotion_gate
from attrix.plans.catalog import register
from attrix.plans.frames import KEY, LABEL, frames, tbl
from attrix.plans.oracle import with_features

# Types of the joined training set (Spark names), for the profile oracle.
TRAINING_TYPES = {
    "customerID": "bigint", "gender": "string", "SeniorCitizen": "boolean", "Partner": "boolean",
    "Dependents": "boolean", "Churn": "int", "tenure": "int", "PhoneService": "boolean",
    "MultipleLines": "string", "InternetService": "string", "OnlineSecurity": "string",
    "OnlineBackup": "string", "DeviceProtection": "string", "TechSupport": "string",
    "StreamingTV": "string", "StreamingMovies": "string", "Contract": "int",
    "PaperlessBilling": "boolean", "PaymentMethod": "string", "MonthlyCharges": "double",
    "TotalCharges": "double", "NumOptionalServices": "int", "AvgPriceIncrease": "double",
}
SUMMARY_COLUMNS = ["customerID", "Churn"] + NUMERIC_FEATURES


def _ts(spark, sf_dir) -> DataFrame:
    return frames(spark, sf_dir).training_set()


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------
# Summary statistics (long form)

def _summary_sql(table: str, numeric: list[str], strings: list[str] = ()) -> str:
    aggs, parts = [], []
    for i, c in enumerate([*numeric, *strings]):
        if c in strings:
            aggs += [f"CAST(count({c}) AS DOUBLE) AS a{i}_count", f"min({c}) AS a{i}_min", f"max({c}) AS a{i}_max"]
            values, texts = {"count": "count"}, {"min": "min", "max": "max"}
        else:
            x = f"CAST({c} AS DOUBLE)"
            aggs += [f"CAST(count({x}) AS DOUBLE) AS a{i}_count", f"{significant_sql(f'avg({x})')} AS a{i}_mean",
                     f"{significant_sql(f'stddev_samp({x})')} AS a{i}_stddev",
                     f"min({x}) AS a{i}_min", f"quantile_disc({x}, 0.25) AS a{i}_q1",
                     f"quantile_disc({x}, 0.5) AS a{i}_q2", f"quantile_disc({x}, 0.75) AS a{i}_q3",
                     f"max({x}) AS a{i}_max"]
            values, texts = {"count": "count", "mean": "mean", "stddev": "stddev", "min": "min", "25%": "q1",
                             "50%": "q2", "75%": "q3", "max": "max"}, {}
        for stat in P.SUMMARY_STATISTICS:
            value = f"a{i}_{values[stat]}" if stat in values else "NULL"
            text = f"a{i}_{texts[stat]}" if stat in texts else "NULL"
            parts.append(f"SELECT '{c}' AS column_name, '{stat}' AS statistic, CAST({value} AS DOUBLE) AS value, "
                         f"CAST({text} AS VARCHAR) AS text FROM agg")
    return (f",\nagg AS (SELECT {', '.join(aggs)} FROM {table})\n" + _union(parts))


def _summary(df: DataFrame, columns: list[str], **options) -> DataFrame:
    """The summary with its computed figures rounded for comparison."""
    computed = F.col("statistic").isin("mean", "stddev")
    return P.summary_stats(df, columns, **options).withColumn(
        "value", F.when(computed, significant("value")).otherwise(F.col("value")))


@register("summary_stats", with_features("").rstrip() + _summary_sql("demographic_service",
                                                                      SUMMARY_COLUMNS, CATEGORICAL_FEATURES))
def q_summary_stats(spark, sf_dir):
    return _summary(_ts(spark, sf_dir), SUMMARY_COLUMNS + CATEGORICAL_FEATURES)


_ORDER_NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]
_ORDER_STRINGS = ["o_orderstatus", "o_orderpriority"]


@register("summary_orders", "WITH o AS (SELECT * FROM orders)" + _summary_sql("o", _ORDER_NUMERIC, _ORDER_STRINGS))
def q_summary_orders(spark, sf_dir):
    return _summary(tbl(spark, sf_dir, "orders"), _ORDER_NUMERIC + _ORDER_STRINGS, reread=True)


# ids above 2^53, where neighbours share a double, and exact decimals: the digits as text
_WIDE = {"order_id": "o_orderkey + 9007199254740993", "price": "CAST(o_totalprice AS DECIMAL(18,2))"}


def _wide_sql() -> str:
    stats = {"count": "count({c})", "min": "min({c})", "25%": "quantile_disc({c}, 0.25)", "50%": "quantile_disc({c}, 0.5)",
             "75%": "quantile_disc({c}, 0.75)", "max": "max({c})"}
    return (f"WITH w AS (SELECT {', '.join(f'{e} AS {c}' for c, e in _WIDE.items())} FROM orders)\n"
            + _union([f"SELECT '{c}' AS column_name, '{st}' AS statistic, CAST({f.format(c=c)} AS VARCHAR) AS text FROM w"
                      for c in _WIDE for st, f in stats.items()]))


@register("summary_wide_values", _wide_sql())
def q_summary_wide_values(spark, sf_dir):
    wide = tbl(spark, sf_dir, "orders").select(*[F.expr(e).alias(c) for c, e in _WIDE.items()])
    return (P.summary_stats(wide, texts=True, reread=True).where(~F.col("statistic").isin("mean", "stddev"))
            .select("column_name", "statistic", "text"))


# --------------------------------------------------------------------------
# Data profile

def _profile_sql(types: dict[str, str] = TRAINING_TYPES, table: str = "demographic_service",
                 wrap=with_features) -> str:
    parts = []
    for c, t in types.items():
        if t not in ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double"):
            mn = mx = mean = "CAST(NULL AS DOUBLE)"
        else:
            x = f"CAST(CAST({c} AS INTEGER) AS DOUBLE)" if t == "boolean" else f"CAST({c} AS DOUBLE)"
            mn, mx, mean = f"min({x})", f"max({x})", significant_sql(f"avg({x})")
        parts.append(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
            f"count(*) - count({c}) AS n_nulls, count(DISTINCT {c}) AS n_distinct, "
            f"{mn} AS min_value, {mx} AS max_value, {mean} AS mean_value FROM {table}")
    return wrap(_union(parts))


def _profile(df: DataFrame, columns: list[str], reread: bool = False) -> DataFrame:
    return P.data_profile(df, columns, exact_distinct=True, reread=reread).withColumn("mean_value", significant("mean_value"))


@register("data_profile", _profile_sql())
def q_data_profile(spark, sf_dir):
    return _profile(_ts(spark, sf_dir), list(TRAINING_TYPES))


@register("data_profile_approx")
def q_data_profile_approx(spark, sf_dir):
    """Scale mode: HyperLogLog++ distinct counts (rows-only check)."""
    return P.data_profile(_ts(spark, sf_dir), list(TRAINING_TYPES))


@register("data_profile_approx_check", with_features(_union(
    [f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, true AS within_bound "
     f"FROM demographic_service" for c in TRAINING_TYPES])))
def q_data_profile_approx_check(spark, sf_dir):
    """The estimates against the exact counts: within four standard errors (rsd 0.05)."""
    ts = _ts(spark, sf_dir)
    exact = P.data_profile(ts, list(TRAINING_TYPES), exact_distinct=True).select(
        "column_name", F.col("n_distinct").alias("exact"))
    off = F.abs(F.col("n_distinct") - F.col("exact"))
    return P.data_profile(ts, list(TRAINING_TYPES)).join(exact, "column_name").select(
        "column_name", "n_rows", "n_nulls", (off <= F.greatest(F.lit(1.0), F.col("exact") * 0.2)).alias("within_bound"))


HIST_COLUMNS = NUMERIC_FEATURES


def _hist_sql(bins: int = 10, cols=HIST_COLUMNS, table: str = "demographic_service",
              wrap=with_features) -> str:
    long = _union([f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value "
                   f"FROM {table}" for c in cols])
    return wrap(f"""SELECT column_name, bin, lo + bin * ((hi - lo) / {bins}e0) AS lower,
  lo + (bin + 1) * ((hi - lo) / {bins}e0) AS upper, count(*) AS n
FROM (
  SELECT l.column_name, b.lo, b.hi,
    CAST(CASE WHEN b.hi = b.lo THEN 0
         ELSE least(floor((l.value - b.lo) / (b.hi - b.lo) * {bins}e0), {bins - 1}) END AS BIGINT) AS bin
  FROM ({long}) l
  JOIN (SELECT column_name, min(value) AS lo, max(value) AS hi FROM ({long}) x
        WHERE value IS NOT NULL GROUP BY column_name) b USING (column_name)
  WHERE l.value IS NOT NULL) t
GROUP BY column_name, bin, lo, hi""")


@register("histogram", _hist_sql())
def q_histogram(spark, sf_dir):
    return P.histogram(_ts(spark, sf_dir), HIST_COLUMNS, bins=10)


TOP_COLUMNS = CATEGORICAL_FEATURES + BOOLEAN_FEATURES


def _long_text_sql(cols) -> str:
    return _union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value "
                   f"FROM demographic_service" for c in cols])


@register("top_values", with_features(f"""SELECT column_name, value, n, rank FROM (
  SELECT column_name, value, n,
    CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank
  FROM (SELECT column_name, value, count(*) AS n FROM ({_long_text_sql(TOP_COLUMNS)}) l
        WHERE value IS NOT NULL GROUP BY column_name, value) c) r
WHERE rank <= 5"""))
def q_top_values(spark, sf_dir):
    return P.top_values(_ts(spark, sf_dir), TOP_COLUMNS, k=5)


@register("category_vocabulary", with_features(f"""SELECT column_name, value,
  CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS index
FROM (SELECT DISTINCT column_name, value FROM ({_long_text_sql(CATEGORICAL_FEATURES)}) l
      WHERE value IS NOT NULL) d"""))
def q_category_vocabulary(spark, sf_dir):
    return P.category_vocabulary(_ts(spark, sf_dir), CATEGORICAL_FEATURES)


# --------------------------------------------------------------------------
# Imputation and scaling

@register("impute_mean", with_features(
    "SELECT customerID, " + ", ".join(
        significant_sql(f"COALESCE(CAST({c} AS DOUBLE), (SELECT avg(CAST({c} AS DOUBLE)) FROM demographic_service))")
        + f" AS {c}" for c in NUMERIC_FEATURES)
    + " FROM demographic_service"))
def q_impute_mean(spark, sf_dir):
    ts = _ts(spark, sf_dir).select(KEY, *NUMERIC_FEATURES)
    return impute_columns(ts, NUMERIC_FEATURES, "mean").select(KEY, *[significant(c).alias(c) for c in NUMERIC_FEATURES])


def _mode_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"(SELECT v FROM (SELECT {x} AS v, count(*) AS n FROM demographic_service "
            f"WHERE {c} IS NOT NULL GROUP BY v) ORDER BY n DESC, v LIMIT 1)")


@register("impute_mode", with_features(
    "SELECT customerID, " + ", ".join(
        f"COALESCE(CAST({c} AS DOUBLE), {_mode_sql(c)}) AS {c}" for c in BOOLEAN_FEATURES)
    + " FROM demographic_service"))
def q_impute_mode(spark, sf_dir):
    ts = _ts(spark, sf_dir).select(KEY, *BOOLEAN_FEATURES)
    return impute_columns(ts, BOOLEAN_FEATURES, "mode")


def _std_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    m = f"(SELECT avg({x}) FROM demographic_service)"
    s = f"(SELECT stddev_pop({x}) FROM demographic_service)"
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN {s} = 0 THEN 0e0 ELSE {decimals_sql(f'({x} - {m}) / {s}')} END AS {c}"


@register("standardise", with_features(
    "SELECT customerID, " + ", ".join(_std_sql(c) for c in NUMERIC_FEATURES)
    + " FROM demographic_service"))
def q_standardise(spark, sf_dir):
    ts = _ts(spark, sf_dir).select(KEY, *NUMERIC_FEATURES)
    return standardise_columns(ts, NUMERIC_FEATURES, population=True).select(
        KEY, *[decimals(c).alias(c) for c in NUMERIC_FEATURES])


# --------------------------------------------------------------------------
# Metrics on fixed scores: a transparent scorecard, p = (options + w) / (6 + 2w)

def scorecard(df: DataFrame, weight: float = 1.0) -> DataFrame:
    p = (F.col("NumOptionalServices") + F.lit(weight)) / F.lit(6.0 + 2.0 * weight)
    return df.withColumns({"p_churn": p,
                           "prediction": F.when(p > 0.5, F.lit(1)).otherwise(F.lit(0))})


_SCORE_SQL = "((NumOptionalServices + {w}e0) / ({d}e0))"


def _p_sql(w: float) -> str:
    return _SCORE_SQL.format(w=repr(float(w)), d=repr(6.0 + 2.0 * float(w)))


def _logloss_sql(p: str) -> str:
    pc = f"least(greatest({p}, 1e-15), 1e0 - 1e-15)"
    return significant_sql(f"avg(-ln(CASE WHEN Churn = 1 THEN {pc} ELSE 1e0 - {pc} END))")


def _acc_sql(p: str) -> str:
    return significant_sql(f"avg(CASE WHEN CAST(CASE WHEN {p} > 0.5 THEN 1 ELSE 0 END AS DOUBLE) = "
            f"CAST(Churn AS DOUBLE) THEN 1e0 ELSE 0e0 END)")


@register("metric_accuracy", with_features(
    f"SELECT PaymentMethod AS segment, count(*) AS n_rows, {_acc_sql(_p_sql(1.0))} AS accuracy "
    "FROM demographic_service GROUP BY ROLLUP (PaymentMethod)"))
def q_metric_accuracy(spark, sf_dir):
    s = scorecard(_ts(spark, sf_dir), 1.0)
    return s.rollup(F.col("PaymentMethod").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_rows"), significant(accuracy(LABEL, "prediction")).alias("accuracy"))


@register("metric_log_loss", with_features(
    f"SELECT PaymentMethod AS segment, count(*) AS n_rows, {_logloss_sql(_p_sql(1.0))} AS log_loss "
    "FROM demographic_service GROUP BY ROLLUP (PaymentMethod)"))
def q_metric_log_loss(spark, sf_dir):
    s = scorecard(_ts(spark, sf_dir), 1.0)
    return s.rollup(F.col("PaymentMethod").alias("segment")).agg(
        F.count(F.lit(1)).alias("n_rows"), significant(log_loss(LABEL, "p_churn")).alias("log_loss"))


# Fixed trials: the seeded draws of the search space; trial t scores with the
# scorecard whose smoothing weight is its min_child_weight draw.
_DRAWS = draw_params()
_WEIGHTS = [d["min_child_weight"] for d in _DRAWS]


def fixed_trials(spark, sf_dir) -> DataFrame:
    ts = _ts(spark, sf_dir)
    trials = F.array(*[F.struct(F.lit(i).alias("trial_id"), F.lit(float(w)).alias("w"))
                       for i, w in enumerate(_WEIGHTS)])
    x = ts.select(LABEL, "NumOptionalServices", F.explode(trials).alias("t")).select(
        LABEL, "NumOptionalServices", "t.trial_id", "t.w")
    p = (F.col("NumOptionalServices") + F.col("w")) / (F.lit(6.0) + F.lit(2.0) * F.col("w"))
    x = x.withColumns({"p_churn": p, "prediction": F.when(p > 0.5, F.lit(1)).otherwise(F.lit(0))})
    return x.groupBy("trial_id", F.col("w").alias("min_child_weight")).agg(
        significant(log_loss(LABEL, "p_churn")).alias("log_loss"), significant(accuracy(LABEL, "prediction")).alias("accuracy"))


def _fixed_trials_sql() -> str:
    parts = [f"SELECT {i} AS trial_id, {float(w)!r}e0 AS min_child_weight, "
             f"{_logloss_sql(_p_sql(w))} AS log_loss, {_acc_sql(_p_sql(w))} AS accuracy "
             f"FROM demographic_service" for i, w in enumerate(_WEIGHTS)]
    return _union(parts)


@register("best_trial", with_features(
    f"SELECT * FROM ({_fixed_trials_sql()}) t ORDER BY log_loss, trial_id LIMIT 1"))
def q_best_trial(spark, sf_dir):
    return best_trial(fixed_trials(spark, sf_dir))


@register("promotion_gate", with_features(
    f"SELECT CAST(trial_id AS VARCHAR) AS model, 'accuracy' AS metric, accuracy AS value, "
    f"{ACCURACY_GATE}e0 AS threshold, COALESCE(accuracy >= {ACCURACY_GATE}e0, false) AS passed "
    f"FROM ({_fixed_trials_sql()}) t"))
def q_promotion_gate(spark, sf_dir):
    t = fixed_trials(spark, sf_dir).withColumn("model", F.col("trial_id").cast("string"))
    return promotion_gate(t, "accuracy", ACCURACY_GATE)


# --------------------------------------------------------------------------
# Group difference (on numeric feature values: churners, Male vs not)

@register("group_difference", with_features(
    "SELECT feature, count(CASE WHEN g THEN 1 END) AS n_in_group, "
    "count(CASE WHEN NOT g THEN 1 END) AS n_out_group, " + decimals_sql("avg(CASE WHEN g THEN v END) - avg(CASE WHEN NOT g THEN v END)", 6) + " AS difference FROM ("
    + _union([f"SELECT customerID, '{c}' AS feature, CAST({c} AS DOUBLE) AS v, gender = 'Male' AS g "
              f"FROM demographic_service WHERE Churn = 1" for c in NUMERIC_FEATURES])
    + ") l GROUP BY feature"))
def q_group_difference(spark, sf_dir):
    churners = _ts(spark, sf_dir).filter(F.col(LABEL) == 1)
    long = churners.select(KEY, *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]) \
        .unpivot([KEY], NUMERIC_FEATURES, "feature", "phi")
    groups = churners.select(KEY, (F.col("gender") == "Male").alias("is_male"))
    return X.group_difference(long, KEY, groups, "is_male").withColumn("difference", decimals("difference", 6))


__all__ = ["scorecard", "fixed_trials"]


# Whole-table profiling of the largest input table.
LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double",
    "l_tax": "double", "l_returnflag": "string", "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"]
LINEITEM_STRINGS = ["l_returnflag", "l_linestatus"]


def _plain(sql: str) -> str:
    return sql


@register("lineitem_profile", _profile_sql(LINEITEM_TYPES, "lineitem", _plain))
def q_lineitem_profile(spark, sf_dir):
    return _profile(tbl(spark, sf_dir, "lineitem"), list(LINEITEM_TYPES), reread=True)


@register("lineitem_histogram", _hist_sql(10, LINEITEM_NUMERIC, "lineitem", _plain))
def q_lineitem_histogram(spark, sf_dir):
    return P.histogram(tbl(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC, bins=10)


@register("lineitem_summary", "WITH li AS (SELECT * FROM lineitem)" + _summary_sql("li", LINEITEM_NUMERIC, LINEITEM_STRINGS))
def q_lineitem_summary(spark, sf_dir):
    return _summary(tbl(spark, sf_dir, "lineitem"), LINEITEM_NUMERIC + LINEITEM_STRINGS, reread=True)


# Favourites of columns with few and with many values; ranks of a column of all keys.
HEAVY_COLUMNS = ["l_returnflag", "l_linenumber", "l_suppkey", "l_partkey", "l_orderkey"]


@register("heavy_values", f"""SELECT column_name, value, n, rank FROM (
  SELECT column_name, value, n, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INTEGER) AS rank
  FROM (SELECT column_name, value, count(*) AS n FROM ({_union([
      f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lineitem" for c in HEAVY_COLUMNS])}) l
    WHERE value IS NOT NULL GROUP BY column_name, value) c) r WHERE rank <= 10""")
def q_heavy_values(spark, sf_dir):
    return P.heavy_values(tbl(spark, sf_dir, "lineitem"), HEAVY_COLUMNS, k=10)


KEY_COLUMNS = ["o_orderkey", "o_custkey", "o_orderpriority"]


@register("key_vocabulary", f"""SELECT column_name, value,
  CAST(row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS INTEGER) AS index
FROM (SELECT DISTINCT column_name, value FROM ({_union([
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM orders" for c in KEY_COLUMNS])}) l
  WHERE value IS NOT NULL) d""")
def q_key_vocabulary(spark, sf_dir):
    return P.category_vocabulary(tbl(spark, sf_dir, "orders"), KEY_COLUMNS)
