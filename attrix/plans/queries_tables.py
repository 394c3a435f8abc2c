"""Registered queries: CSV round trip, catalog table writes and reads,
keyed feature tables (overwrite, merge, partial merge).

Each query writes under the shared scratch folder and returns the read-back
table, so the check covers the write path too.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.operators.standardise import standardise_customers
from attrix.plans.catalog import register
from attrix.plans.frames import KEY, frames, tbl
from attrix.plans.oracle import SERVICE_COLUMNS, with_features
from attrix.session import scratch_path
from attrix.sources import csv as CSV
from attrix.sources import features as FT
from attrix.sources import tables as TB
from attrix.streaming.feature_stream import EVENTS_SCHEMA


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("csv_roundtrip", with_features("SELECT * FROM telco"))
def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows -> CSV (blanks kept) -> read with the explicit schema -> standardise."""
    path = scratch_path(spark, "csv_telco")
    raw = frames(spark, sf_dir).raw.withColumn("customerID", F.col("customerID").cast("string"))
    CSV.write_csv(raw, path)
    back = CSV.read_csv(spark, path, schema=CSV.RAW_CUSTOMER_SCHEMA)
    back = back.withColumn("customerID", F.col("customerID").cast("bigint"))
    return standardise_customers(back)


@register("csv_roundtrip_events", "SELECT * FROM events")
def q_csv_roundtrip_events(spark, sf_dir):
    """Microsecond timestamps survive the round trip."""
    path = scratch_path(spark, "csv_events")
    CSV.write_csv(tbl(spark, sf_dir, "events"), path)
    return CSV.read_csv(spark, path, schema=EVENTS_SCHEMA)


@register("table_scan", with_features(
    "SELECT customerID, gender, SeniorCitizen, Partner, Dependents, Churn FROM telco"))
def q_table_scan(spark, sf_dir):
    name = _name("demographic")
    TB.write_table(frames(spark, sf_dir).demographic, name, mode="errorifexists",
                   path=scratch_path(spark, name))
    return TB.read_table(spark, name)


@register("write_new_table", with_features("SELECT * FROM demographic_service"))
def q_write_new_table(spark, sf_dir):
    name = _name("demographic_service")
    ts = frames(spark, sf_dir).training_set()
    TB.write_table(ts, name, mode="errorifexists", path=scratch_path(spark, name))
    return spark.read.table(name)


@register("write_overwrite", with_features("SELECT * FROM demographic_service"))
def q_write_overwrite(spark, sf_dir):
    name = _name("demographic_service")
    path = scratch_path(spark, name)
    ts = frames(spark, sf_dir).training_set()
    TB.write_table(ts.filter(F.col("Churn") == 1), name, mode="errorifexists", path=path)
    TB.write_table(ts, name, mode="overwrite", path=path)
    return spark.read.table(name)


@register("features_overwrite", with_features("SELECT * FROM service_features"))
def q_features_overwrite(spark, sf_dir):
    f = frames(spark, sf_dir)
    name = _name("service_features")
    FT.create_feature_table(spark, name, KEY, schema=f.service_features.schema,
                            description="Telco customer services")
    FT.write_features(spark, name, f.service_features.filter(F.col("tenure") > 0), "overwrite")
    FT.write_features(spark, name, f.service_features, "overwrite")
    return FT.read_features(spark, name)


# Merge scenario: the table holds every segment except AUTOMOBILE; the update
# carries BUILDING and AUTOMOBILE rows with monthly charges raised by 10 %,
# so BUILDING rows are updated and AUTOMOBILE rows inserted.
_OLD = "PaymentMethod <> 'AUTOMOBILE'"
_NEW = "PaymentMethod IN ('AUTOMOBILE', 'BUILDING')"
_RAISE = 1.1


def _updates(sf: DataFrame) -> DataFrame:
    return (sf.filter(F.col("PaymentMethod").isin("AUTOMOBILE", "BUILDING"))
              .withColumn("MonthlyCharges", F.col("MonthlyCharges") * F.lit(_RAISE)))


@register("features_merge", with_features(
    f"SELECT * FROM service_features WHERE {_OLD} AND NOT ({_NEW}) UNION ALL "
    f"SELECT * REPLACE (MonthlyCharges * {_RAISE}e0 AS MonthlyCharges) FROM service_features "
    f"WHERE {_NEW}"))
def q_features_merge(spark, sf_dir):
    sf = frames(spark, sf_dir).service_features
    name = _name("service_features")
    FT.create_feature_table(spark, name, KEY, schema=sf.schema)
    FT.write_features(spark, name, sf.filter(F.col("PaymentMethod") != "AUTOMOBILE"), "merge")
    FT.write_features(spark, name, _updates(sf), "merge")
    return FT.read_features(spark, name)


@register("features_merge_partial", with_features(
    "SELECT " + ", ".join(
        "COALESCE(o.customerID, n.customerID) AS customerID" if c == KEY else
        f"CASE WHEN n.customerID IS NOT NULL THEN n.MonthlyCharges ELSE o.MonthlyCharges END "
        f"AS MonthlyCharges" if c == "MonthlyCharges" else f"o.{c} AS {c}"
        for c in SERVICE_COLUMNS)
    + f" FROM (SELECT * FROM service_features WHERE {_OLD}) o FULL OUTER JOIN "
      f"(SELECT customerID, MonthlyCharges * {_RAISE}e0 AS MonthlyCharges FROM service_features "
      f"WHERE {_NEW}) n ON o.customerID = n.customerID"))
def q_features_merge_partial(spark, sf_dir):
    """The update carries only some feature columns: others keep old values."""
    sf = frames(spark, sf_dir).service_features
    name = _name("service_features")
    FT.create_feature_table(spark, name, KEY, schema=sf.schema)
    FT.write_features(spark, name, sf.filter(F.col("PaymentMethod") != "AUTOMOBILE"), "merge")
    FT.write_features(spark, name, _updates(sf).select(KEY, "MonthlyCharges"), "merge")
    return FT.read_features(spark, name)


_MERGED = with_features(
    f"SELECT * FROM service_features WHERE {_OLD} AND NOT ({_NEW}) UNION ALL "
    f"SELECT * REPLACE (MonthlyCharges * {_RAISE}e0 AS MonthlyCharges) FROM service_features "
    f"WHERE {_NEW}")
MERGE_BUCKETS = 16


def _bucketed(spark, sf: DataFrame) -> str:
    name = _name("service_features")
    FT.create_feature_table(spark, name, KEY, schema=sf.schema, merge_buckets=MERGE_BUCKETS)
    FT.write_features(spark, name, sf.filter(F.col("PaymentMethod") != "AUTOMOBILE"), "merge")
    return name


@register("features_merge_buckets", _MERGED)
def q_features_merge_buckets(spark, sf_dir):
    """The merge into a table under a manifest: only the buckets of the update's keys are rewritten."""
    sf = frames(spark, sf_dir).service_features
    name = _bucketed(spark, sf)
    FT.write_features(spark, name, _updates(sf), "merge")
    return FT.read_features(spark, name)


@register("features_merge_concurrent", _MERGED)
def q_features_merge_concurrent(spark, sf_dir):
    """Two writers merge their halves of the update at the same time; both are kept."""
    sf = frames(spark, sf_dir).service_features
    name = _bucketed(spark, sf)
    halves = [_updates(sf).filter(F.col("PaymentMethod") == p) for p in ("AUTOMOBILE", "BUILDING")]
    with ThreadPoolExecutor(max_workers=2) as pool:
        list(pool.map(lambda half: FT.write_features(spark, name, half, "merge"), halves))
    return FT.read_features(spark, name)


_RICHEST = 100


@register("feature_lookup_few_keys", with_features(
    f"SELECT s.* FROM service_features s JOIN (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT {_RICHEST}) k "
    "ON s.customerID = k.c_custkey"))
def q_feature_lookup_few_keys(spark, sf_dir):
    """A lookup of a few keys (the customers with the highest balance) opens only their buckets."""
    sf = frames(spark, sf_dir).service_features
    name = _name("service_features")
    FT.create_feature_table(spark, name, KEY, schema=sf.schema, merge_buckets=MERGE_BUCKETS)
    FT.write_features(spark, name, sf, "merge")
    keys = (tbl(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(_RICHEST)
            .select(F.col("c_custkey").alias(KEY)))
    return keys.join(FT.read_features(spark, name, for_keys=keys), KEY).select(*sf.columns)


@register("stream_usage_features",
          "SELECT user_id AS customerID, count(*) AS n_events, "
          "CAST(sum(CAST(round(value * 100e0) AS BIGINT)) AS BIGINT) AS cents, "
          "max(value) AS max_value FROM events GROUP BY user_id")
def q_stream_usage_features(spark, sf_dir):
    """Events read as a file stream -> stateful per-user aggregation ->
    micro-batch merges into a keyed feature table -> read back."""
    from attrix.streaming import read_event_stream, upsert_stream, usage_features

    name = _name("usage_features")
    q = upsert_stream(usage_features(read_event_stream(spark, sf_dir, "events.parquet")),
                      name, KEY)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return FT.read_features(spark, name)


@register("lifecycle_tables", with_features(
    "SELECT * EXCLUDE (customerID) FROM demographic_service"))
def q_lifecycle_tables(spark, sf_dir):
    """The reference's setup flow: database -> demographic table -> keyed
    feature table (created, merged) -> joined table written -> read back.
    Both keyed tables are bucketed alike on the key (as many buckets as
    shuffle partitions), so the lookup join runs without a shuffle."""
    from attrix.plans.lifecycle import setup_tables

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = setup_tables(spark, sf_dir, _name("churndb"), buckets=buckets)
    return spark.read.table(names.demographic_service)


@register("score_batch_lookup", with_features(
    "SELECT d.* EXCLUDE (Churn), s.* EXCLUDE (customerID) FROM demographic d "
    "LEFT JOIN service_features s ON d.customerID = s.customerID"))
def q_score_batch_lookup(spark, sf_dir):
    """Join half of scoring by key: caller passes keys + base columns, the
    lookups recorded with the model bring in the features."""
    from attrix.operators.lookup import FeatureLookup, create_training_set
    from attrix.sources.artifacts import lookup_for_scoring, model_meta

    f = frames(spark, sf_dir)
    ts = create_training_set(f.demographic, [FeatureLookup(table="service_features",
                                                           lookup_key=KEY)],
                             label="Churn", exclude_columns=KEY)
    ts.lookups[0] = FeatureLookup(table="service_features", lookup_key=KEY, df=f.service_features)
    meta = model_meta(ts, ts.load_df(keep_keys=True), KEY)
    return lookup_for_scoring(meta, f.demographic.drop("Churn"),
                              {"service_features": f.service_features})


_SHARES = """
SELECT PaymentMethod AS model, greatest(avg(CAST(Churn AS DOUBLE)), 1e0 - avg(CAST(Churn AS DOUBLE))) AS accuracy
FROM demographic_service GROUP BY PaymentMethod"""


@register("model_stages", with_features(f"""SELECT * FROM (
WITH a AS ({_SHARES}), m AS (SELECT avg(accuracy) AS least FROM a)
SELECT model, version, CASE WHEN version = 1 AND accuracy >= least THEN 'Archived' WHEN version = 1 THEN 'Production'
                            WHEN accuracy >= least THEN 'Production' ELSE 'Staging' END AS stage, model || '/' || version AS artifact
FROM a, m, (VALUES (CAST(1 AS INTEGER)), (CAST(2 AS INTEGER))) v(version)) q"""))
def q_model_stages(spark, sf_dir):
    """One model per segment (its majority class): the first version is in production, the second staged, and
    promoted where its accuracy is at least the mean of all, which archives the first."""
    from attrix.sources import stages as ST

    share = F.avg(F.col("Churn").cast("double"))
    models = (frames(spark, sf_dir).training_set().groupBy(F.col("PaymentMethod").alias("model"))
              .agg(F.greatest(share, F.lit(1.0) - share).alias("accuracy")))
    path = scratch_path(spark, "model_stages")
    for version, stage in ((1, ST.PRODUCTION), (2, ST.STAGING)):
        ST.register_versions(spark, path, models.select("model", F.concat("model", F.lit(f"/{version}")).alias("artifact")))
        ST.transition(spark, path, ST.latest_versions(spark, path, [ST.NONE]).select("model", "version"), stage)
    least = models.agg(F.avg("accuracy")).first()[0]
    passed = models.where(F.col("accuracy") >= F.lit(least)).select("model")
    ST.transition(spark, path, ST.latest_versions(spark, path, [ST.STAGING]).join(passed, "model").select("model", "version"), ST.PRODUCTION)
    return ST.current(spark, path)
