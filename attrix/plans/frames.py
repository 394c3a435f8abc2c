"""The reference's data flow as lazily composed DataFrames.

raw telco rows -> standardised -> ``demographic`` + ``service_features`` ->
training set (``demographic`` left-joined to the features by key).

Nothing here runs a job; each function only extends the logical plan, so
Catalyst prunes columns into the scans, pushes filters, and picks the join
strategy for whatever a caller finally selects.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from attrix.operators.lookup import FeatureLookup, create_training_set
from attrix.operators.service import compute_service_features
from attrix.operators.standardise import demographic, standardise_customers
from attrix.sources.synthetic import table, telco_raw

KEY = "customerID"
LABEL = "Churn"


@dataclass
class Frames:
    raw: DataFrame
    telco: DataFrame
    demographic: DataFrame
    service_features: DataFrame

    def training_set(self, label: str | None = None, keep_key: bool = True) -> DataFrame:
        ts = create_training_set(self.demographic,
                                 [FeatureLookup(lookup_key=KEY, df=self.service_features)],
                                 label=label, exclude_columns=KEY)
        return ts.load_df(keep_keys=keep_key)


def frames(spark: SparkSession, sf_dir: str) -> Frames:
    raw = telco_raw(spark, sf_dir)
    telco = standardise_customers(raw)
    return Frames(raw, telco, demographic(telco), compute_service_features(telco))


def tbl(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)
