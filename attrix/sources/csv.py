"""CSV source and sink.

The reader takes an explicit schema by default: inference costs an extra job
over the whole file and types a numeric column with blanks as string. Pass
``infer=True`` to get the inferring behaviour of a quick exploration.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Schema of the raw customer file (column order of the public file).
RAW_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customerID", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("SeniorCitizen", T.IntegerType()),
    T.StructField("Partner", T.StringType()),
    T.StructField("Dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("PhoneService", T.StringType()),
    T.StructField("MultipleLines", T.StringType()),
    T.StructField("InternetService", T.StringType()),
    T.StructField("OnlineSecurity", T.StringType()),
    T.StructField("OnlineBackup", T.StringType()),
    T.StructField("DeviceProtection", T.StringType()),
    T.StructField("TechSupport", T.StringType()),
    T.StructField("StreamingTV", T.StringType()),
    T.StructField("StreamingMovies", T.StringType()),
    T.StructField("Contract", T.StringType()),
    T.StructField("PaperlessBilling", T.StringType()),
    T.StructField("PaymentMethod", T.StringType()),
    T.StructField("MonthlyCharges", T.DoubleType()),
    T.StructField("TotalCharges", T.StringType()),
    T.StructField("Churn", T.StringType()),
])

_TS_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False, header: bool = True, **options: str) -> DataFrame:
    r = spark.read.format("csv").option("header", header)
    r = r.option("timestampNTZFormat", _TS_NTZ)
    r = r.option("enforceSchema", False)  # a header that does not match the schema is an error
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> None:
    """Write CSV; microsecond timestamps (default cuts to millis) and blanks around values are kept."""
    (df.write.mode(mode).option("header", header)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .option("timestampNTZFormat", _TS_NTZ)
       .csv(path))
