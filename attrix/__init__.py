"""attrix: customer-churn analytics and model lifecycle on Spark.

Layout:
  sources/    reading and writing data: CSV, catalog tables, keyed feature
              tables, model artifacts, and the telco-shaped view derived from
              the synthetic test tables
  functions/  column expressions (standardisation, hashing, metrics)
  operators/  DataFrame and MLlib operators (features, lookups, profiling,
              splitting, preprocessing, models, search, explanations, gate)
  plans/      end-to-end flows and the query registry used by
              ``__spark_entry__``
  streaming/  streaming feature upserts through ``foreachBatch``
"""

__version__ = "0.1.0"
