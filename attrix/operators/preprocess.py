"""Column-wise preprocessing: imputation, scaling, and the MLlib feature
pipeline that turns the three column groups into one dense vector.

The model pipeline mirrors the reference's column transformer:

  boolean      cast to double -> most-frequent imputation -> one-hot (both levels)
  numeric      lenient cast to double -> mean imputation
  categorical  constant imputation -> alphabetical index (unseen -> extra
               index) -> one-hot dropping that extra slot, so an unseen
               category encodes as all zeros
  then         assemble -> standardise (mean 0, unit population variance)

A null or empty category is the missing category.

Fitting it runs a handful of aggregation jobs (means, modes, vocabularies,
moments); transforming is a per-row projection. Nothing is collected except
the fitted parameters themselves (means, vocabularies).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator, Transformer
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    OneHotEncoderModel,
    SQLTransformer,
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrix.functions.columns import MISSING_CATEGORY

# ---------------------------------------------------------------------------
# The reference's model input groups.
BOOLEAN_FEATURES = ["Dependents", "PaperlessBilling", "Partner", "PhoneService", "SeniorCitizen"]
NUMERIC_FEATURES = ["AvgPriceIncrease", "Contract", "MonthlyCharges", "NumOptionalServices",
                    "TotalCharges", "tenure"]
CATEGORICAL_FEATURES = ["DeviceProtection", "InternetService", "MultipleLines", "OnlineBackup",
                        "OnlineSecurity", "PaymentMethod", "StreamingMovies", "StreamingTV",
                        "TechSupport", "gender"]
# ---------------------------------------------------------------------------


def standardise_columns(df: DataFrame, columns: Sequence[str], population: bool = True) -> DataFrame:
    """(x - mean) / stddev per column; a constant column becomes 0.0.

    ``population=True`` divides by the population deviation (as scikit-learn
    does), else by the sample deviation. Fitting is one aggregation job that
    returns one row of per-column moments, inlined as literals.
    """
    cols = list(columns)
    xs = [F.col(c).cast("double") for c in cols]
    spread = F.stddev_pop if population else F.stddev_samp
    one = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(xs)],
                 *[spread(x).alias(f"s{i}") for i, x in enumerate(xs)]).first()
    changes = {}
    for i, c in enumerate(cols):
        m, s = one[f"m{i}"], one[f"s{i}"]
        if s is None:
            changes[c] = F.lit(None).cast("double")
        elif s == 0:
            changes[c] = F.when(xs[i].isNotNull(), F.lit(0.0))
        else:
            changes[c] = (xs[i] - F.lit(m)) / F.lit(s)
    return df.withColumns(changes)


def impute_columns(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Fill nulls per column with its mean or most frequent value, as plain
    DataFrame expressions (cast to double, like MLlib's ``Imputer``).

    Fitting is one job returning one value per column: means, or for ``mode`` a grouped count of (column, value) pairs (map-side combined)
    and the top value per column (ties: the smaller value).
    """
    cols = list(columns)
    if strategy == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"f{i}") for i, c in enumerate(cols)]).first()
        fills = {c: row[f"f{i}"] for i, c in enumerate(cols)}
    elif strategy == "mode":
        long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
            [], cols, "column_name", "v").filter(F.col("v").isNotNull())
        counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n"))
        w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("v"))
        top = counts.withColumn("r", F.row_number().over(w)).filter(F.col("r") == 1)
        fills = {r["column_name"]: r["v"] for r in top.select("column_name", "v").collect()}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"),
                                         F.lit(fills.get(c)).cast("double")) for c in cols})


class PopulationScaler(StandardScaler):
    """``StandardScaler`` with the population deviation.

    The fitted model is MLlib's own, rebuilt with its deviations times
    sqrt((n - 1) / n), so it is saved and loaded like any other.
    """

    def __init__(self, inputCol: str, outputCol: str):
        super().__init__(inputCol=inputCol, outputCol=outputCol, withMean=True, withStd=True)

    def _fit(self, dataset: DataFrame) -> StandardScalerModel:
        n = dataset.count()
        model = super()._fit(dataset)
        if n < 2:
            return model
        shrink = ((n - 1) / n) ** 0.5
        jvm = dataset.sparkSession.sparkContext._jvm
        vectors = jvm.org.apache.spark.ml.linalg.Vectors
        gateway = dataset.sparkSession.sparkContext._gateway
        values = gateway.new_array(jvm.double, len(model.std))
        for i, v in enumerate(model.std.toArray()):
            values[i] = float(v) * shrink
        j = jvm.org.apache.spark.ml.feature.StandardScalerModel(model.uid, vectors.dense(values), model._java_obj.mean())
        j.setInputCol(self.getInputCol()).setOutputCol(self.getOutputCol())
        j.set(j.withMean(), True)
        j.set(j.withStd(), True)
        return self._copyValues(StandardScalerModel(j))


def build_feature_pipeline(boolean: Sequence[str] = BOOLEAN_FEATURES,
                           numeric: Sequence[str] = NUMERIC_FEATURES,
                           categorical: Sequence[str] = CATEGORICAL_FEATURES,
                           output_col: str = "features") -> list[Estimator | Transformer]:
    """Stages that map the raw feature columns to one standardised vector."""
    b, n, c = list(boolean), list(numeric), list(categorical)
    casts = ([f"CAST(`{x}` AS DOUBLE) AS `__b_{x}`" for x in b]
             + [f"TRY_CAST(`{x}` AS DOUBLE) AS `__n_{x}`" for x in n]
             + [f"COALESCE(NULLIF(CAST(`{x}` AS STRING), ''), '{MISSING_CATEGORY}') AS `__c_{x}`" for x in c])
    stages: list[Estimator | Transformer] = [
        SQLTransformer(statement=f"SELECT *, {', '.join(casts)} FROM __THIS__")]
    assembled = []
    if b:
        stages.append(Imputer(strategy="mode", inputCols=[f"__b_{x}" for x in b],
                              outputCols=[f"__bi_{x}" for x in b]))
        stages.append(OneHotEncoder(inputCols=[f"__bi_{x}" for x in b],
                                    outputCols=[f"__bo_{x}" for x in b], dropLast=True,
                                    handleInvalid="keep"))
        assembled += [f"__bo_{x}" for x in b]
    if n:
        stages.append(Imputer(strategy="mean", inputCols=[f"__n_{x}" for x in n],
                              outputCols=[f"__ni_{x}" for x in n]))
        assembled += [f"__ni_{x}" for x in n]
    if c:
        stages.append(StringIndexer(inputCols=[f"__c_{x}" for x in c],
                                    outputCols=[f"__ci_{x}" for x in c],
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"__ci_{x}" for x in c],
                                    outputCols=[f"__co_{x}" for x in c], dropLast=True))
        assembled += [f"__co_{x}" for x in c]
    stages.append(VectorAssembler(inputCols=assembled, outputCol="__assembled",
                                  handleInvalid="keep"))
    stages.append(PopulationScaler(inputCol="__assembled", outputCol=output_col))
    return stages


def feature_pipeline(**kw) -> Pipeline:
    return Pipeline(stages=build_feature_pipeline(**kw))


def _wiring(stage) -> tuple:
    """What a stage reads and writes, and what it does with invalid rows."""
    names = [stage.getOrDefault(p) if stage.hasParam(p) and stage.isSet(p) else None
             for p in ("statement", "inputCol", "inputCols", "outputCol", "outputCols")]
    return *names, stage.getOrDefault("handleInvalid") if stage.hasParam("handleInvalid") else None


def slot_features(stages: Sequence[Transformer]) -> list[str] | None:
    """The feature that each slot of the vector comes from; None unless these are the fitted stages of ``build_feature_pipeline``."""
    assembler = next((s for s in stages if isinstance(s, VectorAssembler)), None)
    if assembler is None or not stages[-1].hasParam("outputCol"):
        return None
    inputs = assembler.getInputCols()
    groups = [[c[len(kind):] for c in inputs if c.startswith(kind)] for kind in ("__bo_", "__ni_", "__co_")]
    wanted = build_feature_pipeline(*groups, stages[-1].getOutputCol())
    kinds = [{"PopulationScaler": "StandardScalerModel"}.get(n := type(w).__name__, n if isinstance(w, Transformer) else f"{n}Model") for w in wanted]
    if [type(s).__name__ for s in stages] != kinds or [_wiring(s) for s in stages] != [_wiring(w) for w in wanted]:
        return None
    sizes = {c: 1 for c in inputs}
    for e in (s for s in stages if isinstance(s, OneHotEncoderModel)):
        more = (e.getHandleInvalid() == "keep") - e.getDropLast()
        sizes.update({c: int(n) + more for c, n in zip(e.getOutputCols(), e.categorySizes)})
    owners = [c[len("__bo_"):] for c in inputs for _ in range(sizes[c])]
    return owners if len(owners) == stages[-1].mean.size else None
