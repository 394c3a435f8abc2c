"""Column expressions used to standardise raw customer rows.

All of these are built-in Spark expressions, so they stay inside whole-stage
code generation. The single pandas UDF (``num_optional_services_udf``) exists
only to check the native form against the vectorised Python form.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the reference's for equal results.
# Column groups and category codes of the customer-churn data set.
DEMOGRAPHIC_COLUMNS = ["customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "Churn"]
NON_SERVICE_COLUMNS = ["gender", "SeniorCitizen", "Partner", "Dependents", "Churn"]
YES_NO_COLUMNS = ["Partner", "Dependents", "PhoneService", "PaperlessBilling"]
OPTIONAL_SERVICE_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport",
                            "StreamingTV", "StreamingMovies"]
CONTRACT_MONTHS = {"Month-to-month": 1, "One year": 12, "Two year": 24}
YES = "Yes"
# ---------------------------------------------------------------------------

# Category used where a missing categorical value is imputed with a constant.
# MLlib's one-hot encoder cannot name an empty category, so no "" here.
MISSING_CATEGORY = "__missing__"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_to_bool(c: str | Column, true_value: int = 1) -> Column:
    """0/1 flag to boolean; null stays null."""
    return _c(c) == F.lit(true_value)


def yes_no_to_bool(c: str | Column) -> Column:
    """"Yes" -> true, any other value -> false, null -> null."""
    return _c(c) == F.lit(YES)


def label_binarise(c: str | Column, positive: str = YES) -> Column:
    """Positive label -> 1, anything else including null -> 0 (int)."""
    return F.when(_c(c) == F.lit(positive), F.lit(1)).otherwise(F.lit(0))


def category_to_number(c: str | Column, mapping: Mapping[str, int] = CONTRACT_MONTHS) -> Column:
    """Chained ``when`` without ``otherwise``: unmatched values become null."""
    col = _c(c)
    items = list(mapping.items())
    expr = F.when(col == F.lit(items[0][0]), F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(col == F.lit(k), F.lit(v))
    return expr


def blank_to_null_cast(c: str | Column, to: str = "double") -> Column:
    """Blank (empty or whitespace) -> null, else cast.

    The guard keeps the cast from ever seeing a blank, which under ANSI mode
    would raise; ``CASE WHEN`` only evaluates the branch it takes.
    """
    col = _c(c)
    return F.when(F.length(F.trim(col)) == 0, F.lit(None)).otherwise(col.cast(to))


def coerce_numeric(c: str | Column, to: str = "double") -> Column:
    """Lenient cast: anything that does not parse becomes null."""
    return F.try_cast(_c(c), to) if hasattr(F, "try_cast") else _c(c).try_cast(to)


def count_equal(cols: Iterable[str | Column], value: str = YES) -> Column:
    """Number of columns equal to ``value`` (null counts as not equal), int."""
    terms = [F.when(_c(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0)) for c in cols]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def num_optional_services(cols: Iterable[str | Column] = OPTIONAL_SERVICE_COLUMNS) -> Column:
    """Count of enabled optional services, native form."""
    return count_equal(cols, YES)


@F.pandas_udf(T.IntegerType())
def num_optional_services_udf(*cols: pd.Series) -> pd.Series:
    """Vectorised (Arrow) form of the same count, kept for parity checks."""
    total = None
    for s in cols:
        t = (s == YES).astype("int32")
        total = t if total is None else total + t
    return total


def guarded_ratio_difference(minuend: str | Column, numerator: str | Column,
                             denominator: str | Column, default: float = 0.0) -> Column:
    """``minuend - numerator / denominator`` when denominator > 0, else default.

    Null denominators also take the default (the condition is not true).
    """
    d = _c(denominator)
    return F.when(d > 0, _c(minuend) - _c(numerator) / d).otherwise(F.lit(default))


def avg_price_increase(monthly: str = "MonthlyCharges", total: str = "TotalCharges",
                       tenure: str = "tenure") -> Column:
    """Current monthly charge minus the historical average per month."""
    return guarded_ratio_difference(monthly, total, tenure, 0.0)


def impute_constant(c: str | Column, value: str = MISSING_CATEGORY) -> Column:
    """Constant imputation for categorical columns."""
    return F.coalesce(_c(c), F.lit(value))
