"""Keyed service features computed from standardised customer rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from attrix.functions.columns import (
    NON_SERVICE_COLUMNS,
    OPTIONAL_SERVICE_COLUMNS,
    avg_price_increase,
    num_optional_services,
    num_optional_services_udf,
)


def select_except(df: DataFrame, excluded: Iterable[str]) -> DataFrame:
    """All columns except ``excluded``, in their original order."""
    skip = set(excluded)
    return df.select(*[c for c in df.columns if c not in skip])


def compute_service_features(
    df: DataFrame,
    excluded: Iterable[str] = NON_SERVICE_COLUMNS,
    option_columns: Iterable[str] = OPTIONAL_SERVICE_COLUMNS,
    use_pandas_udf: bool = False,
) -> DataFrame:
    """Service columns + ``NumOptionalServices`` + ``AvgPriceIncrease``.

    Blank totals are filled with 0.0 *before* the ratio, so a customer with a
    blank total and positive tenure gets the full monthly charge as increase.
    The option count is a native sum of ``CASE`` terms by default; the
    Arrow-batched pandas UDF gives the same numbers but breaks codegen.
    """
    opts = list(option_columns)
    count = num_optional_services_udf(*opts) if use_pandas_udf else num_optional_services(opts)
    return (select_except(df, excluded)
            .fillna({"TotalCharges": 0.0})
            .withColumns({"NumOptionalServices": count,
                          "AvgPriceIncrease": avg_price_increase()}))
