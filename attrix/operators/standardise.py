"""Standardise raw customer rows into typed columns.

All replacements go into one ``withColumns`` projection, so the plan is a
single ``Project`` over the scan (no chain of projections to collapse).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from attrix.functions.columns import (
    CONTRACT_MONTHS,
    YES_NO_COLUMNS,
    blank_to_null_cast,
    category_to_number,
    int_to_bool,
    label_binarise,
    yes_no_to_bool,
)


def standardise_customers(
    df: DataFrame,
    flag_columns: Iterable[str] = ("SeniorCitizen",),
    yes_no_columns: Iterable[str] = YES_NO_COLUMNS,
    label: str | None = "Churn",
    ordinal: Mapping[str, Mapping[str, int]] | None = None,
    blank_numeric: Iterable[str] = ("TotalCharges",),
) -> DataFrame:
    """0/1 flags and Yes/No columns to booleans, label to 0/1, ordinal
    categories to numbers (unknown -> null), blank numeric text to null then
    double."""
    ordinal = {"Contract": CONTRACT_MONTHS} if ordinal is None else ordinal
    changes = {}
    for c in flag_columns:
        changes[c] = int_to_bool(c)
    for c in yes_no_columns:
        changes[c] = yes_no_to_bool(c)
    if label:
        changes[label] = label_binarise(label)
    for c, mapping in ordinal.items():
        changes[c] = category_to_number(c, mapping)
    for c in blank_numeric:
        changes[c] = blank_to_null_cast(c, "double")
    return df.withColumns(changes)


def demographic(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """The demographic projection of standardised rows."""
    from attrix.functions.columns import DEMOGRAPHIC_COLUMNS

    return df.select(*(list(columns) if columns is not None else DEMOGRAPHIC_COLUMNS))
