"""Rounding for comparisons of floating-point results.

Sums of doubles depend on the order in which partial sums meet, so two engines
(or two partitionings) agree to about 12 digits, not to the last bit. Queries
that report such figures round them here, with the same arithmetic in Spark and
in SQL. The cut between two results lies off the round decimals (0.3719 instead
of one half), so a figure like 12.5 never sits on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 0.3719


def significant(c: str | Column, digits: int = 9) -> Column:
    """``c`` as a double of ``digits`` significant digits; null, NaN, zero and infinities stay."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    special = (x == 0) | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(special, x).otherwise(F.floor(x * scale + F.lit(SHIFT)) / scale)


def decimals(c: str | Column, digits: int = 9) -> Column:
    """``c`` as a double of ``digits`` decimals, for figures around zero."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = F.lit(float(10 ** digits))
    return F.floor(x * scale + F.lit(SHIFT)) / scale


def significant_sql(expr: str, digits: int = 9) -> str:
    """``significant`` as DuckDB SQL text."""
    x = f"CAST(({expr}) AS DOUBLE)"
    scale = f"pow(10e0, {digits - 1} - floor(log10(nullif(abs({x}), 0e0))))"
    return (f"(CASE WHEN {x} = 0 OR isnan({x}) OR isinf({x}) THEN {x} "
            f"ELSE floor({x} * {scale} + {SHIFT}e0) / {scale} END)")


def decimals_sql(expr: str, digits: int = 9) -> str:
    """``decimals`` as DuckDB SQL text."""
    return f"(floor(CAST(({expr}) AS DOUBLE) * {10 ** digits}e0 + {SHIFT}e0) / {10 ** digits}e0)"
