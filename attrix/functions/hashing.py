"""Seeded, engine-independent row hashes.

``md5`` is computed the same way by Spark and by DuckDB, so a hash built from
it gives identical samples and splits in both, and does not depend on how
rows are partitioned (``DataFrame.sample`` does).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_hash32(key: str | Column, seed: int) -> Column:
    """Unsigned 32-bit value from the first 8 hex digits of md5(seed || key); a null key is hashed as empty."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(str(seed)), F.coalesce(k.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def seeded_hash60(key: str | Column, seed: int) -> Column:
    """Unsigned 60-bit value from the first 15 hex digits of md5(seed || key); a null key is hashed as empty."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(str(seed)), F.coalesce(k.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def seeded_hash60_sql(key_sql: str, seed: int) -> str:
    """The same hash as DuckDB SQL text (for oracles)."""
    return (f"CAST(('0x' || substr(md5('{seed}' || coalesce(CAST({key_sql} AS VARCHAR), '')), 1, 15)) AS BIGINT)")


def seeded_hash32_sql(key_sql: str, seed: int) -> str:
    """The same hash as DuckDB SQL text (for oracles)."""
    return f"CAST(('0x' || substr(md5('{seed}' || coalesce(CAST({key_sql} AS VARCHAR), '')), 1, 8)) AS BIGINT)"
