"""Profiling: summary statistics, per-column profile, histograms, top values,
category vocabularies.

Each operator is one or two aggregation passes with map-side partial
aggregation; per-column results come in long form, one row per
(column, statistic) or (column, bin/value). Means and deviations are Spark's
own aggregates over doubles, so ids of 64 bits, very large and very small
values and NaN give what ``avg`` and ``stddev`` give.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrix.session import cut_lineage

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)
SUMMARY_STATISTICS = ["count", "mean", "stddev", "min", "25%", "50%", "75%", "max"]
QUARTILES = [0.25, 0.5, 0.75]
# Size k of the sketches that locate quantiles: about 3k entries per column and task.
PERCENTILE_ACCURACY = 8_192
# Rows that one task may rank at the end.
BAND_ROWS = 1 << 20


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


@dataclass
class _Band:
    """One wanted quantile and the values it lies among: position ``rank`` of the ``n`` from ``low`` to ``high``."""
    column: int
    prob: float
    rank: int = 0
    n: int = 0
    low: tuple[float, bool] | None = None   # value, itself inside
    high: tuple[float, bool] | None = None
    edges: tuple[float, float] = (0.0, 0.0)

    def inside(self, x: str) -> str:
        """The condition on the value, as SQL text: one expression instead of many small ones."""
        out = f"{x} IS NOT NULL"
        if self.low is not None:
            out += f" AND {x} {'>=' if self.low[1] else '>'} {_literal(self.low[0])}"
        if self.high is not None:
            out += f" AND {x} {'<=' if self.high[1] else '<'} {_literal(self.high[0])}"
        return f"({out})"


def _literal(v: float | int) -> str:
    return f"CAST('{v!r}' AS {'BIGINT' if isinstance(v, int) else 'DOUBLE'})"


def _value_type(t: T.DataType) -> str:
    """The type in which a column's values are compared: whole numbers and decimals as they are, others as doubles."""
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "bigint"
    return t.simpleString() if isinstance(t, T.DecimalType) else "double"


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES,
                    accuracy: int = PERCENTILE_ACCURACY) -> dict[tuple[str, float], float | int | Decimal | None]:
    """Exact discrete quantiles: the value of rank ceil(p * n) among the
    column's non-null values, for every (column, p), in the column's own type
    (64-bit integers and decimals lose no digit); null for a column without
    values. NaN sorts above every number.

    1. A KLL sketch of bounded size (``accuracy`` is its k) names two values
       around each quantile, and one aggregate counts the rows below and between
       them: a measured bracket, whatever the sketch's luck.
    2. A bracket that still has more than ``BAND_ROWS`` rows is sketched again,
       so it shrinks by its share of the error each time.
    3. The values inside the brackets are counted per distinct value (map-side
       combined), and running counts over at most ``BAND_ROWS`` values find the
       wanted rank. A value that fills the bracket is one row.
    A rank that is not found raises an error. What is collected has one row
    per (column, p).
    """
    cols, ps = list(columns), list(probs)
    out: dict = {(c, p): None for c in cols for p in ps}
    types = {f.name: _value_type(f.dataType) for f in df.schema.fields}
    kinds = [types[c] for c in cols]
    data = df.select(*[F.col(c).cast(t).alias(f"c{i}") for i, (c, t) in enumerate(zip(cols, kinds))])
    keys = [f"c{i}" if t in ("bigint", "double") else f"CAST(c{i} AS DOUBLE)" for i, t in enumerate(kinds)]
    margin = 3 * 2.296 / accuracy ** 0.9021  # thrice the sketch's rank error at 99 %
    open_ = [_Band(i, p) for i in range(len(cols)) for p in ps]
    first, small = True, []
    while open_:
        groups: dict[tuple, list[int]] = {}  # bands over the same rows share one sketch
        for j, b in enumerate(open_):
            groups.setdefault((b.column, b.low, b.high), []).append(j)
        aggs = []
        for g, members in enumerate(groups.values()):
            b = open_[members[0]]
            x, whole = keys[b.column], kinds[b.column] == "bigint"
            within = b.inside(x)
            number = within if whole else f"({within} AND NOT isnan({x}))"
            kind = "bigint" if whole else "double"
            at = [open_[j].prob if first else open_[j].rank / open_[j].n for j in members]
            ends = ", ".join(_literal(float(e)) for t in at for e in (max(0.0, t - margin), min(1.0, t + margin)))
            aggs += [F.expr(f"count(CASE WHEN {within} THEN 1 END) AS n{g}"),
                     F.expr(f"CASE WHEN count(CASE WHEN {number} THEN 1 END) > 0 THEN kll_sketch_get_quantile_{kind}("
                            f"kll_sketch_agg_{kind}(CASE WHEN {number} THEN {x} END, {accuracy}), array({ends})) END AS q{g}")]
        row = data.agg(*aggs).first()
        asked = []
        for g, members in enumerate(groups.values()):
            for m, j in enumerate(members):
                b = open_[j]
                if first:
                    b.n, b.rank = row[f"n{g}"], max(1, math.ceil(b.prob * row[f"n{g}"]))
                if b.n and row[f"q{g}"] is None:
                    out[cols[b.column], b.prob] = math.nan  # nothing but NaN
                elif b.n:
                    b.edges = tuple(row[f"q{g}"][2 * m:2 * m + 2])
                    asked.append(b)
        if not asked:
            break
        counts = data.agg(*[F.expr(f"count(CASE WHEN {b.inside(x)} AND {x} {op} {_literal(edge)} THEN 1 END) AS {name}{j}")
                            for j, b in enumerate(asked) for x in [keys[b.column]]
                            for name, op, edge in (("b", "<", b.edges[0]), ("u", "<=", b.edges[1]))]).first()
        open_, first = [], False
        for j, b in enumerate(asked):
            below, upto, before = counts[f"b{j}"], counts[f"u{j}"], b.n
            if b.rank <= below:
                b.high, b.n = (b.edges[0], False), below
            elif b.rank > upto:
                b.low, b.n, b.rank = (b.edges[1], False), b.n - upto, b.rank - upto
            elif b.edges[0] == b.edges[1] and kinds[b.column] in ("bigint", "double"):
                out[cols[b.column], b.prob] = b.edges[0]
                continue
            else:
                b.low, b.high, b.n, b.rank = (b.edges[0], True), (b.edges[1], True), upto - below, b.rank - below
            (small if b.n <= BAND_ROWS or b.n == before else open_).append(b)
    if not small:
        return out
    fields = {t: f"v{k}" for k, t in enumerate(dict.fromkeys(kinds[b.column] for b in small))}
    parts = []
    for i in dict.fromkeys(b.column for b in small):  # a pass over one column, its range filter pushed to the scan
        here = [(j, b) for j, b in enumerate(small) if b.column == i]
        cells = ", ".join(f"CASE WHEN {b.inside(keys[i])} THEN struct({j} AS band, {b.rank}L AS rank) END" for j, b in here)
        values = [f"{f'c{i}' if t == kinds[i] else f'CAST(NULL AS {t})'} AS {v}" for t, v in fields.items()]
        parts.append(data.where(" OR ".join(b.inside(keys[i]) for _, b in here))
                     .selectExpr(f"explode(array_compact(array({cells}))) AS x", *values).select("x.*", *fields.values()))
    counted = reduce(DataFrame.unionByName, parts).groupBy("band", "rank", *fields.values()).agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("band").orderBy(*fields.values()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("upto", F.sum("n").over(run))
    hits = ranked.where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
    found = {r["band"]: r for r in hits.collect()}  # one row per band
    for j, b in enumerate(small):
        if j not in found:
            raise ValueError(f"no row of rank {b.rank} of {cols[b.column]} in {b.low} .. {b.high}")
        out[cols[b.column], b.prob] = found[j][fields[kinds[b.column]]]
    return out


@contextmanager
def _at_hand(df: DataFrame, reread: bool) -> Iterator[DataFrame]:
    """``df`` for several passes: kept while they run, unless reading it again is cheap (a plain table scan)."""
    data = df if reread else df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        if not reread:
            data.unpersist()


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None, accuracy: int = PERCENTILE_ACCURACY,
                  texts: bool = False, reread: bool = False) -> DataFrame:
    """Long form of ``DataFrame.summary()``: (column_name, statistic, value, text).

    Numeric columns have all statistics as ``value``; string columns have the
    count as ``value`` and min and max as ``text``, and null for the rest.
    Booleans and other types are left out, as in ``summary()``. Min, max and
    quartiles are found in the column's own type; with ``texts`` they come as
    ``text`` too, all digits of 64-bit integers and decimals kept, where
    ``value`` is the nearest double. One aggregate for all but the quartiles,
    then ``exact_quantiles``; ``reread`` says that the frame is a plain scan,
    which is read again rather than persisted.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = list(columns) if columns is not None else df.columns
    numeric = [c for c in cols if isinstance(types[c], NUMERIC_TYPES)]
    strings = [c for c in cols if isinstance(types[c], T.StringType)]
    with _at_hand(df.select(*[F.col(c).cast(_value_type(types[c])).alias(c) for c in numeric], *strings), reread) as data:
        aggs = [F.count(F.lit(1)).alias("rows")]
        for c in numeric + strings:
            aggs += [F.count(c).alias(f"{c} count"), F.min(c).alias(f"{c} min"), F.max(c).alias(f"{c} max")]
        for c in numeric:
            x = F.col(c).cast("double")
            aggs += [F.avg(x).alias(f"{c} mean"), F.stddev_samp(x).alias(f"{c} stddev")]
        one = data.agg(*aggs).first().asDict()
        quartiles = exact_quantiles(data, numeric, QUARTILES, accuracy)
    one |= {f"{c} {round(100 * p)}%": q for (c, p), q in quartiles.items()}
    rows = []
    for c in cols:
        if c in numeric or c in strings:
            for st in SUMMARY_STATISTICS:
                v = one.get(f"{c} {st}")
                shown = isinstance(v, str) or (texts and c in numeric and v is not None and st not in ("mean", "stddev"))
                rows.append((c, st, None if isinstance(v, str) or v is None else float(v), str(v) if shown else None))
    return df.sparkSession.createDataFrame(rows, "column_name string, statistic string, value double, text string")


def data_profile(df: DataFrame, columns: Sequence[str] | None = None, exact_distinct: bool = False,
                 rsd: float = 0.05, reread: bool = False) -> DataFrame:
    """Per column: type, rows, nulls, distinct values, min, max, mean.

    Numeric and boolean columns (booleans as 0/1) get min/max/mean; other types
    get null there. One aggregate over the columns as they are, turned into one
    row per column at the end. Distinct counts are HyperLogLog++ estimates
    (fixed memory per column). ``exact_distinct`` counts them exactly in a second
    pass over single values (column, value), combined per task before they
    shuffle: several distinct counts in one aggregate would copy every row
    whole, once per column. The second pass reads the persisted frame, or with
    ``reread`` (a plain scan) the frame itself.
    """
    cols = list(columns) if columns is not None else df.columns
    types = dict(df.dtypes)
    plain = ("tinyint", "smallint", "int", "bigint", "float", "double")

    def profile(data: DataFrame, distinct: list[Column]) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(cols):
            t = types[c]
            x = (F.col(c).cast("int").cast("double") if t == "boolean" else F.col(c).cast("double")
                 if t in plain or t.startswith("decimal") else F.lit(None).cast("double"))
            aggs += [F.count(c).alias(f"n{i}"), distinct[i].alias(f"d{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.avg(x).alias(f"m{i}")]
        rows = F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("data_type"), F.col("rows").alias("n_rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("n_nulls"), F.col(f"d{i}").alias("n_distinct"),
            F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"), F.col(f"m{i}").alias("mean_value"))
            for i, c in enumerate(cols)])
        return data.agg(*aggs).select(F.inline(rows))

    if not exact_distinct:
        return profile(df, [F.approx_count_distinct(c, rsd) for c in cols])
    kept = [(F.col(c) + F.lit(0.0)).alias(c) if types[c] in ("float", "double") else F.col(c) for c in cols]  # -0.0 is 0.0
    with _at_hand(df.select(*kept), reread) as data:
        out = profile(data, [F.count(c) for c in cols])
        rows = out.collect()  # one row per column
        counts = {r["column_name"]: r["n"] for r in _melt(data, cols).where("value IS NOT NULL").distinct()
                  .groupBy("column_name").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    rows = [tuple(r[:4]) + (counts.get(r[0], 0),) + tuple(r[5:]) for r in rows]
    return df.sparkSession.createDataFrame(rows, out.schema)


def _melt(df: DataFrame, columns: Iterable[str], value_type: str = "string") -> DataFrame:
    cols = list(columns)
    return df.select(*[F.col(c).cast(value_type).alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Fixed-width histogram per numeric column: (column_name, bin, lower,
    upper, n). Bins span [min, max] of each column; the max lands in the last
    bin. Empty bins are not listed.

    Min and max come from one aggregate (a table of one row per column, so
    broadcasting it is bounded by the column count), then one grouped count.
    """
    long = _melt(df, columns, "double").filter(F.col("value").isNotNull())
    bounds = long.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))),
                F.lit(bins - 1))).cast("bigint")
    counted = (long.join(F.broadcast(bounds), "column_name")
                   .withColumn("bin", b)
                   .groupBy("column_name", "bin", "lo", "hi")
                   .agg(F.count(F.lit(1)).alias("n")))
    return counted.select(
        "column_name", "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        "n")


def top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-null values per column (ties by value).

    ``row_number() <= k`` over the grouped counts is planned with a
    per-partition group limit before the shuffle, so each partition sends at
    most ``k`` rows per column however many distinct values there are.
    """
    counts = (_melt(df, columns).filter(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value"))
    return (counts.withColumn("rank", F.row_number().over(w))
                  .filter(F.col("rank") <= k))


def heavy_values(df: DataFrame, columns: Sequence[str], k: int = 5, tracked: int = 1 << 14,
                 most_tracked: int = 1 << 17) -> DataFrame:
    """``top_values``, without shuffling the distinct values of columns that have clear favourites.

    A frequent-items sketch of at most ``tracked`` values per column (fixed
    memory per task) names candidates, and one pass recounts those exactly. A
    value that the sketch may have lost has at most ``_sketch_slack`` rows. If
    the k-th exact count is larger, nothing is missing; otherwise the
    column is sketched again with the size that this count asks for, up to
    ``most_tracked``, and beyond that all its values are counted. Ties are broken by value. At
    most ``tracked`` candidates per column meet on the driver.
    """
    todo, beyond, size, done = list(columns), [], tracked, []
    spark = df.sparkSession
    n = {}
    while todo and size <= most_tracked:
        row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(todo)],
                     *[F.expr(f"approx_top_k(CAST(`{c}` AS STRING), {size}, {size})").alias(f"t{i}") for i, c in enumerate(todo)]).first()
        asked = []
        for i, c in enumerate(todo):
            n[c] = row[f"n{i}"]
            seen = sorted(((r["count"], r["item"]) for r in row[f"t{i}"] or [] if r["item"] is not None), reverse=True)
            # an estimate is above the count by the slack at most
            least = (seen[k - 1][0] if len(seen) >= k else 0) - _sketch_slack(n[c] + _nulls(row[f"t{i}"]), size)
            asked += [(c, v) for est, v in seen if est >= least]
        candidates = spark.createDataFrame(asked, "column_name string, value string")
        counted = (_melt(df, todo).join(F.broadcast(candidates), ["column_name", "value"])  # at most size x columns rows
                   .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")).collect())
        again, wanted = [], size
        for i, c in enumerate(todo):
            here = [r for r in counted if r["column_name"] == c]
            best = sorted((-r["n"], r["value"].encode(), r["value"]) for r in here)[:k]
            lost = _sketch_slack(n[c] + _nulls(row[f"t{i}"]), size)
            if sum(r["n"] for r in here) == n[c] or (len(best) == k and -best[-1][0] > lost):
                done += [(c, v, -m, j + 1) for j, (m, _, v) in enumerate(best)]
                continue
            # the size at which the k-th count found would have been enough
            need = 1 << math.ceil(math.log2(size * lost / max(1, -best[-1][0] - 1))) + 1 if len(best) == k else most_tracked + 1
            (again if need <= most_tracked else beyond).append(c)
            wanted = max(wanted, min(need, most_tracked))
        todo, size = again, max(2 * size, wanted)
    beyond += todo
    found = spark.createDataFrame(done, "column_name string, value string, n bigint, rank int")
    return found.unionByName(top_values(df, beyond, k)) if beyond else found


def _sketch_slack(rows: int, tracked: int) -> float:
    """Rows a value may have and be missing among the sketch's sure items: twice its error of 3.5 / size."""
    return 2 * 3.5 * rows / (1 << (tracked.bit_length() - 1))


def _nulls(items) -> int:
    return sum(r["count"] for r in items or [] if r["item"] is None)


def category_vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, its distinct non-null values with the index an
    alphabetically ordered ``StringIndexer`` gives them (0-based).

    Distinct values are found with map-side combining and exchanged by range, so
    each partition holds a stretch of the order. They are checkpointed with their
    partition's number, since a range exchange samples and may cut elsewhere when
    repeated. A value's index is the number of its column's values in earlier
    partitions plus its place in its own: no task ranks a whole column.
    """
    vals = (_melt(df, columns).filter(F.col("value").isNotNull()).distinct()
            .repartitionByRange("column_name", "value").withColumn("part", F.spark_partition_id()))
    vals = cut_lineage(vals)
    earlier = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (vals.groupBy("column_name", "part").agg(F.count(F.lit(1)).alias("n"))
            .select("column_name", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")))
    w = Window.partitionBy("column_name", "part").orderBy("value")
    return (vals.withColumn("place", F.row_number().over(w)).join(base, ["column_name", "part"])
            .select("column_name", "value", (F.col("base") + F.col("place") - 1).cast("int").alias("index")))
