"""Mix sources to target weights by subset-sum budget fitting.

1. Every source gets a target: a share of all words by weight, at most ``repeats``
   times the words it has; what is above goes to the others by weight.
2. A source's documents are taken whole, ``floor(target / words)`` times each. The
   rest of the target is a budget for one copy more of some of them.
3. The budget is fitted over the source's histogram of exact document lengths: an
   equal share of every length, then single documents until the rest is within
   ``WINDOW`` words, and a bounded-knapsack table for that rest.
4. Of the documents of a source and length, the fitted number is chosen by seeded
   hash of ``doc_id``.

The histogram has at most one row per source and length, so the knapsack sees
lengths and counts, never documents. Choosing needs no ranking of a whole length:
hash buckets of about ``BUCKET`` documents are in or out as a whole, and only the
one that the number falls into is ranked.

Rows: a null or empty text has size 0 and is taken 0 words. A null source is a
source of its own, after all others. Rows that share source, size and doc_id (null
included) are interchangeable: the mix decides how many of them it takes once more.
Extra columns are ignored. An empty table gives no rows. The result depends on the
rows and the seed only, not on files, partitions or reruns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrix.llm.common import stored

#: a run of anything but blanks (space, tab to carriage return)
WORD = r"[^\x20\x09-\x0D]+"
#: words that the knapsack table spans
WINDOW = 1 << 16
#: documents of one hash bucket, on average
BUCKET = 1024


def document_sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the number of words of each whole text."""
    return docs.select("doc_id", "source",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2),
                   repeats: int = 2) -> DataFrame:
    """(sid, source, source_size, target) per source.

    Sources in code point order (null last) get ``weights`` in turn. Targets are
    ``share`` (numerator, denominator) of all words by weight, at most ``repeats``
    times the source's own, the excess shared out again until none is above. Only sums leave the
    executors: the level is the same for all sources that are not at their bound.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    last = F.col("source").isNull()
    at = stored(per.repartitionByRange(last, "source").sortWithinPartitions(last, "source")
                .select("*", F.monotonically_increasing_id().alias("at")), "mix-sources")
    part = F.shiftright("at", 33)
    counts = at.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the sources
    starts = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    ranked = (at.withColumn("part", part).join(starts, "part")
              .select((F.col("start") + F.col("at") - F.shiftleft("part", 33)).alias("sid"), "source", "source_size"))
    turn = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]),
                        (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = stored(ranked.select("*", turn.alias("weight"),
                                  (F.col("source_size") * repeats).alias("bound")), "mix-ranked")
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    up, down = share
    held, left = 0, weight or 0
    while True:
        # level of the sources below their bound: (up/down * total - held) / left words a unit of weight
        num, den = up * (total or 0) - down * held, down * (left or 1)
        above = (F.col("bound").cast("decimal(38,0)") * F.lit(den).cast("decimal(18,0)")
                 < F.col("weight").cast("decimal(18,0)") * F.lit(num).cast("decimal(20,0)"))
        now_held, now_left = ranked.agg(F.sum(F.when(above, F.col("bound"))), F.sum(F.when(~above, F.col("weight")))).first()
        if ((now_held or 0), (now_left or 0)) == (held, left):
            break
        held, left = now_held or 0, now_left or 0
    level = F.col("weight") * F.lit(float(num)) / F.lit(float(den))
    return ranked.select("sid", "source", "source_size",
                         F.when(above, F.col("bound").cast("double")).otherwise(level).alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = WINDOW) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget``.

    ``lengths`` are positive and distinct, ``counts`` their documents; at most that
    many are taken. Starts from an equal share of every length, so the choice
    keeps the source's lengths; the table then fits the rest within ``window``.
    """
    have = int((lengths * counts).sum())
    if budget <= 0 or not len(lengths):
        return np.zeros(len(lengths), np.int64)
    if budget >= have:
        return counts.astype(np.int64)
    take = np.array([int(c) * budget // have for c in counts], np.int64)
    order = np.argsort(-lengths, kind="stable")
    rest = budget - int((lengths * take).sum())
    for i in order:
        if rest <= window // 2:
            break
        more = min(int(counts[i] - take[i]), (rest - window // 4) // int(lengths[i]))
        if more > 0:
            take[i] += more
            rest -= more * int(lengths[i])
    span = min(rest, window) + window // 8
    # made[s]: the step whose copies first reach the sum s; -1 nothing, -2 the empty sum
    made = np.full(span + 1, -1, np.int64)
    made[0] = -2
    steps: list[tuple[int, int]] = []
    for i in order[::-1]:
        n, length = int(counts[i] - take[i]), int(lengths[i])
        size = 1
        while n > 0 and size * length <= span and made[min(rest, span)] == -1:
            size = min(size, n)
            width = size * length
            if width > span:
                break
            fresh = np.flatnonzero((made[:span + 1 - width] != -1) & (made[width:] == -1)) + width
            made[fresh] = len(steps)
            steps.append((i, size))
            n -= size
            size *= 2
    sums = np.flatnonzero(made != -1)
    best = int(sums[np.lexsort((sums, np.abs(sums - rest)))[0]])
    longer = [i for i in order[::-1] if lengths[i] > span and counts[i] > take[i]]
    if longer and abs(int(lengths[longer[0]]) - rest) < abs(best - rest):
        take[longer[0]] += 1
        return take
    while best:
        i, size = steps[made[best]]
        take[i] += size
        best -= size * int(lengths[i])
    return take


_PLAN = "sid long, size long, n long, copies long, chosen long, source_size long, target double"


def _plan(table: pa.Table) -> pa.Table:
    """One source's histogram -> copies of every document, and how many get one more."""
    row = table.slice(0, 1).to_pylist()[0]
    words, target = row["source_size"], row["target"]
    copies = int(target // words) if words else 0
    lengths = table.column("size").to_numpy()
    counts = table.column("n").to_numpy()
    chosen = np.zeros(len(lengths), np.int64)
    real = lengths > 0
    chosen[real] = fit_budget(lengths[real], counts[real], round(target - copies * words))
    return table.select(["sid", "size", "n", "source_size", "target"]).append_column(
        "copies", pa.array(np.full(len(lengths), copies, np.int64))).append_column(
        "chosen", pa.array(chosen)).select(["sid", "size", "n", "copies", "chosen", "source_size", "target"])


def mix(docs: DataFrame, seed: int = 0, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2),
        repeats: int = 2) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, copies) per row of ``docs``.

    ``copies`` is how often the mix takes the document, ``taken`` its words with
    repeats. A source's words come as near to its target as whole documents allow.
    """
    sizes = stored(document_sizes(docs), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, repeats), "mix-targets")
    keyed = (sizes.alias("d").join(targets.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
             .select("sid", "d.size", "d.doc_id"))
    # rows that share all three are interchangeable, however many they are
    units = stored(keyed.groupBy("sid", "size", "doc_id").agg(F.count(F.lit(1)).alias("n")), "mix-units")
    histogram = units.groupBy("sid", "size").agg(F.sum("n").alias("n"))
    plan = stored(histogram.join(targets.drop("source"), "sid").groupBy("sid").applyInArrow(_plan, _PLAN), "mix-plan")

    h = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull())
    buckets = F.greatest(F.lit(1), F.ceil(F.col("all") / BUCKET)).cast("long")
    placed = stored(units.join(plan.withColumnRenamed("n", "all"), ["sid", "size"])
                    .withColumn("h", h).withColumn("bucket", F.pmod("h", buckets)), "mix-placed")
    open_ = placed.where("chosen > 0 AND chosen < `all`")
    per = open_.groupBy("sid", "size", "bucket", "chosen").agg(F.sum("n").alias("held"))
    before = F.sum("held").over(Window.partitionBy("sid", "size").orderBy("bucket")) - F.col("held")
    per = (per.select("sid", "size", "bucket", "held", (F.col("chosen") - before).alias("room"))
           .select("sid", "size", "bucket", "held", F.greatest(F.lit(0), F.least("room", "held")).alias("room")))
    told = open_.join(stored(per, "mix-buckets"), ["sid", "size", "bucket"])
    line = Window.partitionBy("sid", "size", "bucket").orderBy("h", "doc_id")
    ranked = told.where("room > 0 AND room < held").withColumn("first", F.sum("n").over(line) - F.col("n"))
    keep = ["sid", "size", "doc_id", "n", "copies", "source_size", "target"]
    more = F.greatest(F.lit(0), F.least(F.col("n"), F.col("room") - F.col("first")))
    decided = (placed.where("chosen = 0 OR chosen = `all`")
               .select(*keep, F.when(F.col("chosen") > 0, F.col("n")).otherwise(F.lit(0)).alias("more"))
               .unionByName(told.where("room = 0 OR room = held")
                            .select(*keep, F.when(F.col("room") > 0, F.col("n")).otherwise(F.lit(0)).alias("more")))
               .unionByName(ranked.select(*keep, more.alias("more"))))
    named = decided.join(targets.select("sid", "source"), "sid")
    return _expand(named).select("doc_id", "size", "source_size", "target",
                                 (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


def _expand(units: DataFrame) -> DataFrame:
    """One row per document again; the first ``more`` of a unit's rows get one copy more.

    Units of many rows are cut into pieces that are dealt out before they unfold.
    """
    step = F.lit(BUCKET).cast("long")
    pieces = units.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, step)))
    dealt = pieces.where("piece > 0").repartition("sid", "size", "doc_id", "piece")
    rows = pieces.where("piece = 0").unionByName(dealt)
    rows = rows.withColumn("row", F.explode(F.sequence("piece", F.least(F.col("piece") + BUCKET, F.col("n")) - 1)))
    return rows.withColumn("copies", F.col("copies") + (F.col("row") < F.col("more")).cast("long"))
