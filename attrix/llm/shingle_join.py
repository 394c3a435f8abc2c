"""Operator 6: n-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles (``shingles.py``). Two link when
``100 * |A & B| >= 80 * |A | B|``. The join is exact:

1. *Sets.* One pass turns each text into its size and a 64-bit set signature.
   Equal sets fall together under one signature: copies are one entry.
2. *Order.* The same pass counts tokens that occur more than once within a
   slice of documents. The most frequent ones (a list of bounded length) come
   last in the global token order, all others go by hash. Any order gives the
   same links; this one keeps common passages out of the prefixes.
3. *Prefixes.* A partner must share a token of the first
   ``n - ceil(0.8 n) + 1``. Tokens that only one set has there are dropped by
   one sorted pass; sets without any other token have no partner. For the sets
   that are left, texts, ``LEADS`` min-hash tokens and a count sketch (tokens per
   hash range, one byte each) are kept.
4. *Groups.* Sets with an equal min-hash token are compared with one leader
   each (never with one another); verified links make components. A component,
   cut by salt into parts of about ``GROUP`` sets, is a group; sets without a
   link so far form groups by min-hash token and size. So a large family of near
   copies, linked or not, is a handful of groups.
5. *Matrix.* A group's row of the matrix is the union of its members' prefix
   tokens, each with the members' sizes and the most tokens that any member has
   from there on. Joining sets with the matrix on the token gives the (set,
   group) pairs whose sizes fit and whose overlap, if this is the first shared
   token, can still reach the threshold. Members of the set's own component are
   settled already, and of two groups only the larger id is asked.
6. *Bound.* For each pair the count sketches bound the overlap from above
   (``2 |A & B| <= |A| + |B| - sum |a_i - b_i|``); only groups with a member
   that can reach the threshold are opened.
7. *Open.* The texts of qualifying sets go to the group and are compared
   exactly; a set needs one link into each other component that a group holds.

Steps 5 to 7 run twice: first each set asks the few groups it shares most
tokens with, which joins most of a family; then, with the components found so
far as groups, it asks every group that is left.

Links become components by ``connected_components``. No step makes all pairs
of a group as rows, and no list of documents reaches the driver; the frequent
tokens do, at most ``FREQUENT`` of them (16 bytes each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from attrix.llm.common import connected_components, stored, text_batches
from attrix.llm.encoding import release
from attrix.llm.shingles import WIDTH, mix, text_shingles_batch

FREQUENT = 200_000
MIN_FREQUENT = 16
GROUP = 128
LEADS = 4
#: sets that query one copy of a group's members; more go to further copies
QUERIES = 512
#: groups a set asks in the first round; the last round asks all that are left
BEST_FIRST = 3
#: tokens whose local counts are taken together, which bounds the memory of a task
COUNT_SLICE = 2_000_000

_SETS = "id long, n long, sig long, token long, cnt long"
_PREFIX = "token long, sig long, left int"
_SEEDS = np.arange(1, LEADS + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)


def sketch_of(tokens: np.ndarray) -> bytes:
    """Tokens per equal hash range, one byte each (255 = 255 or more)."""
    bits = min(14, max(3, int(len(tokens) // 2).bit_length() - 1))
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def _fold(sketch: bytes, size: int) -> np.ndarray:
    a = np.frombuffer(sketch, dtype=np.uint8).astype(np.int32)
    return a if len(a) == size else a.reshape(size, -1).sum(1)


def may_reach(na: int, a: bytes, nb: int, b: bytes, percent: int) -> bool:
    """False only if the sizes or the sketches rule the link out."""
    least = -(-percent * (na + nb) // (100 + percent))
    if min(na, nb) < least:
        return False
    if b"\xff" in a or b"\xff" in b:
        return True
    size = min(len(a), len(b))
    apart = int(np.abs(_fold(a, size) - _fold(b, size)).sum())
    return na + nb - apart >= 2 * least


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def leads_of(tokens: np.ndarray) -> np.ndarray:
    """The min-hash of the set under each of ``LEADS`` hash functions."""
    return np.array([mix(tokens ^ seed).min() for seed in _SEEDS], dtype=np.uint64).view(np.int64)


def _signature(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        s = (tokens * np.uint64(0x9FB21C651E98DF25)) ^ (tokens >> np.uint64(29))
        total = s.sum(dtype=np.uint64) + np.uint64(len(tokens)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return int(total.astype(np.int64))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int64()) for c in ("id", "n", "sig", "token", "cnt")])
        release()
        held: list[np.ndarray] = []
        seen: set[int] = set()

        def frequent() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            tokens, counts = tokens[counts > 1], counts[counts > 1]
            none = pa.nulls(len(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, pa.array(tokens.view(np.int64)), pa.array(counts)], schema=schema)

        size = 0
        for (ids,), texts in text_batches(batches, ["id"], "text"):
            sets = text_shingles_batch(texts, width)
            sigs = [_signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.int64()),
                 pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.int64())], schema=schema)
            for s, sig in zip(sets, sigs):
                if sig not in seen:
                    held.append(s)
                    size += len(s)
                    seen.add(sig)
            if size >= COUNT_SLICE:
                yield from frequent()
                size = 0
                seen.clear()
        yield from frequent()
    return run


def prefix_of(tokens: np.ndarray, frequent: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The first ``n - ceil(percent n / 100) + 1`` tokens: rare ones by hash,
    then frequent ones from the least frequent on."""
    n = len(tokens)
    take = n - -(-percent * n // 100) + 1
    if not len(frequent):
        return tokens[:take]
    at = np.searchsorted(frequent, tokens)
    at[at == len(frequent)] = 0
    hot = frequent[at] == tokens
    rare = tokens[~hot]
    if len(rare) >= take:
        return rare[:take]
    rest = tokens[hot][np.argsort(rank[at[hot]], kind="stable")]
    return np.concatenate([rare, rest[:take - len(rare)]])


def _prefixes(width: int, percent: int, order):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        frequent, rank = order.value
        seen: set[int] = set()
        for _, texts in text_batches(batches, [], "text"):
            tokens, sigs, after = [], [], []
            for s in text_shingles_batch(texts, width):
                sig = _signature(s)
                if len(s) and sig not in seen:
                    seen.add(sig)
                    p = prefix_of(s, frequent, rank, percent)
                    tokens.append(p)
                    sigs.append(np.full(len(p), sig, dtype=np.int64))
                    after.append(np.arange(len(s), len(s) - len(p), -1, dtype=np.int32))
            if len(seen) > 500_000:
                seen.clear()
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(sigs)),
                     pa.array(np.concatenate(after))], names=["token", "sig", "left"])
    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, sig): the distinct ones whose token has two signatures or more."""
    held = [np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)]
    before = None  # token of the last row that went past, kept or not

    def done(rows: list[np.ndarray], last: bool) -> pa.RecordBatch:
        nonlocal before, held
        t, s, _ = rows
        if not len(t):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in rows], names=["token", "sig", "left"])
        first = np.concatenate(([True], (t[1:] != t[:-1]) | (s[1:] != s[:-1])))
        rows = [x[first] for x in rows]
        t = rows[0]
        stop = len(t) if last else len(t) - 1
        held = [x[stop:] for x in rows]
        same = t[1:] == t[:-1]
        keep = np.concatenate(([before is not None and t[0] == before], same)) | np.concatenate((same, [False]))
        if stop:
            before = t[stop - 1]
        return pa.RecordBatch.from_arrays([pa.array(x[:stop][keep[:stop]]) for x in rows], names=["token", "sig", "left"])

    for b in batches:
        yield done([np.concatenate([h, b.column(c).to_numpy(zero_copy_only=False)])
                    for h, c in zip(held, ("token", "sig", "left"))], False)
    yield done(held, True)


class _Members:
    """Members of a group that may link with a set, by sizes and sketches at once."""

    def __init__(self, n: list[int], sketch: list[bytes], percent: int):
        self.n, self.sketch, self.percent = np.array(n, dtype=np.int64), sketch, percent
        self.open = np.array([b"\xff" in s for s in sketch], dtype=bool)
        self.folded: dict[int, np.ndarray] = {}

    def _table(self, size: int) -> np.ndarray:
        if size not in self.folded:
            self.folded[size] = np.array([_fold(s, min(size, len(s))) if len(s) >= size else
                                          np.zeros(size, np.int32) for s in self.sketch], dtype=np.int32)
        return self.folded[size]

    def near(self, n: int, sketch: bytes) -> list[int]:
        if not len(self.n):
            return []
        least = -(-self.percent * (self.n + n) // (100 + self.percent))
        fits = np.minimum(self.n, n) >= least
        if not fits.any():
            return []
        size = min(len(sketch), min(len(s) for s, f in zip(self.sketch, fits) if f))
        apart = np.abs(self._table(size) - _fold(sketch, size)).sum(1)
        apart[self.open] = 0
        if b"\xff" in sketch:
            apart[:] = 0
        return np.flatnonzero(fits & (self.n + n - apart >= 2 * least)).tolist()


def _columns(table, names):
    return [table.column(c).to_pylist() for c in names]


def _bound(percent: int):
    """(set, group) pairs with a member of another component that the sketches do not rule out."""
    def run(key, table):
        sig, n, sketch, home, member = _columns(table, ("sig", "n", "sketch", "home", "member"))
        inside = [i for i, m in enumerate(member) if m]
        members = _Members([n[i] for i in inside], [sketch[i] for i in inside], percent)
        keep = [i for i, m in enumerate(member)
                if not m and any(home[inside[j]] != home[i] for j in members.near(n[i], sketch[i]))]
        return pa.table({"sig": pa.array([sig[i] for i in keep], pa.int64()),
                         "grp": pa.array([key[0].as_py()] * len(keep), pa.int64())})
    return run


def _open(width: int, percent: int):
    """For each asking set one link into every other component that the opened group has one with."""
    def run(key, table):
        rep, home, member = _columns(table, ("rep", "home", "member"))
        sets = text_shingles_batch(table.column("text").to_pylist(), width)
        sketch = [sketch_of(s) for s in sets]
        inside = [i for i, m in enumerate(member) if m]
        members = _Members([len(sets[i]) for i in inside], [sketch[i] for i in inside], percent)
        a, b = [], []
        for i, m in enumerate(member):
            if m:
                continue
            done = {home[i]}
            for j in (inside[k] for k in members.near(len(sets[i]), sketch[i])):
                if home[j] not in done and linked(sets[i], sets[j], percent):
                    done.add(home[j])
                    a.append(rep[i])
                    b.append(rep[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _reach(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("n", "sketch", "leader_n", "leader_sketch")]
            yield b.filter(pa.array([may_reach(*x, percent) for x in zip(*cols)], pa.bool_())).select(["sig", "leader"])
    return run


def _verify(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for (rep, leader, other), texts in text_batches(batches, ["rep", "leader_rep", "leader_text"], "text"):
            a, b = [], []
            for x, y, t, s in zip(rep, leader, other, text_shingles_batch(texts, width)):
                if t != last[0]:
                    last = (t, text_shingles_batch([t], width)[0])
                if linked(s, last[1], percent):
                    a.append(x)
                    b.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _meet(members: DataFrame, asking: DataFrame) -> DataFrame:
    """Members and asking sets of each group, at most about ``QUERIES`` asking
    sets to a copy of the members. Both have the same columns and ``grp``."""
    load = asking.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("long").alias("copies"))
    inside = (members.join(load, "grp")
              .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
              .drop("copies").withColumn("member", F.lit(True)))
    outside = (asking.join(load, "grp").withColumn("copy", F.pmod(F.xxhash64("sig"), F.col("copies")))
               .drop("copies").withColumn("member", F.lit(False)))
    return inside.unionByName(outside)


def shingle_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = WIDTH, percent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    * null or blank text: ``n_shingles`` 0, never linked, ``component_id`` = own id;
    * fewer than ``width`` words: the whole sequence is the only shingle;
    * repeated rows come back as often as they come in; rows with one id and
      several texts are one node of the components, each row has its own size;
    * rows with a null id come back with the smallest id of their component,
      null if it has none;
    * an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    first = stored(src.mapInArrow(_sets(width), _SETS), "shingle-sets")
    rows = first.where("n IS NOT NULL").select("id", "n", "sig")
    top = (first.where("token IS NOT NULL").groupBy("token").agg(F.sum("cnt").alias("cnt"))
           .where(F.col("cnt") >= MIN_FREQUENT).orderBy(F.desc("cnt"), "token").limit(FREQUENT).toPandas())
    hot = top["token"].to_numpy(dtype=np.int64).view(np.uint64)
    by_hash = np.argsort(hot)
    # the list has the most frequent token first, the order wants it last
    order = spark.sparkContext.broadcast((hot[by_hash], (len(hot) - np.arange(len(hot)))[by_hash]))

    shared = stored(src.select("text").mapInArrow(_prefixes(width, percent, order), _PREFIX)
                    .repartition("token").sortWithinPartitions("token", "sig")
                    .mapInArrow(_shared, _PREFIX), "shingle-shared")
    wanted = (rows.where("n > 0 AND id IS NOT NULL").groupBy("sig").agg(F.min("id").alias("rep"))
              .join(shared.select("sig").distinct(), "sig"))
    sets = stored(_sets_with_text(src, wanted, width), "shingle-busy")
    texts = sets.select("sig", "text")

    led = sets.select("sig", F.posexplode("leads").alias("fn", "lead"))
    leaders = (led.groupBy("fn", "lead").agg(F.min("sig").alias("leader"), F.max("sig").alias("other"))
               .where("leader <> other").drop("other"))
    follow = led.join(leaders, ["fn", "lead"]).where("sig <> leader").select("sig", "leader").distinct()
    side = sets.select("sig", "n", "sketch")
    likely = (follow.join(side, "sig")
              .join(side.withColumnsRenamed({"sig": "leader", "n": "leader_n", "sketch": "leader_sketch"}), "leader")
              .mapInArrow(_reach(percent), "sig long, leader long"))
    reps = sets.select("sig", "rep")
    stars = stored(
        likely.join(reps, "sig").join(reps.withColumnsRenamed({"sig": "leader", "rep": "leader_rep"}), "leader")
        .join(texts, "sig").join(texts.withColumnsRenamed({"sig": "leader", "text": "leader_text"}), "leader")
        .mapInArrow(_verify(width, percent), "a long, b long"), "shingle-stars")
    edges, comps = stars, connected_components(stars, "a", "b")
    for best in (BEST_FIRST, None):
        homes = comps.withColumnsRenamed({"node": "rep", "component": "home"})
        links = _search(sets, shared, homes, width, percent, best)
        edges = edges.unionByName(links)
        comps = connected_components(edges, "a", "b")
    comps = comps.withColumnsRenamed({"node": "rep"})
    least = rows.where("n > 0").groupBy("sig").agg(F.min("id").alias("rep"))
    full = least.join(comps, "rep", "left").select("sig", F.coalesce("component", "rep").alias("component"))
    # rows without shingles, however many, need no join
    told = (rows.where("n > 0").join(full, "sig", "left").select("id", "n", "component")
            .unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component"))))
    return told.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _search(sets: DataFrame, shared: DataFrame, homes: DataFrame, width: int, percent: int,
            best: int | None) -> DataFrame:
    """Links between the components of ``homes``: each set asks the groups with
    sets of other components, either all that the matrix leaves open or its ``best``.

    A component of two sets or more is cut into groups of its own; the other
    sets form groups by their smallest min-hash token and size, so that similar
    sets which are not linked share a group as well.
    """
    placed = sets.drop("text").join(homes, "rep", "left").withColumn("home", F.coalesce("home", "rep"))
    several = placed.groupBy("home").agg((F.count(F.lit(1)) > 1).alias("several"))
    keyed = placed.join(several, "home").withColumn(
        "bunch", F.when(F.col("several"), F.concat(F.lit("h"), "home"))
        .otherwise(F.concat(F.lit("s"), F.col("leads")[0], F.lit("x"), F.length("sketch"))))
    crowd = keyed.groupBy("bunch").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("long").alias("parts"))
    grouped = stored(
        keyed.join(crowd, "bunch")
        # 64 bits name a group; two that share a name are one group with the members of both
        .withColumn("grp", F.xxhash64("bunch", F.pmod(F.xxhash64("sig"), F.col("parts"))))
        .select("sig", "rep", "n", "sketch", "home", "grp"), "shingle-groups")
    marked = shared.join(grouped.select("sig", "n", "home", "grp"), "sig")
    matrix = (marked.groupBy("token", F.col("grp").alias("other"))
              .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("left").alias("far"),
                   F.min("home").alias("low"), F.max("home").alias("high")))
    pairs = (marked.select("token", "sig", "n", "left", "home", "grp").join(matrix, "token")
             .where(f"grp <= other AND (low <> home OR high <> home) "
                    f"AND {percent} * n <= 100 * most AND {percent} * least <= 100 * n "
                    f"AND (100 + {percent}) * CAST(least(left, far) AS BIGINT) >= {percent} * (n + greatest(least, {percent} * n / 100))")
             .groupBy("sig", F.col("other").alias("grp")).agg(F.count(F.lit(1)).alias("tokens")))
    if best is not None:
        order = Window.partitionBy("sig").orderBy(F.desc("tokens"), "grp")
        pairs = pairs.withColumn("k", F.row_number().over(order)).where(F.col("k") <= best)
    asking = pairs.select("sig", "grp").join(grouped.drop("grp"), "sig")
    hits = stored(_meet(grouped, asking).groupBy("grp", "copy").applyInArrow(_bound(percent), "sig long, grp long"),
                  "shingle-bound")
    opened = _meet(grouped.select("sig", "rep", "home", "grp"), hits.join(grouped.select("sig", "rep", "home"), "sig"))
    return stored(opened.join(sets.select("sig", "text"), "sig").groupBy("grp", "copy")
                  .applyInArrow(_open(width, percent), "a long, b long"), "shingle-links")


def _sets_with_text(src: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(sig, rep, n, leads, sketch, text) of the wanted sets, each once."""
    found = src.join(wanted.withColumnRenamed("rep", "id"), "id").select("sig", F.col("id").alias("rep"), "text")
    schema = pa.schema([("sig", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()),
                        ("leads", pa.list_(pa.int64())), ("sketch", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (sigs, reps), texts in text_batches(batches, ["sig", "rep"], "text"):
            # an id with several texts comes with each of them
            keep = [x for x in zip(sigs, reps, texts, text_shingles_batch(texts, width)) if _signature(x[3]) == x[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in keep], pa.int64()), pa.array([x[1] for x in keep], pa.int64()),
                 pa.array([len(x[3]) for x in keep], pa.int64()),
                 pa.array([leads_of(x[3]) for x in keep], pa.list_(pa.int64())),
                 pa.array([sketch_of(x[3]) for x in keep], pa.binary()),
                 pa.array([x[2] for x in keep], pa.string())], schema=schema)
    return found.mapInArrow(run, "sig long, rep long, n long, leads array<long>, sketch binary, text string") \
        .dropDuplicates(["sig"])
