"""Repair of conversation structure by dynamic programming over a grammar.

A conversation should read ``(system? (user assistant)+)?`` by the initials of its
roles. Every row has a symbol: its initial (``s``, ``u``, ``a`` or another) and its
fault. The cheapest edits that make a symbol sequence read so are a shortest path
through four states, hence a product of min-plus matrices, one per symbol:

1. Rows are put in order by a range sort, so a conversation of any size is spread
   over tasks, and its symbols are written as blocks of at most ``BLOCK`` rows.
   Equal blocks of all conversations are one sequence from here on.
2. Re-Pair: the most frequent adjacent pairs become symbols of their own, round by round.
3. Each rule has one transfer matrix, the product of its two parts: cost, and the audit (the edits'
   initials) as a rope that shares its parts. Rules are evaluated bottom-up, once.
4. A sequence's matrix is the product over its remaining symbols, once per distinct
   sequence; conversations of one block look theirs up, the others multiply their
   blocks' matrices in a tree of ``FAN`` at a time.

Two audits of one matrix cell with equal cost never are one a part of the other
(that would be further insertions, which cost), so the ASCII-least of a product is
the product of the ASCII-least, and ropes compare from the left.

``ROUNDS`` and ``PAIRS`` bound the grammar, at most ``ROUNDS * PAIRS`` rules; they bear on
speed only, as what the grammar leaves is multiplied symbol by symbol.

Rows: a null role or text is one space. A null conv_id is a conversation of its own.
Rows come by turn (nulls first), rows of one turn by ``row_key``, a digest of role and
text. Roles whose initial is not s, u or a, the empty one included, can be given
another role or deleted. An empty table gives no rows. Extra columns are ignored.
The digest of a conversation's repaired text is sequential by nature: its rows pass
through one task in order, which holds one batch of rows and the audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attrix.llm.common import stored

BLOCK = 4096
ROUNDS = 16
PAIRS = 256
FAN = 64

#: blanks: space, tab to carriage return
BLANKS = " \t\n\x0b\x0c\r"
#: initials; upper case where the row is truncated; x must go
SYMBOLS = "suaoSUAOx"
RE_ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: what the sequence may still need at its end, by state: cost and edits
ENDS = [(0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, "")]
EMPTY = hashlib.sha256(b"").hexdigest()


# --- rows ---------------------------------------------------------------------------------

def conversation_key() -> Column:
    """A string that names the conversation, null ids included."""
    return F.concat(F.when(F.col("conv_id").isNull(), "0").otherwise("1"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults dealt out by crc32 of ``conv_id:turn``: of 20 rows,
    one goes, one loses its text, one its sentence ends, one repeats, one says user."""
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), code.alias("code"))
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (rows.where("code <> 0")
            .select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(F.sequence(F.lit(0), (F.col("code") == 3).cast("int"))))
            .drop("col"))


def row_key() -> Column:
    """A digest of role and text; orders rows of one turn and finds repeated rows."""
    return F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)


def plain_rows(rows: DataFrame) -> DataFrame:
    """Rows of the four columns without nulls in role and text, with their conversation key."""
    return rows.select(conversation_key().alias("key"), F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def marked(rows: DataFrame) -> DataFrame:
    """(key, turn, initial, fault, at) of every row; ``at`` ascends in the rows' order.

    Written, so that positions stand. Only keys and digests move, no texts.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    slim = stored(plain_rows(rows).select(
        "key", "turn", row_key().alias("row_key"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(bare == "", "blank").when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated").alias("fault"),
        F.monotonically_increasing_id().alias("id")), "repair-rows")
    first = slim.groupBy("key", "row_key").agg(F.min(F.struct("turn", "id"))["id"].alias("first"))
    fault = (F.when(F.col("fault") == "blank", "blank").when(F.col("id") != F.col("first"), "duplicate")
             .otherwise(F.col("fault")))
    order = ["key", "turn", "row_key", "id"]
    return stored(slim.join(first, ["key", "row_key"])
                  .select("key", "turn", "row_key", "id", "initial", fault.alias("fault"))
                  .repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("key", "turn", "initial", "fault", F.monotonically_increasing_id().alias("at")), "repair-order")


def blocks(rows: DataFrame) -> DataFrame:
    """(key, k, blocks, symbols, illegal): runs of a conversation's rows as symbol strings.

    ``illegal`` counts the neighbours that no conversation may have, those to the block before included.
    """
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
              .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))
    runs = (rows.select("key", F.shiftright("at", 12).alias("block"), "at", symbol.alias("symbol"), "initial")
            .groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("at", "symbol", "initial"))).alias("run")))
    inside = F.expr("size(filter(zip_with(slice(run.initial, 1, size(run) - 1), slice(run.initial, 2, size(run)),"
                    " (x, y) -> concat(x, y)), p -> p NOT IN ('su', 'ua', 'au')))")
    per = runs.select("key", "block", F.array_join("run.symbol", "").alias("symbols"), inside.alias("inside"),
                      F.col("run")[0]["initial"].alias("head"), F.element_at("run", -1)["initial"].alias("tail"))
    line = Window.partitionBy("key").orderBy("block")
    joint = F.concat(F.lag("tail").over(line), "head")
    per = per.select("key", "symbols", (F.row_number().over(line) - 1).alias("k"),
                     (F.col("inside") + F.when(joint.isin("su", "ua", "au"), 0).when(joint.isNull(), 0).otherwise(1)).alias("illegal"))
    sized = per.select("*", F.max("k").over(Window.partitionBy("key")).alias("last"))
    return stored(sized.select("key", "k", (F.col("last") + 1).alias("blocks"), "symbols", "illegal"), "repair-blocks")


# --- grammar ------------------------------------------------------------------------------

def disjoint_pairs(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of pairs by falling frequency, those that never overlap: no symbol is left in one and right in another."""
    left, right, out = set(), set(), []
    for a, b in pairs:
        if a in right or b in left or (a == b and (a in left or b in right)):
            continue
        left.add(a)
        right.add(b)
        out.append((a, b))
    return out


def _replacer(rules: dict[tuple[int, int], int]) -> Callable:
    """Sequences with each pair of ``rules`` replaced, from the left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for seq in batch.column("seq").to_pylist():
                new: list[int] = []
                i = 0
                while i < len(seq):
                    rule = rules.get((seq[i], seq[i + 1])) if i + 1 < len(seq) else None
                    new.append(seq[i] if rule is None else rule)
                    i += 1 if rule is None else 2
                out.append(new)
            yield pa.RecordBatch.from_arrays([batch.column("symbols"), pa.array(out, pa.list_(pa.int32()))], names=["symbols", "seq"])
    return run


def grammar(sequences: DataFrame, rounds: int = ROUNDS, pairs: int = PAIRS) -> tuple[list[tuple[int, int]], DataFrame]:
    """Re-Pair over distinct ``symbols``: the rules (rule r makes symbol 9 + r), and (symbols, seq) by them."""
    code = F.transform(F.split("symbols", ""), lambda c: (F.instr(F.lit(SYMBOLS), c) - 1).cast("int"))
    seqs = stored(sequences.select("symbols", code.alias("seq")), "repair-sequences")
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        found = (seqs.where(F.size("seq") > 1)
                 .select(F.explode(F.expr("zip_with(slice(seq, 1, size(seq) - 1), slice(seq, 2, size(seq)),"
                                          " (x, y) -> struct(x AS a, y AS b))")).alias("p"))
                 .groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                 .orderBy(F.desc("n"), "a", "b").limit(pairs).collect())
        chosen = disjoint_pairs([(r["a"], r["b"]) for r in found])
        if not chosen:
            break
        new = {p: len(SYMBOLS) + len(rules) + i for i, p in enumerate(chosen)}
        rules += chosen
        seqs = stored(seqs.mapInArrow(_replacer(new), "symbols string, seq array<int>"), "repair-sequences")
    return rules, seqs


# --- transfer matrices --------------------------------------------------------------------

class Rope:
    """A text of two parts, which are ropes or strings."""

    __slots__ = ("left", "right", "size")

    def __init__(self, left, right):
        self.left, self.right, self.size = left, right, _size(left) + _size(right)


def _size(rope) -> int:
    return len(rope) if isinstance(rope, str) else rope.size


def joined(left, right):
    """The text of ``left`` and then ``right``; short ones as strings."""
    if not _size(left):
        return right
    if not _size(right):
        return left
    if isinstance(left, str) and isinstance(right, str) and len(left) + len(right) <= 64:
        return left + right
    return Rope(left, right)


def before(a, b) -> bool:
    """Whether the text of rope ``a`` is ASCII-less than that of ``b``; shared parts are not read."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        if isinstance(p, str) and isinstance(q, str):
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p[:n] < q[:n]
            if len(p) > n:
                x.append(p[n:])
            if len(q) > n:
                y.append(q[n:])
        elif isinstance(q, str) or (not isinstance(p, str) and p.size >= q.size):
            x += [p.right, p.left]
            y.append(q)
        else:
            y += [q.right, q.left]
            x.append(p)
    return not x and bool(y)


def text_of(rope) -> str:
    out, stack = [], [rope]
    while stack:
        p = stack.pop()
        if isinstance(p, str):
            out.append(p)
        else:
            stack += [p.right, p.left]
    return "".join(out)


#: a matrix: 4 rows of 4 cells, each (cost, audit) or None; states: nothing yet, after s, after u, after a
Matrix = list


def _better(old, cost: int, audit):
    if old is None or cost < old[0] or (cost == old[0] and before(audit, old[1])):
        return cost, audit
    return old


def product(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for k in range(4):
            first = a[i][k]
            if first is None:
                continue
            for j in range(4):
                then = b[k][j]
                if then is not None:
                    old, cost = out[i][j], first[0] + then[0]
                    if old is None or cost <= old[0]:
                        out[i][j] = _better(old, cost, joined(first[1], then[1]))
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Any insertions, then the edit of one row."""
    none, user, assistant = (0, ""), (INSERT, "I"), (2 * INSERT, "II")
    inserts: Matrix = [[none, None, user, assistant], [None, none, user, assistant],
                       [None, None, none, user], [None, None, user, none]]
    edit: Matrix = [[(DELETE, "D") if i == j else None for j in range(4)] for i in range(4)]
    if symbol != "x":
        extra, initial = (TRUNCATED if symbol.isupper() else 0), symbol.lower()
        if initial == "s":
            edit[0][1] = (extra, "K")
        for i, j, role in ((0, 2, "u"), (1, 2, "u"), (3, 2, "u"), (2, 3, "a")):
            edit[i][j] = (extra, "K") if initial == role else (extra + RE_ROLE, "R")
    return product(inserts, edit)


def rule_matrices(rules: list[tuple[int, int]]) -> list[Matrix]:
    """One matrix per symbol and rule, bottom-up."""
    out = [symbol_matrix(s) for s in SYMBOLS]
    for a, b in rules:
        out.append(product(out[a], out[b]))
    return out


def _cells(m: Matrix) -> tuple[list[int | None], list[str | None]]:
    flat = [c for row in m for c in row]
    return [c and c[0] for c in flat], [c and text_of(c[1]) for c in flat]


def _matrix(costs: list, audits: list) -> Matrix:
    flat = [None if c is None else (c, a) for c, a in zip(costs, audits)]
    return [flat[4 * i:4 * i + 4] for i in range(4)]


_CELLS = "costs array<bigint>, audits array<string>"


def _cell_arrays(cells: list) -> list[pa.Array]:
    return [pa.array([c[0] for c in cells], pa.list_(pa.int64())), pa.array([c[1] for c in cells], pa.list_(pa.string()))]


def _solver(matrices: list[Matrix]) -> Callable:
    """Sequences (symbols, seq) -> their matrices' cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part, cells = batch.slice(start, 64), []
                for seq in part.column("seq").to_pylist():
                    whole = matrices[seq[0]]
                    for s in seq[1:]:
                        whole = product(whole, matrices[s])
                    cells.append(_cells(whole))
                yield pa.RecordBatch.from_arrays([part.column("symbols"), *_cell_arrays(cells)], names=["symbols", "costs", "audits"])
    return run


def _fold(table: pa.Table) -> pa.Table:
    """At most ``FAN`` neighbouring blocks of a conversation -> one."""
    rows = sorted(table.to_pylist(), key=lambda r: r["k"])
    whole = _matrix(rows[0]["costs"], rows[0]["audits"])
    for r in rows[1:]:
        whole = product(whole, _matrix(r["costs"], r["audits"]))
    return pa.Table.from_arrays([pa.array([rows[0]["key"]]), pa.array([rows[0]["k"] // FAN], pa.int32()),
                                 *_cell_arrays([_cells(whole)])], names=["key", "k", "costs", "audits"])


def cheapest_edits(runs: DataFrame) -> DataFrame:
    """(key, cost, audit) of every conversation of ``blocks``."""
    rules, seqs = grammar(runs.select("symbols").distinct())
    solved = stored(seqs.mapInArrow(_solver(rule_matrices(rules)), f"symbols string, {_CELLS}"), "repair-solved")
    have = runs.join(solved, "symbols")
    whole = have.where("blocks = 1").select("key", "costs", "audits")
    parts = have.where("blocks > 1").select("key", "k", "costs", "audits")
    last = runs.agg(F.max("k")).first()[0] or 0
    while last:
        parts = stored(parts.groupBy("key", F.expr(f"k div {FAN}")).applyInArrow(_fold, f"key string, k int, {_CELLS}"), "repair-fold")
        last //= FAN
    whole = whole.unionByName(parts.select("key", "costs", "audits"))
    # from the first state to any, and what the end still needs
    ways = F.array(*[F.when(F.col("costs")[j].isNotNull(), F.struct((F.col("costs")[j] + cost).alias("cost"),
                                                                   F.concat(F.col("audits")[j], F.lit(tail)).alias("audit")))
                     for j, (cost, tail) in enumerate(ENDS)])
    return whole.select("key", F.array_min(ways).alias("best")).select("key", "best.cost", "best.audit")


# --- results ------------------------------------------------------------------------------

def structure_repairs(rows: DataFrame) -> DataFrame:
    """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation of ``rows``."""
    ordered = marked(rows)
    runs = blocks(ordered)
    facts = ordered.groupBy("key").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in ("blank", "duplicate", "truncated")])
    illegal = runs.groupBy("key").agg(F.sum("illegal").alias("illegal"))
    return facts.join(illegal, "key").join(cheapest_edits(runs), "key")


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits, each followed by its conversation's rows in order -> the repaired rows."""
    names = ["key", "place", "edit", "role", "text"]
    key, audit, at, place, last = None, "", 0, 0, ""
    out: list[tuple] = []

    def put(edit: str, role: str | None, text: str) -> None:
        nonlocal place, last
        role = ("assistant" if last == "u" else "user") if role is None else role
        place, last = place + 1, role[:1]
        out.append((key, place, edit, role, text))

    def inserts() -> None:
        nonlocal at
        while audit[at:at + 1] == "I":
            put("I", None, "")
            at += 1

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), *[pa.string()] * 3))], names=names)

    for batch in batches:
        for k, a, role, text in zip(*[batch.column(c) for c in ("key", "audit", "role", "text")]):
            if a.is_valid:
                inserts()
                key, audit, at, place, last = k.as_py(), a.as_py(), 0, 0, ""
                continue
            inserts()
            edit = audit[at]
            at += 1
            if edit != "D":
                put(edit, role.as_py() if edit == "K" else None, text.as_py())
        yield flushed()
    inserts()
    yield flushed()


def repaired_rows(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(key, place, edit, role, text): the rows after the edits, those of a conversation together and in order."""
    texts = plain_rows(rows).select("key", F.lit(1).alias("part"), "turn", row_key().alias("row_key"),
                                    F.lit(None).cast("string").alias("audit"), "role", "text")
    none = F.lit(None).cast("string")
    heads = audits.select("key", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), none.alias("row_key"),
                          "audit", none.alias("role"), none.alias("text"))
    return (heads.unionByName(texts).repartition("key").sortWithinPartitions("key", "part", "turn", "row_key")
            .select("key", "audit", "role", "text")
            .mapInArrow(_apply, "key string, place long, edit string, role string, text string"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in batches:
        done = []
        for k, role, text in zip(*[batch.column(c) for c in ("key", "role", "text")]):
            k = k.as_py()
            if k != key:
                if key is not None:
                    done.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role.as_py()}:{text.as_py()}".encode())
        yield pa.RecordBatch.from_pylist([{"key": k, "repaired_sha256": d} for k, d in done],
                                         pa.schema([("key", pa.string()), ("repaired_sha256", pa.string())]))
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"key": key, "repaired_sha256": digest.hexdigest()}])


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(key, repaired_sha256) of conversations that lie together and in order, as ``repaired_rows`` leaves them."""
    return repaired.mapInArrow(_digest, "key string, repaired_sha256 string")


def conversation_repairs(conversations: DataFrame) -> DataFrame:
    """Damage the rows, repair them, and report on every original conversation."""
    rows = damage(conversations)
    repairs = stored(structure_repairs(rows), "repair-audits")
    digests = repaired_digests(repaired_rows(rows, repairs.select("key", "audit")))
    ids = conversations.groupBy("conv_id").agg(F.count(F.lit(1))).select("conv_id", conversation_key().alias("key"))
    zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(repairs, "key", "left").join(digests, "key", "left")
            .select("conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256")))
