"""Conversation repair against SQL, an exhaustive search and plain faults."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

import __spark_entry__ as E
from attrix.llm import structure as S
from tests.conftest import SF_CHECK, SF_SMALL

LEGAL = re.compile(r"(s?(ua)+)?")
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def sql(con):
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({E.oracle_sql()['op11_structure_repair']})").fetchall(), key=str)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_CHECK])
def test_repairs_equal_their_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf}/conversations.parquet')")
    got = rows(E.queries()["op11_structure_repair"](spark, sf))
    assert got == sql(con) and any("R" in r[7] for r in got) and any("I" in r[7] for r in got)


def edits_by_search(symbols):
    """Cheapest, then ASCII-least edits, by trying all of them with up to two insertions between rows."""
    best = None

    def go(i, cost, audit, initials, run):
        nonlocal best
        if best and cost > best[0]:
            return
        if not LEGAL.fullmatch(initials) and not LEGAL.fullmatch(initials + "a") and not LEGAL.fullmatch(initials + "ua"):
            return
        if i == len(symbols) and LEGAL.fullmatch(initials):
            best = min(best or (cost, audit), (cost, audit))
        if run < 2:
            for r in "ua":
                go(i, cost + 3, audit + "I", initials + r, run + 1)
        if i < len(symbols):
            c = symbols[i]
            go(i + 1, cost + 4, audit + "D", initials, 0)
            if c != "x":
                more = 3 if c.isupper() else 0
                if c.lower() != "o":
                    go(i + 1, cost + more, audit + "K", initials + c.lower(), 0)
                for r in "ua":
                    if r != c.lower():
                        go(i + 1, cost + more + 3, audit + "R", initials + r, 0)
    go(0, 0, "", "", 0)
    return best


def by_grammar(words, rules):
    matrices = S.rule_matrices(rules)
    out = []
    for word in words:
        whole = matrices[word[0]]
        for s in word[1:]:
            whole = S.product(whole, matrices[s])
        out.append(min((c[0] + cost, S.text_of(c[1]) + tail) for c, (cost, tail) in zip(whole[0], S.ENDS) if c))
    return out


def test_every_short_sequence_has_its_cheapest_edits():
    words = [w for n in (1, 2, 3) for w in itertools.product(S.SYMBOLS, repeat=n)]
    rng = random.Random(5)
    words += [tuple(rng.choice(S.SYMBOLS) for _ in range(n)) for n in (4, 5, 6) for _ in range(60)]
    got = by_grammar([[S.SYMBOLS.index(c) for c in w] for w in words], [])
    assert got == [edits_by_search(w) for w in words]


def test_grammar_keeps_sequences_and_results(spark):
    rng = random.Random(9)
    words = sorted({"".join(rng.choice("suaAx" if rng.random() < .2 else "ua") for _ in range(rng.randint(1, 40))) for _ in range(200)}
                   | {"u" * 37, "ua" * 50})
    rules, seqs = S.grammar(spark.createDataFrame([(w,) for w in words], "symbols string"))
    assert len(rules) > 20

    def unfold(s):
        return S.SYMBOLS[s] if s < 9 else "".join(map(unfold, rules[s - 9]))
    got = {r["symbols"]: r["seq"] for r in seqs.collect()}
    assert {"".join(map(unfold, q)) for q in got.values()} == set(words) == set(got)
    assert sum(map(len, got.values())) < sum(map(len, words)) / 2
    plain = by_grammar([[S.SYMBOLS.index(c) for c in w] for w in words], [])
    assert by_grammar([got[w] for w in words], rules) == plain


def test_disjoint_pairs():
    assert S.disjoint_pairs([(1, 2), (2, 1), (1, 3), (3, 2), (4, 4), (4, 5), (5, 2)]) == [(1, 2), (1, 3), (4, 4), (5, 2)]


@pytest.fixture(scope="module")
def odd():
    out = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 3, "assistant", "Yes."), (2, None, None, None), (2, None, "user", "A."),
           (2, 5, "", "B."), (2, 5, "", "B."), (None, 1, "user", "Q!"), (None, None, "assistant", "A?"), (None, 1, "user", "Q!"),
           (3, 1, "tool", "x"), (4, 0, "assistant", "\t \n"), (4, 1, "assistant", " end. \n"), (-7, 2, "user", "é:\n😀."), (-7, 2, "user", "z")]
    # an id whose only row goes
    gone = next(i for i in range(10, 200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    out.append((gone, 0, "user", "Lost."))
    return out, gone


def test_edge_rows(spark, odd):
    data, gone = odd
    df = spark.createDataFrame([(*r, "k", 1, "s") for r in data],
                               "conv_id long, turn long, role string, text string, key string, at int, symbols string")
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", data)
    got = rows(S.conversation_repairs(df))
    assert got == sql(con) and len(got) == len({r[0] for r in data})
    assert (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert S.conversation_repairs(df.limit(0)).count() == 0


def test_long_conversation_in_many_blocks(spark, monkeypatch):
    """More rows than a block and more blocks than one fold, over several partitions, beside short ones."""
    monkeypatch.setattr(S, "FAN", 2)
    rng = random.Random(3)
    data = [(7, i, rng.choice(["user", "assistant", "assistant", "tool"]), rng.choice(["Yes.", "no", "", f"T{i}.", f"T{i}."])) for i in range(21_000)]
    data += [(c, i, r, "Same words.") for c in range(100, 160) for i, r in enumerate(["system", "user", "assistant"])]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r["key"]: r for r in S.structure_repairs(df).collect()}
    seen, symbols = set(), []
    for _, _, role, text in data[:21_000]:
        ok = text and (role, text) not in seen
        seen.add((role, text))
        c = {"user": "u", "assistant": "a"}.get(role, "o")
        symbols.append("x" if not ok else c if text[-1] in ".!?" else c.upper())
    (cost, audit), = by_grammar([[S.SYMBOLS.index(c) for c in symbols]], [])
    assert (got["17"]["cost"], got["17"]["audit"]) == (cost, audit)
    assert got["1100"]["audit"] == "KKK" and len(got) == 61
    out = S.repaired_rows(df, spark.createDataFrame([(r["key"], r["audit"]) for r in got.values()], "key string, audit string")).collect()
    long = sorted((r["place"], r["role"][0]) for r in out if r["key"] == "17")
    assert LEGAL.fullmatch("".join(i for _, i in long)) and len(long) == len(audit) - audit.count("D")
