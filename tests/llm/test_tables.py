"""The registered queries over whole tables, against brute force, SQL or held-out labels."""

import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from attrix.llm import decontaminate as D
from attrix.llm.encoding import encoder, vocabulary_path
from tests.conftest import SF_CHECK, SF_SMALL


def rows_of(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op3_warc_archives", "op4_embedding_near_duplicates",
                                  "op6_ngram_jaccard_join"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("conversations", "pages", "embeddings", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert rows_of(E.queries()[name](spark, SF_SMALL), cols) == sorted(map(tuple, cur.fetchall()), key=str)


def test_decontamination_equals_brute_force(spark):
    index = D.build_index(spark.read.parquet(f"{SF_CHECK}/benchmark.parquet"))
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()
    weight = np.zeros((len(index.terms) + 1, len(index.items)))
    for t, (items, x) in enumerate(index.impact):
        weight[t, items] = x
    want, step = set(), index.step
    for r in docs:
        words = D.words_of(r["text"])
        starts = [0] if len(words) <= 2 * step else range(0, len(words) - step, step)
        for a in starts:
            window = words[a:a + 2 * step]
            seen = list({index.terms.get(w, len(index.terms)) for w in window})
            for i in np.flatnonzero(weight[seen].sum(0) >= D.THRESHOLD):
                q, z = (D.share_found(p, window) for p in index.parts[i])
                if q >= D.QUESTION_SHARE and z >= D.ANSWER_SHARE:
                    want.add((r["doc_id"], index.items[i]))
    got = E.queries()["op2_benchmark_decontamination"](spark, SF_CHECK).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 10


def test_token_queries_equal_the_library(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}

    def direct(name, text, end):
        e = encoder(vocabulary_path(name)).tokenizer.encode(text, add_special_tokens=False)
        return np.array(e.ids + [end], dtype="<u4")
    start = 0
    out = {r["doc_id"]: r for r in E.queries()["op9_token_output"](spark, SF_SMALL).collect()}
    assert len(out) == len(docs)
    for doc in sorted(docs):
        ids = direct("word_bpe_49k.json", docs[doc], 2)
        assert (out[doc]["start"], out[doc]["n_tokens"], out[doc]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    pieces, used = {}, {}
    for r in E.queries()["op8_packing"](spark, SF_SMALL).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    for doc, text in docs.items():
        ids, at = direct("byte_bpe_50k.json", text, 0), 0
        for r in sorted(pieces[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert max(used.values()) <= 1024 and sum(used.values()) > 0.98 * 1024 * len(used)
    total = sum(len(direct("byte_bpe_50k.json", t, 0)) - 1 for t in docs.values())
    top = E.queries()["op7_token_counts"](spark, SF_SMALL).orderBy("n_tokens").first()
    assert top["tokens_from"] == total and top["docs_from"] == len(docs)


def test_toxicity_on_held_out_rows(spark):
    scores = E.queries()["op10_toxicity"](spark, SF_CHECK)
    labels = spark.read.parquet(f"{SF_CHECK}/labels.parquet")
    rows = scores.join(labels, "doc_id").collect()
    assert scores.count() == spark.read.parquet(f"{SF_CHECK}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    toxic, clean = [r for r in held if r["toxic"]], [r for r in held if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)


def test_shards_of_the_table(spark):
    rows = E.queries()["op5_kd_sharding"](spark, SF_CHECK).collect()
    size, slots = {}, {}
    for r in rows:
        size[r["shard"]] = size.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    largest = max(r["size"] for r in rows)
    assert set(size) == set(range(40)) and max(size.values()) - min(size.values()) <= 2 * largest
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
