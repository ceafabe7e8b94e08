"""Ranked search against a brute-force version, with blocks, items and seeds so small that every path is taken."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from lectern.llm import strata
from lectern.llm.queries import ORACLE, QUERIES

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOW))


def brute(docs, items, top):
    counted = [(k, Counter(words(t))) for k, t in docs]
    counted = [(k, c) for k, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(words(text))
    out = set()
    for item, terms in asked.items():
        found = []
        for k, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                        for t in terms if t in c)
            if score > 0:
                found.append((-score, k is not None, k or 0, k))
        out |= {(item, i + 1, k, -s) for i, (s, _, _, k) in enumerate(sorted(found)[:top])}
    return out


def rows(df):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in df.select("item_id", "rank", "doc_id", "score").collect()}


def test_terms():
    for text in ["A-b_C", "Straße ÉÀ x y", "\x00a\x7fb\x80", "", "日本 ΣΑΣ 12.5", "kK"]:
        assert [t.decode() for t in strata.terms_of(text.encode())] == words(text)


@pytest.mark.parametrize("block,item_block,seed,cells", [(1024, 256, 1000, 1 << 22), (3, 2, 4, 40), (1, 1, 1, 1)])
def test_small_tables(spark, monkeypatch, block, item_block, seed, cells):
    for name, value in (("BLOCK", block), ("ITEM_BLOCK", item_block), ("SEED", seed), ("CELLS", cells)):
        monkeypatch.setattr(strata, name, value)
    rng = random.Random(block)
    vocabulary = ["the", "The", "of", "a", *(f"w{i}" for i in range(30)), "é", "日本"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 5, 5, 40])))) for i in range(60)]
    docs += [(100 + i, "w1 w2 w3 the of") for i in range(15)] + [(200, None), (201, ""), (202, "-- !"), (None, "w1 rare"), (203, "the " * 3000)]
    items = [(1, "w1 W2 w3!"), (2, "the of a"), (3, "none-of-these zzz qqq"), (4, "absent"), (5, ""), (6, None), (1, "w4 w1"), (None, "rare w5")]
    items += [(10 + i, " ".join(rng.choices(vocabulary, k=6))) for i in range(4)]
    frame = spark.createDataFrame([(*d, 7, "x") for d in docs], "doc_id long, text string, m long, terms string")
    got = strata.search(frame, spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, number long"), top=10)
    assert rows(got) == brute(docs, items, 10)


def test_bounds_leave_blocks_out(spark, monkeypatch, sf_small):
    """Fewer documents are scored than match, and the result is the same as with no bound at all."""
    docs, items = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "benchmark"))
    index, n_docs, n_terms = strata.build_index(docs)
    assert index.selectExpr("sum(size(docs)) n").first().n == n_docs > 0
    monkeypatch.setattr(strata, "SEED", 50)
    few = rows(strata.search(docs, items, top=3))
    monkeypatch.setattr(strata, "SEED", 1)
    assert rows(strata.search(docs, items, top=3)) == few


def test_query_equals_sql(spark, sf_small):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_small}/{name}.parquet'")
    want = set(con.execute(f"SELECT item_id, rank, doc_id, score FROM ({ORACLE['op13_stratified_search']})").fetchall())
    assert rows(QUERIES["op13_stratified_search"](spark, sf_small)) == want
