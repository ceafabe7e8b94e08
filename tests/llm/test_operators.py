"""Each operator against a brute-force version, on the smallest tables or small fixtures."""

import base64
import gc
import hashlib
import math
import random
import re
import time
import weakref
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from lectern.llm import byte_bpe, importance, kneser_ney, line_chunks, prefix_join, pstable, revisits, secrets, templates, url_rules
from lectern.llm.queries import ORACLE, QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def texts(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def reference_encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- op1


def brute_base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def brute_peak(value, cls):
    w = cls.window
    return max(-sum(c / w * math.log2(c / w) for c in Counter(value[i:i + w]).values()) for i in range(len(value) - w + 1))


def test_secret_base_spans(spark, sf_small):
    got = {r.doc_id: r for r in QUERIES["op1_secret_scan"](spark, sf_small).collect()}
    for k, t in texts(spark, sf_small).items():
        assert got[k].base_sha256 == hashlib.sha256(brute_base(t).encode()).hexdigest()


def test_secret_hand_cases(spark):
    rows = ["token=secret: abcdefgh12345", "TOKEN = 'abc-DEF_12=' token:short", "é😀 AKIA0123456789ABCD x", "a" * 40, "x" * 31,
            "password=secret=abcdefgh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.secret_report(df).collect()}
    for i, t in enumerate(rows):
        assert got[i].base_sha256 == hashlib.sha256(brute_base(t).encode()).hexdigest(), t
    assert [got[i].n_assign for i in range(6)] == [0, 1, 0, 0, 0, 1] and got[2].n_access == 1 and got[3].n_hex == 1


def test_secret_entropy(spark):
    key, words = "q7Zt0Kx93LmVb2RyPdW8sHc5NfGj", "thisisaverylongordinarywordwithoutdigits"
    df = spark.createDataFrame([(0, f"see {key} there"), (1, words), (2, key + "EXAMPLE"), (3, "ab12" * 12 + " z")],
                               "doc_id long, text string")
    got = {r.doc_id: r.spans for r in secrets.secret_report(df).collect()}
    assert got == {0: f"base64_entropy:4:{4 + len(key)}", 1: "", 2: "", 3: "hex:0:48"}
    cls = secrets.CLASSES[1]
    rng = random.Random(1)
    values = ["".join(rng.choice(cls.alphabet) for _ in range(rng.randint(24, 60))) for _ in range(30)]
    df = spark.createDataFrame([(v,) for v in values], "v string").select("v", secrets.peak_entropy(F.col("v"), cls).alias("e"))
    assert all(abs(r.e - brute_peak(r.v, cls)) < 1e-9 for r in df.collect())


def test_secret_allowed_words_cover_their_part_only(spark):
    key = "q7Zt0Kx93LmVb2RyPdW8sHc5NfGj"
    blob = key + "Wd4" + key[::-1] + "tEsT" + key[::-1] + "Wd4" + key
    rows = [f"https://h.com/latest/{key}", f"/contest/{key} x", f"example_{key}", blob, f"{key}_test", f"a {key}test b",
            f"AKIA0123456789ABCD/{key}"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",") if "base64_entropy" in x]
           for r in secrets.secret_report(df).collect()}
    for i in (0, 1, 2, 4, 6):
        assert [rows[i][a:b].strip("/_") for a, b in got[i]] == [key], rows[i]
    assert [rows[3][a:b] for a, b in got[3]] == [blob[:35], blob[-35:]] and got[5] == []


# --- op2


def test_bpe_matches_library(spark, sf_small):
    enc = reference_encoding()
    got = {r.doc_id: r for r in QUERIES["op2_byte_bpe"](spark, sf_small).collect()}
    for k, t in texts(spark, sf_small).items():
        ids = enc.encode_ordinary(t)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_bpe_random_texts():
    enc, rng = reference_encoding(), random.Random(3)
    own = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    parts = ["the", "ation", " ", "  ", "\n", "\n\n", "\t", "é", "ñ", "日本", "😀", "'s", "'", "12", "3", "...", "aaaaaaa", "xzqj", "\x1c",
             " ", "　", "Ünïcödé", "erthndly", "!", "a"]
    for _ in range(400):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids = enc.encode_ordinary(t)
        assert own.encode(t) == ids, t
        dec = byte_bpe.Decoder(own.bytes_of)
        assert "".join(dec.feed([i]) for i in ids) + dec.finish() == t


# --- op3


def brute_revisits(rows):
    out = {}
    for r in rows:
        if r["kind"] != "revisit":
            continue
        earlier = [x for x in rows if x["kind"] == "response" and x["site"] == r["site"]
                   and (x["ts"], x["record_id"]) and x["ts"] <= r["ts"]]
        if not earlier:
            out[r["record_id"]] = ("no-response", None)
            continue
        x = max(earlier, key=lambda x: (x["ts"], x["record_id"]))
        if r["etag"] and x["etag"]:
            same = r["etag"].removeprefix("W/") == x["etag"].removeprefix("W/")
        elif r["last_modified"] and x["last_modified"]:
            same = r["last_modified"] == x["last_modified"]
        else:
            same = None
        out[r["record_id"]] = ("unverified" if same is None else "resolved" if same else "changed",
                               x["record_id"] if same else None)
    return out


@pytest.mark.parametrize("hot", [0.1, 0.9])
def test_revisits_against_brute_force(spark, hot):
    rng, rows = random.Random(5), []
    for i in range(600):
        site = "http://WWW.a.org/hot/" if rng.random() < hot else f"https://h{rng.randint(0, 9)}.org/x?b=2&a=1#f"
        rows.append((i, site, rng.randint(0, 150), rng.choice(["response", "revisit"]), rng.choice([None, '"a"', 'W/"a"', '"b"']),
                     rng.choice([None, "1", "2"]), None, {"etag": str(i), "x": str(i)}))
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, etag string, last_modified string,"
                                     "digest string, headers map<string,string>").repartition(7)
    site = {r.record_id: r.site for r in df.select("record_id", revisits.canonical_url(F.col("url")).alias("site")).collect()}
    want = brute_revisits([{"record_id": r[0], "site": site[r[0]], "ts": r[2], "kind": r[3], "etag": r[4], "last_modified": r[5]}
                           for r in rows])
    got = revisits.resolve(df).collect()
    assert {r.record_id: (r.reason, r.resolved_id) for r in got} == want
    assert all(r.headers == {"etag": str(r.record_id), "x": str(r.resolved_id)} for r in got if r.reason == "resolved")
    assert set(site.values()) >= {"a.org/hot"}


# --- op4, op8: held-out accuracy


def test_importance_separates(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op4_importance_resampling"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r.selected for r in got if r.quality], [r.selected for r in got if not r.quality]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.1


def test_kth_largest(spark):
    values = [float(x % 37) for x in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 17, 250, 500):
        assert importance.kth_largest(df, "x", k, most=10) == sorted(values, reverse=True)[k - 1]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op8_kneser_ney_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(
        "held_out").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit / sum(r.toxic for r in got) >= 0.85 and hit / sum(r.predicted for r in got) >= 0.85


def test_every_labelled_row_counts(spark):
    labels = spark.range(230_000).select(F.col("id").alias("doc_id"), (F.col("id") % 7 == 0).cast("int").alias("toxic"))
    known = importance.labelled(labels, "toxic")
    assert known.agg(F.count("*"), F.sum("label")).first()[:] == (230_000, 32_858)


def test_labels_sent_or_shuffled_give_the_same(spark, monkeypatch):
    rows = [(i, f"some plain words number {i % 9}" + (" vile nasty filth" * 3 if i % 3 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, "no id"), (5, rows[5][1]), (401, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (7, None, None)],
                                   "doc_id long, quality int, toxic int")

    def key(r):
        return str(r[0])

    def result():
        toxic = kneser_ney.score_toxicity(docs, labels)
        sample = importance.resample(docs, labels)[0]
        return [sorted(((r[0], *(round(float(x), 9) for x in r[1:])) for r in df.collect()), key=key) for df in (toxic, sample)]

    sent = result()
    monkeypatch.setattr(importance, "SENT_LABELS", 0)
    assert result() == sent and [len(x) for x in sent] == [403, 403]


def test_logistic_by_sums_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    y = (x @ [1.5, -0.7] + 0.3 + rng.logistic(size=500) > 0).astype(int)
    one, beta = np.column_stack([x, np.ones(500)]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(one @ beta, -30, 30)))
        beta -= np.linalg.solve((one * (p * (1 - p) + 1e-9)[:, None]).T @ one + 1e-2 * np.eye(3), one.T @ (p - y) + 1e-2 * beta)
    rows = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, label int").repartition(5)
    assert np.allclose(kneser_ney.fit_logistic(rows, ["a", "b"]), beta, atol=1e-9)


def test_sketch_counts():
    rng = np.random.default_rng(1)
    for n in (1, 10, 100, 10_000):
        est = [kneser_ney.sketch_counts(np.array([np.bitwise_or.reduce(kneser_ney.sketch_bit(
            rng.integers(0, 1 << 63, n).astype(np.uint64)))]))[0] for _ in range(40)]
        assert 0.7 < np.mean(est) / n < 1.5


# --- op5


def test_url_rules_hand_cases(spark):
    urls = ["http://A.EXAMPLE.net/en/x", "http://net/a", "http://xnet/a", "http://a.net", "ftp://b.org/fr/", "http://b.org/frx",
            "x", None, "http://example.com/de/?q", "http://a.net#/x", "http://b.net/?://c"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, url_rules.rule_table(
        spark, url_rules.PAGE_RULES)).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow") and got[1] == ("net", "/a", "net/", "block")
    assert [got[i][2] for i in range(2, 11)] == [None, None, "org/fr/", None, None, None, "example.com/de/", None, "net/"]
    assert got[6][:2] == ("", "") and got[7][:2] == ("", "") and got[9][:2] == ("a.net", "")


def test_oracle_queries(spark, sf_small):
    from lectern.plans import oracle_check
    from lectern.plans.registry import ORACLE as all_sql, QUERIES as all_queries

    for key, sql in ORACLE.items():
        all_queries[key], all_sql[key] = QUERIES[key], sql
        try:
            assert oracle_check.compare(spark, key, sf_small)["status"] == "match"
        finally:
            del all_queries[key], all_sql[key]


# --- op6


def test_line_chunks_remove_passages(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    line = lambda n: " ".join(word() for _ in range(n))
    passage, wide = [line(14) for _ in range(8)], line(60)
    rows = [(i, "\n".join([line(9), line(20)] + (passage if i % 3 == 0 else [wide] if i % 3 == 1 else []) + [line(12), line(9)]))
            for i in range(60)]
    got = {r.doc_id: r.text for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        lines, left = t.split("\n"), got[i].split("\n")
        own = lines[:2] + lines[-2:]
        assert [x for x in left if x in own] == own  # what is not repeated stays, in order
        if i < 2:
            assert left == lines
        elif i % 3 == 1:
            assert wide not in left
        elif i and i % 3 == 0:
            assert not set(left) & set(passage)


def test_line_chunks_keep_first_occurrences(spark, sf_small):
    rows = texts(spark, sf_small)
    got = {r.doc_id: r.text for r in QUERIES["op6_line_chunks"](spark, sf_small).collect()}
    assert {x for t in rows.values() for x in t.split("\n")} - {""} == {x for t in got.values() for x in t.split("\n")} - {""}
    assert all(len(got[k]) <= len(t) for k, t in rows.items())


def test_line_chunks_short_passages(spark):
    rng = random.Random(4)
    line = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    rows, shared, own, n = [], {}, {}, 0
    for lines, words in ((2, 30), (3, 20), (4, 15)) * 15:
        passage = [line(words) for _ in range(lines)]
        for x in passage if words == 15 else []:  # each line also stands alone, earlier
            rows.append((n := n + 1, "\n".join([line(9), x, line(9)])))
        between = "\n\n" if n % 2 else "\n"
        for copy in range(2):
            n += 1
            around = [line(9), line(9)]
            rows.append((n, "\n".join([around[0], between.join(passage), around[1]])))
            if copy:
                shared[n], own[n] = passage, around
    got = {r.doc_id: r.text for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == "\n".join(own[i]) for i in shared)
    assert all(got[i] == t for i, t in rows if i not in shared)


def test_line_chunks_count_words_by_runs(spark):
    gaps, tabs = "a" + " " * 60 + "b", "\t".join(f"w{i}" for i in range(60))
    rows = [(i, f"x{i}\n{gaps}\ny{i}\n{tabs}\nz{i}") for i in range(2)]
    got = {r.doc_id: r.text for r in line_chunks.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1], 1: f"x1\n{gaps}\ny1\nz1"}


# --- op7


def test_templates(spark):
    item = "A train leaves at 12 from Boston and covers 40 miles in 3 hours, then it waits 12 minutes and goes on to Albany at once"
    other = item.replace("12", "25").replace("Boston", "Leeds").replace("40", "90")
    torn = item.replace("12 minutes", "17 minutes")
    clean = "A cook leaves the kitchen with two pots and a pan, then waits for the soup and goes on to bake some bread and cake at once"
    docs = spark.createDataFrame([(0, f"x y {item} z"), (1, f"Some words. {other} end"), (2, torn), (3, clean), (4, None), (5, "")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "two words")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.exact for r in templates.contaminated(docs, bench).collect()}
    assert got == {(0, 7): True, (1, 7): False}  # in 2 one number meets two values
    assert {r.doc_id for r in templates.decontaminate(docs, bench).collect()} == {2, 3, 4, 5}


def test_templates_whatever_the_case(spark):
    item = "a farmer brings seven sheep to the market in Leeds and sells three of them before noon"
    moved = "A Farmer Brings Seven Sheep To The Market In York And Sells Three Of Them Before Noon"
    table = "12 7 90 4 33 18 2 65 41 8 77 3 10 56"
    texts = [item, item.title(), item.upper(), f"sum {table} end", "sum 13 8 91 5 34 19 3 66 42 9 78 4 11 57 end",
             "He said: What Is Love? And left", "what is it, love", moved]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = [(0, item), (1, item.title()), (2, item.upper()), (3, table), (4, "what is love"), (5, "?!")]
    got = {(r.doc_id, r.item_id) for r in templates.contaminated(
        docs, spark.createDataFrame(bench, "item_id long, text string")).collect()}
    assert {(d, i) for d in range(3) for i in range(3)} <= got and (3, 3) in got and (5, 4) in got
    assert {(d, i) for d, i in got if i >= 3} == {(3, 3), (5, 4)} and {d for d, i in got if d in (4, 6)} == set()


def test_templates_find_planted_items(spark, sf_small):
    bench = {r.item_id: r.text for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op7_benchmark_templates"](spark, sf_small).collect()}
    want = {(d, i) for d, t in texts(spark, sf_small).items() for i, b in bench.items() if b in t}
    assert want and want <= got


# --- op9


def brute_components(rows, width, percent):
    sets = {}
    for d, t in rows.items():
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    held = {}
    for d, s in sets.items():
        for x in s:
            held.setdefault(x, []).append(d)
    common = Counter((a, b) for ds in held.values() for i, a in enumerate(ds) for b in ds[i + 1:])
    for (a, b), k in common.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_join_components(spark, width, percent):
    rng = random.Random(width)
    base = [[f"w{rng.randint(0, 40)}" for _ in range(rng.randint(0, 90))] for _ in range(14)]
    rows = {}
    for i in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            if w:
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 99)}"
        rows[i] = rng.choice([" ", "\n"]).join(w)
    rows.update({300: None, 301: "", 302: " \t", 303: "One", 304: "oNE", 305: "É", 306: "é"})
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.jaccard_components(df, width, percent).collect()}
    want = brute_components(rows, width, percent)
    assert got == want
    kept = {r.doc_id for r in prefix_join.keep_one(df, width, percent).collect()}
    assert kept == {d for d, (_, c) in want.items() if c == d}


def test_parities_pass_every_pair_that_links(spark):
    rng = random.Random(7)
    rows = []
    for n in [1, 2, 9, 10, 40, 300, 2000]:
        for apart in [0, 1, 2, 5, n // 20, n // 10, n // 5]:
            a = np.unique(np.array([rng.getrandbits(63) for _ in range(n)], np.int64))
            b = np.unique(np.concatenate([a[min(apart, n - 1):], [rng.getrandbits(63) for _ in range(apart)]]).astype(np.int64))
            both = len(np.intersect1d(a, b))
            rows.append(((len(a), prefix_join.parities(a).tolist()), (len(b), prefix_join.parities(b).tolist()),
                         both * 190 >= (len(a) + len(b)) * 90))
    side = "struct<n: long, parities: array<long>>"
    df = spark.createDataFrame(rows, f"x {side}, y {side}, linked boolean")
    found = df.select("linked", prefix_join.may_overlap(F.col("x"), F.col("y"), 90).alias("may")).collect()
    assert all(r.may for r in found if r.linked) and any(r.linked for r in found)
    assert not all(r.may for r in found)


def test_join_verifies_no_square_of_unlinked_variants(spark, monkeypatch):
    """Variants of one text, nearly all further than the threshold from all others, whose prefixes share hashes."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    rows = {}
    for i in range(120):
        w = list(base)
        for k in rng.sample(range(3, 200, 6), 8):
            w[k] = f"e{k}"
        rows[i] = " ".join(w)
    sets = []
    whole = prefix_join.whole_sets
    monkeypatch.setattr(prefix_join, "whole_sets", lambda d, nodes, width: sets.append(nodes.count()) or whole(d, nodes, width))
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in prefix_join.jaccard_components(df, 3, 90).collect()}
    assert got == brute_components(rows, 3, 90)
    assert len({c for _, c in got.values()}) > 100
    assert sum(sets) < len(rows)  # sets read again; round by round all of them before


# --- op10


def test_search_recall_and_order(spark):
    sf = "/root/testdata/sf0.01"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in e]), np.array([r.embedding for r in e], float)
    found = {}
    for r in QUERIES["op10_multiprobe_search"](spark, sf).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        score = dict(zip(ids, x @ x[ids == q][0]))
        want = sorted((k for k in score if k != q), key=lambda k: (-score[k], k))[:20]
        rows = sorted(found[q])
        assert [r for r, _, _ in rows] == list(range(1, 21))
        assert all(abs(score[v] - s) < 1e-9 for _, v, s in rows)
        assert [v for _, v, _ in rows] == sorted((v for _, v, _ in rows), key=lambda k: (-score[k], k))
        hit, total = hit + len(set(want) & {v for _, v, _ in rows}), total + 20
    assert hit / total >= 0.9


def test_search_copies_and_unusable(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.5]) for i in range(0, 60)] + [(60, [0.0, 0.0]), (61, None), (62, [nan, 1.0]), (63, [1.0, None]),
                                                      (64, [inf, 1.0]), (65, [0.9, 0.5]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in pstable.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert set(got) == {0, 20, 40}
    for q, found in got.items():
        assert [v for _, v in sorted(found)] == [v for v in range(60) if v != q][:20]


def test_search_all_candidates_where_few(spark):
    rng = np.random.default_rng(3)
    for n, spread in ((10, 0.0), (21, 0.0), (2000, None)):
        x = rng.standard_normal((n, 16))
        x /= np.linalg.norm(x, axis=1)[:, None]
        if spread is None:
            x[1] *= 100  # one outlier
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        found = {}
        for r in pstable.nearest(df, query_every=10).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        score = x @ x.T
        for q in range(0, n, 10):
            want = [k for k in np.argsort(-score[q], kind="stable") if k != q][:20]
            assert len(found[q]) == min(20, n - 1)
            assert n > 21 and len(found[q] & set(want)) >= 10 or found[q] == set(want)


def test_bpe_small_memos_and_undone_merges_agree_with_plain_merging(monkeypatch):
    """Full memos and restarts of the machine change nothing; undoing merges tells what merging a pair tells."""
    monkeypatch.setattr(byte_bpe, "MEMO", 50)
    monkeypatch.setattr(byte_bpe, "STATES", 40)
    ranks = byte_bpe.read_ranks(RANKS)
    own = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rnd = random.Random(5)
    for _ in range(1500):
        text = "".join(rnd.choice("aaabbcde '12.,\n\tö привет你好🙂") for _ in range(rnd.randint(0, 60)))
        assert own.encode(text) == library.encode(text, disallowed_special=())
    assert len(own.chunks) <= 50 and len(own.older) <= 50
    ids = sorted(own.bytes_of)
    for _ in range(20000):
        a, b = rnd.choice(ids[:2000]), rnd.choice(ids[:2000])
        assert own._apart(a, b) == (own.merged(own.bytes_of[a] + own.bytes_of[b]) == [a, b])


def test_bpe_results_leave_in_small_batches(spark):
    """However results are cut into batches, keys keep their rows."""
    docs = spark.createDataFrame([(k, "word " * (k % 7)) for k in range(3000)], "doc_id long, text string").coalesce(1)
    got = byte_bpe.bpe_digests(docs, RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    own = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    assert sorted(r.doc_id for r in got) == list(range(3000))
    assert all(r.ids == own.encode("word " * (r.doc_id % 7)) and r.n_tokens == len(r.ids) for r in got)


def test_bpe_pieces_come_back_from_the_older_half_as_they_are(monkeypatch):
    """What was encoded and decoded once is not put together again; whole texts agree with the library."""
    monkeypatch.setattr(byte_bpe, "MEMO", 4)
    monkeypatch.setattr(byte_bpe, "BLOCK", 3)
    own = byte_bpe.Encoder(byte_bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    text = "grünes Haus, alte\nBrücke  am \U0001f642 Fluss und 12 weitere Häuser "
    first = own._word(" Haus")
    own.encode(text)
    own.older[" Haus"] = first
    own.chunks.pop(" Haus", None)
    assert own._again(" Haus") is first
    ids = reference_encoding().encode_ordinary(text)
    n, ids_sha, text_sha, kept = byte_bpe.digests(text, own, True)
    assert (n, list(kept)) == (len(ids), ids)
    assert ids_sha == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert text_sha == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_memo_holds_one_string_a_piece_and_states_go_at_a_restart():
    with open(RANKS, "rb") as f:
        ranks = f.read()
    with byte_bpe.encoder(ranks, public_tokenizers.PATTERN) as own:
        assert own.encode("Häuser am Fluss, unfoldably") == reference_encoding().encode_ordinary("Häuser am Fluss, unfoldably")
        state = own.start
        assert len(state) > 1 and not gc.isenabled()
        assert all(isinstance(known, str) for known in own.chunks.values())
        own._reset()
        assert not state
    assert gc.isenabled()


def test_bpe_encoder_goes_when_no_task_uses_it(monkeypatch):
    monkeypatch.setattr(byte_bpe, "IDLE_S", 0.05)
    with open(RANKS, "rb") as f:
        ranks = f.read()
    with byte_bpe.encoder(ranks, public_tokenizers.PATTERN) as own:
        own.encode("Häuser am Fluss, unfoldably unfoldably")
    with byte_bpe.encoder(ranks, public_tokenizers.PATTERN) as again:
        assert again is own
        left = weakref.ref(own)
    del own, again
    end = time.monotonic() + 20
    while left() is not None and time.monotonic() < end:
        time.sleep(0.05)
    assert left() is None


def test_bpe_states_are_kept_from_the_second_time_and_plain_pieces_need_no_pattern():
    with open(RANKS, "rb") as f:
        ranks = f.read()
    own = byte_bpe.Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}, public_tokenizers.PATTERN)
    word = b" ofanstouou"
    once = own.encode_word(word)
    assert len(own.states) == 1  # the start; what one rare word passes is not kept
    assert own.encode_word(word) == own.encode_word(word) == once and len(own.states) > 1
    rng = random.Random(3)
    parts = ["Häuser", "it", "'s", "don't", "a", "  ", " ", "\n", "\xa0", ",", "$$$", "'", ".\n", "\u0301", "ǆ", "中", "9", "\x1c"]
    for _ in range(300):
        text = "".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randint(0, 9)))
        assert own.encode(text) == reference_encoding().encode_ordinary(text), text
        assert byte_bpe.only_lone_spaces(text) == (
            not byte_bpe.MIXED_SPACE.search(text) and text[:1] != " " and text[-1:] != " "), text


def test_template_filters_stay_out_of_the_plans(spark):
    """The window filters are data: as literals each made half a megabyte of text at every mention in a plan."""
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "One two three four five six seven eight nine ten")], "item_id long, text string")
    found = templates.contaminated(docs, bench)
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1, 7)]
    assert len(found._jdf.queryExecution().toString()) < 1_000_000


def test_template_words_at_odd_letters(spark):
    """Hashes of words taken in lower case together are those of each word alone."""
    text = "ΟΔΥΣΣΕΥΣ ΑΣ'Α İstanbul Kg 5kg ²x ½ kg KM Ab ǅabc ẞA 7 oak"
    row = templates.hashed(spark.createDataFrame([(text,), ("",)], "text string").select(
        "text", templates.words_of(F.col("text")).alias("words"))).where("text != ''").select(
        "words", "plain", "loose", "canon", F.transform("words", lambda w: F.xxhash64(F.lower(w))).alias("p"),
        F.transform("words", lambda w: F.xxhash64(templates.canonical(w))).alias("c"),
        F.transform("words", lambda w: F.xxhash64(F.when(F.substring(w, 1, 1).between("0", "9"), "<number>").when(
            F.lower(w).isin(*templates.UNITS), "<unit>").otherwise(F.lower(w)))).alias("l")).first()
    assert len(row.words) == 15
    assert (row.plain, row.canon, row.loose) == (row.p, row.c, row.l)
