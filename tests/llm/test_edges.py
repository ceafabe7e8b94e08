"""Nulls, empty and long texts, repeated rows, empty tables and clashing extra columns, for every operator and stage."""

import pytest

import corpus_pipeline
from lectern.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, _key long, _text string, node long"
LONG = " ".join(f"word{i % 97}" for i in range(20_000))


def write(spark, path, empty):
    def put(name, rows, schema):
        spark.createDataFrame([] if empty else rows, schema).write.parquet(f"{path}/{name}.parquet")

    extra = (None, 1, 2, 3, "x", 4)
    docs = [(1, "same text here\nand there", "en"), (1, "same text here\nand there", "en"), (2, "same text here\nand there", None),
            (None, "no id", "en"), (None, None, None), (3, None, "de"), (4, "", "de"), (5, " \n\t ", "de"), (6, LONG, "en"),
            (7, LONG + " more", "en"), (8, "é😀" * 50, "fr")]
    put("documents", [(i, t, x, *extra) for i, t, x in docs], DOCS)
    put("labels", [(1, 1, 0), (1, 0, 1), (2, 1, None), (3, None, 0), (None, 1, 1), (6, 0, 0), (7, 1, 1)],
        "doc_id long, quality int, toxic int")
    put("pages", [(1, "http://a.net/x", "<p>"), (1, "http://a.net/x", "<p>"), (None, None, None), (2, None, ""), (3, "", None)],
        "page_id long, url string, html string")
    put("benchmark", [(1, LONG[:500]), (1, LONG[:500]), (None, None), (2, "")], "item_id long, text string")
    put("embeddings", [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 1.0]), (2, None), (3, []), (4, [0.5, None])],
        "vec_id long, embedding array<float>")
    put("conversations", [(1, 0, "user", "Same.", 1, "x")] * 3 + [(1, None, "assistant", "No end", 2, None), (None, None, None, None, None, "x"),
                          (2, 0, "", "", 3, "x"), (3, 5, "user", LONG, 4, "x"), (3, 9, "assistant", LONG + ".", 5, "x")],
        "conv_id long, turn long, role string, text string, pos long, node string")
    return path


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("odd")), False)


@pytest.fixture(scope="module")
def bare(spark, tmp_path_factory):
    return write(spark, str(tmp_path_factory.mktemp("bare")), True)


ROWS = {"op1": 11, "op2": 11, "op3": 5, "op4": 11, "op5": 5, "op6": 11, "op8": 11, "op9": 11}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, odd, name):
    rows = QUERIES[name](spark, odd).collect()
    assert len(rows) == ROWS.get(name.split("_")[0], len(rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, bare, name):
    assert QUERIES[name](spark, bare).collect() == []


def test_odd_values(spark, odd):
    op9 = {(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op9_prefix_join"](spark, odd).collect()}
    assert {(1, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, 0, None), (None, 1, None)} <= op9
    op10 = [tuple(r) for r in QUERIES["op10_multiprobe_search"](spark, odd).select("query_id", "rank", "vec_id", "score").collect()]
    assert op10 == [(0, 1, 1, 1.0)]
    op11 = {r.conv_id: r for r in QUERIES["op11_turn_alignment"](spark, odd).collect()}
    assert op11.keys() == {None, 1, 2, 3} and (op11[2].blank, op11[2].audit, op11[2].cost) == (1, "D", 4)
    assert (op11[3].gaps, op11[3].truncated, op11[3].illegal, op11[3].audit, op11[3].cost) == (3, 2, 0, "KK", 6)  # the damage takes the full stop of 3:9
    op12 = [r for r in QUERIES["op12_best_fit_packing"](spark, odd).collect()]
    assert sorted(r.length for r in op12 if r.doc_id in (3, 4, 5)) == [1, 1, 1] and {r.doc_tokens for r in op12 if r.doc_id == 1} == {6}
    op13 = [r for r in QUERIES["op13_stratified_search"](spark, odd).collect()]
    assert {r.item_id for r in op13} == {1} and [r.doc_id for r in sorted(op13, key=lambda r: r["rank"])] == [6, 7]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_odd_and_empty(spark, odd, bare, name, stage):
    for path in (odd, bare):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        out = stage(spark, docs, path)
        if name != "encoding":
            assert out.columns == docs.columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        n = out.count()
        assert n == 0 if path == bare else n > 0


def test_pipeline_chain(spark, sf_small):
    rows = corpus_pipeline.run(spark, sf_small).collect()
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) and rows[0].n_tokens == len(rows[0].ids)
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    labels = spark.read.parquet(f"{sf_small}/labels.parquet")
    junk = {r.doc_id for r in labels.where("quality = 0").join(docs, "doc_id").collect()}
    assert len(junk & set(ids)) <= 0.3 * len(junk) + 1


def test_entry_lists_all(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert {"pipeline"} | set(QUERIES) <= set(names) and len({n.split("_")[0] for n in QUERIES}) == 13
