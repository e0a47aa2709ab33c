"""The pipeline and the registered queries on the smallest tables."""

import pytest

import corpus_pipeline
from marketframe.llm.common import documents
from marketframe.llm.registry import llm_queries, llm_sql
from tools.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_sql()))
def test_query_equals_sql(spark, name):
    assert difference(llm_queries()[name](spark, FOLDER).toArrow(), connect(FOLDER).sql(llm_sql()[name]).to_arrow_table()) is None


def test_all_queries_are_there():
    assert {n.split("_")[0] for n in llm_queries()} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_by_brute_force(spark):
    docs, columns = documents(spark, FOLDER), documents(spark, FOLDER).columns
    from .test_operators import brute_components, distance
    from marketframe.llm.decontaminate import normalised

    named = corpus_pipeline.language(spark, docs, FOLDER)
    assert named.columns == columns and named.count() == docs.filter("text rlike '[A-Za-zÀ-ÿ]'").count()
    rows = [(r.doc_id, r.text) for r in named.collect()]
    single = corpus_pipeline.near_duplicates(spark, named, FOLDER)
    assert single.columns == columns and sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in brute_components(rows)})
    clean = corpus_pipeline.decontaminate(spark, single, FOLDER)
    items = [normalised(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    plain = {r.doc_id: normalised(r.text) for r in single.collect()}
    gone = set(plain) - {r.doc_id for r in clean.collect()}
    assert clean.columns == columns and {d for d, t in plain.items() if any(i in t for i in items)} <= gone
    assert all(any(min(distance(i, plain[d])) <= int(0.05 * len(i)) for i in items) for d in gone)
    mixed = corpus_pipeline.mixture(spark, clean, FOLDER)
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().filter("count > 3").count() == 0
    assert corpus_pipeline.sharding(spark, mixed, FOLDER).columns == [*columns, "shard"]


def test_whole_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    load = [r["sum(b)"] for r in out.selectExpr("shard", "octet_length(text) + 16 AS b").groupBy("shard").sum("b").collect()]
    largest = out.selectExpr("max(octet_length(text)) + 16").first()[0]
    assert max(load) - sum(load) / 40 <= largest


def test_stages_take_odd_documents(spark, clashing):
    from .conftest import words

    docs = clashing((1, None), (2, ""), (None, "plain words of text", "en"), (4, words(60, "é"), "fr", "s"), (4, words(60, "é"), "fr", "s"), (5, "12 34", None, "s"))
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, FOLDER)
            assert rows.columns[:len(docs.columns)] == docs.columns
        rows.collect()
