"""The pipeline and the registered queries on the smallest tables."""

import corpus_pipeline
import duckdb
import pytest
from oracle import compare, connect

import __spark_entry__
from sluice.llm import registry

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_decide(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_DIR)
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        docs = spark.createDataFrame(after.collect(), docs.schema)
    assert 0 < docs.count() < before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert sorted(row.doc_id for row in last.collect()) == sorted(row.doc_id for row in docs.collect())
    again = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, last.collect()))


def test_stages_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c d e f g", None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, SF_DIR).count() == frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count() == frame.count()


def test_stages_keep_columns_of_the_operators_names(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = docs.selectExpr("doc_id", "text", "lang", "source", "n_chars", "concat('s', doc_id) AS score",
                           "doc_id + 7 AS n_words", "'p' AS Predicted", "'x' AS _y", "2 AS spans", "3 AS items")
    before = set(map(tuple, docs.collect()))
    for name in ("toxicity", "decontamination"):
        after = dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR)
        assert after.schema.simpleString() == docs.schema.simpleString()
        rows = set(map(tuple, after.collect()))
        assert rows and rows <= before


def test_stages_keep_the_operators_helper_columns(spark):
    rows = [(i, f"password = hunter{i}x secret words of text number {i % 3} and more words here", "en", "s", 1) for i in range(6)]
    rows.append((None, rows[0][1], "en", "s", 1))
    docs = spark.createDataFrame([(*row, *range(7)) for row in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, _class int, _root int, "
                                 "_least int, _place int, _hashes int, _row int, _live int")  # fmt: skip
    for name, count in (("near_duplicates", len(rows)), ("secrets", len(rows))):
        after = dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR)
        assert after.schema.simpleString() == docs.schema.simpleString()
        found = after.collect()
        assert 0 < len(found) <= count and {tuple(row)[5:] for row in found} == {tuple(range(7))}


def test_registered(spark):
    found = __spark_entry__.queries()
    assert "pipeline" in found and all(name in found for name in registry.QUERIES)
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(registry.SQL))
def test_query_and_sql(spark, name):
    assert compare(registry.QUERIES[name](spark, SF_DIR), connect(SF_DIR), registry.SQL[name]) is None


def test_duckdb_is_there():
    assert duckdb.connect().execute("select 1").fetchone() == (1,)
