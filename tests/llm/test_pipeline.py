"""The registered queries and the pipeline over small tables."""

import pytest
from check import TESTDATA, compare, oracle

import corpus_pipeline
from flowlake.llm import queries

TABLES = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle(TABLES)


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_against_sql(spark, connection, name):
    rows = compare(queries.QUERIES[name](spark, TABLES), queries.ORACLE_SQL[name], connection)
    # No phrase of the smallest tables need occur a hundred times.
    assert rows > 0 or name == "op13_phrase_mining"


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_pipeline_by_stages(spark, tmp_path):
    """What each stage keeps, on its own input, against plain Python."""
    from test_near import plain_groups
    from test_texts import plain_lines

    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "lines", "near_copies", "surrogates", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, TABLES)
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "packing":
            break
        assert docs.columns == columns
        after = {r.doc_id: r for r in docs.collect()}
        rows = [(d, r.text) for d, r in before.items()]
        if name == "quality":
            assert 0.6 * len(before) < len(after) <= len(before)
            assert all(after[d] == before[d] for d in after)
        elif name == "lines":
            assert sorted(((d, r.text) for d, r in after.items()), key=str) == [x[:2] for x in plain_lines(rows)]
            assert all(r.n_chars == len(r.text) and r.lang == before[d].lang for d, r in after.items())
        elif name == "near_copies":
            assert after.keys() == {d for d, _, c in plain_groups(rows) if d == c}
        else:
            assert after.keys() == before.keys()
            assert not any("example.com" in r.text and r.text == before[d].text for d, r in after.items())
        before = after
    tokens = docs.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id for r in tokens} == before.keys()
    packed = {r.doc_id: r[1] for r in tokens}
    assert packed == {r.doc_id: r.doc_tokens for r in docs.select("doc_id", "doc_tokens").distinct().collect()}


def test_pipeline_runs_as_one(spark):
    got = corpus_pipeline.run(spark, TABLES)
    assert got.count() > 0


def test_surrogates_stage_keeps_clashing_columns(spark):
    rows = [(1, "write to mr.x@example.org", 7, "a"), (2, None, 8, "b"), (None, "", 9, "c"), (1, "plain", 7, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_entities int, `row` string")
    got = corpus_pipeline.surrogates(spark, docs, TABLES)
    assert got.columns[:4] == docs.columns
    found = sorted(map(tuple, got.select(*docs.columns).collect()), key=str)
    assert sorted((r[0], r[2], r[3]) for r in found if r[0]) == [(1, 7, "a"), (1, 7, "d"), (2, 8, "b")]
    texts = {r[3]: r[1] for r in found}
    assert texts["a"] != rows[0][1] and texts["b"] is None and texts["c"] == "" and texts["d"] == "plain"
    assert corpus_pipeline.surrogates(spark, docs.limit(0), TABLES).collect() == []
