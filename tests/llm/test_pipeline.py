from collections import defaultdict

import pytest

import __spark_entry__ as entries
import corpus_pipeline
from dayfold.llm.catalog import QUERIES, SQL

from .conftest import SCHEMA
from .test_decontaminate import brute as passages
from .test_near_dedup import brute as classes


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows of every stage, each written and read again."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs.collect()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(n))
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_stages_against_brute_force(spark, folder, stages):
    raw, languages, exact, near, clean, packed = stages
    assert {r.doc_id for r in languages} == {r.doc_id for r in raw if any(c.isalpha() for c in r.text)}
    last = defaultdict(int)
    for r in languages:
        last[r.text] = max(last[r.text], r.doc_id)
    assert sorted(r.doc_id for r in exact) == sorted(last.values())
    assert sorted(r.doc_id for r in near) == sorted(set(classes([(r.doc_id, r.text) for r in exact]).values()))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in near if not passages(r.text, items)[1])
    assert {r.doc_id for r in packed} == {r.doc_id for r in clean}
    rows = {r.doc_id: r for r in raw}
    assert all(tuple(r) == tuple(rows[r.doc_id]) for r in clean)


def test_run_gives_the_last_stage(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[-1]))


def test_odd_rows_through_all_stages(spark, folder, odd_rows, tmp_path):
    docs = spark.createDataFrame(odd_rows, SCHEMA)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{n}")
        docs = spark.read.parquet(f"{tmp_path}/{n}")
        assert docs.columns == corpus_pipeline.COLUMNS or n == 4


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entries.queries())
    assert set(SQL) <= set(entries.oracle_sql())
    assert len([name for name in QUERIES if name.startswith("op")]) == 13
