"""Queries beside their SQL, native plans, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from compare import differences, oracle_connection
from strata.llm import exact_dedup, minhash, queries
from strata.llm.common import staged, table
from strata.llm.oracle import oracle_sql


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_its_sql(spark, data, name):
    with oracle_connection(data) as connection:
        assert differences(spark, data, queries.queries()[name], oracle_sql()[name], connection) is None


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.queries()) == list(range(1, 14))


def test_exact_dedup_runs_no_python(spark, data):
    plan = queries.exact_groups(spark, data)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pipeline_stages(spark, data):
    docs = table(spark, data, "documents")
    every = {row.doc_id: row.text for row in docs.select("doc_id", "text").collect()}
    labels = {row.doc_id: row.quality for row in table(spark, data, "labels").collect()}
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(staged(stage(spark, kept[-1], data), name))
        assert kept[-1].columns == docs.columns
    good, unique, distinct, mixed = ([row.doc_id for row in rows.select("doc_id").collect()] for rows in kept[1:])

    known = [i for i in every if i in labels]
    assert sum((i in set(good)) == (labels[i] == 1) for i in known) >= 0.95 * len(known)
    assert all(i in set(good) for i in known if labels[i] == 1)
    largest = {}
    for i in good:
        largest[every[i]] = max(i, largest.get(every[i], i))
    assert sorted(unique) == sorted(largest.values())
    groups = minhash.near_groups(kept[2], 5, 80).collect()
    assert sorted(distinct) == sorted({row.component_id for row in groups})
    assert set(mixed) <= set(distinct) and max(map(mixed.count, set(mixed))) <= 3

    coded = corpus_pipeline.STAGES[-1][1](spark, kept[-1], data).collect()
    assert sorted(row.doc_id for row in coded) == sorted(mixed) and all(row.round_trip for row in coded)


def test_exact_stage_keeps_one_of_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (1, "c")], "doc_id bigint, text string")
    assert sorted(map(tuple, exact_dedup.drop_exact(rows).collect())) == [(1, "a"), (1, "c"), (2, "b")]
