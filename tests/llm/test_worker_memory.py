"""What Python workers hold: rows come in batches bounded by bytes, and memory is given back behind the last."""

import pyarrow as pa
import pytest

from strata.llm import common, minhash, quality

TEXT = "some words of a long text " * 20_000
DOCS = "doc_id bigint, text string"


@pytest.fixture
def long_texts(spark):
    return spark.createDataFrame([(i, TEXT) for i in range(40)], DOCS).coalesce(1)


@pytest.mark.parametrize("operator", ["minhash", "quality"])
def test_texts_reach_workers_in_small_batches(spark, long_texts, operator):
    def batch_sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "64m")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    try:
        {
            "minhash": lambda: minhash.signatures(long_texts, 5),
            "quality": lambda: quality.keep_good(long_texts, labels, "quality", quality.fold(), 0.3),
        }[operator]()
        sizes = [row.size for row in long_texts.mapInArrow(batch_sizes, "size bigint").collect()]
    finally:
        spark.conf.set(key, before)
    assert sum(sizes) > 40 * len(TEXT) and max(sizes) < common.ARROW_BYTES + 2 * len(TEXT)


def test_memory_is_given_back_when_the_work_holds_nothing(monkeypatch):
    held, seen = [], []

    def work(batches):
        held.append(1)
        try:
            yield from batches
        finally:
            held.clear()

    monkeypatch.setattr(common, "release_memory", lambda: seen.append(list(held)))
    assert list(common.released(work)(iter([1, 2]))) == [1, 2]
    assert seen == [[]]
