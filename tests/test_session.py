import pytest

from strata.session import partitions_for, scratch_folder


class FakeContext:
    master = "spark://cluster:7077"


class FakeSession:
    sparkContext = FakeContext()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_scratch_lies_below_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one.startswith(shared) and other.startswith(shared) and one != other


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(FakeSession(), "x")


def test_partitions_follow_the_rows_and_are_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with partitions_for(spark, 1_000, 10):
        assert spark.conf.get(key) == "100"
    with pytest.raises(RuntimeError), partitions_for(spark, 1, 10):
        assert spark.conf.get(key) == before
        raise RuntimeError
    assert spark.conf.get(key) == before
