"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Each tree hashes a vector to a string of ``BITS`` bits, one random hyperplane each, and keeps its strings
as a sorted array. A search descends every tree to the longest prefix that matches the query's string,
then ascends all trees together, one bit at a time, until the union of the ranges of strings that share
the prefix holds as many of the shard's vectors as are wanted (``k`` at least, beside the query's own
entry, or the whole shard). The last step goes tree by tree and ends with the few trees that fill the number.
A vector that many trees find counts once, so a group of near copies cannot end a search. The candidates are
scored exactly, in double precision.

How many are wanted is measured, as it depends on the data and on the shard's size: ``SAMPLE_QUERIES`` of a
block's queries are compared with the whole shard, and the smallest number with which a search finds
``recall`` of their ``k`` nearest serves the block. The sample sets that number alone.

Vectors with unequal norms get one more component, so that the largest inner product is the smallest
angle. Equal vectors are one entry; it carries the smallest ids only, as no result can hold more of
them. Entries are dealt into shards of about ``SHARD_ROWS`` by hash and queries into blocks of
``QUERY_ROWS``: a task holds one shard's forest and one block, whatever the size of the tables. Every
entry is in the index; hyperplanes are drawn from a fixed seed.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part;
a vector meets only vectors of its own length. A query's own row is no candidate. Rows that repeat a
vec_id are one entry for each vector. Ties go to the smaller vec_id.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship_package, staged

TREES = 256
BITS = 32
RECALL = 0.96
SAMPLE_QUERIES = 64
SHARE_STEPS = 64  # the wanted numbers tried are steps of this part of a shard
TREES_AT_ONCE = 8
SHARD_ROWS = 32_768
QUERY_ROWS = 4_096
RANGE_QUERIES = 256
_FOUND = "query_no bigint, entry bigint, least_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
        .filter("vec_id IS NOT NULL AND vector IS NOT NULL")
        .filter(F.coalesce(finite, F.lit(False)))
        .filter(F.exists("vector", lambda x: x != 0))
    )


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    trees: int = TREES,
    bits: int = BITS,
    recall: float = RECALL,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row that ``is_query`` selects."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = staged(usable(vectors).distinct(), "vectors")
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    # k + 1 ids of equal vectors are enough: a query leaves out its own. Ranks above that are cut
    # before the shuffle, in each task.
    few = rows.withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= k + 1)
    entries = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = entries.select(
        F.monotonically_increasing_id().alias("entry"), "ids", F.col("ids")[0].alias("least_id"), "vector",
        F.size("vector").alias("length"),
        F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)).alias("norm"),
    )
    entries = staged(entries, "entries")
    queries = rows.filter(is_query).select(
        F.monotonically_increasing_id().alias("query_no"), F.col("vec_id").alias("query_id"), "vector",
        F.size("vector").alias("length"),
    )
    queries = staged(queries, "queries")

    shards = max(1, -(-entries.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    longest = entries.groupBy("length").agg(F.max("norm").alias("most"))
    # Numbers of rows may differ in another run; shards and blocks do not.
    shard = F.pmod(F.xxhash64("vector"), F.lit(shards))
    block = F.pmod(F.xxhash64("query_id", "vector"), F.lit(blocks))
    # Each pair of a shard and a block is a group of bounded size.
    held = entries.join(F.broadcast(longest), "length").select(
        "length", shard.alias("shard"), F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        "entry", "least_id", "vector", "most",
    )
    asked = queries.select(
        "length", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")).alias("shard"),
        block.alias("block"), "query_no", "query_id", "vector",
    )
    keys = ["length", "shard", "block"]
    found = staged(
        held.groupBy(*keys)
        .cogroup(asked.groupBy(*keys))
        .applyInPandas(_searcher(k, trees, bits, recall), _FOUND),
        "found",
    )
    best = Window.partitionBy("query_no").orderBy(F.desc("score"), "least_id")
    merged = found.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1)
    named = (
        merged.join(entries.select("entry", "ids"), "entry")
        .join(queries.select("query_no", "query_id"), "query_no")
        .select("query_no", "query_id", F.explode("ids").alias("vec_id"), "score")
        .filter("vec_id != query_id")
    )
    nearest_first = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    return (
        named.withColumn("rank", F.row_number().over(nearest_first))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def hash_strings(vectors: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """The hash strings as numbers, most significant bit first: (trees, vectors)."""
    planes = np.random.default_rng(5).standard_normal((vectors.shape[1], trees * bits))
    weights = (np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)).astype(np.uint64)
    strings = np.empty((trees, len(vectors)), np.uint64)
    for tree in range(trees):
        side = vectors @ planes[:, tree * bits : (tree + 1) * bits] > 0
        strings[tree] = side.astype(np.uint64) @ weights
    return strings


class Forest:
    """Sorted arrays of hash strings over one shard."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int):
        self.bits = bits
        strings = hash_strings(vectors, trees, bits)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.strings = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, asked: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query, the places of the strings that share ``depth`` bits with the query's."""
        shift = np.uint64(self.bits - depth)
        low = (asked >> shift) << shift
        high = low + (np.uint64(1) << shift)
        return tuple(
            np.stack([np.searchsorted(own, value) for own, value in zip(self.strings, bound)])
            for bound in (low, high)
        )

    def steps(self, asked: np.ndarray, wanted: int) -> np.ndarray:
        """The ranges of the ascent, deepest first: no deeper than where each query's hold less than ``wanted``."""
        found = []
        for depth in range(self.bits + 1):
            low, high = self.ranges(asked, depth)
            found.append((low, high))
            if ((high - low).sum(axis=0) < wanted).all():
                break
        return np.stack(found[::-1])

    def candidates(self, vectors: np.ndarray, wanted: int):
        """The candidates of each query: trees ascend together until their union holds ``wanted`` entries."""
        for start in range(0, len(vectors), RANGE_QUERIES):
            asked = hash_strings(vectors[start : start + RANGE_QUERIES], len(self.strings), self.bits)
            yield from self.united(self.steps(asked, wanted), wanted)

    def united(self, steps: np.ndarray, wanted: int):
        """What each query finds on its way up; a larger number gives a superset."""
        mark = np.zeros(self.strings.shape[1], bool)
        for query in range(steps.shape[-1]):
            mark[:] = False
            self._ascend(steps[..., query], mark, wanted)
            yield np.flatnonzero(mark)

    def _ascend(self, steps: np.ndarray, mark: np.ndarray, wanted: int) -> None:
        """Mark the ranges of all trees, step by step, until ``wanted`` entries are marked."""
        sizes = (steps[:, 1] - steps[:, 0]).sum(axis=1)
        # Before this step even ranges without a common entry would not be enough.
        first = min(int(np.searchsorted(sizes, wanted)), len(steps) - 1)
        low = high = steps[0, 0]
        for wide_low, wide_high in steps[max(first - 1, 0) :]:
            for tree, order in enumerate(self.order):
                mark[order[wide_low[tree] : low[tree]]] = True
                mark[order[high[tree] : wide_high[tree]]] = True
                if (tree + 1) % TREES_AT_ONCE == 0 and np.count_nonzero(mark) >= wanted:
                    return
            if np.count_nonzero(mark) >= wanted:
                return
            low, high = wide_low, wide_high


def fitted_number(forest: Forest, entries, queries, flat, k: int, recall: float) -> int:
    """The smallest of the numbers tried with which searches find ``recall`` of the nearest of a sample."""
    count = len(entries)
    picked = np.random.default_rng(5).permutation(len(queries))[:SAMPLE_QUERIES]
    scores = np.empty((len(picked), count))
    limits = np.full(len(picked), np.inf)
    for row, query in enumerate(picked):
        scores[row] = entries @ queries[query]
        scores[row, (entries == queries[query]).all(axis=1)] = -np.inf  # its own entry
        others = np.count_nonzero(scores[row] > -np.inf)
        if others:
            limits[row] = np.partition(scores[row], -min(k, others))[-min(k, others)]
    nearest_ones = np.minimum((scores >= limits[:, None]).sum(axis=1), k)

    def number(step: int) -> int:
        return min(max(math.ceil(step / SHARE_STEPS * count), k) + 1, count)

    steps = forest.steps(hash_strings(flat[picked], len(forest.strings), forest.bits), number(0))

    def enough(step: int) -> bool:
        hits = 0
        for row, found in enumerate(forest.united(steps, number(step))):
            hits += min(np.count_nonzero(scores[row, found] >= limits[row]), nearest_ones[row])
        return hits >= recall * nearest_ones.sum()

    return number(bisect.bisect_left(range(SHARE_STEPS), True, key=enough))


def search(entries, most, queries, k: int, trees: int, bits: int, recall: float):
    """(query, entry, score) places and values of the ``k`` best candidates of each query."""
    lift = np.sqrt(np.maximum(0.0, most * most - np.einsum("ij,ij->i", entries, entries)))
    forest = Forest(np.column_stack([entries, lift]), trees, bits)
    flat = np.column_stack([queries, np.zeros(len(queries))])
    wanted = fitted_number(forest, entries, queries, flat, k, recall)
    for query, found in enumerate(forest.candidates(flat, wanted)):
        yield query, found, entries[found] @ queries[query]


def _searcher(k: int, trees: int, bits: int, recall: float):
    columns = ["query_no", "entry", "least_id", "score"]

    def work(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(held) or not len(asked):
            return pd.DataFrame({name: [] for name in columns})
        held = held.sort_values("least_id", kind="stable")
        asked = asked.sort_values("query_id", kind="stable")
        entries, queries = np.stack(held["vector"].to_numpy()), np.stack(asked["vector"].to_numpy())
        ids, least = held["entry"].to_numpy(), held["least_id"].to_numpy()
        parts = []
        for query, found, scores in search(entries, held["most"].iloc[0], queries, k, trees, bits, recall):
            # Entries are in the order of their ids: a stable sort breaks ties by id.
            best = np.argsort(-scores, kind="stable")[: k + 1]
            one = np.full(len(best), asked["query_no"].iloc[query])
            parts.append((one, ids[found[best]], least[found[best]], scores[best]))
        return pd.DataFrame(dict(zip(columns, (np.concatenate(part) for part in zip(*parts)))))

    return work
