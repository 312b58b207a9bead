"""N-gram Jaccard join with R-trees of count vectors.

A document is the set of its distinct shingles; equal sets are one class (a node, named by 64 bits of the
hash of the set). The shingles of a set are hashed into groups, and the counts of the groups are its point.

1. Work is divided so that linked sets surely meet: of two linked sets each has a shingle of the other among
   its first n - ceil(0.8 n) + 1 ones, in any order of all shingles that is the same for both. Frequent
   shingles come last: each task counts what is frequent in it, and the ``FREQUENT`` most frequent are
   broadcast. The counts only choose an order; no link depends on them.
2. The sets that share such a shingle are a bucket; buckets of the same sets are one. Sets have more groups the
   larger they are (2^bits, with 2 to 4 shingles in each), and meet at the bits of the smaller: a bucket is divided
   by bits. Each part is an R-tree of points, joined with itself: pairs of boxes, then of points, whose summed
   coordinate minima cannot reach the similarity are left out. A bucket gives a spanning part of the pairs that are left, and the components of
   these are families of sets that are close by that bound. Large buckets are dealt into tiles, and each
   pair of tiles is a task of bounded size.
3. A family's full sets are dealt into tiles by size. In each pair of tiles an R-tree with finer groups gives
   the surviving pairs, which are verified by exact intersection, unless links already found connect them.
   The components of the verified links are the result: no link between different texts is lost.

Defined results: a null, empty or wordless text has no shingles and is linked with nothing. Rows that repeat
a doc_id are linked like any others. A null doc_id gives no component_id unless another document of its
group has one. Fewer words than a shingle has are one shingle. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mixed, ship_package, sorted_groups, staged, text_chunks
from strata.llm.components import components
from strata.llm.count_tree import CountTree, Links, count_vectors, may_link
from strata.llm.minhash import class_sets, family_links, set_names, shingle_sets

LEAST_BITS, MOST_BITS = 4, 14
FREQUENT = 1 << 17
TASK_FREQUENT = 1 << 14
BUCKET_TILE = 1024
FEW = 8
_PROFILE = "doc_id bigint, n_shingles bigint, name string, node bigint, bits array<int>, point binary, token bigint, seen bigint"
_POSTINGS = "token bigint, node bigint"
_BUCKETS = "bucket bigint, node bigint"
_EDGES = "a bigint, b bigint"


def nodes_of(names: list[str]) -> np.ndarray:
    return np.array([int(name[:16], 16) for name in names], np.uint64).view(np.int64)


def bits_of(sizes: np.ndarray) -> np.ndarray:
    """Bits of the group number for sets of these sizes, 1 and above."""
    return np.clip(np.frexp(sizes)[1] - 2, LEAST_BITS, MOST_BITS)


def folded(points: np.ndarray, bits: int) -> np.ndarray:
    """Points brought to fewer groups: the groups that agree in their first bits are added."""
    return points.reshape(len(points), 1 << bits, -1).sum(axis=2, dtype=np.int32)


def written_point(point: np.ndarray) -> bytes:
    """A point in bytes, or in four bytes a group where a count is above 255."""
    return (point.astype(np.uint8) if point.max() < 256 else point).tobytes()


def read_point(written: pa.Buffer, own_bits: int) -> np.ndarray:
    return np.frombuffer(written, np.uint8 if len(written) == 1 << own_bits else np.int32)


def points_of(shingles: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The point of each set at its own bits."""
    sizes = np.diff(bounds)
    points = [b""] * len(sizes)
    bits = bits_of(sizes)
    for each in np.unique(bits).tolist():
        chosen = np.flatnonzero(bits == each)
        members = np.repeat(bits == each, sizes)
        own = np.concatenate([[0], np.cumsum(sizes[chosen])])
        for i, point in zip(chosen.tolist(), count_vectors(shingles[members], own, each)):
            points[i] = written_point(point)
    return points


class FrequentTokens:
    """The most frequent of the tokens added, with counts that may be too low: the rare ones are dropped
    whenever there are too many to keep."""

    def __init__(self, most: int):
        self.most, self.tokens, self.counts = most, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, tokens: np.ndarray) -> None:
        found, counts = np.unique(tokens, return_counts=True)
        repeated = (counts > 1) | np.isin(found, self.tokens)
        found, counts = found[repeated], counts[repeated]
        merged, place = np.unique(np.concatenate([self.tokens, found]), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate([self.counts, counts])).astype(np.int64)
        kept = np.argsort(-sums, kind="stable")[: self.most]
        kept.sort()
        self.tokens, self.counts = merged[kept], sums[kept]


def _profiles(words: int, percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in _PROFILE.split(", ")]
        frequent, waiting, held = FrequentTokens(TASK_FREQUENT), [], 0
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                waiting.append(shingles.view(np.int64))
                held += len(shingles)
                if held > 1 << 21:
                    frequent.add(np.concatenate(waiting))
                    waiting, held = [], 0
                own = set_names(shingles, bounds)
                rows, sizes = last - first, np.diff(bounds)
                # Those of the smallest set that may be linked, to its own.
                least = bits_of(-(-percent * sizes // 100))
                bits = [list(range(low, high + 1)) for low, high in zip(least.tolist(), bits_of(sizes).tolist())]
                none = pa.nulls(rows, pa.int64())
                columns = [
                    batch.column("doc_id").slice(first, rows), pa.array(sizes), pa.array(own, pa.string()),
                    pa.array(nodes_of(own)), pa.array(bits, pa.list_(pa.int32())),
                    pa.array(points_of(shingles, bounds), pa.binary()), none, none,
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
        if waiting:
            frequent.add(np.concatenate(waiting))
        rows = len(frequent.tokens)
        none = pa.nulls(rows, pa.int64())
        columns = [
            none, none, pa.nulls(rows, pa.string()), none, pa.nulls(rows, pa.list_(pa.int32())), pa.nulls(rows, pa.binary()),
            pa.array(frequent.tokens), pa.array(frequent.counts),
        ]
        yield pa.RecordBatch.from_arrays(columns, names)

    return work


def prefix_lengths(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many first shingles of a set are enough to share one with every linked set."""
    return sizes + (-percent * sizes) // 100 + 1


def first_shingles(
    shingles: np.ndarray, bounds: np.ndarray, percent: int, frequent: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set, rare ones before frequent ones, and the set each is of."""
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.zeros(len(shingles), np.int64)
    if len(frequent) and len(shingles):
        tokens = shingles.view(np.int64)
        place = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        rank = np.where(frequent[place] == tokens, counts[place], 0)
    # Equal ranks are told apart by another hash than the one the groups are made of.
    order = np.lexsort((mixed(shingles), rank, owner))
    place = np.arange(len(shingles)) - bounds[:-1][owner]
    chosen = order[place < np.repeat(prefix_lengths(sizes, percent), sizes)]
    return shingles[chosen], owner[chosen]


def _postings(words: int, percent: int, shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = shared.value
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                nodes = nodes_of(set_names(shingles, bounds))
                # A chunk's copies are one set.
                alone = np.zeros(len(nodes), bool)
                alone[np.unique(nodes, return_index=True)[1]] = True
                tokens, owner = first_shingles(shingles, bounds, percent, frequent, counts)
                kept = alone[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[kept].view(np.int64)), pa.array(nodes[owner[kept]])], ["token", "node"]
                )

    return work


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by token and node: the nodes of each token that has two or more, under the name
    of the bucket, a hash of these nodes."""
    for rows in sorted_groups(batches, "token"):
        token, node = rows.column("token").to_numpy(), rows.column("node").to_numpy()
        fresh = np.concatenate([[True], (token[1:] != token[:-1]) | (node[1:] != node[:-1])])
        token, node = token[fresh], node[fresh]
        begins = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(begins, append=len(token))
        name = mixed(np.add.reduceat(mixed(node.view(np.uint64)), begins) + sizes.astype(np.uint64))
        _, alone = np.unique(name, return_index=True)
        kept = np.zeros(len(begins), bool)
        kept[alone] = True
        kept = np.repeat(kept & (sizes > 1), sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(name, sizes)[kept].view(np.int64)), pa.array(node[kept])], ["bucket", "node"]
        )


def close_pairs(points: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of ``left`` and ``right`` that connect all whom pairs within the bound connect."""
    links, found = Links(len(sizes)), []
    # With the first point alone most of a family of near copies is one class, which the tree leaves out.
    for one, many in ((left[0], right), (right[0], left)):
        near = may_link(np.minimum(points[one], points[many]).sum(axis=1), sizes[one], sizes[many], percent)
        found += [(one, other) for other in many[near].tolist() if links.join(one, other)]
    labels = links.labels()
    if (labels == labels[0]).all():
        return found
    tree = CountTree(points[left], sizes[left])
    other = tree if left is right else CountTree(points[right], sizes[right])
    for a, b in tree.join(other, percent, labels[left], labels[right]):
        found += [(i, j) for i, j in zip(left[a].tolist(), right[b].tolist()) if links.join(i, j)]
    return found


def _bucket_pairs(percent: int):
    def pairs_of(key: np.ndarray, sizes: np.ndarray, first: np.ndarray, points: np.ndarray) -> Iterator[tuple]:
        """Places of close pairs in whole meetings, sorted, of points of the same bits."""
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        counts = np.diff(begins, append=len(key))
        members = np.repeat(counts, counts)
        for step in range(1, FEW):
            i = np.flatnonzero((key[step:] == key[:-step]) & (members[:-step] <= FEW))
            for some in np.array_split(i, len(i) * points.shape[1] // (1 << 20) + 1):
                overlap = np.minimum(points[some], points[some + step]).sum(axis=1)
                near = some[may_link(overlap, sizes[some], sizes[some + step], percent)]
                yield near, near + step
        for begin, end in zip(begins[counts > FEW].tolist(), (begins + counts)[counts > FEW].tolist()):
            left = np.flatnonzero(first[begin:end])
            right = left if len(left) == end - begin else np.flatnonzero(~first[begin:end])
            if len(left) and len(right):
                pairs = close_pairs(points[begin:end], sizes[begin:end], left, right, percent)
                yield tuple(begin + np.array([pair[side] for pair in pairs], np.int64) for side in (0, 1))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, "meeting"):
            key, node = rows.column("meeting").to_numpy(), rows.column("node").to_numpy()
            sizes, bits = rows.column("n").to_numpy(), rows.column("bits").to_numpy()
            first = np.asarray(rows.column("first").to_numpy(zero_copy_only=False), bool)
            own, own_bits = rows.column("point"), rows.column("own_bits").to_numpy()
            edges = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            for each in np.unique(bits).tolist():
                mine = np.flatnonzero(bits == each)
                points = np.zeros((len(mine), 1 << each), np.int32)
                for k, i in enumerate(mine.tolist()):
                    points[k] = folded(read_point(own[i].as_buffer(), own_bits[i])[None], each)
                found = pairs_of(key[mine], sizes[mine], first[mine], points)
                edges += [(mine[i], mine[j]) for i, j in found]
            a, b = (pa.array(node[np.concatenate(side)]) for side in zip(*edges))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    return work


def bucket_families(buckets: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """node, family of the classes that a pair within the bound connects with another."""
    sizes = buckets.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET_TILE).alias("tiles"))
    large = staged(sizes.filter("tiles > 1"), "large-buckets")
    points = classes.select(F.col("node").alias("of_node"), "n", "bits", "point")
    dealt = buckets.join(large, "bucket", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1).cast("bigint")))
    dealt = dealt.join(points, F.col("node") == F.col("of_node")).drop("of_node")
    dealt = dealt.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")))
    # Each set once for each pair of tiles that its own tile is in.
    dealt = dealt.withColumn("with", F.explode(F.expr("sequence(0L, tiles - 1)")))
    dealt = dealt.withColumn("own_bits", F.array_max("bits")).withColumn("bits", F.explode("bits"))
    meeting = F.xxhash64("bucket", "bits", F.least("tile", "with"), F.greatest("tile", "with"))
    dealt = dealt.select(meeting.alias("meeting"), "node", "n", "bits", "own_bits", "point", (F.col("tile") <= F.col("with")).alias("first"))
    sorted_rows = dealt.repartition("meeting").sortWithinPartitions("meeting", "node")
    edges = sorted_rows.mapInArrow(_bucket_pairs(percent), _EDGES)
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return components(staged(edges, "close-pairs")).select("node", F.col("root").alias("family"))


def verified_links(
    values: np.ndarray, bounds: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links between sets of ``left`` and ``right`` that connect all whom such links connect."""
    sizes = np.diff(bounds)
    points = count_vectors(values, bounds, int(bits_of(sizes.max(keepdims=True))[0]))
    links, found = Links(len(sizes)), []

    def linked(i: int, j: int) -> bool:
        if not may_link(np.minimum(points[i], points[j]).sum(), sizes[i], sizes[j], percent):
            return False
        short, long = sorted((values[bounds[k] : bounds[k + 1]] for k in (i, j)), key=len)
        place = np.minimum(np.searchsorted(long, short), len(long) - 1)
        return bool(may_link((long[place] == short).sum(), sizes[i], sizes[j], percent))

    def verify(pairs: Iterator[tuple[int, int]]) -> None:
        for i, j in pairs:
            if links.top(i) != links.top(j) and linked(i, j):
                links.join(i, j)
                found.append((i, j))

    for one, many in ((left[0], right), (right[0], left)):
        verify((int(one), other) for other in many.tolist())
    labels = links.labels()
    if not (labels == labels[0]).all():
        tree = CountTree(points[left], sizes[left])
        other = tree if left is right else CountTree(points[right], sizes[right])
        for a, b in tree.join(other, percent, labels[left], labels[right]):
            verify(zip(left[a].tolist(), right[b].tolist()))
    return found


def _tile_links(percent: int):
    def work(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        first = np.asarray(group.column("first").to_numpy(), bool)
        lists = group.column("shingles").combine_chunks()
        offsets = np.asarray(lists.offsets).astype(np.int64)
        values = lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64)
        left = np.arange(len(node)) if first.all() else np.flatnonzero(first)
        right = left if first.all() else np.flatnonzero(~first)
        links = []
        if len(left) and len(right) and len(node) > 1:
            links = verified_links(values, offsets - offsets[0], left, right, percent)
        a, b = (pa.array([int(node[one[side]]) for one in links], pa.int64()) for side in (0, 1))
        return pa.table({"a": a, "b": b})

    return work


def jaccard_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Linked are documents with 100 * intersection >= ``percent`` * union.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    profiles = staged(texts.mapInArrow(_profiles(words, percent), _PROFILE), "profiles")
    rows = profiles.filter("name IS NOT NULL")
    classes = rows.filter("n_shingles > 0").groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("node").alias("node"),
        F.first("bits").alias("bits"), F.first("point").alias("point"),
    )
    classes = staged(classes, "classes")

    # At most ``FREQUENT`` rows come to the driver and are broadcast.
    seen = profiles.filter("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
    most = seen.orderBy(F.desc("seen"), "token").limit(FREQUENT).toArrow()
    tokens, counts = most.column("token").to_numpy(), most.column("seen").to_numpy()
    order = np.argsort(tokens)
    shared = spark.sparkContext.broadcast((tokens[order], counts[order]))
    postings = docs.select("text").mapInArrow(_postings(words, percent, shared), _POSTINGS)
    postings = postings.repartition("token").sortWithinPartitions("token", "node")
    buckets = staged(postings.mapInArrow(_buckets, _BUCKETS).distinct(), "buckets")

    family = bucket_families(buckets, classes, percent)
    sets = staged(class_sets(docs, classes, family, words), "sets")
    found = components(staged(family_links(sets, percent, _tile_links(percent)), "links"))
    grouped = classes.select("name", "node", "doc_id").join(found, "node", "left")
    grouped = grouped.withColumn("root", F.coalesce("root", "node"))
    smallest = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = grouped.join(smallest, "root").select("name", "component_id")
    known = rows.select("doc_id", "n_shingles", "name").join(of_class, "name", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return known.select("doc_id", "n_shingles", component.alias("component_id"))
