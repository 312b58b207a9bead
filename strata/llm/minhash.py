"""Near-duplicate groups by min-max hashing.

A document is the set of its distinct shingles. Each of ``PERMUTATIONS`` hash functions is evaluated
once per shingle and gives two signature values, its minimum and its maximum; bands of ``ROWS_IN_BAND``
minima and bands of as many maxima are the keys of candidate buckets. With 12 + 12 bands of 4 values a
pair at similarity 0.8 has no common bucket with probability (1 - 0.8^4)^24 = 3e-6.

Equal sets are one class from the start, so copies never meet as pairs. In every bucket each class is
paired with the first class of the bucket alone; the connected components of these pairs are families, and
every candidate pair is inside one. A family's sets are divided by size (linked sets differ little) and
dealt into tiles. Each pair of tiles is a task of bounded size that compares full sets as a matrix product,
with exact counts, and gives back a spanning part of the links: no link between texts is lost, and no pairs
are emitted beyond that.

Defined results: a null, empty or wordless text has no shingles and is linked with nothing. Rows that
repeat a doc_id are linked like any others. A null doc_id gives no component_id unless another document
of its group has one. ``drop_near`` keeps one row of each group, whatever ids repeat or are null, and every
row without shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.llm.bloom import blocked_bloom, may_be_in
from strata.llm.common import (
    LOWER,
    bound_batches,
    distinct,
    mixed,
    release_memory,
    released,
    ship_package,
    span_hashes,
    staged,
    text_chunks,
    word_spans,
)
from strata.llm.components import components

ROWS_IN_BAND = 4
PERMUTATIONS = 48
TILE = 512
COLUMNS = 4096
SIGNATURES = "doc_id bigint, n_shingles bigint, name string, bands array<bigint>"
SETS = "name string, shingles array<bigint>"
_NAMED = [StructField("__strata_shingles", LongType()), StructField("__strata_name", StringType())]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each row, one row after the other, and where each row begins."""
    rows = len(offsets) - 1
    data = LOWER[data]
    starts, ends, row = word_spans(data, offsets)
    in_row = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(in_row)])
    hashes = span_hashes(data, starts, ends)
    # A row with fewer words than a shingle has one shingle, of all its words.
    length = np.minimum(in_row, words)
    place = np.arange(len(row)) - first[row]
    begins = np.flatnonzero(place <= (in_row - length)[row])
    length = length[row[begins]]
    shingles = mixed(length.astype(np.uint64) + np.uint64(1))
    for k in range(words):
        within = begins[length > k]
        shingles[length > k] = mixed(shingles[length > k] * np.uint64(0x9FB21C651E98DF25) + hashes[within + k])
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row[begins], minlength=rows))])
    sets = [distinct(shingles[bounds[i] : bounds[i + 1]])[0] for i in range(rows)]
    sizes = np.array([len(one) for one in sets], np.int64)
    return np.concatenate(sets) if sets else shingles, np.concatenate([[0], np.cumsum(sizes)])


def set_names(shingles: np.ndarray, bounds: np.ndarray) -> list[str]:
    """A 128-bit name of each set, from sums of two hashes of its members and its size."""
    sums = []
    for salt in (0x2545F4914F6CDD1D, 0xDA942042E4DD58B5):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mixed(shingles ^ np.uint64(salt)), dtype=np.uint64)])
        sums.append(mixed(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)))
    return [f"{a:016x}{b:016x}" for a, b in zip(*[one.tolist() for one in sums])]


def min_max(shingles: np.ndarray, bounds: np.ndarray, permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima of each non-empty set under each hash function: two arrays (sets, functions)."""
    draw = np.random.default_rng(11)
    starts = bounds[:-1]
    low, high = (np.empty((len(starts), permutations), np.uint64) for _ in range(2))
    for k, (a, b) in enumerate(draw.integers(0, 1 << 63, (permutations, 2), dtype=np.uint64)):
        values = (shingles ^ b) * (a * np.uint64(2) + np.uint64(1))
        low[:, k] = np.minimum.reduceat(values, starts)
        high[:, k] = np.maximum.reduceat(values, starts)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, in_band: int) -> np.ndarray:
    keys = []
    for values in (low, high):
        for first in range(0, values.shape[1], in_band):
            key = np.full(len(values), np.uint64(len(keys) + 1))
            for k in range(first, first + in_band):
                key = mixed(key * np.uint64(0x9FB21C651E98DF25) + values[:, k])
            keys.append(key)
    return np.stack(keys, axis=1)


def _signatures(words: int, permutations: int, in_band: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                sizes = np.diff(bounds)
                filled = sizes > 0
                keys = np.zeros((0, 1), np.uint64)
                if filled.any():
                    starts = np.concatenate([bounds[:-1][filled], bounds[-1:]])
                    keys = band_keys(*min_max(shingles, starts, permutations), in_band)
                ends = np.concatenate([[0], np.cumsum(filled * keys.shape[1])]).astype(np.int32)
                columns = [
                    batch.column("doc_id").slice(first, last - first),
                    pa.array(sizes),
                    pa.array(set_names(shingles, bounds), pa.string()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "name", "bands"])

    return work


def _sets(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                lists = pa.ListArray.from_arrays(
                    pa.array(bounds.astype(np.int32)), pa.array(shingles.view(np.int64))
                )
                names = pa.array(set_names(shingles, bounds), pa.string())
                yield pa.RecordBatch.from_arrays([names, lists], ["name", "shingles"])

    return work


def _with_names(words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                shingles, bounds = shingle_sets(data, offsets, words)
                rows = batch.slice(first, last - first)
                added = [pa.array(np.diff(bounds)), pa.array(set_names(shingles, bounds), pa.string())]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, *added], [*rows.schema.names, "__strata_shingles", "__strata_name"]
                )

    return work


def signatures(
    docs: DataFrame, words: int, permutations: int = PERMUTATIONS, in_band: int = ROWS_IN_BAND
) -> DataFrame:
    """doc_id, n_shingles, name (of the shingle set) and the band keys of each row."""
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(released(_signatures(words, permutations, in_band)), SIGNATURES)


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Linked are documents with 100 * intersection >= ``percent`` * union.
    """
    rows, grouped = _grouped(docs, words, percent)
    smallest = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_class = grouped.join(smallest, "root").select("name", "component_id")
    known = rows.select("doc_id", "n_shingles", "name").join(of_class, "name", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return known.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _grouped(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The written signatures, and of each class of equal sets its name, smallest doc_id and group (root)."""
    rows = staged(signatures(docs, words), "signatures")
    classes = rows.filter("n_shingles > 0").groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    # The numbers of the classes are written with them; results do not depend on which has which.
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    members = classes.select("node", F.explode("bands").alias("bucket"))
    leaders = members.groupBy("bucket").agg(F.min("node").alias("first"), F.count("*").alias("members"))
    shared = members.join(leaders.filter("members > 1").select("bucket", "first"), "bucket")
    # Whoever shares a bucket shares its first member, so every candidate pair is inside one family.
    stars = staged(shared.filter("node != first").select("node", "first").distinct(), "stars")
    family = components(stars.select(F.col("node").alias("a"), F.col("first").alias("b")))
    family = family.select("node", F.col("root").alias("family"))
    sets = staged(class_sets(docs, classes, family, words), "sets")

    edges = staged(family_links(sets, percent), "links")
    found = components(edges)

    grouped = classes.select("name", "node", "doc_id").join(found, "node", "left")
    return rows, grouped.withColumn("root", F.coalesce("root", "node"))


def drop_near(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, with all its columns: of the smallest doc_id and, among rows of this id, of
    the smallest set name, any one. Rows without shingles are groups of their own."""
    rows, grouped = _grouped(docs, words, percent)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "name")
    kept = grouped.groupBy("root").agg(F.min(order).alias("least")).select("least.doc_id", "least.name")
    kept = staged(kept.unionByName(rows.filter("n_shingles = 0").select("doc_id", "name")), "kept")
    kept = kept.select(F.col("doc_id").alias("__strata_doc_id"), F.col("name").alias("__strata_kept"))
    repeated = rows.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    repeated = staged(repeated.select(F.col("doc_id").alias("__strata_doc_id")), "repeated")
    # An id that one row has names the row. Only rows of other ids are told apart by their sets.
    own = kept.join(repeated, "__strata_doc_id", "left_anti").filter("__strata_doc_id IS NOT NULL")
    same_id = F.col("doc_id") == F.col("__strata_doc_id")
    alone = docs.join(own, same_id, "left_semi")
    others = docs.filter("doc_id IS NULL").unionByName(docs.join(repeated, same_id, "left_semi"))
    schema = StructType([*docs.schema.fields, *_NAMED])
    named = others.mapInArrow(released(_with_names(words)), schema)
    same_row = F.col("doc_id").eqNullSafe(F.col("__strata_doc_id")) & (F.col("__strata_name") == F.col("__strata_kept"))
    first = named.filter("__strata_shingles > 0").join(kept, same_row, "left_semi")
    first = first.dropDuplicates(["doc_id", "__strata_name"])
    told = first.unionByName(named.filter("__strata_shingles = 0"))
    return alone.unionByName(told.select(*docs.columns))


def class_sets(docs: DataFrame, classes: DataFrame, family: DataFrame, words: int) -> DataFrame:
    """node, family, shingles of the classes in a family, from the texts with the smallest doc_id of each."""
    wanted = staged(classes.join(family, "node").select("name", "node", "family", "doc_id"), "wanted")
    # No text is shuffled: a filter of bounded size leaves out those of other classes, and the sets of the
    # few that it lets pass are left out by the exact join on names. A semi join on ids here would be moved
    # below the filter by the optimizer, and would shuffle every text.
    ids = wanted.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")).distinct()
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    texts = may_be_in(texts, "id", blocked_bloom(ids, "id"))
    sets = texts.select("text").mapInArrow(released(_sets(words)), SETS).dropDuplicates(["name"])
    return sets.join(wanted.select("name", "node", "family"), "name").select("node", "family", "shingles")


def family_links(sets: DataFrame, percent: int, tile_links=None) -> DataFrame:
    """Links (a, b) that connect what the links inside families connect.

    Sets that may link differ in size by a factor of 100 / ``percent`` at most, so they are in the same size
    class or in neighbouring ones. Each class of a family is dealt into tiles of about ``TILE`` sets by
    hash, and each pair of tiles is one small task: it compares its sets, by default as a matrix product, and
    gives back a spanning part of its links, fewer than it has sets.
    """
    ratio = math.log(100 / percent)
    # The margin keeps a pair right at the limit in neighbouring classes.
    size_class = F.floor(F.log(F.size("shingles").cast("double")) / F.lit(ratio * (1 + 1e-9))).alias("class")
    placed = sets.select("node", "family", size_class, "shingles")
    tiles = placed.groupBy("family", "class").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    # A class meets its own tiles and those of the class above.
    above = tiles.select("family", (F.col("class") - 1).alias("class"), F.col("tiles").alias("above"))
    below = tiles.select("family", (F.col("class") + 1).alias("class"), F.col("tiles").alias("below"))
    counted = (
        tiles.join(above, ["family", "class"], "left")
        .join(below, ["family", "class"], "left")
        .na.fill(0, ["above", "below"])
    )
    tile = F.pmod(F.xxhash64("node"), F.col("tiles"))
    dealt = placed.join(counted, ["family", "class"]).withColumn("tile", tile)
    # The pairs of tiles a set takes part in: (class of the first tile, first tile, class of the second, second).
    own = "transform(sequence(0L, tiles - 1), t -> struct(class AS c, least(tile, t) AS s, class AS d, greatest(tile, t) AS t))"
    up = "if(above = 0, array(), transform(sequence(0L, above - 1), t -> struct(class AS c, tile AS s, class + 1 AS d, t AS t)))"
    down = "if(below = 0, array(), transform(sequence(0L, below - 1), t -> struct(class - 1 AS c, t AS s, class AS d, tile AS t)))"
    meetings = dealt.select(
        "node", "family", "class", "tile", "shingles", F.explode(F.expr(f"concat({own}, {up}, {down})")).alias("pair")
    )
    meetings = meetings.select(
        "node", "family", "pair.*", "shingles", ((F.col("class") == F.col("pair.c")) & (F.col("tile") == F.col("pair.s"))).alias("first")
    )
    return meetings.groupBy("family", "c", "s", "d", "t").applyInArrow(tile_links or _tile_links(percent), "a bigint, b bigint")


def _tile_links(percent: int):
    def work(group: pa.Table) -> pa.Table:
        node = group.column("node").to_numpy()
        first = np.asarray(group.column("first").to_numpy(), bool)
        lists = group.column("shingles").combine_chunks()
        offsets = np.asarray(lists.offsets)
        values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        sizes = np.diff(offsets)
        # A pair of a tile with itself, or of the first tile with the second.
        same = bool(first.all())
        left = np.arange(len(node)) if same else np.flatnonzero(first)
        right = left if same else np.flatnonzero(~first)
        links = []
        if len(left) and len(right) and len(node) > 1:
            links = spanning_links(values, sizes, left, right, percent)
            if len(node) >= TILE // 2:
                release_memory()
        a = [int(node[i]) for i, _ in links]
        b = [int(node[j]) for _, j in links]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return work


def spanning_links(
    values: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int
) -> list[tuple[int, int]]:
    """Links between sets of ``left`` and ``right`` that connect all that are connected by such links."""
    # Numbers for the shingles that more than one set has; the others are in no intersection.
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    begins = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    number = np.empty(len(values), np.int64)
    number[order] = np.cumsum(begins) - 1
    frequent = np.bincount(number) > 1
    renumbered = np.cumsum(frequent) - 1
    kept = frequent[number]
    owner = np.repeat(np.arange(len(sizes)), sizes)[kept]
    column = renumbered[number[kept]]
    width = int(frequent.sum())

    common = np.zeros((len(left), len(right)), np.int64)
    place_left, place_right = np.full(len(sizes), -1), np.full(len(sizes), -1)
    place_left[left], place_right[right] = np.arange(len(left)), np.arange(len(right))
    for start in range(0, width, COLUMNS):
        inside = (column >= start) & (column < start + COLUMNS)
        block = np.zeros((2, max(len(left), len(right)), min(COLUMNS, width - start)), np.float32)
        for side, place in enumerate((place_left, place_right)):
            mine = place[owner[inside]]
            block[side, mine[mine >= 0], column[inside][mine >= 0] - start] = 1
        # A block has too few columns to round a count.
        common += (block[0, : len(left)] @ block[1, : len(right)].T).astype(np.int64)
    either = sizes[left][:, None] + sizes[right][None, :] - common
    linked = common * 100 >= either * percent
    rows, columns = np.nonzero(linked & (left[:, None] != right[None, :]))

    root = list(range(len(sizes)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in zip(left[rows].tolist(), right[columns].tolist()):
        x, y = top(i), top(j)
        if x != y:
            root[x] = y
            links.append((i, j))
    return links
