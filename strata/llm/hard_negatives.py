"""Hard-negative mining by threshold joins with an inverted index bounded by suffix norms.

Rows are dealt into shards of about ``SHARD_ROWS`` and anchors into blocks; a task joins one of each. The
dimensions are taken in the order of their energy, ``STEP`` at a time. For a threshold the index of a shard
lists a row under a step of dimensions only while the norm of what is left of the row, times that of the
anchor, can still reach the threshold: the suffix the bound covers is in no list, and a row whose whole
norm is too small is in none. A join adds up partial scores list by list, drops a pair once its partial
score plus the product of the remaining norms is below the threshold, and scores the pairs that are left in
full. Thresholds start high and are lowered, for the anchors that need it, until their windows are
full or nothing lower counts; so each shard gives its best rows exactly, and the best of all shards are
the best of the table.

There are two joins: with the rows of the anchor's label, for its positives, and with those of other
labels, for the negatives whose scores lie between the given percentages of each positive's.

Defined results: components become floor(256 * x), scores are exact below 2^53. Rows with a null vec_id,
label or vector or a null or non-finite component take no part, nor do rows of another length than
the anchor's. Rows with the anchor's vec_id are not its partners. Rows that repeat a vec_id are each a row of their
own, as anchors too. Ties go to the smaller vec_id. Without partners an anchor has no rows in the result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship_package, staged

SCALE = 256
STEP = 8
SHARD_ROWS = 8_192
ANCHOR_ROWS = 1_024
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT, MOST_PERCENT = 30, 90
LOWER = 0.8
# Allows for rounding in norms; scores themselves are whole numbers.
_MARGIN = 1e-9
_POSITIVES = "anchor_no bigint, positive_id bigint, positive_score bigint"
_NEGATIVES = "anchor_no bigint, place int, negative_id bigint, negative_score bigint"


class SuffixIndex:
    """Rows of a shard, their dimensions ordered by energy, and the norms of what is left of a row behind
    each step of dimensions."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
        self.vectors = vectors[:, self.order]
        self.starts = range(0, vectors.shape[1], STEP)
        self.left = suffix_norms(self.vectors)

    def join(self, anchors: np.ndarray, least: np.ndarray, may: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row and score of all pairs that ``may`` allows (anchors, rows) with a score of at least the
        anchor's threshold."""
        anchors = anchors[:, self.order]
        left = suffix_norms(anchors)
        # Behind this norm of a row's suffix no anchor can find what it asks for.
        covered = np.min(least / np.maximum(left[:, 0], 1e-300)) * (1 - _MARGIN)
        rows = np.flatnonzero(may.any(axis=0) & (self.left[:, 0] >= covered))
        live = may[:, rows]
        partial = np.zeros(live.shape)
        for step, start in enumerate(self.starts):
            # Rows whose suffix from here on is omitted keep the bound they had when their lists ended.
            listed = np.flatnonzero(self.left[rows, step] >= covered)
            if not len(listed):
                break
            partial[:, listed] += anchors[:, start : start + STEP] @ self.vectors[rows[listed], start : start + STEP].T
            reach = left[:, step + 1 : step + 2] * (self.left[rows[listed], step + 1] * (1 + _MARGIN))
            live[:, listed] &= partial[:, listed] + reach >= least[:, None] - _MARGIN
            kept = live.any(axis=0)
            if not kept.all():
                rows, live, partial = rows[kept], live[:, kept], partial[:, kept]
        anchor, place = np.nonzero(live)
        row = rows[place]
        scores = np.empty(len(row))
        for first in range(0, len(row), 1 << 18):
            some = slice(first, first + (1 << 18))
            scores[some] = np.einsum("ij,ij->i", anchors[anchor[some]], self.vectors[row[some]])
        found = scores >= least[anchor]
        return anchor[found], row[found], scores[found]


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Norm of each row from each step of dimensions on, and 0 behind the last."""
    squares = np.add.reduceat(vectors**2, range(0, vectors.shape[1], STEP), axis=1)
    sums = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([sums, np.zeros((len(vectors), 1))], axis=1))


def _best(anchor: np.ndarray, row: np.ndarray, scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` first pairs of each anchor: highest score, then smallest id."""
    order = np.lexsort((ids[row], -scores, anchor))
    ordered = anchor[order]
    opens = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(order) else np.zeros(0, bool)
    nth = np.arange(len(order)) - np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))
    return order[nth < most]


def best_positives(index: SuffixIndex, ids: np.ndarray, anchors: np.ndarray, may: np.ndarray, most: int):
    """Anchor, row and score of the ``most`` best allowed rows of each anchor."""
    ceiling = np.linalg.norm(anchors, axis=1) * index.left[:, 0].max(initial=0)
    waiting, share, parts = np.arange(len(anchors)), 0.5, []
    while len(waiting):
        # Below a tenth of what two parallel vectors score, all rows are asked for.
        least = ceiling[waiting] * share if share > 0.1 else np.full(len(waiting), -np.inf)
        anchor, row, scores = index.join(anchors[waiting], least, may[waiting])
        enough = np.bincount(anchor, minlength=len(waiting)) >= most
        full = enough | (share <= 0.1)
        place = _best(anchor, row, scores, ids, most)
        place = place[full[anchor[place]]]
        parts.append((waiting[anchor[place]], row[place], scores[place]))
        waiting, share = waiting[~full], share * LOWER
    return [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 3


def best_in_windows(index: SuffixIndex, ids: np.ndarray, anchors: np.ndarray, may: np.ndarray, windows: list, most: int):
    """Anchor, window, row and score of the ``most`` best allowed rows in each window of each anchor.

    ``windows`` has for each anchor its (lowest, highest) scores, bounds included.
    """
    lowest = np.array([min((low for low, _ in own), default=np.inf) for own in windows])
    # The first threshold is a step below the lowest window's upper bound.
    least = np.array([min((high for _, high in own), default=np.inf) for own in windows])
    waiting, parts = np.flatnonzero(np.isfinite(lowest)), []
    while len(waiting):
        least[waiting] = np.maximum(lowest[waiting], least[waiting] - (1 - LOWER) * np.abs(least[waiting]) - 1)
        anchor, row, scores = index.join(anchors[waiting], least[waiting], may[waiting])
        bounds = np.searchsorted(anchor, np.arange(len(waiting) + 1))
        full = least[waiting] <= lowest[waiting]
        found = []
        for k, number in enumerate(waiting.tolist()):
            mine = slice(bounds[k], bounds[k + 1])
            inside = [(scores[mine] >= low) & (scores[mine] <= high) for low, high in windows[number]]
            full[k] |= all(chosen.sum() >= most or least[number] <= low for chosen, (low, _) in zip(inside, windows[number]))
            if full[k]:
                for place, chosen in enumerate(inside):
                    own_row, own_score = row[mine][chosen], scores[mine][chosen]
                    best = np.lexsort((ids[own_row], -own_score))[:most]
                    found.append((np.full(len(best), number), np.full(len(best), place), own_row[best], own_score[best]))
        parts += found
        waiting = waiting[~full]
    return [np.concatenate(column) for column in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4


def _batches(held: pd.DataFrame, asked: pd.DataFrame, same_label: bool):
    """The shard's index and, for a few anchors at a time, their numbers, vectors and allowed pairs."""
    index = SuffixIndex(np.array(held["vector"].tolist(), float))
    ids, labels = held["vec_id"].to_numpy(), held["label"].to_numpy()
    for first in range(0, len(asked), 128):
        some = asked.iloc[first : first + 128]
        may = (some["label"].to_numpy()[:, None] == labels) == same_label
        may &= some["vec_id"].to_numpy()[:, None] != ids
        yield index, ids, some, np.array(some["vector"].tolist(), float), may


def _positives(most: int):
    names = [part.split()[0] for part in _POSITIVES.split(", ")]

    def work(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({name: np.zeros(0, np.int64) for name in names})]
        if len(held) and len(asked):
            for index, ids, some, vectors, may in _batches(held, asked, True):
                anchor, row, scores = best_positives(index, ids, vectors, may, most)
                numbers = some["anchor_no"].to_numpy()[anchor.astype(int)]
                columns = (numbers, ids[row.astype(int)], scores.astype(np.int64))
                parts.append(pd.DataFrame(dict(zip(names, columns))))
        return pd.concat(parts)

    return work


def _negatives(most: int, percents: tuple[int, int]):
    names = [part.split()[0] for part in _NEGATIVES.split(", ")]

    def window(score: int) -> tuple[int, int]:
        """The whole scores n with percents[0] * score <= 100 * n <= percents[1] * score."""
        return -(-percents[0] * score // 100), percents[1] * score // 100

    def work(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        parts = [pd.DataFrame({name: np.zeros(0, np.int64) for name in names})]
        if len(held) and len(asked):
            for index, ids, some, vectors, may in _batches(held, asked, False):
                windows = [[window(int(score)) for score in scores] for scores in some["scores"]]
                anchor, place, row, scores = best_in_windows(index, ids, vectors, may, windows, most)
                numbers = some["anchor_no"].to_numpy()[anchor.astype(int)]
                columns = (numbers, place.astype(np.int64) + 1, ids[row.astype(int)], scores.astype(np.int64))
                parts.append(pd.DataFrame(dict(zip(names, columns))))
        return pd.concat(parts)

    return work


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, vector (whole numbers as doubles) and length of the rows that take part."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.select("vec_id", F.col("label").cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
        .filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .filter(F.coalesce(finite, F.lit(False)) & (F.size("vector") > 0))
        .withColumn("vector", F.transform("vector", lambda x: F.floor(x * F.lit(float(SCALE))).cast("double")))
        .withColumn("length", F.size("vector"))
    )


def _every(parts: int) -> Column:
    """A row for each part, of the type that ``pmod`` of a hash has: both sides of a cogroup need the same."""
    return F.explode(F.expr(f"sequence(0L, {parts - 1}L)"))


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percents: tuple[int, int] = (LEAST_PERCENT, MOST_PERCENT),
    shard_rows: int = SHARD_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each of the first
    ``positives`` rows of an anchor's label the first ``negatives`` rows of other labels whose scores are within
    ``percents`` of the positive's score.

    ``vectors`` has vec_id, label and embedding.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    entries = staged(usable(vectors).withColumn("entry", F.monotonically_increasing_id()), "entries")
    anchors = staged(entries.filter(is_anchor).withColumnRenamed("entry", "anchor_no"), "anchors")
    shards = max(1, -(-entries.count() // shard_rows))
    blocks = max(1, -(-anchors.count() // anchor_rows))
    keys = ["length", "shard", "block"]
    held = entries.select(
        "length", F.pmod(F.xxhash64("entry"), F.lit(shards).cast("bigint")).alias("shard"),
        _every(blocks).alias("block"), "vec_id", "label", "vector",
    )

    def joined(asked: DataFrame, work, schema: str) -> DataFrame:
        """Every shard with every block of anchors, a task of bounded size for each pair."""
        asked = asked.select(
            F.col("length").alias("length"), _every(shards).alias("shard"),
            F.pmod(F.xxhash64("anchor_no"), F.lit(blocks).cast("bigint")).alias("block"),
            *[F.col(name).alias(name) for name in asked.columns if name != "length"],
        )
        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(work, schema)

    first = Window.partitionBy("anchor_no").orderBy(F.desc("positive_score"), "positive_id")
    found = staged(joined(anchors, _positives(positives), _POSITIVES), "positives")
    found = found.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= positives)
    found = staged(found, "best-positives")

    windows = found.groupBy("anchor_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda one: one["positive_score"]).alias("scores")
    )
    asked = staged(anchors.join(windows, "anchor_no"), "windows")
    near = staged(joined(asked, _negatives(negatives, percents), _NEGATIVES), "negatives")
    hardest = Window.partitionBy("anchor_no", "place").orderBy(F.desc("negative_score"), "negative_id")
    near = near.withColumn("rank", F.row_number().over(hardest)).filter(F.col("rank") <= negatives)
    return (
        near.join(found, ["anchor_no", "place"])
        .join(anchors.select("anchor_no", F.col("vec_id").alias("anchor_id")), "anchor_no")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
