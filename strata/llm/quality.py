"""Quality classification by nearest-neighbour voting on latent-semantic vectors.

A text is a bag of terms hashed to ``TERMS`` places: its words, the shapes of its words and of pairs of
them (letters as classes, runs shortened, punctuation kept) and words that repeat the word before. The
weights are 1 + log of the counts, times the inverse document frequency, at length 1. A truncated singular
value decomposition of the labelled sample gives ``LATENT`` dimensions. The latent vectors of the sample,
at most ``SAMPLE_ROWS``, are broadcast; the exact cosines of every document with all of them are matrix
products, block by block, and the ``NEIGHBOURS`` nearest vote with a power of their cosine as weight.

The sample is the only bounded part: ``SAMPLE_ROWS`` / 2 labelled rows of either class at most, those with
the smallest hashes of their texts, equal texts once. All documents are scored, over their whole texts.

Defined results: a null, empty or wordless text has no direction and gets the share of good rows in the
sample, as all texts do where no row is labelled (0.5 then). Unlabelled and null labels do not teach. Rows
that repeat a doc_id learn its label alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import (
    bound_batches,
    crc_remainder,
    mixed,
    release_memory,
    released,
    ship_package,
    span_hashes,
    text_chunks,
    word_spans,
)

TERMS = 2048
LATENT = 48
SAMPLE_ROWS = 4096
NEIGHBOURS = 15
SHARPNESS = 4.0
BLOCK = 512

# Classes of bytes: lower letters and all of UTF-8's longer sequences, capitals, digits; others are themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def term_counts(data: np.ndarray, offsets: np.ndarray, terms: int = TERMS) -> np.ndarray:
    """How often each hashed term is in each row: (rows, terms)."""
    rows = len(offsets) - 1
    starts, ends, row = word_spans(data, offsets)
    if not len(starts):
        return np.zeros((rows, terms), np.float32)
    words = span_hashes(data, starts, ends)
    # Shapes: third and later bytes of a run of one class are left out.
    shape = _SHAPE[data]
    kept = np.ones(len(shape), bool)
    kept[2:] = (shape[2:] != shape[1:-1]) | (shape[1:-1] != shape[:-2])
    kept[starts] = True
    place = np.concatenate([[0], np.cumsum(kept)])
    shapes = span_hashes(shape[kept], place[starts], place[ends])
    follows = np.flatnonzero(row[1:] == row[:-1]) + 1
    salted = (
        (words, row),
        (mixed(shapes + np.uint64(1)), row),
        (mixed(shapes[follows - 1] * np.uint64(3) + shapes[follows]), row[follows]),
        (np.where(words[follows] == words[follows - 1], np.uint64(1), np.uint64(2)), row[follows]),
    )
    cells = np.concatenate([at * terms + (mixed(term) % np.uint64(terms)).astype(np.int64) for term, at in salted])
    return np.bincount(cells, minlength=rows * terms).reshape(rows, terms).astype(np.float32)


def leading_axes(rows: np.ndarray, most: int, rounds: int = 12) -> np.ndarray:
    """The right singular vectors of the largest singular values, by subspace iteration from a fixed start with some
    axes to spare: (columns, ``most``)."""
    wide = min(rows.shape[1], most + 16)
    axes = np.random.default_rng(13).normal(size=(rows.shape[1], wide)).astype(np.float32)
    for _ in range(rounds):
        axes = np.linalg.qr(rows.T @ (rows @ axes))[0]
    seen = rows @ axes
    _, turn = np.linalg.eigh((seen.T @ seen).astype(float))
    return (axes @ turn[:, ::-1][:, :most]).astype(np.float32)


@dataclass
class LatentVote:
    """The fitted classifier: bounded by the sample and the number of terms and dimensions."""

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    good: np.ndarray
    share: float

    @classmethod
    def fit(cls, counts: np.ndarray, good: np.ndarray, latent: int = LATENT) -> LatentVote:
        """``counts`` becomes the weights: of the sample there is one copy, and beside it only narrow arrays."""
        share = float(good.mean()) if len(good) else 0.5
        rarity = np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
        weights = counts
        for first in range(0, len(counts), BLOCK):
            weights[first : first + BLOCK] = _weights(counts[first : first + BLOCK], rarity)
        axes = leading_axes(weights, latent) if len(good) else np.zeros((counts.shape[1], 1), np.float32)
        vectors = _unit(weights @ axes)
        # A row without terms has no direction to vote from.
        there = np.linalg.norm(vectors, axis=1) > 0
        return cls(rarity, axes, vectors[there], good[there].astype(np.float32), share)

    def vote(self, counts: np.ndarray, neighbours: int, sharpness: float) -> np.ndarray:
        scores = np.full(len(counts), self.share)
        if not len(self.vectors):
            return scores
        for first in range(0, len(counts), BLOCK):
            block = _unit(_weights(counts[first : first + BLOCK], self.rarity) @ self.axes)
            cosines = block @ self.vectors.T
            k = min(neighbours, cosines.shape[1])
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-3).astype(float) ** sharpness
            voted = (weight * self.good[near]).sum(axis=1) / weight.sum(axis=1)
            there = np.linalg.norm(block, axis=1) > 0
            scores[first : first + BLOCK][there] = voted[there]
        return np.clip(scores, 0.0, 1.0)


def _weights(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    return _unit(np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * rarity)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-9)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, teaches: Column, most: int) -> DataFrame:
    """text and label of at most ``most`` / 2 rows per class, those with the smallest text hashes."""
    known = labels.select(F.col("doc_id").alias("labelled_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("label IS NOT NULL AND labelled_id IS NOT NULL").dropDuplicates(["labelled_id", "label"])
    text = F.coalesce("text", F.lit(""))
    texts = docs.filter(teaches).select("doc_id", text.alias("text"), F.xxhash64(text).alias("order"))
    # Only ids and hashes meet the labels; one id stands for each text, so its copies are not fetched.
    hashed = texts.select("doc_id", "order").join(known, F.col("doc_id") == F.col("labelled_id"))
    hashed = hashed.groupBy("order", "label").agg(F.min("doc_id").alias("doc_id"))
    of_class = [hashed.filter(F.col("label") == value).orderBy("order").limit(most // 2) for value in (0, 1)]
    # ``most`` rows are broadcast; the documents are read again, and no text outside the sample is shuffled.
    picked = F.broadcast(of_class[0].unionByName(of_class[1]))
    sample = texts.join(picked, ["doc_id", "order"]).select("text", "label", "order")
    return sample.dropDuplicates(["order", "label"])


def fit(docs: DataFrame, labels: DataFrame, label: str, teaches: Column, most: int = SAMPLE_ROWS) -> LatentVote:
    sample = labelled_sample(docs, labels, label, teaches, most)
    ship_package(docs.sparkSession)
    bound_batches(docs.sparkSession)
    # Counts of at most ``most`` rows come to the driver, not their texts.
    rows = (
        sample.select("text", "label", "order")
        .mapInArrow(_sample_counts, "label int, order bigint, counts binary")
        .orderBy("order", "label")
        .toArrow()
    )
    counts = np.zeros((rows.num_rows, TERMS), np.float32)
    for i, packed in enumerate(rows.column("counts")):
        places, values = np.frombuffer(packed.as_buffer(), np.float32).reshape(2, -1)
        counts[i, places.astype(np.int64)] = values
    model = LatentVote.fit(counts, rows.column("label").to_numpy().astype(float))
    del rows, counts
    release_memory()
    return model


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for _, _, data, offsets in text_chunks(batch.column("text")):
            for row in term_counts(data, offsets):
                at = np.flatnonzero(row)
                packed.append(np.stack([at.astype(np.float32), row[at]]).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), batch.column("order"), pa.array(packed, pa.binary())],
            ["label", "order", "counts"],
        )


def vote_column(model: LatentVote, spark: SparkSession) -> Column:
    """The score of ``text`` as a column."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            scores = [
                shared.value.vote(term_counts(data, offsets), NEIGHBOURS, SHARPNESS)
                for _, _, data, offsets in text_chunks(pa.array(texts, pa.large_string(), from_pandas=True))
            ]
            yield pd.Series(np.concatenate([np.zeros(0), *scores]))
        release_memory()

    return vote(F.coalesce(F.col("text"), F.lit("")))


def score(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1, higher: label 1 likelier)."""
    held_out = F.coalesce(held_out, F.lit(False))
    model = fit(docs, labels, label, ~held_out, most)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"),
        vote_column(model, docs.sparkSession).alias("score"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, least: float, most: int = SAMPLE_ROWS
) -> DataFrame:
    """The rows of ``docs`` whose score is ``least`` or more, with all their columns."""
    model = fit(docs, labels, label, ~F.coalesce(held_out, F.lit(False)), most)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_chunks(batch.column("text")):
                scores = shared.value.vote(term_counts(data, offsets), NEIGHBOURS, SHARPNESS)
                yield batch.slice(first, last - first).filter(pa.array(scores >= least))

    return docs.mapInArrow(released(work), docs.schema)


def fold(parts: int = 5) -> Column:
    """Rows that do not teach: crc32 of the doc_id as text leaves no remainder."""
    return crc_remainder("doc_id", parts) == 0
