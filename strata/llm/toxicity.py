"""Toxicity by gradient-boosted trees over a few dense features, calibrated by isotonic regression.

Features of a text, all rates over its whole length: hits of a fixed lexicon and of one learned from the
labels, such hits near a second-person pronoun, capitals, punctuation, exclamation marks, and words that
only spell a lexicon entry once look-alike characters are undone. Every document gets its features in one
pass over the texts; trees and calibration are applied to the features.

The classifier is fitted on at most ``SAMPLE_ROWS`` / 2 labelled rows of either class, those with the smallest
hashes of their texts, equal texts once; a fifth of them, by hash, calibrates and teaches neither stems nor
trees. The learned lexicon holds at most ``LEARNED_TERMS`` stems, the first ``STEM`` characters of words. All of
it is bounded; scores cover all documents.

Defined results: a null, empty or wordless text has the features 0 and their score. Null labels do not
teach. Where a class has no labelled row, the score is the share of toxic rows in the sample (0.5 without
any).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import LOWER, ship_package, staged, text_chunks
from strata.llm.quality import labelled_sample

SAMPLE_ROWS = 12_000
LEARNED_TERMS = 400
STEM = 5
LEAST_DOCUMENTS = 4  # and one in two hundred of the toxic rows
NEAR = 5
TREES = 20
DEPTH = 3
CALIBRATION_FIFTH = 5
LEAST_SPLIT = 100  # a smaller sample both trains and calibrates

# Insults and words of contempt, and words that address a reader.
LEXICON = (
    "idiot stupid moron imbecile dumb fool loser clown scum trash garbage worthless pathetic disgusting "
    "filthy vermin pig creep freak coward liar hate hateful useless ugly shut jerk bastard crap"
).split()
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros"
).split()
# Characters that stand in for letters.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i", "*": "", ".": "", "-": "", "_": ""}

FEATURES = (
    "lexicon_rate", "lexicon_hits", "learned_rate", "learned_hits", "near_rate", "capital_rate",
    "punctuation_rate", "exclamation_rate", "obfuscation_rate", "odd_word_rate", "log_words",
)
_FEATURE_ROWS = "doc_id bigint, held_out boolean, " + ", ".join(f"{name} double" for name in FEATURES)

_EDGES = b"\"'`.,;:!?()[]{}<>|*&%$#~+=/\\-_"
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def plain_words(text: bytes) -> list[bytes]:
    """The words of a text in lower case, without punctuation at their ends."""
    return [word.strip(_EDGES) for word in text.translate(bytes(LOWER)).split()]


def stems(words) -> set[bytes]:
    return {word.decode("utf-8", "replace")[:STEM].encode() for word in words if len(word) >= 4}


class Scanner:
    """Features of texts, given the learned stems."""

    def __init__(self, learned: list[str]):
        self.lexicon = {word.encode() for word in LEXICON}
        self.person = {word.encode() for word in SECOND_PERSON}
        self.learned = {stem.encode() for stem in learned}
        self.kinds: dict[bytes, int] = {}

    def kind(self, word: bytes) -> int:
        """Bits: 1 lexicon, 2 learned stem, 4 second person, 8 lexicon once look-alikes are undone, 16 odd."""
        core = word.strip(_EDGES)
        bits = 0
        if core in self.lexicon:
            bits |= 1
        if core in self.person:
            bits |= 4
        text = core.decode("utf-8", "replace")
        if len(core) >= 4 and text[:STEM].encode() in self.learned:
            bits |= 2
        if any(char in LOOK_ALIKES for char in text):
            undone = "".join(LOOK_ALIKES.get(char, char) for char in word.decode("utf-8", "replace")).encode()
            if not bits & 1 and (undone in self.lexicon or undone.strip(_EDGES) in self.lexicon):
                bits |= 8
            if any(char.isalpha() for char in text):
                bits |= 16
        return bits

    def features(self, text: bytes, data: np.ndarray) -> list[float]:
        words = text.translate(bytes(LOWER)).split()
        kinds = self.kinds
        if len(kinds) > 300_000:
            kinds.clear()
        fresh = {word for word in words if word not in kinds}
        for word in fresh:
            kinds[word] = self.kind(word)
        bits = np.fromiter(map(kinds.__getitem__, words), np.int8, len(words))
        n, size = max(len(words), 1), max(len(data), 1)
        hit = (bits & 11) > 0
        places, persons = np.flatnonzero(hit), np.flatnonzero(bits & 4)
        near = 0
        if len(places) and len(persons):
            after = np.searchsorted(persons, places)
            gap = np.minimum(
                np.where(after < len(persons), persons[np.minimum(after, len(persons) - 1)] - places, NEAR + 1),
                np.where(after > 0, places - persons[np.maximum(after - 1, 0)], NEAR + 1),
            )
            near = int((gap <= NEAR).sum())
        plain, learned = int((bits & 1 > 0).sum()), int((bits & 2 > 0).sum())
        return [
            plain / n, float(min(plain, 20)), learned / n, float(min(learned, 20)), near / n,
            float(_UPPER[data].sum()) / size, float(_PUNCTUATION[data].sum()) / size,
            float((data == 33).sum()) / size, int((bits & 8 > 0).sum()) / n, int((bits & 16 > 0).sum()) / n,
            float(np.log1p(len(words))),
        ]


def _feature_rows(learned: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(learned)
        for batch in batches:
            rows = []
            for _, _, data, offsets in text_chunks(batch.column("text")):
                whole = data.tobytes()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    rows.append(scanner.features(whole[a:b], data[a:b]))
            values = np.array(rows, float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *[pa.array(column) for column in values.T]],
                ["doc_id", "held_out", *FEATURES],
            )

    return work


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class by stem, summed over the task."""
    counts = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            counts[label].update(stems(set(plain_words(text.encode()))))
    found = list(counts[0].keys() | counts[1].keys())
    yield pa.RecordBatch.from_arrays(
        [pa.array([stem.decode("utf-8", "replace") for stem in found], pa.string()),
         *[pa.array([own[stem] for stem in found], pa.int64()) for own in counts]],
        ["stem", "clean", "toxic"],
    )


def learned_stems(sample: DataFrame, most: int = LEARNED_TERMS) -> list[str]:
    """Stems that toxic rows of the sample have far more often: at most ``most``."""
    per_class = {row.label: row.n for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    counted = sample.select("text", "label").mapInArrow(_stem_counts, "stem string, clean bigint, toxic bigint")
    counted = counted.groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log(
        ((F.col("toxic") + 0.5) / (per_class.get(1, 0) + 1)) / ((F.col("clean") + 0.5) / (per_class.get(0, 0) + 1))
    )
    rows = (
        counted.filter(F.col("toxic") >= max(LEAST_DOCUMENTS, per_class.get(1, 0) / 200))
        .withColumn("odds", odds)
        .filter("odds > 2.5")
        .orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "stem")
        .limit(most)
        .collect()
    )
    return [row.stem for row in rows]


@dataclass(frozen=True)
class Classifier:
    """Learned stems, trees over the features, and the curve that calibrates the margin of the trees."""

    stems: list[str]
    trees: GBTClassificationModel
    curve: IsotonicRegressionModel

    def scores(self, texts: DataFrame) -> DataFrame:
        """doc_id, held_out, score of rows with doc_id, held_out, text."""
        features = texts.mapInArrow(_feature_rows(self.stems), _FEATURE_ROWS)
        # Between calibrated levels the margin decides the order; it moves a score by a thousandth at most.
        value = F.col("__calibrated") * 0.999 + F.col("__margin") * 0.001
        value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
        return self.curve.transform(_margin(self.trees, features)).select(
            "doc_id", "held_out", value.alias("score")
        )


def _gathered(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(rows)


def _margin(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    scored = trees.transform(_gathered(rows)).withColumn("__margin", vector_to_array("probability")[1])
    return scored.drop("rawPrediction", "probability", "prediction")


def calibrates(order: Column) -> Column:
    """Which rows of the sample calibrate, by the hash of their text."""
    return F.pmod(F.xxhash64(F.lit(3), order.cast("bigint")), F.lit(CALIBRATION_FIFTH)) == 0


def fit(sample: DataFrame, rows: int) -> Classifier:
    """The classifier of a sample (text, label, order) of ``rows`` rows of both classes."""
    for_curve = calibrates(F.col("order"))
    for_trees = ~for_curve
    if rows < LEAST_SPLIT:
        for_trees = for_curve = F.lit(True)
    learned = learned_stems(sample.filter(for_trees))
    # Rows of the sample carry their label and hash in the columns of a document.
    taught = sample.select(F.col("order").alias("doc_id"), (F.col("label") == 1).alias("held_out"), "text")
    taught = taught.mapInArrow(_feature_rows(learned), _FEATURE_ROWS)
    taught = taught.withColumnRenamed("doc_id", "order").withColumn("label", F.col("held_out").cast("double"))
    taught = staged(taught, "features")
    trees = GBTClassifier(
        featuresCol="__features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=1
    ).fit(_gathered(taught.filter(for_trees)).coalesce(4))
    curve = IsotonicRegression(featuresCol="__margin", labelCol="label", predictionCol="__calibrated")
    return Classifier(
        learned, trees, curve.fit(_margin(trees, taught.filter(for_curve)).select("__margin", "label"))
    )


def score(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, most: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1, higher: label 1 likelier)."""
    ship_package(docs.sparkSession)
    held_out = F.coalesce(held_out, F.lit(False))
    sample = staged(labelled_sample(docs, labels, label, ~held_out, most).repartition(4, "order"), "sample")
    classes = {row.label: row.n for row in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out.alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    if len(classes) < 2:
        share = float(next(iter(classes))) if classes else 0.5
        return texts.select("doc_id", "held_out", F.lit(share).alias("score"))
    return fit(sample, sum(classes.values())).scores(texts)
