"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow of its documents in a shuffled order (by a hash of doc_id), repeated up to
``MAX_PASSES`` times. A document's virtual finish time is the number of tokens its source has sent up
to its end, divided by the source's target. All documents in the order of their finish times, cut at
the total budget, are the mix.

Both running sums are split so that no task sees a whole source: a source's order is cut into ranges of
its hash, virtual time into slices, with about ``RANGE_ROWS`` documents each. Sums of the ranges come
first, and then a window inside each range. Only tables with one row per source or per range are sorted
as a whole.

Defined results: size is the number of words of the text, 0 for a null text. Documents of size 0 and all
documents of an empty or wordless table have taken = 0. A null source is a source, the last. Every row is
mixed by itself: rows that repeat a doc_id keep an order by size and then by their written row numbers, and
rows without one are shuffled by these numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, staged

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
RANGE_ROWS = 65_536
KEY_BITS = 60
_ORDER = ("key", "doc_id", "size", "row")


def source_targets(sizes: DataFrame, weights=WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: source, source_size, source_rows, place, target.

    Sources ordered by how many tokens a unit of weight may get; those that reach their limit come
    first, and the level of the others follows from what the limits leave.
    """
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("source_rows")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    limited = (
        per_source.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("most", F.col("source_size") * passes)
        .withColumn("ratio", F.col("most") / F.col("weight"))
    )
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    left_size = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = (
        limited.withColumn("level", left_size / left_weight)
        .withColumn("above", F.col("ratio") > F.col("level"))
        .withColumn("decided", F.coalesce(F.max("above").over(before), F.lit(False)))
    )
    level = F.max(F.when(~F.col("decided"), F.col("level"))).over(everything)
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.col("common_level"))
    return levels.withColumn("common_level", level).select(
        "source", "source_size", "source_rows", "place", target.alias("target")
    )


def word_count():
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")


def _shuffle_key(seed: int):
    named = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row "), F.col("row").cast("string")))
    text = F.concat(F.lit(f"{seed}:"), named)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def mix(docs: DataFrame, weights=WEIGHTS, passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, passes_taken, taken and
    finish, the virtual time at which its first pass ends (null without words)."""
    sized = docs.select("doc_id", "source", word_count().alias("size"))
    numbered = staged(sized.withColumn("row", F.monotonically_increasing_id()), "sizes")
    return _mix(numbered, weights, passes, seed).drop("row")


def _mix(numbered: DataFrame, weights, passes: int, seed: int) -> DataFrame:
    """The mix of written rows (row, doc_id, source, size), with their numbers."""
    sizes = numbered.select("row", "doc_id", "source", "size", _shuffle_key(seed).alias("key"))
    targets = staged(source_targets(sizes, weights, passes), "targets")
    bits = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("source_rows") / RANGE_ROWS)))
    rows = sizes.withColumnRenamed("source", "own").join(
        targets, F.col("own").eqNullSafe(F.col("source"))
    )
    shift = (F.lit(KEY_BITS) - bits).cast("int")
    rows = rows.withColumn("part", F.call_function("shiftright", F.col("key"), shift))
    flowing = rows.filter("size > 0")

    parts = flowing.groupBy("place", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "place", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("sent_before")
    )
    inside = Window.partitionBy("place", "part").orderBy(*_ORDER)
    sent = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + F.col("sent_before")
    flows = staged(
        flowing.join(parts, ["place", "part"]).select(
            "row", "doc_id", "source", "size", "key", "source_size", "target", sent.alias("sent")
        ),
        "flows",
    )

    turns = flows.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1)))).withColumn(
        "finish", _finish(F.col("turn"))
    )
    slices = max(1, -(-passes * flows.count() // RANGE_ROWS))
    turns = turns.withColumn("slice", F.floor(F.least("finish", F.lit(float(passes))) * slices))
    cut = _cut(turns, targets)
    order = [F.col(name) for name in _ORDER]
    in_mix = [
        F.coalesce(F.struct(_finish(F.lit(turn)), *order, F.lit(turn)) < F.col("cut"), F.lit(True))
        for turn in range(passes)
    ]
    taken = sum((F.when(one, 1).otherwise(0) for one in in_mix), F.lit(0)).cast("bigint")
    answered = flows.join(F.broadcast(cut), how="left").select(
        "row", "doc_id", "source", "size", "source_size", "target", taken.alias("passes_taken"),
        (taken * F.col("size")).alias("taken"), _finish(F.lit(0)).alias("finish"),
    )
    wordless = rows.filter("size = 0").select(
        "row", "doc_id", "source", "size", "source_size", "target", F.lit(0).cast("bigint").alias("passes_taken"),
        F.lit(0).cast("bigint").alias("taken"), F.lit(None).cast("double").alias("finish"),
    )
    return answered.unionByName(wordless)


def _finish(turn):
    return (turn * F.col("source_size") + F.col("sent")) / F.col("target")


def _cut(turns: DataFrame, targets: DataFrame) -> DataFrame:
    """One row at most, ``cut``: the first document in global order that the budget has no room for."""
    budget = targets.agg(F.sum("source_size").alias("budget"))
    totals = turns.groupBy("slice").agg(F.sum("size").alias("slice_size"))
    so_far = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    crossed = (
        totals.withColumn("sum_to", F.sum("slice_size").over(so_far))
        .join(F.broadcast(budget))
        .filter("sum_to > budget")
        .agg(F.min(F.struct("slice", (F.col("sum_to") - F.col("slice_size")).alias("base"), "budget")).alias("at"))
        .filter("at IS NOT NULL")
        .select("at.*")
    )
    order = ["finish", *_ORDER, "turn"]
    in_order = Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        turns.join(F.broadcast(crossed), "slice")
        .withColumn("sum_to", F.col("base") + F.sum("size").over(in_order))
        .filter("sum_to > budget")
        .agg(F.min(F.struct(*order)).alias("cut"))
    )


def mixture(docs: DataFrame, weights=WEIGHTS, passes: int = MAX_PASSES, seed: int = 0) -> DataFrame:
    """The mixed documents with all their columns, in the order of their virtual finish times; a document
    taken in several passes comes several times.

    The rows are written with their numbers, so that what is decided for a row is joined to this row, however
    many others share its doc_id.
    """
    written = staged(docs.withColumn("__strata_row", F.monotonically_increasing_id()), "numbered")
    sized = written.select(F.col("__strata_row").alias("row"), "doc_id", "source", word_count().alias("size"))
    taken = _mix(staged(sized, "sizes"), weights, passes, seed).filter("passes_taken > 0").select(
        F.col("row").alias("__strata_row"), F.col("passes_taken").alias("__strata_passes"),
        F.col("finish").alias("__strata_first"), (F.col("source_size") / F.col("target")).alias("__strata_round"),
    )
    return (
        written.join(taken, "__strata_row")
        .withColumn("__strata_turn", F.explode(F.expr("sequence(0, int(__strata_passes) - 1)")))
        .orderBy(F.col("__strata_first") + F.col("__strata_turn") * F.col("__strata_round"))
        .select(*docs.columns)
    )
