"""What the training-data operators share: written intermediates, code for workers, words in bytes."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_folder

# White space is the ASCII kind alone, everywhere in these operators.
WORD = r"[^\x20\x09-\x0D]+"

CHUNK_BYTES = 1 << 20
# What a task hands to its Python worker at once.
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def staged(rows: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows, written below the shared folder and read again: later work restarts from there."""
    target = scratch_folder(rows.sparkSession, name)
    rows.write.parquet(target, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(target)


def ship_package(spark: SparkSession) -> None:
    """Give workers this package, once per application; a cluster may have no copy of it."""
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    root = Path(__file__).parents[1]
    archive = Path(tempfile.mkdtemp(prefix="strata-")) / "strata-package.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(root.rglob("*.py")):
            packed.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._strata_shipped = True


def worker_memo() -> dict:
    """A dictionary that lives as long as the Python worker, for tables built from a model file."""
    return sys.modules.setdefault("strata_worker_memo", types.ModuleType("strata_worker_memo")).__dict__


def release_memory() -> None:
    """Give what this process has freed back to the system; its allocators would keep it for later."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def bound_batches(spark: SparkSession) -> None:
    """Have tasks hand rows to Python workers ``ARROW_BYTES`` at once. By default it is 10,000 rows or 64 MB, and the
    task's buffers, which grow by doubling, the message and the worker each hold a copy."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``work``, after whose last batch the worker gives memory back: idle workers stay beside those that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Once it is through, what ``work`` held is free.
        yield from work(batches)
        release_memory()

    return run


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """The rows of a partition sorted by ``key``, cut so that no group is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() == keys[0] and keys[0] == keys[-1]:
            held.append(batch)
            continue
        start = int(np.searchsorted(keys, keys[-1]))
        yield from pa.Table.from_batches([*held, batch.slice(0, start)]).combine_chunks().to_batches()
        held = [batch.slice(start)]
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def crc_remainder(column: str, parts: int) -> Column:
    """crc32 of the number as text, modulo ``parts``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def lowered(text: Column) -> Column:
    """A-Z lower-cased, and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Texts as bytes

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_GOLDEN = 0x9E3779B97F4A7C15
_STEP = np.uint64(_GOLDEN | 1)
_STEP_BACK = np.uint64(pow(_GOLDEN | 1, -1, 1 << 64))
_BYTE_CODES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the value."""
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and how often each occurs; by one sort."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    ordered = np.sort(values)
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[begins], np.diff(begins, append=len(ordered))


def text_buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of the texts, one after the other, and where each begins (a null is empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_chunks(
    texts: pa.Array | pa.ChunkedArray, size: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows with about ``size`` bytes. A row is
    never cut: a longer text is a run of its own."""
    if len(texts) == 0:
        return
    data, offsets = text_buffers(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the row it is in; no word crosses from one row to the next."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none
    word = ~SPACE[data]
    filled = np.diff(offsets) > 0
    opens = np.empty_like(word)
    opens[0], opens[1:] = True, ~word[:-1]
    opens[offsets[:-1][filled]] = True
    closes = np.empty_like(word)
    closes[-1], closes[:-1] = True, ~word[1:]
    closes[offsets[1:][filled] - 1] = True
    starts = np.flatnonzero(word & opens)
    ends = np.flatnonzero(word & closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, from one running sum over the bytes."""
    memo = worker_memo()
    powers = memo.get("powers")
    if powers is None or len(powers[0]) <= len(data):
        size = max(len(data) + 1, CHUNK_BYTES + (1 << 17))
        ahead, back = np.full(size, _STEP, np.uint64), np.full(size, _STEP_BACK, np.uint64)
        ahead[0] = back[0] = 1
        powers = np.cumprod(ahead), np.cumprod(back)
        if size <= 16 * CHUNK_BYTES:
            memo["powers"] = powers
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * powers[0][: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * powers[1][starts]
    return mixed(hashes + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
