"""Token counts by a separator scan of flat token files.

A flat token file is nothing but ids, little-endian, of all its documents one after the other, each ended
by an end-of-document id; there is no index. Files are cut into blocks of ``BLOCK_IDS`` wherever that
falls. A task reads a block and searches it for separators with one vector comparison: the block's counts
are those between its separators, with an open piece at its head and at its tail. Running sums over the
blocks of a file (one small row per block) then give each block the number of documents ended before it
and the tokens of the document that is open where it begins, which is all that stitching needs.

``write_flat`` makes such files of texts. A task names its file anew at each attempt, and only the rows of
committed attempts name files, so what a lost attempt leaves behind is never read. The token files are as
large as the ids; a worker holds one batch of texts or one block.

Defined results: a null or empty text is a document of 0 tokens. Texts that spell a separator are ordinary
text. Repeated rows are documents of their own. Ids behind the last separator of a file are a document
that was not ended; it is counted as well.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import ship_package, staged, worker_memo
from strata.session import scratch_folder

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END_ID = 50256  # free in the vocabulary
ID_TYPE = "<u2"
BLOCK_IDS = 1 << 22
# The split pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PLACES = "doc_id bigint, file string, place bigint, file_ids bigint"
_PIECES = "file string, block bigint, nth long, tokens long, ended boolean"


def _location(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if not path.startswith("file://") else path)


def write_flat(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, id_type: str = ID_TYPE
) -> DataFrame:
    """Write the texts as flat token files, one per task, below ``folder`` (no files are shared or
    overwritten). Returns, written, doc_id, file, place (of the document in its file), file_ids."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(vocabulary, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value)
        system, base = _location(folder)
        name, place, length, out = f"{uuid.uuid4().hex}.bin", 0, 0, None
        try:
            for batch in batches:
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", buffer_size=1 << 20)
                texts = batch.column("text").fill_null("")
                for first in range(0, len(texts), 256):
                    for text in texts.slice(first, 256).to_pylist():
                        ids = encoding.encode_ordinary(text)
                        ids.append(end_id)
                        out.write(np.array(ids, id_type).tobytes())
                        length += len(ids)
                rows = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([name] * rows, pa.string()),
                     pa.array(np.arange(place, place + rows)), pa.array(np.full(rows, length))],
                    ["doc_id", "file", "place", "file_ids"],
                )
                place += rows
        finally:
            if out is not None:
                out.close()

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return staged(texts.mapInArrow(work, _PLACES), "token-places")


def _encoding(ranks: bytes):
    import tiktoken

    memo = worker_memo()
    if memo.get("ranks_of") != hash(ranks):
        lines = (line.split() for line in ranks.splitlines() if line)
        memo["ranks"] = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, special_tokens={},
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in lines},
        )
        memo["ranks_of"] = hash(ranks)
    return memo["ranks"]


def block_pieces(ids: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens between the separators of a block, and whether a separator ends each piece. The last piece
    is open; it is left out where it is empty and not the only one."""
    ends = np.flatnonzero(ids == end_id)
    bounds = np.concatenate([[-1], ends, [len(ids)]])
    tokens = np.diff(bounds) - 1
    ended = np.arange(len(tokens)) < len(ends)
    return tokens, ended


def _scanner(folder: str, end_id: int, id_type: str, block_ids: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _location(folder)
        width = np.dtype(id_type).itemsize
        for batch in batches:
            for file, block in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
                with system.open_input_file(f"{base}/{file}") as opened:
                    data = opened.read_at(block_ids * width, block * block_ids * width)
                tokens, ended = block_pieces(np.frombuffer(data, id_type, len(data) // width), end_id)
                n = len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file] * n, pa.string()), pa.array(np.full(n, block)), pa.array(np.arange(n)),
                     pa.array(tokens), pa.array(ended)],
                    ["file", "block", "nth", "tokens", "ended"],
                )

    return work


def scan_flat(
    spark: SparkSession,
    folder: str,
    files: DataFrame,
    end_id: int = END_ID,
    id_type: str = ID_TYPE,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Token counts of the documents in flat files: file, place, n_tokens.

    ``files`` has file (a name below ``folder``) and file_ids, the number of ids in it.
    """
    ship_package(spark)
    blocks = files.select("file", F.explode(F.expr(f"sequence(0L, (file_ids - 1) div {block_ids})")).alias("block"))
    tasks = max(1, spark.sparkContext.defaultParallelism * 4)
    pieces = staged(
        blocks.repartition(tasks).mapInArrow(_scanner(folder, end_id, id_type, block_ids), _PIECES), "pieces"
    )
    # The prefix scan: one row per block. A document that is open over several blocks restarts its sum
    # behind each block that has a separator.
    ended = F.sum(F.col("ended").cast("bigint"))
    tail = F.max(F.when(~F.col("ended"), F.col("tokens")))
    sums = pieces.groupBy("file", "block").agg(ended.alias("ends"), tail.alias("tail"))
    in_file = Window.partitionBy("file").orderBy("block")
    sums = sums.withColumn("run", F.coalesce(F.sum(F.when(F.col("ends") > 0, 1).otherwise(0)).over(
        in_file.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    in_run = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("open_after", F.sum("tail").over(in_run))
    carried = sums.select(
        "file", "block",
        F.coalesce(F.sum("ends").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.coalesce(F.lag("open_after").over(in_file), F.lit(0)).alias("open"),
        F.lead("block").over(in_file).isNull().alias("is_last"),
    )
    whole = F.col("tokens") + F.when(F.col("nth") == 0, F.col("open")).otherwise(0)
    return (
        pieces.join(carried, ["file", "block"])
        .select("file", (F.col("before") + F.col("nth")).alias("place"), whole.alias("n_tokens"), "ended", "is_last")
        .filter(F.col("ended") | (F.col("is_last") & (F.col("n_tokens") > 0)))
        .select("file", "place", "n_tokens")
    )


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, block_ids: int = BLOCK_IDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, by way of flat token files in the shared folder."""
    spark = docs.sparkSession
    folder = scratch_folder(spark, "tokens")
    places = write_flat(docs, folder, vocabulary)
    files = places.groupBy("file").agg(F.max("file_ids").alias("file_ids"))
    counts = scan_flat(spark, folder, files, block_ids=block_ids)
    return places.join(counts, ["file", "place"]).select("doc_id", "n_tokens")
