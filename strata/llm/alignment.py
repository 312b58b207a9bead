"""Alignment of two tokenizers over the same texts by galloping intersection.

A text with a space before it is encoded by a byte-level BPE (A) and a piece BPE (B). The byte offsets at
which tokens end are two sorted lists. The shorter list of a document drives the search in the longer: an
exponential search from where the offset is expected, then a binary one, in lockstep for all tokens of a
chunk. Offsets in both lists cut the tokens into groups; the ranks of neighbouring offsets differ by the
tokens that overlap, which gives the links, all pairs of an A and a B token whose byte ranges overlap.

Texts are encoded once. Chunks of about ``CHUNK`` bytes are written as blocks: per document the digests and
its distinct id pairs as places in the block's list of pairs, and that list once. So a frequent pair
crosses a shuffle once per block and not once per document, and counts come back to a block by a
join: neither the pairs of the corpus nor its counts are gathered or broadcast. Of the ids B has, the highest
count of a pair is a maximum per key, combined before its shuffle.

Defined results: a text that is null or empty, or whose joined A or B bytes are not those of the text with
a space before it, has no tokens: zeros and ''. Strings of special tokens are plain text. Rows that
repeat a doc_id, or have none, are aligned and counted like any others. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ship_package, staged, text_chunks, worker_memo

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 2 << 20

_DIGESTS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
_BLOCKS = f"block bigint, is_list boolean, {_DIGESTS}, places array<int>, times array<bigint>, pairs array<bigint>"
_ALIGNED = f"{_DIGESTS}, n_best bigint, count_sum bigint"
_ALIGNED_TYPES = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64())]
)


def gallop(ordered: np.ndarray, wanted: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each wanted value the first place of ``ordered`` that holds it or a larger one (its length, if
    none does): steps that double from ``start`` on, up or down, then a binary search between the last two."""
    top = len(ordered)
    padded = np.append(ordered, np.iinfo(np.int64).max)
    start = np.minimum(start, top)
    below = padded[start] < wanted
    low, high = np.where(below, start + 1, 0), np.where(below, top, start)
    for going_up in (True, False):
        active, step = np.flatnonzero(below == going_up), 1
        while len(active):
            if going_up:
                probe = np.minimum(low[active] + step - 1, top)
                further = padded[probe] < wanted[active]
                low[active[further]] = probe[further] + 1
                high[active[~further]] = probe[~further]
            else:
                probe = np.maximum(high[active] - step, 0)
                further = padded[probe] >= wanted[active]
                high[active[further]] = probe[further]
                low[active[~further]] = probe[~further] + 1
                further &= probe > 0
            active, step = active[further], step * 2
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        less = padded[middle] < wanted[active]
        low[active[less]], high[active[~less]] = middle[less] + 1, middle[~less]
        active = active[low[active] < high[active]]
    return low


@dataclass
class Ends:
    """The tokens of a chunk by one tokenizer: ids, byte offsets of their ends over the whole chunk, the
    documents they are in, and where each document's tokens begin."""

    ids: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, coded: list[list[int]], lengths: np.ndarray) -> Ends:
        sizes = np.array([len(ids) for ids in coded], np.int64)
        ids = np.fromiter(chain.from_iterable(coded), np.int64, int(sizes.sum()))
        first = np.concatenate([[0], np.cumsum(sizes)])
        return cls(ids, np.cumsum(lengths[ids]), np.repeat(np.arange(len(coded)), sizes), first)

    def __len__(self) -> int:
        return len(self.ids)


@dataclass
class Alignment:
    """Links of a chunk as places in both token lists, and the group of each token (over the chunk)."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def align(a: Ends, b: Ends) -> Alignment:
    """Align two tokenizations of the same bytes, document by document."""
    size_a, size_b = np.diff(a.first), np.diff(b.first)
    a_drives = size_a <= size_b
    links, common_a, common_b = [], np.zeros(len(a), bool), np.zeros(len(b), bool)
    for driver, other, chosen, common, common_other in (
        (a, b, a_drives, common_a, common_b),
        (b, a, ~a_drives, common_b, common_a),
    ):
        mine = np.flatnonzero(chosen[driver.doc])
        if not len(mine):
            links.append((np.zeros(0, np.int64), np.zeros(0, np.int64)))
            continue
        doc = driver.doc[mine]
        share = np.diff(other.first)[doc] / np.diff(driver.first)[doc]
        expected = other.first[doc] + ((mine - driver.first[doc]) * share).astype(np.int64)
        rank = gallop(other.ends, driver.ends[mine], expected)
        both = other.ends[rank] == driver.ends[mine]
        common[mine[both]] = common_other[rank[both]] = True
        # The token after one that ends with a common offset begins behind it.
        begin = np.empty_like(rank)
        begin[1:] = rank[:-1] + both[:-1]
        opens = mine == driver.first[doc]
        begin[opens] = other.first[doc[opens]]
        spans = rank - begin + 1
        before = np.cumsum(spans) - spans
        links.append(
            (np.repeat(mine, spans), np.arange(int(spans.sum())) - np.repeat(before, spans) + np.repeat(begin, spans))
        )
    (one, two), (three, four) = links
    # A token that ends a group is in it.
    groups = [np.cumsum(common) - common for common in (common_a, common_b)]
    return Alignment(np.concatenate([one, four]), np.concatenate([two, three]), *groups)


def digit_rows(ids: int) -> np.ndarray:
    """The decimal digits of the numbers below ``ids`` as rows of bytes, with zero bytes behind them."""
    width = len(str(max(ids - 1, 1)))
    texts = np.arange(ids).astype(f"S{width}")
    return np.frombuffer(texts.tobytes(), np.uint8).reshape(ids, width)


def group_texts(a: Ends, b: Ends, found: Alignment, digits: np.ndarray) -> list[bytes]:
    """For each document its groups as text: ids of A, a bar, ids of B; groups divided by semicolons."""
    groups = int(found.group_a[-1]) + 1 if len(a) else 0
    count_a = np.bincount(found.group_a, minlength=groups)
    count_b = np.bincount(found.group_b, minlength=groups)
    b_before = np.cumsum(count_b) - count_b
    a_through = np.cumsum(count_a)
    place_a = np.arange(len(a)) + b_before[found.group_a]
    place_b = np.arange(len(b)) + a_through[found.group_b]
    rows = np.zeros((len(a) + len(b), digits.shape[1] + 1), np.uint8)
    for side, place, group, last_mark in ((a, place_a, found.group_a, b"|"), (b, place_b, found.group_b, b";")):
        rows[place, :-1] = digits[side.ids]
        last = np.append(group[1:] != group[:-1], True) if len(side) else np.zeros(0, bool)
        rows[place, -1] = np.where(last, ord(last_mark), ord(","))
    flat = rows.reshape(-1)
    flat = flat[flat != 0]
    bytes_of = np.concatenate([[0], np.cumsum((rows != 0).sum(axis=1))])
    bounds = bytes_of[a.first + b.first]
    whole = flat.tobytes()
    return [whole[x : max(x, y - 1)] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself where it prints, and letters
    from 256 on, in order, for the others."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(prints)]
    return {chr(byte): byte for byte in prints} | {chr(256 + n): byte for n, byte in enumerate(others)}


# Fixed value: how a byte-level vocabulary cuts a text before its merges.
BYTE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def ranked_encoding(model: dict, token_bytes: list[bytes]):
    """The same encoding by the ranks of the vocabulary, which is faster; None where the model says more than
    ranks do: another cut or normalisation, or merges in another order than their ids."""
    import tiktoken

    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    rules = model["pre_tokenizer"] or {}
    vocabulary, kind = model["model"]["vocab"], model["model"]
    merges = [one if isinstance(one, list) else one.split(" ") for one in kind["merges"]]
    in_order = all(vocabulary.get("".join(one)) == 256 + rank for rank, one in enumerate(merges))
    extras = [kind.get(name) for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")]
    if model["normalizer"] or any(extras) or kind.get("ignore_merges") or not in_order:
        return None
    if any(rules.get(name) != value for name, value in plain.items()) or len(vocabulary) != 256 + len(merges):
        return None
    ranks = {token_bytes[number]: number for number in vocabulary.values()}
    return tiktoken.Encoding("byte-level", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Both tokenizers with the bytes of each of their ids."""

    def __init__(self, byte_model: str, piece_model: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_model)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=piece_model)
        letters = byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(letter in letters for letter in token)
            self.bytes_a[number] = bytes(letters[letter] for letter in token) if known else token.encode()
        self.ranked = ranked_encoding(json.loads(byte_model), self.bytes_a)
        self.bytes_b = [self._piece_bytes(number) for number in range(self.b.get_piece_size())]
        self.lengths_a, self.lengths_b = (
            np.array([len(one) for one in table], np.int64) for table in (self.bytes_a, self.bytes_b)
        )
        self.digits = digit_rows(max(len(self.bytes_a), len(self.bytes_b)))

    def _piece_bytes(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        if self.b.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode_bytes(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            return [self.ranked.encode_ordinary(text) for text in texts]
        return [one.ids for one in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for each text; none for a text they do not give back."""
        filled = [i for i, text in enumerate(texts) if text]
        spaced = [" " + texts[i] for i in filled]
        coded_a = self.encode_bytes(spaced)
        coded_b = self.b.encode([texts[i] for i in filled], num_threads=1)
        all_a, all_b = [[] for _ in texts], [[] for _ in texts]
        for i, text, ids_a, ids_b in zip(filled, spaced, coded_a, coded_b):
            plain = text.encode()
            if b"".join([self.bytes_a[one] for one in ids_a]) != plain:
                continue
            if b"".join([self.bytes_b[one] for one in ids_b]) == plain:
                all_a[i], all_b[i] = ids_a, ids_b
        return all_a, all_b


def _aligner(shared):
    """Blocks: a row for each document and, first, one with the block's pairs and their numbers of links."""

    def chunk(models: Tokenizers, texts: list[str], block: int, ids: pa.Array) -> pa.RecordBatch:
        coded_a, coded_b = models.encode(texts)
        a, b = Ends.of(coded_a, models.lengths_a), Ends.of(coded_b, models.lengths_b)
        found = align(a, b)
        rows = len(texts)
        texts_of_groups = group_texts(a, b, found, models.digits)
        group_end = np.append(found.group_a[1:] != found.group_a[:-1], True) if len(a) else np.zeros(0, bool)
        n_groups = np.bincount(a.doc[group_end], minlength=rows)
        doc = a.doc[found.a]
        pairs, place = np.unique((a.ids[found.a] << 32) | b.ids[found.b], return_inverse=True)
        own, times = np.unique(doc * max(1, len(pairs)) + place, return_counts=True)
        owner, places = np.divmod(own, max(1, len(pairs)))
        bounds = np.concatenate([[0, 0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
        times = np.concatenate([np.bincount(place, minlength=len(pairs)), times])
        bounds_times = bounds + len(pairs)
        bounds_times[0] = 0

        def with_list(values) -> pa.Array:
            return pa.array([0, *np.asarray(values).tolist()], pa.int64())

        columns = [
            pa.array(np.full(rows + 1, block)),
            pa.array([True] + [False] * rows),
            pa.array([None, *ids.to_pylist()], pa.int64()),
            with_list(np.diff(a.first)),
            with_list(np.diff(b.first)),
            with_list(n_groups),
            with_list(np.bincount(doc, minlength=rows)),
            pa.array([""] + [hashlib.sha256(one).hexdigest() if one else "" for one in texts_of_groups]),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(places.astype(np.int32))),
            pa.ListArray.from_arrays(pa.array(bounds_times), pa.array(times)),
            pa.ListArray.from_arrays(pa.array(np.array([0] + [len(pairs)] * (rows + 1), np.int32)), pa.array(pairs)),
        ]
        names = [part.split()[0] for part in _BLOCKS.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo()
        number, byte_model, piece_model = shared.value
        if memo.get("tokenizers_of") != number:
            memo["tokenizers"], memo["tokenizers_of"] = Tokenizers(byte_model, piece_model), number
        # Written once, so that a block is known by its task and its place in it.
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column("text")
            for first, last, _, _ in text_chunks(texts, CHUNK):
                own = texts.slice(first, last - first).fill_null("").to_pylist()
                yield chunk(memo["tokenizers"], own, block, batch.column("doc_id").slice(first, last - first))
                block += 1

    return work


def _totals(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with sums over their links of what the counts of the pairs say."""
    place = counts.column("place").to_numpy()
    value, best = np.zeros((2, len(place)), np.int64)
    value[place] = counts.column("n").to_numpy()
    best[place] = np.asarray(counts.column("best").to_numpy(), np.int64)
    places, times = (docs.column(name).combine_chunks() for name in ("places", "times"))
    owner = np.repeat(np.arange(docs.num_rows), np.diff(np.asarray(places.offsets)))
    at, often = places.flatten().to_numpy(), times.flatten().to_numpy()
    sums = []
    for values in (best, value):
        total = np.concatenate([[0], np.cumsum(values[at] * often)])
        bounds = np.searchsorted(owner, np.arange(docs.num_rows + 1))
        sums.append(pa.array(total[bounds[1:]] - total[bounds[:-1]]))
    digests = [docs.column(name) for name in _ALIGNED_TYPES.names[:6]]
    return pa.Table.from_arrays([*digests, *sums], _ALIGNED_TYPES.names)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """pair, n (links of the pair in all documents), best (no pair of the same B id has more)."""
    listed = blocks.filter("is_list").select(F.explode(F.arrays_zip("pairs", "times")).alias("one"))
    counts = listed.groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.times").alias("n"))
    counts = staged(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(byte_model, encoding="utf-8") as one, open(piece_model, "rb") as other:
        models = one.read(), other.read()
    shared = spark.sparkContext.broadcast((hash(models), *models))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    blocks = staged(texts.mapInArrow(_aligner(shared), _BLOCKS), "alignments")

    listed = blocks.filter("is_list").select(
        F.col("block").alias("of_block"), F.posexplode("pairs").alias("place", "pair")
    )
    counted = listed.join(pair_counts(blocks), "pair").select("of_block", "place", "n", "best")
    rows = blocks.filter("NOT is_list").drop("is_list", "pairs")
    return rows.groupBy("block").cogroup(counted.groupBy("of_block")).applyInArrow(_totals, _ALIGNED)
