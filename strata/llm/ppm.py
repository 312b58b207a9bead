"""Language-model scoring by prediction by partial matching (PPM) over bytes.

A text is the sequence of its words, A-Z lower-cased, with one blank between words and an end symbol.
The model is a trie of byte contexts up to ``ORDER`` symbols, trained on the documents that learn. A
symbol is coded at the longest context of the trie that has it: at every context on the way down an
escape is coded, with probability distinct / (2 * total), and the symbols of the longer context are
excluded from the counts of the shorter one. Below the empty context all remaining symbols are
equally likely. The score is the sum of the log10 probabilities.

The trie is never gathered in one place. Its leaves are grams, ORDER context symbols and the symbol
coded, packed into one number, counted per block of documents and summed over all. All contexts of two and
more symbols that end in the same two lie in one group, whose size the number of symbols bounds; the two
shortest orders are one small table (at most 256 * 257 rows). Each group gives the probabilities of its
grams, and the grams a block needs go back to it by a join. Words, as 64-bit hashes, and their counts take the same way.
Documents are cut into blocks of ``BLOCK_BYTES`` (a longer document is a block of its own) in the order a task reads
them, so repeated rows are in many blocks; a block is counted and written with its number before the task begins the next.
What is gathered, shuffled and looked up grows with the input.

Defined results: a null or empty text is the end symbol alone. Repeated rows are scored alike, and each
of them counts in training. Without training documents every symbol is equally likely.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import (
    CHUNK_BYTES,
    LOWER,
    distinct,
    release_memory,
    ship_package,
    sorted_groups,
    span_hashes,
    staged,
    text_buffers,
    text_chunks,
    word_spans,
)

ORDER = 5
SYMBOLS = 256
END = 255  # no byte of UTF-8
WIDTH = 8
BLOCK_BYTES = 32 << 20
# A row of a block is a key with its count, or some documents packed.
_BLOCKS = "block bigint, is_word boolean, key bigint, seen bigint, documents binary"
_BLOCK_TYPES = pa.schema(
    [("block", pa.int64()), ("is_word", pa.bool_()), ("key", pa.int64()), ("seen", pa.int64()), ("documents", pa.binary())]
)
_LOOKUP = "key bigint, value double"
_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
_SCORE_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
_SCORE_TYPES = pa.schema(list(zip(_SCORE_NAMES, [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()])))


def grams(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of the texts its context and itself, packed, and the number of symbols of each
    text. A context that begins before its text is filled with end symbols."""
    plain = [b" ".join(text.split()) for text in texts]
    lengths = np.array([len(text) + 1 for text in plain], np.int64)
    gap = bytes([END]) * order
    # Behind each text come as many end symbols as a context has: the first is its own.
    coded = np.frombuffer(b"".join([gap, gap.join(plain), gap]), np.uint8).astype(np.int64)
    packed = coded
    for symbol in range(1, order + 1):
        packed = (packed[:-1] << WIDTH) | coded[symbol:]
    spans = lengths + order - 1
    own = np.ones(int(spans.sum()), bool)
    for extra in range(1, order):
        own[np.cumsum(spans) - extra] = False
    return packed[: len(own)][own], lengths


def byte_rows(column: pa.Array) -> list[bytes]:
    data, offsets = text_buffers(column)
    whole = data.tobytes()
    return [whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def packed(rows: pa.RecordBatch) -> bytes:
    """Rows as compressed bytes, which take a third of the room of texts in files and shuffles."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpacked(documents: bytes | pa.Buffer) -> pa.Table:
    return pa.ipc.open_stream(documents).read_all()


class KeyCounts:
    """Sorted keys with counts. Added runs are merged once they are as long as what is there."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, found: np.ndarray, learned: bool) -> None:
        """Count keys; those of held-out documents are there with 0."""
        keys, counts = distinct(found)
        self.runs.append((keys, counts if learned else np.zeros(len(keys), np.int64)))
        if sum(len(keys) for keys, _ in self.runs[1:]) > len(self.runs[0][0]) + (1 << 20):
            self.runs = [self.merged()]

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = (np.concatenate(column) for column in zip(*self.runs))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[begins], np.add.reduceat(counts, begins)


def word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of the texts, and the text it is in."""
    offsets = np.cumsum([0] + [len(text) for text in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts, ends, text = word_spans(data, offsets)
    return span_hashes(data, starts, ends).view(np.int64), text


def _counter(order: int, block_bytes: int):
    """Blocks of documents: their rows, and their grams and words with their number in training documents,
    which may be 0."""
    lower = bytes(LOWER)

    def with_nulls(rows: int, **columns: pa.Array) -> pa.RecordBatch:
        filled = [columns[field.name].cast(field.type) if field.name in columns else pa.nulls(rows, field.type) for field in _BLOCK_TYPES]
        return pa.RecordBatch.from_arrays(filled, schema=_BLOCK_TYPES)

    def counts(block: int, sums: dict[bool, KeyCounts]) -> Iterator[pa.RecordBatch]:
        for is_word, counted in sums.items():
            keys, seen = counted.merged()
            for start in range(0, len(keys), 1 << 16):
                some = slice(start, start + (1 << 16))
                rows = len(keys[some])
                yield with_nulls(
                    rows, block=pa.array(np.full(rows, block)), is_word=pa.array(np.full(rows, is_word)),
                    key=pa.array(keys[some]), seen=pa.array(seen[some]),
                )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Written once, so that a block is known by its task and its place in it.
        block, held = TaskContext.get().partitionId() << 32, 0
        sums: dict[bool, KeyCounts] = defaultdict(KeyCounts)
        for batch in batches:
            learn_of = ~np.asarray(batch.column("held_out").to_numpy(zero_copy_only=False), bool)
            for first, last, data, _ in text_chunks(batch.column("text"), min(CHUNK_BYTES, block_bytes)):
                if held and held + len(data) > block_bytes:
                    yield from counts(block, sums)
                    block, held, sums = block + 1, 0, defaultdict(KeyCounts)
                held += len(data)
                rows = batch.slice(first, last - first)
                texts = byte_rows(rows.column("text"))
                for learned in (True, False):
                    picked = [texts[i].translate(lower) for i in np.flatnonzero(learn_of[first:last] == learned)]
                    if picked:
                        sums[False].add(grams(picked, order)[0], learned)
                        sums[True].add(word_keys(picked)[0], learned)
                yield with_nulls(1, block=pa.array([block]), documents=pa.array([packed(rows)], pa.binary()))
        yield from counts(block, sums)
        release_memory()

    return work


class Contexts:
    """The contexts of one length: their leaves (context and symbol, packed) with counts above 0."""

    def __init__(self, leaves: np.ndarray, counts: np.ndarray):
        self.leaves, self.counts = leaves, counts
        self.nodes, self.node_of = np.unique(leaves >> WIDTH, return_inverse=True)
        self.total = np.bincount(self.node_of, weights=counts, minlength=len(self.nodes))
        self.kinds = np.bincount(self.node_of, minlength=len(self.nodes)).astype(float)

    def count(self, leaves: np.ndarray) -> np.ndarray:
        return _found(self.leaves, self.counts, leaves)

    def excluded(self, shorter: Contexts, length: int) -> np.ndarray:
        """For each context the counts that its symbols have in the context one shorter."""
        below = shorter.count(self.leaves & _low(length))
        return np.bincount(self.node_of, weights=below, minlength=len(self.nodes))


def _low(symbols_kept: int) -> int:
    return (1 << (WIDTH * symbols_kept)) - 1


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The value of each wanted key, 0 for one that ``keys`` (sorted) lacks."""
    if not len(keys):
        return np.zeros(len(wanted))
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[place] == wanted, values[place], 0).astype(float)


def log_probabilities(packed: np.ndarray, seen: np.ndarray, short: list, order: int) -> np.ndarray:
    """log10 probability of each gram.

    ``packed`` holds every gram whose context ends in the same two symbols, ``seen`` its number in
    training; ``short`` has (leaves, counts), sorted, of orders 0 and 1 of the whole corpus.
    """
    levels = []
    for length in range(order + 1):
        if length < len(short):
            leaves, counts = short[length]
        else:
            leaves, place = np.unique(packed[seen > 0] & _low(length + 1), return_inverse=True)
            counts = np.bincount(place, weights=seen[seen > 0], minlength=len(leaves))
        levels.append(Contexts(leaves, counts))

    result = np.zeros(len(packed))
    waiting = np.ones(len(packed), bool)
    # Of the symbols that longer contexts have: their counts at this length, and how many they are.
    shut, shut_kinds = np.zeros(len(packed)), np.zeros(len(packed))
    for length in range(order, -1, -1):
        level = levels[length]
        own = packed & _low(length + 1)
        count = level.count(own)
        kinds = _found(level.nodes, level.kinds, own >> WIDTH)
        total = _found(level.nodes, level.total, own >> WIDTH) - shut
        fresh = kinds - shut_kinds
        # Half a count of each symbol goes to the escape. With the whole alphabet counted there is
        # nothing left to escape to.
        escape = np.where((length == 0) & (kinds >= SYMBOLS), 0, fresh)
        whole = 2 * total - fresh + escape
        hit = waiting & (count > 0)
        result[hit] += np.log10((2 * count[hit] - 1) / whole[hit])
        waiting &= ~hit
        # A context never seen, or without a symbol that is not excluded, is left at no cost.
        down = waiting & (fresh > 0)
        result[down] += np.log10(escape[down] / whole[down])
        shut_kinds = kinds
        if length:
            below = level.excluded(levels[length - 1], length)
            shut = _found(level.nodes, below, own >> WIDTH)
    result[waiting] -= np.log10(SYMBOLS - shut_kinds[waiting])
    return result


def _scorer_of_grams(order: int, short: list):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sorted_groups(batches, "ending"):
            packed, seen = rows.column("key").to_numpy(), rows.column("seen").to_numpy()
            values = log_probabilities(packed, seen, short, order)
            yield pa.RecordBatch.from_arrays([rows.column("key"), pa.array(values)], ["key", "value"])
        release_memory()

    return work


class KeyTable:
    """Values by key. Keys hash to slots of a table; those whose slot is taken go to a next table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values, self.tables = keys, values, []
        left = np.arange(len(keys))
        while len(left):
            bits = max(4, int(len(left) * 4).bit_length())
            slots = self._slots(keys[left], bits)
            table = np.zeros(1 << bits, np.int32)
            table[slots] = left
            self.tables.append((bits, table))
            left = left[table[slots] != left]

    def _slots(self, keys: np.ndarray, bits: int) -> np.ndarray:
        factor = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.tables) * 0x5851F42D4C957F2D & ((1 << 64) - 1))
        return ((keys.view(np.uint64) * factor) >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, wanted: np.ndarray) -> np.ndarray:
        tables, self.tables = self.tables, []
        place = np.zeros(len(wanted), np.int64)
        left = None
        for bits, table in tables:
            asked = wanted if left is None else wanted[left]
            at = table[self._slots(asked, bits)]
            self.tables.append((bits, table))
            if left is None:
                place[:] = at
                left = np.flatnonzero(self.keys[at] != asked)
            else:
                place[left] = at
                left = left[self.keys[at] != asked]
            if not len(left):
                break
        self.tables = tables
        return self.values[place]


def _scorer_of_blocks(order: int, train_tokens: int, kinds: int, ends: int):
    """Scores of a block's documents, from the values of its grams and the counts of its words."""
    lower = bytes(LOWER)
    whole = np.log10(train_tokens + kinds + 1)

    def work(packs: pa.Table, lookup: pa.Table) -> pa.Table:
        is_word = lookup.column("is_word").to_numpy()
        keys, values = lookup.column("key").to_numpy(), lookup.column("value").to_numpy()
        of_gram, of_word = KeyTable(keys[~is_word], values[~is_word]), KeyTable(keys[is_word], values[is_word])
        parts = [_SCORE_TYPES.empty_table()]
        for one in packs.column("documents"):
            docs = unpacked(one.as_buffer())
            chunk = [text.translate(lower) for text in byte_rows(docs.column("text"))]
            symbols, lengths = grams(chunk, order)
            scores = np.add.reduceat(of_gram.get(symbols), np.cumsum(lengths) - lengths)
            words, text = word_keys(chunk)
            counts = of_word.get(words) if len(words) else np.zeros(0)
            tokens = np.bincount(text, minlength=len(chunk)) + 1
            known = np.bincount(text, weights=counts > 0, minlength=len(chunk)) + (ends > 0)
            base = np.bincount(text, weights=np.log10(counts + 1), minlength=len(chunk)) + np.log10(ends + 1)
            columns = [tokens, known.astype(np.int64), base - tokens * whole, scores]
            parts.append(
                pa.Table.from_arrays([docs.column("doc_id"), docs.column("held_out"), *map(pa.array, columns)], _SCORE_NAMES).cast(_SCORE_TYPES)
            )
        release_memory()
        return pa.concat_tables(parts)

    return work


def score(docs: DataFrame, held_out: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows for which ``held_out`` is false. ``base_score`` is that of the words as
    independent draws with one added to each count.
    """
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    blocks = staged(texts.mapInArrow(_counter(order, block_bytes), _BLOCKS), "blocks", "zstd")
    counts = blocks.filter("key IS NOT NULL").select("block", "is_word", "key", "seen")
    # Sums over all blocks: the trie's leaves, and the words.
    sums = staged(counts.groupBy("is_word", "key").agg(F.sum("seen").alias("seen")), "sums")
    trie, words = sums.filter("NOT is_word").select("key", "seen"), sums.filter("is_word").select("key", "seen")

    short = [_short_order(trie, length) for length in (0, 1)]
    # A task holds the grams of a few endings at a time.
    ending = F.shiftright("key", WIDTH).bitwiseAND(_low(2)).alias("ending")
    by_ending = trie.select(ending, "key", "seen").repartition("ending").sortWithinPartitions("ending")
    probabilities = by_ending.mapInArrow(_scorer_of_grams(order, short), _LOOKUP)
    tokens, kinds = words.filter("seen > 0").agg(F.coalesce(F.sum("seen"), F.lit(0)), F.count("*")).first()
    ends = int(dict(zip(*map(np.ndarray.tolist, short[0]))).get(END, 0))
    tokens, kinds = tokens + ends, kinds + (ends > 0)

    values = probabilities.select(F.lit(False).alias("is_word"), "key", "value").unionByName(
        words.select(F.lit(True).alias("is_word"), "key", F.col("seen").cast("double").alias("value"))
    )
    lookup = counts.select("block", "is_word", "key").join(values, ["key", "is_word"])
    lookup = lookup.select(F.col("block").alias("of_block"), "is_word", "key", "value")
    documents = blocks.filter("documents IS NOT NULL").select("block", "documents")
    scored = (
        documents.groupBy("block")
        .cogroup(lookup.groupBy("of_block"))
        .applyInArrow(_scorer_of_blocks(order, tokens, kinds, ends), _SCORES)
    )
    return scored.withColumn("train_tokens", F.lit(tokens).cast("bigint"))


def _short_order(trie: DataFrame, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves and counts of a short order: at most 256 ** (length + 1) rows."""
    leaf = F.col("key").bitwiseAND(_low(length + 1)).alias("leaf")
    rows = trie.filter("seen > 0").groupBy(leaf).agg(F.sum("seen").alias("seen")).orderBy("leaf").collect()
    return tuple(np.array([row[i] for row in rows], np.int64) for i in (0, 1))
