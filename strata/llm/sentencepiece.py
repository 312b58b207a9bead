"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

A text is cut into units at its blanks (no piece of these vocabularies crosses from a letter to a blank).
Units that a task meets for the first time are searched together, all those of one length at once: for
each end and each piece length one hash of the substrings is probed in the sorted keys of the pieces of
that length, and the best way to each end is kept with its last piece as back pointer.

What is best depends on the model. Unigram models add the scores of the pieces. BPE models are defined by
merges, and no sum of piece scores gives their result; there a step scores 0 if its piece and the one
before it stand side by side in the result of merging the two together, and minus infinity if not. Just one
segmentation has only such steps, and it is the one the merges give. Whether two pieces may stand side by
side follows from their last merges, walked backwards: at no time may the symbols at the border form a
piece that ranks before the next merge on either side.

Units of more than ``LONGEST_SEARCH`` characters, such as texts without blanks, are merged one by one.

Characters without a piece become byte pieces, or the unknown piece if the model has none. Vocabularies are
read, never trained. Supported are models that keep characters as they are (normaliser "identity").

Defined results: a null or empty text has no pieces and decodes to the empty text. Decoding gives the text
back unless it holds U+2581, which stands for a blank.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mixed, released, ship_package, worker_memo

BLANK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MOST_KEPT = 600_000  # units whose pieces a worker remembers
LONG_UNIT = 64
LONGEST_SEARCH = 512
BATCH = 1 << 15
_NEVER = np.int64(1) << 40
_CODED = "doc_id bigint, n_pieces int, ids array<int>, round_trip boolean"

_STEP = 0x9E3779B97F4A7C15


def _substring_sums(codes: np.ndarray) -> np.ndarray:
    """Running sums of the codes of each row, from which the hash of any substring follows."""
    powers = np.array([pow(_STEP, j, 1 << 64) for j in range(codes.shape[1])], np.uint64)
    sums = np.zeros((codes.shape[0], codes.shape[1] + 1), np.uint64)
    np.cumsum(mixed(codes.astype(np.uint64) + np.uint64(_STEP)) * powers, axis=1, out=sums[:, 1:])
    return sums


def _code_points(units: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(len(units), length)


class SortedKeys:
    """Sorted 64-bit keys with a directory over their leading bits, so a probe looks at few of them."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(1, (6 * len(keys)).bit_length()))
        first = np.searchsorted(self.keys, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift)
        self.first = first.astype(np.int32)
        self.longest = int(np.diff(first, append=len(keys)).max(initial=0))
        # Probes may run over the end, onto keys that are not there: hash 2 ** 64 - 1 is left unused.
        self.padded = np.append(self.keys, np.uint64((1 << 64) - 1))

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``wanted`` whose key is here, and their values."""
        place = self.first[(wanted >> self.shift).astype(np.int64)]
        for _ in range(self.longest - 1):
            place += self.padded[place] < wanted
        rows = np.flatnonzero(self.padded[place] == wanted)
        return rows, self.values[place[rows]]


@dataclass
class PieceModel:
    """Tables of a vocabulary. Their size is set by the vocabulary alone."""

    pieces: list[str]
    is_bpe: bool
    scores: np.ndarray
    unknown: int
    bytes_: dict[int, int]
    spelled_bytes: np.ndarray
    spelled_starts: np.ndarray
    spelled_sizes: np.ndarray
    keys: dict[int, SortedKeys]
    dummy_prefix: bool
    cuts_at_blanks: bool
    unknown_char: re.Pattern
    rank: np.ndarray = field(default=None)
    left: np.ndarray = field(default=None)
    right: np.ndarray = field(default=None)
    pairs: SortedKeys = field(default=None)
    joined: dict[tuple[int, int], int] = field(default=None)
    single: dict[str, int] = field(default=None)

    @classmethod
    def parse(cls, model: bytes) -> PieceModel:
        from sentencepiece import sentencepiece_model_pb2 as format_

        proto = format_.ModelProto()
        proto.ParseFromString(model)
        kinds, rules = format_.ModelProto.SentencePiece, proto.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that keep characters as they are can be used")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == kinds.USER_DEFINED for p in proto.pieces):
            raise ValueError("models with suffix blanks or user-defined pieces cannot be used")
        is_bpe = proto.trainer_spec.model_type == format_.TrainerSpec.BPE
        if not is_bpe and proto.trainer_spec.model_type != format_.TrainerSpec.UNIGRAM:
            raise ValueError("only BPE and unigram models can be used")

        pieces = [piece.piece for piece in proto.pieces]
        usable = {piece.piece: i for i, piece in enumerate(proto.pieces) if piece.type == kinds.NORMAL}
        byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == kinds.BYTE}
        spelled = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == kinds.BYTE
            else b"" if p.type == kinds.CONTROL
            else " ⁇ ".encode() if p.type == kinds.UNKNOWN
            else p.piece.replace(BLANK, " ").encode()
            for p in proto.pieces
        ]
        sizes = np.array([len(own) for own in spelled], np.int64)
        keys = {}
        for length in sorted({len(piece) for piece in usable}):
            own = [piece for piece in usable if len(piece) == length]
            hashes = _substring_sums(_code_points(own, length))[:, -1]
            keys[length] = SortedKeys(hashes, np.array([usable[piece] for piece in own], np.int64))
        unknown = next(i for i, p in enumerate(proto.pieces) if p.type == kinds.UNKNOWN)
        tables = cls(
            pieces, is_bpe, np.array([p.score for p in proto.pieces], float), unknown, byte_ids,
            np.frombuffer(b"".join(spelled), np.uint8), np.cumsum(sizes) - sizes, sizes, keys,
            rules.add_dummy_prefix, not any(re.search(f"[^{BLANK}]{BLANK}", piece) for piece in usable),
            re.compile(f"([^{re.escape(''.join(sorted(set(''.join(usable)))))}])"),
        )
        if is_bpe:
            tables._add_merges(usable)
        return tables

    def _add_merges(self, usable: dict[str, int]) -> None:
        """The rank of each piece, the two parts of its last merge, and all pairs that form a piece."""
        size = len(self.pieces)
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        pairs: dict[tuple[int, int], int] = {}
        for piece, own in usable.items():
            if len(piece) > 1:
                self.rank[own] = round(-self.scores[own])
            for cut in range(1, len(piece)):
                parts = usable.get(piece[:cut]), usable.get(piece[cut:])
                if None not in parts:
                    pairs[parts] = own
        unmade = []
        for piece, own in usable.items():
            parts = [usable.get(char, -1) for char in piece]
            while len(parts) > 1:
                ranked = [(self.rank[pairs[two]], i) for i, two in enumerate(zip(parts, parts[1:])) if two in pairs]
                if not ranked:
                    unmade.append(own)
                    break
                at = min(ranked)[1]
                if len(parts) == 2:
                    self.left[own], self.right[own] = parts
                parts[at : at + 2] = [pairs[parts[at], parts[at + 1]]]
        # Pieces that merging cannot reach are never in a result.
        for length, own in self.keys.items():
            made = ~np.isin(own.values, unmade)
            if not made.all():
                self.keys[length] = SortedKeys(own.keys[made], own.values[made])
        self.joined, self.single = pairs, {piece: own for piece, own in usable.items() if len(piece) == 1}
        joined = np.array([a * size + b for a, b in pairs], np.uint64)
        self.pairs = SortedKeys(mixed(joined), self.rank[np.array(list(pairs.values()), np.int64)])

    def side_by_side(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether merging the two pieces together leaves them as they are. Unknowns (-1) never merge."""
        fits = np.ones(len(before), bool)
        at = np.flatnonzero((before >= 0) & (after >= 0))
        a, b = before[at], after[at]
        limit = np.full(len(at), _NEVER)
        while len(at):
            rows, ranks = self.pairs.find(mixed((a * len(self.pieces) + b).astype(np.uint64)))
            merges = np.zeros(len(at), bool)
            merges[rows[ranks < limit[rows]]] = True
            fits[at[merges]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~merges & ((rank_a >= 0) | (rank_b >= 0))
            at, a, b, rank_a, rank_b = at[go], a[go], b[go], rank_a[go], rank_b[go]
            # The one formed later is taken apart; of equal merges the left one comes first.
            later = rank_a > rank_b
            limit = np.where(later, rank_a, rank_b + 1)
            a, b = np.where(later, self.right[a], a), np.where(later, b, self.left[b])
        return fits

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit's pieces, as the bytes of 32-bit integers."""
        found: list = [None] * len(units)
        by_length: dict[int, list[int]] = {}
        for i, unit in enumerate(units):
            if self.is_bpe and len(unit) > LONGEST_SEARCH:
                found[i] = self._merge(unit)
            else:
                by_length.setdefault(len(unit), []).append(i)
        for length, members in by_length.items():
            batch = max(1, min(BATCH, (BATCH * 16) // length))
            for first in range(0, len(members), batch):
                own = members[first : first + batch]
                for i, ids in zip(own, self._search([units[i] for i in own], length)):
                    found[i] = ids
        return found

    def _merge(self, unit: str) -> bytes:
        """The ids of one very long unit, by the merges themselves."""
        parts = [self.single.get(char, -1) for char in unit]
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        waiting: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (parts[i], parts[j]) in self.joined:
                rank = int(self.rank[self.joined[parts[i], parts[j]]])
                heapq.heappush(waiting, (rank, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while waiting:
            _, i, a, b = heapq.heappop(waiting)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = self.joined[a, b], -2
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        spelled: list[int] = []
        for char, piece in zip(unit, parts):
            if piece >= 0:
                spelled.append(piece)
            elif piece == -1:
                spelled += self._unknown(char, spelled)
        return np.array(spelled, np.int32).tobytes()

    def _search(self, units: list[str], length: int) -> list[bytes]:
        codes = _code_points(units, length)
        sums = _substring_sums(codes)
        count = len(units)
        best = np.full((length + 1, count), -np.inf)
        best[0] = 0
        last = np.full((length + 1, count), -1, np.int64)
        steps = np.ones((length + 1, count), np.int32)
        worst = self.scores.min() - 10 if not self.is_bpe else 0.0
        for end in range(1, length + 1):
            single = np.zeros(count, bool)
            # A single character always has a way: its piece, or the unknown one.
            for size in sorted((size for size in self.keys if size <= end), reverse=True):
                rows = np.flatnonzero(np.isneginf(best[end])) if self.is_bpe else np.arange(count)
                back = np.uint64(pow(pow(_STEP, -1, 1 << 64), end - size, 1 << 64))
                wanted = (sums[rows, end] - sums[rows, end - size]) * back
                hit, piece = self.keys[size].find(wanted)
                rows = rows[hit]
                if size == 1:
                    single[rows] = True
                if self.is_bpe:
                    if end > size:
                        fits = self.side_by_side(last[end - size][rows], piece)
                        rows, piece = rows[fits], piece[fits]
                    best[end][rows] = 0.0
                else:
                    value = best[end - size][rows] + self.scores[piece]
                    better = value > best[end][rows]
                    rows, piece = rows[better], piece[better]
                    best[end][rows] = value[better]
                last[end][rows], steps[end][rows] = piece, size
            if self.is_bpe:
                none = np.isneginf(best[end])
                best[end][none] = 0.0
            else:
                # The unknown piece competes where its character has no piece of its own.
                value = best[end - 1] + worst
                none = (value > best[end]) & ~single
                best[end][none] = value[none]
            last[end][none], steps[end][none] = -1, 1
        return self._walk_back(codes, last, steps, length)

    def _walk_back(self, codes, last, steps, length: int) -> list[bytes]:
        count = codes.shape[0]
        # Pieces from the end, one column per step; rows that are through keep filler.
        at, every = np.full(count, length), np.arange(count)
        columns, ends = [], []
        while (at > 0).any():
            through = at == 0
            columns.append(np.where(through, -2, last[at, every]))
            ends.append(at)
            at = np.where(through, 0, at - steps[at, every])
        ids, ends = np.stack(columns[::-1], axis=1), np.stack(ends[::-1], axis=1)
        there = ids >= 0
        flat, stops = ids[there].astype(np.int32).tobytes(), (4 * np.cumsum(there.sum(axis=1))).tolist()
        found = [flat[start:stop] for start, stop in zip([0, *stops], stops)]
        for i in np.flatnonzero((ids == -1).any(axis=1)):
            spelled: list[int] = []
            for piece, end in zip(ids[i], ends[i]):
                if piece >= 0:
                    spelled.append(int(piece))
                elif piece == -1:
                    spelled += self._unknown(chr(codes[i, end - 1]), spelled)
            found[i] = np.array(spelled, np.int32).tobytes()
        return found

    def _unknown(self, char: str, before: list[int]) -> list[int]:
        if self.bytes_:
            return [self.bytes_[byte] for byte in char.encode()]
        return [] if before and before[-1] == self.unknown else [self.unknown]

    def units(self, text: str) -> list[str]:
        """The units of a text, in order; their concatenation is the text as the model sees it."""
        if not text:
            return []
        whole = (BLANK if self.dummy_prefix else "") + text.replace(" ", BLANK)
        if not self.cuts_at_blanks or not self.bytes_:
            return [whole]
        if "\n" in whole and self.unknown_char.match("\n"):
            # A character without a piece stands alone, whatever is beside it; line ends are frequent.
            whole = whole.replace("\n", " \n ")
        if BLANK * 2 in whole:
            parts = re.findall(f"{BLANK}+[^{BLANK} ]*|[^{BLANK} ]+", whole)
        else:
            parts = whole.replace(BLANK, " " + BLANK).split(" ")
        if len(max(parts, key=len)) > LONG_UNIT:
            parts = [cut for part in parts for cut in (self.unknown_char.split(part) if len(part) > LONG_UNIT else [part])]
        return list(filter(None, parts))

    def decode_bytes(self, coded: list[np.ndarray]) -> list[bytes]:
        """The UTF-8 bytes of each text."""
        ids = np.concatenate([np.zeros(0, np.int64), *coded])
        ends = np.cumsum([0] + [len(own) for own in coded])
        sizes = self.spelled_sizes[ids]
        after = np.concatenate([[0], np.cumsum(sizes)])
        shift = np.repeat(self.spelled_starts[ids] - after[:-1], sizes)
        whole = self.spelled_bytes[np.arange(len(shift)) + shift].tobytes()
        bounds = after[ends].tolist()
        texts = [whole[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        return [text[1:] if self.dummy_prefix and text[:1] == b" " else text for text in texts]

    def decode(self, coded: list[np.ndarray]) -> list[str]:
        return [text.decode("utf-8", "replace") for text in self.decode_bytes(coded)]


class Encoder:
    """Encodes texts; remembers the pieces of the units it has met, ``MOST_KEPT`` at most."""

    def __init__(self, model: PieceModel):
        self.model, self.kept = model, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        units = [self.model.units(text) for text in texts]
        coded = [list(map(self.kept.get, own)) for own in units]
        fresh = list({unit for own, got in zip(units, coded) if None in got for unit, ids in zip(own, got) if ids is None})
        met = dict(zip(fresh, self.model.encode_units(fresh)))
        for own, got in zip(units, coded):
            if None in got:
                got[:] = [met[unit] if ids is None else ids for unit, ids in zip(own, got)]
        if len(self.kept) + len(met) > MOST_KEPT:
            self.kept.clear()
        self.kept.update((unit, ids) for unit, ids in met.items() if len(unit) <= LONG_UNIT)
        return [np.frombuffer(b"".join(got), np.int32) for got in coded]


def _worker(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo()
        if memo.get("pieces_of") != shared.value[0]:
            memo["pieces_of"], memo["pieces"] = shared.value[0], Encoder(shared.value[1])
        encoder = memo["pieces"]
        for batch in batches:
            texts = batch.column("text").fill_null("")
            size = max(1, int(len(texts) * (8 << 20) / max(1, texts.nbytes)))
            for first in range(0, len(texts), size):
                own = texts.slice(first, size).to_pylist()
                coded = encoder.encode(own)
                back = []
                for start in range(0, len(own), 256):
                    texts_back = encoder.model.decode_bytes(coded[start : start + 256])
                    back += [one == text.encode() for one, text in zip(texts_back, own[start : start + 256])]
                counts = np.array([len(ids) for ids in coded], np.int32)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(coded)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, size), pa.array(counts), lists, pa.array(back)],
                    ["doc_id", "n_pieces", "ids", "round_trip"],
                )

    return work


def encode(docs: DataFrame, model_path: str = MODEL) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pieces, ids, round_trip (decoding gives the text back)."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(model_path, "rb") as file:
        model = file.read()
    shared = spark.sparkContext.broadcast((hash(model), PieceModel.parse(model)))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return texts.mapInArrow(released(_worker(shared)), _CODED)


def decode(coded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """doc_id and text of rows with ``ids``; a null list is an empty text."""
    spark = coded.sparkSession
    ship_package(spark)
    with open(model_path, "rb") as file:
        model = file.read()
    shared = spark.sparkContext.broadcast(PieceModel.parse(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = shared.value.decode([np.array(ids or [], np.int64) for ids in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = coded.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids")
    return rows.mapInArrow(work, "doc_id bigint, text string")
