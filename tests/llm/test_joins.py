"""The join, mining and alignment operators beside brute force, and on hand-made rows."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import alignment, hard_negatives, ngram_join, queries
from strata.llm.common import table
from strata.llm.count_tree import CountTree, count_vectors, may_link
from test_llm_small import DOCS, EXTRA, ODD, words


def with_extra(rows):
    return rows.withColumns({name: F.lit(7) for name in (*EXTRA, "token", "bucket", "family", "n", "pairs")})


@pytest.fixture(scope="module")
def odd(spark):
    return with_extra(spark.createDataFrame(ODD, DOCS))


@pytest.fixture(scope="module")
def none(spark):
    return with_extra(spark.createDataFrame([], DOCS))


# N-gram join


def shingles(text, size):
    found = words(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def plain_groups(rows, size=5, percent=80):
    """Sorted (doc_id, n_shingles, component_id) by comparing every pair of different sets."""
    sets = [(doc_id, shingles(text, size)) for doc_id, text in rows]
    kinds = sorted({one for _, one in sets if one}, key=sorted)
    root = {one: one for one in kinds}

    def top(one):
        while root[one] != one:
            one = root[one]
        return one

    for k, one in enumerate(kinds):
        for other in kinds[:k]:
            if len(one & other) * 100 >= percent * len(one | other):
                root[top(one)] = top(other)
    least = defaultdict(lambda: None)
    for doc_id, one in sets:
        if one and doc_id is not None:
            least[top(one)] = min(doc_id, least[top(one)] if least[top(one)] is not None else doc_id)
    found = [(doc_id, len(one), least[top(one)] if one else doc_id) for doc_id, one in sets]
    return sorted(found, key=str)


def joined(rows, **options):
    return sorted(map(tuple, ngram_join.jaccard_groups(rows, **options).collect()), key=str)


def test_join_on_odd_rows(odd, none):
    assert joined(odd) == plain_groups([(row[0], row[1]) for row in ODD])
    assert joined(none) == []


def test_join_equals_brute_force_on_given_documents(spark, data):
    docs = table(spark, data, "documents")
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    result = queries.ngram_groups(spark, data)
    assert result.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, result.collect()), key=str) == plain_groups(rows)


def families():
    """Edited copies in chains, sets that share a template, and a passage that all texts hold."""
    draw = np.random.default_rng(3)
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for family in range(6):
        base = [f"w{x}" for x in draw.integers(0, 4000, 60)]
        for _ in range(14):
            base = list(base)
            base[int(draw.integers(60))] = f"x{draw.integers(10**6)}"
            rows.append((len(rows), " ".join([*base, *passage])))
    template = [f"t{i}" for i in range(20)]
    for _ in range(40):
        rows.append((len(rows), " ".join([*template, *[f"u{x}" for x in draw.integers(0, 10**6, 12)], *passage])))
    return rows


@pytest.mark.parametrize("tile", [1024, 16])
def test_join_of_chains_and_templates(spark, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "BUCKET_TILE", tile)
    rows = families()
    assert joined(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2) == plain_groups(rows, 2)


def test_similarity_right_at_the_limit(spark):
    # 8 of 10 shingles of one word, and 7 of 9.
    rows = [(1, "a b c d e f g h i"), (2, "a b c d e f g h j"), (3, "k l m n o p q r"), (4, "k l m n o p q s")]
    found = joined(spark.createDataFrame(rows, "doc_id bigint, text string"), words=1)
    assert found == plain_groups(rows, 1) == [(1, 9, 1), (2, 9, 1), (3, 8, 3), (4, 8, 4)]


def test_repeated_rows_meet_as_one_set(spark):
    rows = [(i % 7, "one text that many rows repeat word by word") for i in range(3000)]
    rows.append((100, "one text that many rows repeat word by ward"))
    found = ngram_join.jaccard_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), words=1)
    # "word" comes twice in the copies; all their 8 words are in the other text.
    assert Counter(map(tuple, found.collect())) == Counter((i, 8 if i < 7 else 9, 0) for i, _ in rows)


def test_prefixes_always_meet():
    draw = np.random.default_rng(5)
    for _ in range(300):
        size = int(draw.integers(1, 60))
        one = set(draw.choice(200, size, replace=False).tolist())
        other = set(sorted(one)[: max(1, size - int(draw.integers(0, 8)))]) | set(draw.choice(200, int(draw.integers(0, 8))).tolist())
        if len(one & other) * 100 < 80 * len(one | other):
            continue
        lengths = ngram_join.prefix_lengths(np.array([len(one), len(other)]), 80)
        assert set(sorted(one)[: lengths[0]]) & set(sorted(other)[: lengths[1]])


def test_tree_gives_every_pair_within_the_bound():
    draw = np.random.default_rng(9)
    sets = [np.unique(draw.integers(0, 1 << 60, int(size), dtype=np.uint64)) for size in draw.integers(1, 90, 150)]
    sets += [np.unique(np.concatenate([one[len(one) // 9 :], draw.integers(0, 1 << 60, 2, dtype=np.uint64)])) for one in sets]
    bounds = np.cumsum([0, *map(len, sets)])
    points, sizes = count_vectors(np.concatenate(sets), bounds, 6), np.diff(bounds)
    tree = CountTree(points, sizes)
    found = {(i, j) for a, b in tree.join(tree, 80) for i, j in zip(a.tolist(), b.tolist())}
    overlap = np.minimum(points[:, None], points[None]).sum(axis=2)
    near = may_link(overlap, sizes[:, None], sizes[None], 80) & (100 * sizes[:, None] >= 80 * sizes) & (100 * sizes >= 80 * sizes[:, None])
    assert set(zip(*map(np.ndarray.tolist, np.nonzero(near)))) <= found
    labels = draw.integers(0, 3, len(sets))
    apart = {(i, j) for a, b in tree.join(tree, 80, labels, labels) for i, j in zip(a.tolist(), b.tolist())}
    assert apart == {(i, j) for i, j in found if labels[i] != labels[j]}


# Hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int"


def plain_negatives(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    used = [
        (vec_id, label, [math.floor(256 * x) for x in vector])
        for vec_id, vector, label in rows
        if vec_id is not None and label is not None and vector and all(x is not None and math.isfinite(x) for x in vector)
    ]
    found = []
    for vec_id, label, vector in used:
        if not is_anchor(vec_id):
            continue
        partners = [
            (-sum(x * y for x, y in zip(vector, other)), other_id, other_label)
            for other_id, other_label, other in used
            if other_id != vec_id and len(other) == len(vector)
        ]
        for score, positive, _ in sorted(one for one in partners if one[2] == label)[:positives]:
            fit = sorted(one for one in partners if one[2] != label and low * -score <= 100 * -one[0] <= high * -score)
            for rank, (other_score, negative, _) in enumerate(fit[:negatives], 1):
                found.append((vec_id, positive, rank, negative, -score, -other_score))
    return sorted(found)


def random_vectors(count, size=24, seed=1):
    draw = np.random.default_rng(seed)
    vectors = draw.normal(size=(count, size)).astype(np.float32)
    vectors[count // 2 :] += vectors[: count - count // 2] * 0.7
    return [(i, row.tolist(), int(label)) for i, (row, label) in enumerate(zip(vectors, draw.integers(0, 4, count)))]


@pytest.mark.parametrize("shard, block", [(10_000, 1024), (37, 5)])
def test_negatives_equal_brute_force(spark, shard, block):
    rows = random_vectors(300)
    # A third of all rows share one vector; some are the negative of another.
    rows = [(i, rows[7][1] if i % 3 == 0 else [-x for x in v] if i % 11 == 0 else v, label) for i, v, label in rows]
    vectors = spark.createDataFrame(rows, VECTORS).withColumns({n: F.lit(1) for n in ("score", "shard", "place", "rank")})
    mined = hard_negatives.mine(vectors, F.col("vec_id") % 10 == 0, shard_rows=shard, anchor_rows=block)
    assert sorted(map(tuple, mined.collect())) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (1, [1.0, 0.25], 1), (2, [0.5, 0.5], 2), (3, [0.5, 0.5], 2), (4, None, 1), (5, [], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 2), (8, [None, 1.0], 2), (None, [1.0, 1.0], 1), (9, [1.0, 1.0], None),
        (10, [0.0, 0.0], 1), (11, [1.0, 0.5, 0.5], 1), (12, [0.5, 0.25, 1.0], 2), (13, [0.0, 0.0], 2),
        (2, [0.5, 0.5], 2), (14, [-1.0, -1.0], 1),
    ]
    mined = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 2 == 0)
    assert sorted(map(tuple, mined.collect())) == plain_negatives(rows, lambda i: i % 2 == 0)
    empty = hard_negatives.mine(spark.createDataFrame([], VECTORS), F.col("vec_id") % 2 == 0)
    assert empty.collect() == [] and empty.columns == mined.columns


def test_index_omits_covered_suffixes_and_finds_all():
    draw = np.random.default_rng(2)
    rows = np.floor(draw.normal(size=(400, 40)) * 256 * np.linspace(1, 0.05, 40))
    anchors = np.floor(draw.normal(size=(9, 40)) * 256)
    index = hard_negatives.SuffixIndex(rows)
    scores = anchors @ rows.T
    for share in (0.9, 0.5, 0.1, -1.0):
        least = scores.max(axis=1) * share
        anchor, row, found = index.join(anchors, least, np.ones(scores.shape, bool))
        assert set(zip(anchor.tolist(), row.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(scores >= least[:, None]))))
        assert (found == scores[anchor, row]).all()


# Alignment


@pytest.fixture(scope="module")
def models():
    with open(alignment.BYTE_MODEL, encoding="utf-8") as one, open(alignment.PIECE_MODEL, "rb") as other:
        return alignment.Tokenizers(one.read(), other.read())


def plain_alignment(models, rows):
    def spans(ids, table):
        ends = np.cumsum([len(table[one]) for one in ids]).tolist()
        return list(zip([0, *ends[:-1]], ends))

    found, counts = [], Counter()
    for doc_id, text in rows:
        a = models.a.encode(" " + text, add_special_tokens=False).ids if text else []
        b = models.b.encode(text) if text else []
        plain = (" " + text).encode() if text else b""
        if b"".join(models.bytes_a[i] for i in a) != plain or b"".join(models.bytes_b[i] for i in b) != plain:
            a, b = [], []
        spans_a, spans_b = spans(a, models.bytes_a) if a else [], spans(b, models.bytes_b) if b else []
        links, j = [], 0
        for number, (begin, end) in zip(a, spans_a):
            while spans_b[j][1] <= begin:
                j += 1
            k = j
            while k < len(b) and spans_b[k][0] < end:
                links.append((number, b[k]))
                k += 1
        common = {end for _, end in spans_a} & {end for _, end in spans_b}
        texts = []
        for ids, own in ((a, spans_a), (b, spans_b)):
            parts = [[]]
            for number, (_, end) in zip(ids, own):
                parts[-1].append(str(number))
                if end in common:
                    parts.append([])
            texts.append([",".join(part) for part in parts[:-1]])
        groups = ";".join(f"{x}|{y}" for x, y in zip(*texts))
        counts.update(links)
        found.append((doc_id, len(a), len(b), len(common), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (doc_id, n_a, n_b, n_groups, len(links), digest, sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links))
            for doc_id, n_a, n_b, n_groups, links, digest in found
        ),
        key=str,
    )


def aligned(rows):
    return sorted(map(tuple, alignment.align_documents(rows).collect()), key=str)


def test_alignment_of_odd_rows(spark, models, odd, none):
    assert aligned(odd) == plain_alignment(models, [(row[0], row[1]) for row in ODD])
    assert aligned(none) == []
    more = [
        (1, " leading"), (2, "two  blanks\n\nand\ttabs "), (3, "▁ a piece mark"), (4, "<|endoftext|> and <s> </s>"), (5, " nbsp　wide"),
        (6, "é combining ﬁ"), (7, "\0 nul"), (8, " "), (9, "🧑‍🚀" * 50),
    ]
    result = aligned(spark.createDataFrame(more, "doc_id bigint, text string"))
    assert result == plain_alignment(models, more)


@pytest.mark.parametrize("chunk", [1 << 21, 3000])
def test_alignment_equals_brute_force(spark, data, models, monkeypatch, chunk):
    monkeypatch.setattr(alignment, "CHUNK", chunk)
    docs = table(spark, data, "documents")
    rows = [(row.doc_id, row.text) for row in docs.select("doc_id", "text").collect()]
    result = queries.alignments(spark, data)
    assert result.columns[:6] == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    assert sorted(map(tuple, result.collect()), key=str) == plain_alignment(models, rows)


def test_gallop_from_any_start():
    draw = np.random.default_rng(4)
    for size in (0, 1, 2, 50):
        ordered = np.sort(draw.integers(0, 80, size))
        wanted = draw.integers(-2, 84, 200)
        found = alignment.gallop(ordered, wanted, draw.integers(0, size + 3, 200))
        assert (found == np.searchsorted(ordered, wanted)).all()


def test_byte_letters_are_those_of_the_vocabulary(models):
    assert sorted(alignment.byte_letters().values()) == list(range(256))
    assert all(one for one in models.bytes_a)
