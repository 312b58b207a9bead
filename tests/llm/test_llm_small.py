"""Each operator on hand-made rows: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import ann, bloom, exact_dedup, minhash, mixing, ppm, quality, sentencepiece, token_count, toxicity, url_filter
from strata.llm.common import crc_remainder, table

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside.
EXTRA = ("size", "kept", "score", "rank", "node", "bucket", "key", "target", "taken", "block", "label")
ODD = [
    (1, "the cat sat on the mat today", "en", "a", 0),
    (2, "the cat sat on the mat today", "en", "a", 0),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, "word", "en", "b", 0),
    (6, " \t\n\x0b ", "en", None, 0),
    (None, "the cat sat on the mat today", "en", "c", 0),
    (None, None, None, None, None),
    (7, "naïve Größe 😀 über 中文   x", "de", "c", 0),
    (8, "lang " * 30_000, "en", "c", 0),
    (9, "x" * 200_000, "en", "a", 0),
    (9, "x" * 200_000, "en", "a", 0),
    (10, "THE CAT SAT ON THE MAT TODAY", "en", "b", 0),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumns({name: F.lit(7) for name in EXTRA})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS).withColumns({name: F.lit(7) for name in EXTRA})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 1, 0), (4, 0, None), (5, 0, 1), (7, 1, 0), (8, 0, 1), (None, 1, 1)],
        "doc_id bigint, quality int, toxic int",
    )


def words(text):
    lowered = (text or "").translate({code: code + 32 for code in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def test_exact_groups(odd):
    rows = exact_dedup.exact_groups(odd).collect()
    assert len(rows) == len(ODD)
    by_text = defaultdict(list)
    for doc_id, text, *_ in ODD:
        by_text[hashlib.sha256((text or "").encode()).hexdigest()].append(doc_id)
    for row in rows:
        own = by_text[row.text_sha256]
        assert row.group_size == len(own)
        assert row.keep_id == max((i for i in own if i is not None), default=None)
    # Of each group exactly one stays, of a repeated row as well.
    assert Counter(row.text_sha256 for row in rows if row.kept) == Counter(dict.fromkeys(by_text, 1))


def test_hot_digests_take_the_broadcast_way(spark):
    rows = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', string(id div 2)) AS text")
    found = exact_dedup.exact_groups(rows, support=0.01).collect()
    hot = [row for row in found if row.group_size == 1000]
    assert len(found) == 3000 and len(hot) == 1000 and {row.keep_id for row in hot} == {2997}
    digests = rows.select(exact_dedup.text_digest().alias("text_sha256"), "doc_id", F.col("doc_id").alias("row_no"))
    assert exact_dedup.winners(digests, 0.01).count() == 1


def test_drop_exact_keeps_columns(odd):
    kept = exact_dedup.drop_exact(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({text or "" for _, text, *_ in ODD})


def test_exact_of_nothing(none):
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_exact(none).count() == 0


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 1000), ("d", 5)], "source string, size bigint")
    found = {row.source: row.target for row in mixing.source_targets(sizes).collect()}
    # a and d stop at three times their size; b (weight 2) and the null source (weight 5) share the rest.
    assert found["a"] == 30 and found["d"] == 15
    assert math.isclose(found["b"], (2015 - 45) * 2 / 7) and math.isclose(found[None], (2015 - 45) * 5 / 7)


def test_mix_of_odd_rows(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD)
    assert sorted(row["size"] for row in rows) == sorted(len(words(text)) for _, text, *_ in ODD)
    assert all(row.taken % max(row["size"], 1) == 0 and row.taken <= 3 * row["size"] for row in rows)
    assert sum(row.taken for row in rows) <= sum(row["size"] for row in rows)


def test_mix_comes_near_targets_and_repeats(spark):
    rows = spark.range(6000).selectExpr(
        "id AS doc_id", "concat('s', if(id % 3 = 0, 0, id % 7)) AS source", "repeat('w ', int(id % 40)) AS text"
    )
    first, again = (sorted(map(tuple, mixing.mix(rows.repartition(n)).collect())) for n in (3, 5))
    assert first == again
    per_source = mixing.mix(rows).groupBy("source").agg(F.first("target").alias("target"), F.sum("taken").alias("taken"))
    assert all(abs(row.taken - row.target) <= 80 for row in per_source.collect())
    ranged = mixing.RANGE_ROWS
    mixing.RANGE_ROWS = 64
    try:
        assert sorted(map(tuple, mixing.mix(rows).collect())) == first
    finally:
        mixing.RANGE_ROWS = ranged


def test_mixture_takes_each_row_by_itself(spark):
    # Rows that agree in doc_id, source and size: some are taken once more than others.
    rows = [(None, "y", f"a b c d e f {k}") for k in range(12)] + [(k, "x", "a b c") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").withColumn("row", F.lit(1))
    taken = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("words"), F.first("target").alias("target")).collect()
    assert all(abs(row.words - row.target) <= 7 for row in taken)
    mixed = mixing.mixture(docs)
    assert mixed.columns == docs.columns
    words = mixed.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("words")).collect()
    assert {row.source: row.words for row in words} == {row.source: row.words for row in taken}


@pytest.mark.parametrize("odd_stage", ["mixture", "keep_good"])
def test_stages_keep_odd_rows_whole(spark, odd, none, labels, odd_stage):
    def stage(docs):
        return mixing.mixture(docs) if odd_stage == "mixture" else quality.keep_good(docs, labels, "quality", quality.fold(), 0.0)

    kept = stage(odd)
    assert kept.columns == odd.columns
    found, given = Counter(map(tuple, kept.collect())), Counter(map(tuple, odd.collect()))
    assert set(found) <= set(given)
    assert odd_stage == "mixture" or found == given
    assert stage(none).collect() == []


def test_scores_of_many_equal_rows(spark):
    # Blocks are cut by their bytes, whatever repeats.
    rows = [(1, "one row that comes many times over")] * 10_000 + [(2, "another")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    scored = ppm.score(docs, F.lit(False), block_bytes=20_000)
    assert scored.count() == 10_001
    assert scored.select("doc_id", "score").distinct().count() == 2
    blocks = docs.select("doc_id", F.lit(False).alias("held_out"), "text").mapInArrow(ppm._counter(ppm.ORDER, 20_000), ppm._BLOCKS)
    sizes = Counter()
    for row in blocks.filter("documents IS NOT NULL").collect():
        sizes[row.block] += sum(map(len, ppm.unpacked(bytes(row.documents)).column("text").to_pylist()))
    assert len(sizes) > 10 and max(sizes.values()) <= 20_000


def test_leading_axes_span_those_of_the_whole_decomposition():
    draw = np.random.default_rng(1)
    rows = (draw.normal(size=(300, 60)) * np.linspace(4, 0.1, 60)).astype(np.float32)
    own, exact = quality.leading_axes(rows, 8, 60), np.linalg.svd(rows, full_matrices=False)[2][:8]
    assert np.linalg.svd(exact @ own)[1].min() > 0.99


def test_mixture_repeats_documents(spark):
    rows = spark.createDataFrame([(1, "a b", "x"), (2, "c d e f g h i j", "y"), (3, None, "y")], "doc_id bigint, text string, source string")
    taken = {row.doc_id: row.passes_taken for row in mixing.mix(rows).collect()}
    found = Counter(row.doc_id for row in mixing.mixture(rows).collect())
    assert found == Counter({doc_id: n for doc_id, n in taken.items() if n})


def test_mix_of_nothing(none):
    assert mixing.mix(none).count() == 0 and mixing.mixture(none).count() == 0


PAGES = [
    (1, "http://a.net/x", "block", "net/"), (2, "http://www.example.net/en/1?q#f", "allow", "example.net/en/"),
    (3, "https://EXAMPLE.com/de/", "block", "example.com/de/"), (4, "https://x.org/fr/2", "allow", "org/fr/"),
    (5, "https://x.org/en/2", "allow", None), (6, None, "allow", None), (7, "no scheme net/", "allow", None),
    (8, "http://a.net", "allow", None), (9, "http://www.spam.com/p.html?utm_source=x#top", "block", None),
    (10, "https://spam.com/p/", "block", None), (11, "http://spam.com/p?x=1", "allow", None),
    (12, "http://notexample.com/de/", "allow", None), (12, "http://notexample.com/de/", "allow", None), (13, "", "allow", None),
]


def test_urls(spark):
    pages = spark.createDataFrame([row[:2] for row in PAGES], "page_id bigint, url string").withColumns({name: F.lit(7) for name in EXTRA})
    listed = spark.createDataFrame([("spam.com/p",), ("spam.com/p",), (None,)], "canonical string")
    rows = url_filter.judge(pages, listed).collect()
    assert sorted((r.page_id, r.verdict, r.rule) for r in rows) == sorted((i, v, r) for i, _, v, r in PAGES) or (
        Counter((r.page_id, r.verdict, r.rule) for r in rows) == Counter((i, v, r) for i, _, v, r in PAGES)
    )
    host_path = {row.page_id: (row.host, row.path) for row in rows}
    assert host_path[2] == ("www.example.net", "/en/1") and host_path[6] == ("", "") and host_path[3][0] == "example.com"


def test_urls_of_nothing_and_no_list(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    empty = spark.createDataFrame([], "canonical string")
    assert url_filter.judge(pages, empty).first().verdict == "allow"
    assert url_filter.judge(pages.limit(0), empty).count() == 0


def test_bloom_lets_every_listed_url_pass_and_few_others(spark):
    listed = spark.range(5000).selectExpr("concat('h/', id) AS canonical")
    other = spark.range(5000, 25000).selectExpr("concat('h/', id) AS canonical")
    filter_ = bloom.blocked_bloom(listed, "canonical")
    assert bloom.may_be_in(listed, "canonical", filter_).count() == 5000
    assert bloom.may_be_in(other, "canonical", filter_).count() < 400


def near_by_brute_force(rows, size, percent):
    sets = []
    for _, text, *_ in rows:
        own = words(text)
        sets.append({tuple(own[i : i + size]) for i in range(len(own) - size + 1)} or ({tuple(own)} if own else set()))
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    smallest = {}
    for r, (doc_id, *_) in zip(root, rows):
        if doc_id is not None:
            smallest[r] = min(doc_id, smallest.get(r, doc_id))
    return Counter((row[0], len(s), smallest.get(r)) for row, s, r in zip(rows, sets, root))


@pytest.mark.parametrize("size", [2, 5])
def test_near_groups_of_odd_rows(odd, size):
    rows = minhash.near_groups(odd, size).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == near_by_brute_force(ODD, size, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_groups_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    rows = []
    for base in range(12):
        text = [f"w{n}" for n in draw.integers(0, 400, 60)]
        for copy in range(9):
            changed = list(text)
            for place in draw.integers(0, 60, copy):
                changed[place] = f"v{draw.integers(0, 9999)}"
            rows.append((len(rows), " ".join(changed)))
    for tile in (512, 4):
        minhash.TILE = tile
        found = minhash.near_groups(spark.createDataFrame(rows, "doc_id bigint, text string"), 2).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == near_by_brute_force(rows, 2, 80)
    minhash.TILE = 512


def test_one_row_of_each_near_group_stays(spark):
    a, b, c, d = (" ".join(f"{letter}{n}" for n in range(60)) for letter in "abcd")
    rows = [
        (1, a), (1, a + " more"), (1, b), (2, b + " more"), (3, c), (4, c + " more"), (4, d), (4, d),
        (None, a + " else"), (None, "x " + d), (5, ""), (5, ""), (None, None), (6, " "),
    ]
    lone = " ".join(f"e{n}" for n in range(60))
    rows += [(None, lone), (None, lone + " more"), (None, lone)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("name", F.lit(7))
    kept = [(r.doc_id, r.text) for r in minhash.drop_near(docs, 2).collect()]
    of = lambda base: [row for row in kept if base in (row[1] or "")]
    assert [len(of(base)) for base in (a, b, c, d, lone)] == [1] * 5
    assert [of(base)[0][0] for base in (a, b, c, d, lone)] == [1, 1, 3, 4, None]
    assert Counter(row for row in kept if not (row[1] or "").strip()) == Counter(rows[10:14])
    assert len(kept) == 9 and minhash.drop_near(docs, 2).columns == docs.columns


def test_links_of_very_long_texts_are_exact():
    # 100 * 671,517 = 99 * 678,300, which single precision rounds down; one shingle less is no link.
    both, either = 671_517, 678_300
    for less, links in ((0, 1), (1, 0)):
        values = np.concatenate([np.arange(either), np.arange(both - less)])
        sizes = np.array([either, both - less])
        place = np.arange(2)
        assert len(minhash.spanning_links(values, sizes, place, place, 99)) == links


def test_drop_near_of_nothing(none):
    assert minhash.drop_near(none).count() == 0 and minhash.near_groups(none, 2).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("score", F.lit(1))


def test_neighbours_of_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [1.0, None], 1),
        (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 1), (8, [], 1), (9, [2.0, 1.0], 1), (10, [-1.0, 0.5], 1),
        (20, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (2, [1.0, 0.0], 1),
    ]
    found = ann.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=4).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in found] == [
        (0, 1, 9, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 10, -1.0),
    ]
    assert ann.nearest(vectors(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_and_exact_scores(spark):
    draw = np.random.default_rng(1)
    data = draw.standard_normal((1500, 16)) * draw.uniform(0.5, 2, (1500, 1))
    data[700:1200] = data[700]
    data = data.astype(np.float32)
    frame = vectors(spark, [(i, row.tolist(), 0) for i, row in enumerate(data)])
    exact = data.astype(float)
    for shape in ({}, {"shard_rows": 200, "query_rows": 20}):
        found = ann.nearest(frame, F.col("vec_id") % 20 == 0, k=20, **shape).toPandas()
        hits = 0
        for query, own in found.groupby("query_id"):
            scores = exact @ exact[query]
            assert np.allclose(own["score"], scores[own["vec_id"]], rtol=1e-12)
            assert sorted(own["rank"]) == list(range(1, 21))
            best = [i for i in np.lexsort((np.arange(len(exact)), -scores)) if i != query][:20]
            hits += len(set(best) & set(own["vec_id"]))
        assert len(found) == 75 * 20 and hits / len(found) >= 0.9


@pytest.mark.parametrize("shape", [{}, {"shard_rows": 150, "query_rows": 10}])
def test_recall_on_the_given_vectors(spark, data, shape):
    given = table(spark, data, "embeddings")
    usable = ann.usable(given).toPandas()
    ids, exact = usable["vec_id"].to_numpy(), np.stack(usable["vector"].to_numpy())
    found = ann.nearest(given, F.col("vec_id") % 20 == 0, k=20, **shape).toPandas()
    hits = wanted = 0
    for query in np.flatnonzero(ids % 20 == 0):
        scores = exact @ exact[query]
        best = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[query]][:20]
        own = found[found["query_id"] == ids[query]]
        assert len(own) == len(best)
        hits, wanted = hits + len(set(ids[best]) & set(own["vec_id"])), wanted + len(best)
    assert hits / wanted >= 0.95


def test_search_ends_on_the_smallest_number_that_finds_the_sample():
    draw = np.random.default_rng(4)
    entries = draw.standard_normal((3000, 24))
    queries, most = entries[:40], np.linalg.norm(entries, axis=1).max()
    scored = {}
    for recall in (0.5, 0.96, 1.0):
        hits, scored[recall] = 0, 0
        for query, found, scores in ann.search(entries, most, queries, 10, 64, 24, recall):
            exact = entries @ queries[query]
            exact[query] = -np.inf
            assert np.allclose(scores, entries[found] @ queries[query]) and len(set(found)) == len(found)
            hits, scored[recall] = hits + len(set(np.argsort(-exact)[:10]) & set(found)), scored[recall] + len(found)
        assert hits >= recall * 400
    assert scored[0.5] < scored[0.96] / 2 < len(entries) * len(queries) / 4 and scored[0.96] <= scored[1.0]


@pytest.mark.parametrize("copies", [3, 4, 8, 14, 19])
def test_near_copies_do_not_end_a_search(spark, copies):
    draw = np.random.default_rng(copies)
    rows, exact = [], {}
    for length, count in ((64, 500), (24, 60), (16, 15)):
        centres = draw.standard_normal((-(-count // copies), length))
        data = np.repeat(centres / np.linalg.norm(centres, axis=1)[:, None], copies, axis=0)[:count]
        data = (data + 1e-6 * draw.standard_normal(data.shape)).astype(np.float32)
        exact[length] = (len(rows), data.astype(float))
        rows += [(len(rows) + i, row.tolist(), 0) for i, row in enumerate(data)]
    frame = vectors(spark, rows)
    for shape in ({}, {"shard_rows": 200, "query_rows": 20}):
        found = ann.nearest(frame, F.col("vec_id") % 5 == 0, k=20, **shape).toPandas()
        own = {query: set(part["vec_id"]) for query, part in found.groupby("query_id")}
        for first, data in exact.values():
            hits = wanted = 0
            for query in range(-(-first // 5) * 5, first + len(data), 5):
                scores = data @ data[query - first]
                best = [first + i for i in np.argsort(-scores, kind="stable") if first + i != query][:20]
                assert len(own[query]) == len(best) == min(20, len(data) - 1)
                hits, wanted = hits + len(own[query] & set(best)), wanted + len(best)
            assert hits / wanted >= 0.9


def trie_scores(train, rows, order):
    """Code lengths from a plain trie of dictionaries."""
    seen = defaultdict(Counter)

    def symbols(text):
        return [255] * order + list(b" ".join(w.encode() for w in words(text))) + [255]

    for text in train:
        coded = symbols(text)
        for i in range(order, len(coded)):
            for length in range(order + 1):
                seen[tuple(coded[i - length : i])][coded[i]] += 1
    scores = []
    for text in rows:
        coded, total = symbols(text), 0.0
        for i in range(order, len(coded)):
            shut = set()
            for length in range(order, -1, -1):
                own = seen[tuple(coded[i - length : i])]
                free = {symbol: n for symbol, n in own.items() if symbol not in shut}
                if free:
                    escape = len(free) if length or len(own) < 256 else 0
                    whole = 2 * sum(free.values()) - len(free) + escape
                    if coded[i] in free:
                        total += math.log10((2 * free[coded[i]] - 1) / whole)
                        break
                    total += math.log10(escape / whole)
                shut |= own.keys()
            else:
                total -= math.log10(256 - len(shut))
        scores.append(total)
    return scores


def test_lm_scores_equal_a_plain_trie(spark):
    draw = np.random.default_rng(4)
    texts = ["".join(draw.choice(list("abcdeA é  \n"), draw.integers(0, 50))) for _ in range(80)] + [None, "", "zz q", "a" * 3000]
    rows = [(i, text) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({name: F.lit(7) for name in EXTRA})
    held = {r.doc_id: r.h for r in frame.select("doc_id", (crc_remainder("doc_id", 7) == 2).alias("h")).collect()}
    train = [text for i, text in rows if not held[i]]
    counts = Counter(word for text in train for word in words(text))
    tokens, kinds = sum(counts.values()) + len(train), len(counts) + 1
    expected = trie_scores(train, texts, ppm.ORDER)
    for block in (ppm.BLOCK_BYTES, 500):
        found = ppm.score(frame, crc_remainder("doc_id", 7) == 2, block_bytes=block).collect()
        assert len(found) == len(rows)
        for row in found:
            own = words(texts[row.doc_id])
            base = sum(math.log10((c + 1) / (tokens + kinds + 1)) for c in [*map(counts.__getitem__, own), len(train)])
            assert (row.held_out, row.n_tokens, row.train_tokens) == (held[row.doc_id], len(own) + 1, tokens)
            assert row.n_known == sum(word in counts for word in own) + 1
            assert math.isclose(row.base_score, base, rel_tol=1e-9)
            assert math.isclose(row.score, expected[row.doc_id], rel_tol=1e-9)


def test_lm_scores_of_odd_rows(odd, none):
    rows = ppm.score(odd, crc_remainder("doc_id", 7) == 2).collect()
    assert len(rows) == len(ODD) and all(row.score < 0 for row in rows)
    assert ppm.score(none, crc_remainder("doc_id", 7) == 2).count() == 0
    untaught = ppm.score(odd, F.lit(True)).filter("doc_id = 4").first()
    assert (untaught.train_tokens, untaught.n_known, untaught.base_score) == (0, 0, 0.0)
    assert math.isclose(untaught.score, -math.log10(256))


def test_tokens_of_odd_rows(odd, none):
    encoding = token_count._encoding(open(token_count.VOCABULARY, "rb").read())
    expected = Counter((i, len(encoding.encode_ordinary(text or ""))) for i, text, *_ in ODD)
    for block in (token_count.BLOCK_IDS, 7):
        rows = token_count.count_tokens(odd, block_ids=block).collect()
        assert Counter((row.doc_id, row.n_tokens) for row in rows) == expected
    assert token_count.count_tokens(none).count() == 0


def test_scan_counts_a_document_that_is_not_ended(spark, tmp_path):
    ids = np.array([5, 5, 9, 9, 5, 5, 5, 5, 5], "<u2")
    (tmp_path / "f.bin").write_bytes(ids.tobytes())
    files = spark.createDataFrame([("f.bin", len(ids))], "file string, file_ids bigint")
    for block in (1, 2, 3, 100):
        rows = token_count.scan_flat(spark, str(tmp_path), files, end_id=9, block_ids=block).collect()
        assert sorted((row.place, row.n_tokens) for row in rows) == [(0, 2), (1, 0), (2, 5)]


def test_pieces_equal_the_library(odd, none):
    import sentencepiece as library

    processor = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    rows = sentencepiece.encode(odd)
    found = rows.collect()
    assert Counter((row.doc_id, tuple(row.ids)) for row in found) == Counter(
        (i, tuple(processor.encode(text or ""))) for i, text, *_ in ODD
    )
    assert all(row.n_pieces == len(row.ids) and row.round_trip for row in found)
    back = Counter((row.doc_id, row.text) for row in sentencepiece.decode(rows).collect())
    assert back == Counter((i, text or "") for i, text, *_ in ODD)
    assert sentencepiece.encode(none).count() == 0


def test_pieces_of_many_texts_equal_the_library():
    import sentencepiece as library

    raw = open(sentencepiece.MODEL, "rb").read()
    processor, encoder = library.SentencePieceProcessor(model_proto=raw), sentencepiece.Encoder(sentencepiece.PieceModel.parse(raw))
    draw = np.random.default_rng(6)
    texts = ["".join(draw.choice(list("aabehinorst etTé0.,\n  _=中"), draw.integers(0, 120))) for _ in range(1500)]
    assert [ids.tolist() for ids in encoder.encode(texts)] == processor.encode(texts)


def test_unigram_pieces_equal_the_library():
    import sentencepiece as library
    from sentencepiece import sentencepiece_model_pb2 as format_

    proto = format_.ModelProto()
    kinds = format_.ModelProto.SentencePiece
    rows = [("<unk>", 0.0, kinds.UNKNOWN), ("<s>", 0.0, kinds.CONTROL), ("</s>", 0.0, kinds.CONTROL)]
    rows += [(f"<0x{byte:02X}>", -20.0, kinds.BYTE) for byte in range(256)]
    draw = np.random.default_rng(8)
    spelled = {"▁", *"abcde"} | {"".join(draw.choice(list("abcde"), draw.integers(2, 5))) for _ in range(60)} | {"▁ab", "▁c", "▁abc"}
    rows += [(piece, float(-draw.uniform(1, 9)), kinds.NORMAL) for piece in sorted(spelled)]
    for piece, score, kind in rows:
        proto.pieces.add(piece=piece, score=score, type=kind)
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = format_.TrainerSpec.UNIGRAM, True
    proto.normalizer_spec.add_dummy_prefix, proto.normalizer_spec.remove_extra_whitespaces = True, False
    raw = proto.SerializeToString()
    processor, encoder = library.SentencePieceProcessor(model_proto=raw), sentencepiece.Encoder(sentencepiece.PieceModel.parse(raw))
    texts = ["".join(draw.choice(list("aabbcde  x"), draw.integers(0, 60))) for _ in range(400)]
    # Of segmentations with the same score either may be found.
    score = {i: own for i, (_, own, _) in enumerate(rows)}
    for own, theirs in zip(encoder.encode(texts), processor.encode(texts)):
        assert sorted(own.tolist()) == sorted(theirs) or math.isclose(
            sum(map(score.get, own.tolist())), sum(map(score.get, theirs)), rel_tol=1e-5
        )


@pytest.mark.parametrize("operator, label", [(quality, "quality"), (toxicity, "toxic")])
def test_scores_of_odd_rows(odd, none, labels, operator, label):
    rows = operator.score(odd, labels, label, quality.fold()).collect()
    assert len(rows) == len(ODD) and all(0 <= row.score <= 1 for row in rows)
    assert operator.score(none, labels, label, quality.fold()).count() == 0
    unlabelled = operator.score(odd, labels.limit(0), label, quality.fold()).collect()
    assert {row.score for row in unlabelled} == {0.5}


def learnable(spark):
    draw = np.random.default_rng(9)
    rows = []
    for i in range(400):
        own = [f"w{n}" for n in draw.integers(0, 300, 40)]
        bad = i % 4 == 0
        if bad:
            own = [word.upper() + "!!" for word in own[:20]] + ["idiot", "stemword" + own[0]]
        rows.append((i, " ".join(own), int(not bad), int(bad)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, quality int, toxic int")
    return frame.select("doc_id", "text"), frame.select("doc_id", "quality", "toxic")


@pytest.mark.parametrize("operator, label, least", [(quality, "quality", 0.3), (toxicity, "toxic", 0.5)])
def test_held_out_accuracy(spark, operator, label, least):
    docs, labels = learnable(spark)
    scored = operator.score(docs, labels, label, quality.fold()).join(labels, "doc_id").filter("held_out").toPandas()
    assert ((scored["score"] >= least) == (scored[label] == 1)).mean() > 0.95


def plain_features(text, learned):
    """The features one word and one character at a time."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    edges = toxicity._EDGES.decode()
    plain = [word.strip(edges) for word in words]
    undone = ["".join(toxicity.LOOK_ALIKES.get(c, c) for c in word) for word in words]
    strange = [any(c in toxicity.LOOK_ALIKES for c in word) for word in plain]
    listed = [word in toxicity.LEXICON for word in plain]
    taught = [len(word.encode()) >= 4 and word[: toxicity.STEM] in learned for word in plain]
    hidden = [
        odd and not own and (word in toxicity.LEXICON or word.strip(edges) in toxicity.LEXICON)
        for odd, own, word in zip(strange, listed, undone)
    ]
    odd = [is_odd and any(c.isalpha() for c in word) for is_odd, word in zip(strange, plain)]
    persons = [i for i, word in enumerate(plain) if word in toxicity.SECOND_PERSON]
    hits = [i for i in range(len(words)) if listed[i] or taught[i] or hidden[i]]
    near = sum(any(abs(i - person) <= toxicity.NEAR for person in persons) for i in hits)
    n, size = max(len(words), 1), max(len(text.encode()), 1)
    return [
        sum(listed) / n, min(sum(listed), 20), sum(taught) / n, min(sum(taught), 20), near / n,
        sum("A" <= c <= "Z" for c in text) / size,
        sum(33 <= ord(c) < 48 or 58 <= ord(c) < 65 or 91 <= ord(c) < 97 or 123 <= ord(c) < 127 for c in text) / size,
        text.count("!") / size, sum(hidden) / n, sum(odd) / n, math.log1p(len(words)),
    ]


def plain_score(model, features):
    """Every tree walked from its root, then the curve between its two neighbouring points."""
    raw = 0.0
    for tree, weight in zip(model.trees.trees, model.trees.treeWeights):
        node = tree._call_java("rootNode")
        while node.subtreeDepth():
            split = node.split()
            node = node.leftChild() if features[split.featureIndex()] <= split.threshold() else node.rightChild()
        raw += weight * node.prediction()
    margin = 1 / (1 + math.exp(-2 * raw))
    level = np.interp(margin, model.curve.boundaries.toArray(), model.curve.predictions.toArray())
    return min(1.0, max(0.0, 0.999 * level + 0.001 * margin))


def test_toxicity_equals_plain_features_trees_and_curve(spark, data):
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    sample = quality.labelled_sample(docs, labels, "toxic", ~quality.fold(), 600)
    model = toxicity.fit(sample, sample.count())
    texts = [
        "", "   ", "You ST*PID idiot!!! you", "1d1ot, 5tup1d. Sie sind", "ÄÖ café\x1fnaïve\u3000x", "a\tb\nc" * 50,
        "you " + "far " * 4 + "liar " + "far " * 9 + "liar", "!!!", "$$$ m0ron @you", "fool " * 500,
        *[row.text for row in docs.filter("text IS NOT NULL").orderBy("doc_id").limit(60).collect()],
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").withColumn("held_out", F.lit(True))
    found = {row.doc_id: row for row in frame.mapInArrow(toxicity._feature_rows(model.stems), toxicity._FEATURE_ROWS).collect()}
    scores = {row.doc_id: row.score for row in model.scores(frame).collect()}
    assert len(scores) == len(texts)
    for i, text in enumerate(texts):
        features = plain_features(text, model.stems)
        assert np.allclose([found[i][name] for name in toxicity.FEATURES], features, rtol=1e-12), text[:40]
        assert math.isclose(scores[i], plain_score(model, features), rel_tol=1e-9, abs_tol=1e-12)


def test_calibrating_rows_teach_neither_stems_nor_trees(spark):
    docs, labels = learnable(spark)
    sample = quality.labelled_sample(docs, labels, "toxic", ~quality.fold(), 600)
    aside = toxicity.calibrates(F.col("order"))
    other = F.when(aside, 1 - F.col("label")).otherwise(F.col("label"))
    first, second = (
        toxicity.fit(own, sample.count()) for own in (sample, sample.withColumn("label", other.cast("int")))
    )
    assert sample.filter(aside).count() > 20 and first.stems == second.stems
    assert first.trees.toDebugString.split("\n", 1)[1] == second.trees.toDebugString.split("\n", 1)[1]
    assert first.curve.predictions != second.curve.predictions


def test_held_out_labels_do_not_teach(spark):
    docs, labels = learnable(spark)
    turned = labels.withColumn("quality", F.when(quality.fold(), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, other = (
        sorted(map(tuple, quality.score(docs, own, "quality", quality.fold()).collect())) for own in (labels, turned)
    )
    assert first == other


def test_exact_vote():
    draw = np.random.default_rng(2)
    counts = draw.integers(0, 4, (60, quality.TERMS)).astype(np.float32)
    good = draw.integers(0, 2, 60).astype(float)
    model = quality.LatentVote.fit(counts.copy(), good, latent=8)
    asked = draw.integers(0, 4, (7, quality.TERMS)).astype(np.float32)
    latent = quality._unit(quality._weights(asked, model.rarity) @ model.axes)
    for row, score in zip(latent, model.vote(asked, 5, 4.0)):
        cosines = model.vectors @ row
        near = np.argsort(-cosines)[:5]
        weight = np.maximum(cosines[near], 1e-3) ** 4
        assert math.isclose(score, (weight * model.good[near]).sum() / weight.sum(), rel_tol=1e-4)
