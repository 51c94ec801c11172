import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coursepulse.llm import decontaminate, forest, graph, minhash_dedup
from coursepulse.llm.text import overlap, runs_of, shingles, words

RNG = random.Random(4)
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def _text(n, rng=RNG):
    return " ".join(rng.choices(VOCABULARY, k=n))


def _changed(text, times, rng=RNG):
    found = text.split()
    for _ in range(times):
        found[rng.randrange(len(found))] = rng.choice(VOCABULARY)
    return " ".join(found)


def _jaccard(a, b):
    shared = overlap(a, b)
    return shared / max(1, len(a) + len(b) - shared)


def _components(pairs, numbers):
    label = {n: n for n in numbers}
    moved = True
    while moved:
        moved = False
        for a, b in pairs:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                moved = True
    return label


# --- helpers --------------------------------------------------------------------------------


def test_words_and_shingles():
    assert words("The CAT_sat, on-2 Äpfel!") == ["the", "cat", "sat", "on", "2", "äpfel"]
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a b")) == 1
    assert len(shingles("a a a a a a a")) == 1 and len(shingles("?!")) == 0 == len(shingles(None))
    assert not overlap(shingles("a b c"), shingles("a b c d"))
    assert [len(run) for run in runs_of(["ab", None, "c" * 9, "d"], 5)] == [2, 1, 1]


def test_components_of_links(spark):
    rng = random.Random(8)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)]
    pairs += [(200 + i, 201 + i) for i in range(40)] + [(300, i) for i in range(301, 340)]
    links = spark.createDataFrame(pairs + [(5, 5), (None, 3), (1, None)] + pairs[:9],
                                  "a long, b long")
    found = {r["id"]: r["component"] for r in graph.components(links).collect()}
    linked = {n for a, b in pairs for n in (a, b) if a != b}
    label = _components(pairs, linked | {n for pair in pairs for n in pair})
    assert found == {n: label[n] for n in linked}
    assert graph.components(links.filter(F.lit(False))).collect() == []


# --- signatures -----------------------------------------------------------------------------


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    shared = rng.integers(1, 2 ** 63, 80).astype(np.uint64)
    own = rng.integers(1, 2 ** 63, 40).astype(np.uint64)
    a, b = shared, np.concatenate([shared[:60], own])
    weight_a, weight_b = rng.gamma(2, 2, 80), np.concatenate([rng.gamma(2, 2, 60), rng.random(40)])
    signatures = minhash_dedup.dart_signatures([a, b], [weight_a, weight_b], 4000)
    both = np.minimum(weight_a[:60], weight_b[:60]).sum()
    truth = both / (weight_a.sum() + weight_b.sum() - both)
    assert abs((signatures[0] == signatures[1]).mean() - truth) < 4 * np.sqrt(truth / 4000)


def test_signatures_do_not_depend_on_company_or_order():
    sets = [shingles(_text(n)) for n in (1, 6, 40, 3000)]
    many = minhash_dedup.dart_signatures(sets)
    for one, row in zip(sets, many):
        assert (minhash_dedup.dart_signatures([one[::-1]])[0] == row).all()
    assert not minhash_dedup.dart_signatures([np.empty(0, np.uint64)]).any()
    zero = minhash_dedup.dart_signatures([sets[1]], [np.zeros(len(sets[1]))])
    assert not zero.any()


def test_weights_scale_alike():
    one = shingles(_text(30))
    weight = np.full(len(one), 0.25)
    a, b = minhash_dedup.dart_signatures([one, one], [weight, weight])
    assert (a == b).all()


# --- near duplicates ------------------------------------------------------------------------


def _collection():
    rng = random.Random(6)
    rows = []
    for group in range(12):
        base = _text(rng.randint(30, 200), rng)
        rows += [base] + [_changed(base, rng.randint(0, 5), rng) for _ in range(8)]
    hot = _text(150, rng)
    rows += [hot] * 60 + [_changed(hot, rng.randint(1, 3), rng) for _ in range(60)]
    rows += [_text(rng.randint(1, 60), rng) for _ in range(60)]
    rows += [rows[0].upper(), "  " + rows[1].replace(" ", ", "), "", "?!", "one two", "one two"]
    return list(enumerate(rows))


def _brute_classes(rows):
    sets = {n: shingles(text) for n, text in rows}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2)
             if len(sets[a]) and len(sets[b]) and _jaccard(sets[a], sets[b]) >= 0.8]
    return _components(pairs, list(sets))


def test_classes_match_brute_force(spark):
    rows = _collection()
    given = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit(1))
    found = minhash_dedup.NearDuplicates(given.repartition(5))
    got = {r["doc_id"]: r for r in found.classes().collect()}
    want = _brute_classes(rows)
    assert {n: r["class_id"] for n, r in got.items()} == want
    assert all(r["kept"] == (n == want[n]) for n, r in got.items())
    sets = {n: shingles(text) for n, text in rows}
    for link in found.links.collect():
        exact = _jaccard(sets[link["a"]], sets[link["b"]])
        assert link["a"] < link["b"] and exact == link["similarity"] >= 0.8


def test_star_around_an_original_is_one_class(spark):
    """Copies that are like their original but not like each other."""
    rng = random.Random(9)
    base = _text(200, rng)
    rows = [(500, base)] + [(n, _changed(base, 4, rng)) for n in range(120)]
    got = minhash_dedup.NearDuplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).classes()
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == _brute_classes(rows)


def test_copies_of_copies_at_the_threshold(spark):
    """Texts like one member of a large group, and just not like its others."""
    rng = random.Random(21)
    base = _text(600, rng)
    rows = [(1000 + n, _changed(base, 1, rng)) for n in range(60)]
    sets = [shingles(text) for _, text in rows] + [shingles(base)]
    while len(rows) < 120:
        member = _changed(base, 3, rng)
        found = member.split()
        at = rng.randrange(40)
        found[at : at + 1] = rng.choices(VOCABULARY, k=rng.randint(110, 145))
        copy = " ".join(found)
        if _jaccard(shingles(member), shingles(copy)) >= 0.8 and all(
                _jaccard(shingles(copy), one) < 0.8 for one in sets):
            rows += [(len(rows), copy), (2000 + len(rows), member)]
    got = minhash_dedup.NearDuplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).classes()
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == _brute_classes(rows)


def test_texts_around_a_passage_are_not_compared_with_each_other(spark):
    """Mutual similarity just below the threshold: what is compared grows with their number."""
    rng = random.Random(31)
    passage = rng.choices(VOCABULARY, k=500)
    compared = {}
    for size in (75, 150, 300):
        texts = [" ".join([*rng.choices(VOCABULARY, k=43), *passage, *rng.choices(VOCABULARY, k=40)])
                 for _ in range(size)]
        assert 0.7 < _jaccard(shingles(texts[0]), shingles(texts[1])) < 0.8
        rows = list(enumerate(texts)) + [(1000 + n, _changed(texts[n], 1, rng)) for n in range(5)]
        found = minhash_dedup.NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert {r["doc_id"]: r["class_id"] for r in found.classes().collect()} == _brute_classes(rows)
        compared[size] = found._tried.count()
    assert compared[300] < 6 * compared[75] and compared[300] < 300 * 299 / 2 / 5


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.95])
def test_similar_sets_meet_among_their_first(similarity):
    """Every pair of sets that is similar enough shares one of the looked-at elements, in any order."""
    rng = random.Random(2)
    for _ in range(3000):
        shared, own, other = rng.randint(1, 60), rng.randint(0, 20), rng.randint(0, 20)
        order = rng.sample(range(1000), shared + own + other)
        a, b = sorted(order[: shared + own]), sorted(order[:shared] + order[shared + own:])
        if shared >= similarity * len(order):
            first_a, first_b = (one[: minhash_dedup.looked_at(len(one), similarity)] for one in (a, b))
            met = min(set(first_a) & set(first_b))
            left = min(len(a) - a.index(met), len(b) - b.index(met))
            assert left * (1 + similarity) >= similarity * (len(a) + len(b)) - 1e-6


@pytest.mark.parametrize("most", [1_000_000, 3, 0])
def test_any_number_of_frequent_shingles(spark, monkeypatch, most):
    monkeypatch.setattr(minhash_dedup, "MOST_FREQUENT", most)
    monkeypatch.setattr(minhash_dedup, "LEADERS", 1)
    monkeypatch.setattr(minhash_dedup, "KEY_LEADERS", (1,))
    rows = _collection()
    got = minhash_dedup.NearDuplicates(
        spark.createDataFrame(rows, "doc_id long, text string")).classes()
    assert {r["doc_id"]: r["class_id"] for r in got.collect()} == _brute_classes(rows)


def test_an_id_with_several_texts(spark):
    """The text of the smallest digest counts, however the rows are dealt, and repeated rows are one."""
    rng = random.Random(4)
    texts = [_text(80, rng) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (1, None), (1, texts[0]), *[(7, texts[2])] * 30, (7, "?!"),
            (2, _changed(texts[0], 1, rng)), (3, _changed(texts[1], 1, rng)), (4, texts[0]),
            (5, texts[1]), (6, _changed(texts[2], 1, rng))]
    digests = {t: minhash_dedup.xxh3_128_intdigest(shingles(t).tobytes()) for t in texts[:2]}
    least = min(digests, key=lambda t: (minhash_dedup._signed(digests[t] >> 64),
                                        minhash_dedup._signed(digests[t] & (2 ** 64 - 1))))
    single = [row for row in rows if row[0] not in (1, 7)] + [(1, least), (7, texts[2])]
    want = _brute_classes(single)
    for parts in (1, 7):
        given = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        got = {r["doc_id"]: r["class_id"] for r in minhash_dedup.NearDuplicates(given).classes().collect()}
        assert got == want


def test_stage_keeps_one_of_each_class(spark):
    rows = _collection()
    extra = [(0, rows[0][1], "again"), (None, rows[0][1], "no id"), (None, None, None),
             (9000, None, "null"), (9000, None, "null")]
    given = spark.createDataFrame([(n, text, "x") for n, text in rows] + extra,
                                  "doc_id long, text string, bucket string")
    kept = minhash_dedup.drop_near_duplicates(given)
    assert kept.columns == given.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda n: (n is None, n))
    want = {n for n, head in _brute_classes(rows).items() if n == head}
    assert ids == sorted(want | {9000}) + [None, None]
    none = given.filter(F.lit(False))
    assert minhash_dedup.drop_near_duplicates(none).collect() == []
    assert minhash_dedup.NearDuplicates(none).classes().collect() == []


# --- test items in documents ----------------------------------------------------------------


def _benchmark():
    rng = random.Random(12)
    items = [(n, _text(rng.choice((5, 6, 9, 30, 60)), rng)) for n in range(40)]
    items += [(100, "two words"), (101, None), (102, "?!"), (0, items[0][1])]
    docs = []
    for n in range(150):
        item = items[rng.randrange(40)][1]
        size = rng.choice((0, 20, 300, 6000))
        parts = [_text(size, rng), _changed(item, rng.randint(0, 4), rng), _text(size // 2, rng)]
        docs.append((n, " ".join(parts) if n % 2 else _text(size + 5, rng)))
    items += [(103, _text(6, rng)), (104, _text(4, rng)), (105, "two")]
    docs += [(800, _text(40, rng) + " two WORDS " + _text(900, rng)), (801, "words two"),
             (802, _text(9, rng) + " " + items[-2][1] + " " + _text(9, rng))]
    return items, docs + [(900, "Two, words."), (901, None), (902, ""), (None, items[3][1]),
                          (1, docs[1][1])]


def _brute_leaks(items, docs):
    found = set()
    for (d, text), (i, item) in itertools.product(docs, items):
        held = len(words(item))
        a = shingles(item)
        b = shingles(text, min(5, held)) if held else shingles(text)
        if d is not None and len(a) and overlap(a, b) >= 0.8 * len(a):
            found.add((d, i, overlap(a, b), len(a)))
    return found


@pytest.mark.parametrize("carried", [decontaminate.MOST_CARRIED, 300])
def test_contamination_matches_brute_force(spark, monkeypatch, carried):
    monkeypatch.setattr(decontaminate, "MOST_CARRIED", carried)  # the second: several blocks
    items, docs = _benchmark()
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(3))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    rows = decontaminate.contaminated(given, bench).collect()
    assert {tuple(r)[:4] for r in rows} == _brute_leaks(items, docs) and rows
    assert len(rows) == len({tuple(r)[:2] for r in rows})
    kept = decontaminate.drop_contaminated(given, bench)
    bad = {d for d, *_ in _brute_leaks(items, docs)}
    assert kept.columns == given.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted(
        d for d, _ in docs if d is not None and d not in bad)
    assert kept.filter("doc_id is null").count() == 1


def test_contamination_of_empty_tables(spark):
    items, docs = _benchmark()
    given = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    none = F.lit(False)
    assert decontaminate.contaminated(given.filter(none), bench).collect() == []
    assert decontaminate.contaminated(given, bench.filter(none)).collect() == []
    assert decontaminate.drop_contaminated(given, bench.filter(none)).count() == len(docs)


# --- embeddings -----------------------------------------------------------------------------


def _vectors():
    rng = np.random.default_rng(3)
    rows = [rng.normal(size=16) for _ in range(300)]
    for at in range(40):
        rows += [rows[at] + rng.normal(size=16) * rng.uniform(0.05, 0.4) for _ in range(4)]
    rows += [rows[0]] * 30 + [rows[1] * 1e-30, rows[1] * 1e30]
    return [(n + 10, [float(np.float32(x)) for x in row], "x") for n, row in enumerate(rows)]


def _brute_links(rows):
    unit = np.stack([np.array(v) / np.abs(v).max() for _, v, _ in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cosine = unit @ unit.T
    ids = [n for n, _, _ in rows]
    pairs = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(cosine >= 0.9)) if a < b]
    return pairs, _components(pairs, ids)


@pytest.mark.parametrize("leaf", [forest.LEAF, 64])
def test_links_match_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(forest, "LEAF", leaf)
    rows = _vectors()
    odd = [(1, None, "n"), (2, [0.0] * 16, "z"), (3, [float("nan")] + [1.0] * 15, "nan"),
           (4, [float("inf")] + [1.0] * 15, "inf"), (5, [], "e"), (6, [None] + [1.0] * 15, "null"),
           (7, [1.0, 2.0], "short"), (8, [2.0, 4.0], "short"), (None, rows[0][1], "no id"),
           (10, rows[0][1], "again")]
    given = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, node string")
    found = {r["vec_id"]: tuple(r)[1:] for r in forest.EmbeddingLinks(given).result().collect()}
    pairs, label = _brute_links(rows)
    degree = {n: 0 for n, _, _ in rows}
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    assert set(found) == set(degree) | set(range(1, 9))
    assert found[7] == (1, 7, True) and found[8] == (1, 7, False)
    assert all(found[n] == (0, n, True) for n in range(1, 7))
    got, want = sum(found[n][0] for n in degree), sum(degree.values())
    assert all(found[n][0] <= degree[n] for n in degree)  # no link below the threshold
    assert got >= 0.99 * want
    if leaf == forest.LEAF:
        assert all(found[n] == (degree[n], label[n], n == label[n]) for n in degree)


def test_one_direction_is_one_vector(spark, monkeypatch):
    """Many vectors that differ in length alone: one row in the trees, all links counted."""
    monkeypatch.setattr(forest, "LEAF", 32)
    rng = np.random.default_rng(8)
    base = [float(np.float32(x)) for x in rng.normal(size=8)]
    rows = [(n, [x * 2.0 ** (n % 40 - 20) for x in base], "") for n in range(300)]
    rows += [(1000, [-x for x in base], ""), (1001, [0.0, -0.0, 3.0] + [0.0] * 5, ""),
             (1002, [0.0, 0.0, 7.0] + [-0.0] * 5, "")]
    links = forest.EmbeddingLinks(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string"))
    assert links.heads.count() == 3
    found = {r["vec_id"]: tuple(r)[1:] for r in links.result().collect()}
    assert all(found[n] == (299, 0, n == 0) for n in range(300))
    assert found[1000] == (0, 1000, True)
    assert found[1001] == (1, 1001, True) and found[1002] == (1, 1001, False)


def test_recall_in_deep_trees(spark, monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 64)
    monkeypatch.setattr(forest, "SAMPLE", 256)  # several rounds of splits
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 32))
    near = base[:500] + rng.normal(size=(500, 32)) * 0.35
    rows = [(n, [float(np.float32(x)) for x in row], "") for n, row in
            enumerate(np.vstack([base, near]))]
    pairs, _ = _brute_links(rows)
    found = forest.EmbeddingLinks(spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, label string")).result()
    got = found.agg(F.sum("n_links")).first()[0] // 2
    assert len(pairs) > 200 and 0.9 * len(pairs) <= got <= len(pairs)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert forest.EmbeddingLinks(none).result().collect() == []
    nulls = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in forest.EmbeddingLinks(nulls).result().collect()] == [(1, 0, 1, True)]
