import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from coursepulse.llm import langid, quality, queries, toxicity
from coursepulse.llm.fitting import labelled_sample

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int, toxic int"


def _prose(rng, words=40):
    return " ".join("".join(rng.choice("abdeilmnorst") for _ in range(rng.randint(2, 7)))
                    for _ in range(words))


def _toxic_texts(n=600):
    """Toxic is an insult together with a group, neither of them alone."""
    rng, rows = random.Random(3), []
    for at in range(n):
        insult, group = at % 2, at // 2 % 2
        text = _prose(rng) + " grumblers" * insult + " " + _prose(rng) + " martians" * group
        rows.append((text, insult * group))
    return rows


def test_machine_learns_pairs():
    rows = _toxic_texts()
    terms = [toxicity.document_terms(text) for text, _ in rows]
    labels = np.array([label for _, label in rows])
    machine = toxicity.fit_machine(terms[:400], labels[:400])
    score = toxicity.Scorer(machine)
    wrong = [text for text, label in rows[400:] if (score(text) >= 0.7) != bool(label)]
    assert not wrong


def test_machine_learns_terms_that_say_something_only_together():
    """Toxic is exactly one of two words: alone, neither says anything."""
    rng, rows = random.Random(13), []
    for at in range(900):
        first, second = at % 2, at // 2 % 2
        rows.append((_prose(rng) + " grumblers" * first + " " + _prose(rng) + " martians" * second,
                     first ^ second))
    terms = [toxicity.document_terms(text) for text, _ in rows]
    labels = np.array([label for _, label in rows])
    machine = toxicity.fit_machine(terms[:600], labels[:600])
    score = toxicity.Scorer(machine)
    right = [(score(text) >= 0.5) == bool(label) for text, label in rows[600:]]
    assert np.mean(right) > 0.97


def test_a_frequent_word_beside_a_toxic_one_is_no_pair():
    rng = np.random.default_rng(2)
    held = rng.random((3000, 40)) < np.linspace(0.05, 0.9, 40)
    labels = held[:, 5].astype(int)
    documents = [np.flatnonzero(row).astype(np.uint32) for row in held]
    assert not toxicity._paired(documents, labels, np.arange(40, dtype=np.uint32), 40.0).any()
    labels = held[:, 5] ^ held[:, 20]
    found = toxicity._paired(documents, labels.astype(int), np.arange(40, dtype=np.uint32), 40.0)
    assert np.flatnonzero(found).tolist() == [5, 20]


def test_machine_pair_sum_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = toxicity.Machine(0.3, np.arange(5, dtype=np.uint32), rng.normal(size=5),
                               rng.normal(size=(5, 3)))
    slots = np.array([0, 2, 3])
    raw = 0.3 + machine.weights[slots].sum() + sum(
        machine.factors[a] @ machine.factors[b] for a in slots for b in slots if a < b)
    assert np.isclose(machine.score(slots), 1 / (1 + np.exp(-raw)))


def test_scores_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(_toxic_texts(200))] + [(900, None), (901, "")],
        DOCS)
    labels = spark.createDataFrame(
        [(i, 1 - i % 2, label) for i, (_, label) in enumerate(_toxic_texts(200))]
        + [(5, None, None), (None, 1, 1), (6, 1, 0)], LABELS)
    for fitted in (toxicity.toxicity_score(toxicity.fit_toxicity(docs, labels), "text"),
                   quality.quality_score(quality.fit_quality(docs, labels), "text")):
        rows = docs.select("doc_id", fitted.alias("score")).collect()
        assert len(rows) == 202
        assert all(0 <= r["score"] <= 1 for r in rows)
    again = [r["s"] for r in docs.select(toxicity.toxicity_score(
        toxicity.fit_toxicity(docs.repartition(7), labels.repartition(3)), "text").alias("s"))
        .collect()]
    first = [r["s"] for r in docs.select(toxicity.toxicity_score(
        toxicity.fit_toxicity(docs, labels), "text").alias("s")).collect()]
    assert again == first


def test_without_labels_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "some text", "a"), (1, "some text", "a"), (None, None, "b")],
                                 DOCS + ", score string")
    labels = spark.createDataFrame([], LABELS)
    assert toxicity.reject_toxic(docs, labels).collect() == docs.collect()
    assert quality.reject_low_quality(docs, labels).collect() == docs.collect()
    none = docs.filter(F.lit(False))
    assert toxicity.reject_toxic(none, labels).collect() == []
    assert quality.reject_low_quality(none, labels).columns == docs.columns


def test_one_class_only(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)
    assert toxicity.reject_toxic(docs, labels).count() == 20
    assert quality.reject_low_quality(docs, labels).count() == 20


def test_sample_is_bounded_and_leaves_the_test_fold_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)], DOCS)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(300)], LABELS)
    rows = labelled_sample(docs, labels, "toxic", 3, 1, 50).collect()
    assert len(rows) == 50
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 for r in rows)
    assert rows and {r["label"] for r in rows} == {0, 1}


def test_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(0, "a")] * 40 + [(0, "b")] * 40 + [(2, None), (2, "c"), (3, "d")], DOCS)
    labels = spark.createDataFrame([(i, 1, 1) for i in (0, 0, 2, 3, 5)], LABELS)
    first = sorted(tuple(r) for r in labelled_sample(docs, labels, "toxic", 3, 7, 50).collect())
    again = sorted(tuple(r) for r in labelled_sample(docs.repartition(9), labels, "toxic", 3, 7, 50).collect())
    assert [r[0] for r in first] == [0, 2, 3] and first == again


def test_repeats_count_every_run():
    texts = ["abcdefghijklm", "short", "a line of text, a line of text,", "x" * 300, "", "ab " * 9]
    repeated = quality.CLASSES + quality.CLASSES ** 2
    features, owner = quality.encode(texts)
    for number, text in enumerate(texts):
        runs = [text[at : at + quality.REPEAT_RUN]
                for at in range(len(text) - quality.REPEAT_RUN + 1)]
        again = sum(run in runs[:at] for at, run in enumerate(runs))
        row = features[owner == number][0]
        assert row[repeated] == again / max(1, len(runs))
        assert row[repeated + 1] == bool(runs)


def test_quality_attends_to_one_bad_passage():
    rng, texts, labels = random.Random(5), [], []
    for at in range(240):
        parts = [_prose(rng, 80) for _ in range(6)]
        if at % 2:
            parts[rng.randrange(6)] = " ".join("%%%&&&$$$" for _ in range(50))
        texts.append("\n".join(parts))
        labels.append(1 - at % 2)
    net = quality.fit_attention(texts[:160], np.array(labels[:160]))
    scores = net.score(texts[160:])
    assert ((scores >= 0.5) == np.array(labels[160:], bool)).mean() > 0.95


def test_passages_cover_whole_texts():
    texts = ["", "a" * 10, "Ab1 \n.x" * 300, "é" * 1260]
    features, owner = quality.encode(texts)
    assert np.bincount(owner).tolist() == [1, 1, 4, 3]
    assert np.allclose((features[1:, :quality.CLASSES] ** 2).sum(1), 1)
    assert features[0].max() <= 0.1
    for at, text in enumerate(texts):  # alone or among others, a text is encoded alike
        assert np.allclose(quality.encode([text])[0], features[owner == at])


def test_repeats_are_seen():
    rng = random.Random(2)
    plain, loop = _prose(rng, 400), _prose(rng, 20) * 20
    repeated = quality.CLASSES + quality.CLASSES ** 2
    features, owner = quality.encode([plain, loop])
    assert features[owner == 0, repeated].max() < 0.1 < 0.9 < features[owner == 1, repeated][2:].min()


def test_held_out_accuracy(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.1")
    labels = queries.read(spark, folder, "labels")
    for query, label, least in ((queries.op2_toxicity, "toxic", 0.97),
                                (queries.op6_quality, "quality", 0.97)):
        rows = query(spark, folder).join(labels, "doc_id").filter("held_out").select(
            "predicted", F.col(label).alias("label")).toPandas()
        assert (rows["predicted"] == rows["label"]).mean() > least
    rows = queries.op7_language(spark, folder).join(
        queries.read(spark, folder, "documents").select("doc_id", "lang"), "doc_id").filter(
        "held_out").toPandas()
    assert (rows["lang_pred"] == rows["lang"]).mean() > 0.97


def _languages(spark):
    texts = {"xx": "kala mana tapa sala pata", "yy": "grzyb strzmk wrzdł pstrg krzw"}
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(texts[lang].split(), k=12)), lang)
            for i, lang in enumerate(["xx", "yy"] * 60)]
    return spark.createDataFrame(rows + [(500, None, "xx"), (501, "kala", None), (None, "x", "xx")],
                                 DOCS + ", lang string")


def test_languages_and_mixtures(spark):
    known = langid.fit_languages(_languages(spark))
    assert known.names == ["xx", "yy"]
    assert np.allclose(known.chances.sum(1), 1)
    mixed = "kala mana tapa sala " * 6 + "grzyb strzmk wrzdł " * 2
    names, scores = known.predict([mixed, "kala mana", "GRZYB strzmk", "", "12 3!", "q"])
    assert names[:5] == ["xx", "xx", "yy", "und", "und"]
    assert 0.55 < scores[0] < 0.95 and scores[1] == 1.0 and scores[3] == 0
    counts, _ = langid.trigram_counts([mixed])
    full, _ = known.proportions(counts.astype(float), np.full((1, 2), 0.5))
    assert abs(full[0, 0] - scores[0]) < 0.02


def test_mixture_is_the_likeliest(spark):
    known = langid.fit_languages(_languages(spark))
    counts, _ = langid.trigram_counts(["kala mana grzyb tapa strzmk sala"])
    grid = np.linspace(0.01, 0.99, 99)
    fits = [(counts * np.log(np.array([[p, 1 - p]]) @ known.chances)).sum() for p in grid]
    found = np.full((1, 2), 0.5)
    for _ in range(6):
        found, fit = known.proportions(counts.astype(float), found)
    assert abs(found[0, 0] - grid[int(np.argmax(fits))]) < 0.02
    assert fit[0] >= max(fits) - 1e-3


def test_language_of_odd_rows(spark):
    docs = _languages(spark)
    found = docs.select("doc_id", langid.language(langid.fit_languages(docs), "text").alias("f"))
    rows = {r["doc_id"]: r["f"] for r in found.collect()}
    assert len(rows) == 123
    assert rows[500]["lang"] == "und" and rows[500]["score"] == 0
    assert rows[501]["lang"] == "xx"
    nothing = langid.fit_languages(docs.filter(F.lit(False)))
    assert nothing.predict(["kala"])[0] == ["und"]
    assert docs.filter(F.lit(False)).select(langid.language(nothing, "text")).collect() == []


def test_six_languages_in_equal_parts(spark):
    """No bound on the number of languages of a document."""
    rng = random.Random(17)
    letters = ["abcde", "fghij", "klmno", "pqrst", "uvwxy", "äöüßz", "éèàçâ"]

    def text(letters, words):
        return " ".join("".join(rng.choices(letters, k=rng.randint(3, 8))) for _ in range(words))
    rows = [(8 * n + at, text(held, 60), f"l{at}") for n in range(30) for at, held in enumerate(letters)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = langid.fit_languages(docs, test_fold=9)
    names, scores = known.predict([" ".join(text(held, 80) for held in letters[:6]), text(letters[6], 80)])
    assert names[1] == "l6" and scores[1] > 0.98
    assert abs(scores[0] - 1 / 6) < 0.03


def test_proportions_stand_still():
    rng = np.random.default_rng(4)
    chances = rng.dirichlet(np.full(300, 0.2), 5)
    truth = np.array([0.5, 0.3, 0.2, 0, 0])
    counts = rng.multinomial(20_000, truth @ chances, 3).astype(float)
    known = langid.Languages(list("abcde"), chances)
    found, _ = known.proportions(counts, np.full((3, 5), 0.2))
    assert np.abs(found - truth).max() < 0.03
    alone, _ = known.proportions(counts[:1], np.full((1, 5), 0.2))
    assert np.allclose(alone[0], found[0])
