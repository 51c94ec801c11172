"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coursepulse.llm import lexical, queries

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms(text):
    return [t.translate(UPPER) for t in re.findall(lexical.TERM, text or "")]


def ranking(documents, items, most=10):
    """(item, rank, doc_id, score) rows by scoring every document."""
    counts = [(number, Counter(terms(text))) for number, text in documents]
    with_terms = [c for _, c in counts if c]
    n, length = len(with_terms), sum(c.total() for c in with_terms)
    df = Counter(term for c in with_terms for term in c)
    asked = {}
    for item, text in set(items):
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, query in asked.items():
        scored = []
        for number, held in counts:
            if not held:
                continue
            m = 25 + (75 * held.total() * n) // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                * ((1_000_000_000 * held[term]) // (1000 * held[term] + 8 * m))
                for term, times in query.items() if held[term])
            if score > 0:
                scored.append((-score, number is None, number or 0, number))
        out += [(item, rank, number, -score)
                for rank, (score, _, _, number) in enumerate(sorted(scored)[:most], 1)]
    return out


def sort(rows):
    return sorted(rows, key=str)


def found(spark, documents, items, **options):
    docs = spark.createDataFrame(documents, "doc_id long, text string").withColumns(
        {"term": F.lit("x"), "shard": F.lit(3), "block": F.lit(1)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit("s"))
    return sort(tuple(r) for r in lexical.search(docs, asked, **options).collect())


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ1 .\n@[`{\x7fé😀 K", max_size=60), st.integers(1, 9))
def test_terms(text, size):
    before, lexical.SLICE = lexical.SLICE, size
    try:
        assert [t.decode() for part in lexical.terms(text) for t in part] == terms(text)
    finally:
        lexical.SLICE = before


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), min_size=1, unique=True).map(sorted), min_size=1, max_size=6),
       st.randoms())
def test_blocks(lists, pick):
    df = np.array([len(one) for one in lists])
    docs = np.concatenate([np.array(one) for one in lists])
    times = np.array([pick.choice([1, 2, 300, 70_000]) for _ in docs])
    lengths = np.array([pick.randint(1, 10 ** 6) for _ in range(301)])
    (table, data), first, offsets = lexical._pack(docs, times, lengths[docs], df)
    size, at = lexical._BLOCK_TYPE.itemsize, 0
    for number, one in enumerate(lists):
        held = lexical._List(3, table[first[number] * size : first[number + 1] * size],
                             data[offsets[number] : offsets[number + 1]], lengths, lambda n: n)
        blocks = [held.block(b) for b in range(len(held.blocks))]
        assert np.concatenate([b[0] for b in blocks]).tolist() == one
        want = [3 * (10 ** 9 * int(t) // (1000 * int(t) + 8 * int(lengths[d])))
                for d, t in zip(one, times[at : at + len(one)])]
        assert np.concatenate([b[1] for b in blocks]).tolist() == want
        assert all(b[1].max() <= bound for b, bound in zip(blocks, held.most))
        at += len(one)


def corpus(number, vocabulary, seed):
    pick = random.Random(seed)
    words = [f"w{n}" for n in range(vocabulary)]
    weights = [1 / (n + 1) for n in range(vocabulary)]
    return [(n, " ".join(pick.choices(words, weights, k=pick.choice([1, 5, 40, 120]))))
            for n in range(number)]


@pytest.mark.parametrize("block, window, shard", [(64, 256, 1 << 16), (4, 8, 150), (2, 3, 40)])
def test_same_as_scoring_everything(spark, monkeypatch, block, window, shard):
    monkeypatch.setattr(lexical, "BLOCK", block)
    documents = corpus(900, 400, 4)
    items = [(n, text) for n, text in corpus(25, 400, 9)]
    held = lexical._Shard()
    counts = [Counter(terms(text)) for _, text in documents]
    n, length = len(counts), sum(c.total() for c in counts)
    df = Counter(term for c in counts for term in c)
    for number, text in documents:
        held.add(number, text)
    header, lists = None, []
    for batch in held.rows(0):
        for row in batch.to_pylist():
            if row["term"] is None:
                header = row
            else:
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[row["term"]] + 1)))
                lists.append((row["term"], weight, row["blocks"], row["data"]))
    monkeypatch.setattr(lexical, "FIRST_WINDOW", window)
    searcher = lexical.Searcher(header["lengths"], lists, n, length)
    ids = header["ids"]
    got = [(item, rank, ids[doc], score) for item, text in items
           for rank, (doc, score) in enumerate(searcher.best(Counter(terms(text)), ids), 1)]
    assert sort(got) == sort(ranking(documents, items))


def test_blocks_stay_closed():
    """Rare terms decide; of a frequent one's blocks, few are opened."""
    documents = [(n, ("rare " if n % (20 if n < 600 else 400) == 3 else "") + "common" + " y" * (n % 90))
                 for n in range(6000)]
    held = lexical._Shard()
    for number, text in documents:
        held.add(number, text)
    rows = [row for batch in held.rows(0) for row in batch.to_pylist()]
    lists = [(r["term"], {"rare": 9000, "common": 3}.get(r["term"], 0), r["blocks"], r["data"])
             for r in rows if r["term"]]
    searcher = lexical.Searcher(rows[0]["lengths"], lists, 6000, sum(rows[0]["lengths"]))
    searcher.best({"rare": 1, "common": 1}, rows[0]["ids"])
    common = searcher.lists["common"]
    assert len(common.read) < len(common.blocks) / 4


def test_shards_and_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)
    documents = corpus(400, 200, 2)
    items = corpus(12, 200, 3)
    assert found(spark, documents, items) == sort(ranking(documents, items))


ODD = [(None, None), (1, ""), (1, "..."), (2, "Straße ÉCOLE K"), (2, "straße ÉCOLE"), (3, "a " * 300_000),
       (None, "A b c"), (4, "a b c"), (4, "a b c"), (-5, "a b c"), (6, "z" * 100_000)]


def test_odd_rows(spark):
    items = [(1, "a b"), (1, "a b"), (1, "c"), (None, "STRASSE straße"), (2, None), (3, ""), (4, "école ÉCOLE K"),
             (5, "z" * 100_000), (6, "nowhere")]
    assert found(spark, ODD, items) == sort(ranking(ODD, items))
    assert found(spark, ODD, items, most=2) == sort(ranking(ODD, items, 2))
    assert found(spark, [(1, None)], items) == []
    assert found(spark, [], items) == [] and found(spark, ODD, []) == []


def test_query_by_brute_force(spark, sf_dir):
    documents = queries.read(spark, sf_dir, "documents")
    items = queries.read(spark, sf_dir, "benchmark")
    rows = lexical.search(documents, items)
    assert rows.columns == ["item_id", "rank", "doc_id", "score"]
    assert sort(tuple(r) for r in rows.collect()) == sort(ranking(
        [tuple(r) for r in documents.select("doc_id", "text").collect()],
        [tuple(r) for r in items.select("item_id", "text").collect()]))
