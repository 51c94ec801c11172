"""Registered queries against their SQL; the pipeline against its stages by brute force."""

import corpus_pipeline
import oracle
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from coursepulse.llm import queries
from coursepulse.llm.text import overlap, shingles


def test_registered():
    found = entry.queries()
    assert {q.__name__ for q in queries.QUERIES} | {"pipeline"} <= set(found)
    assert len(queries.QUERIES) == 13
    assert set(queries.SQL) <= {q.__name__ for q in queries.QUERIES}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, sf_dir, name):
    rows = entry.queries()[name](spark, sf_dir)
    assert oracle.differences(rows, oracle.connect(sf_dir), queries.SQL[name]) is None


def test_stages_by_brute_force(spark, sf_dir):
    docs = queries.read(spark, sf_dir, "documents")
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()} \
            if "text" in docs.columns else before
        out = stage(spark, docs, sf_dir).persist()
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= set(before) and out.count() == len(ids)
        if name != "tokens":
            assert out.dtypes == docs.dtypes
        kept[name] = (before, ids)
        docs = out
    before, ids = kept["near_duplicates"]
    sets = {n: shingles(text) for n, text in before.items()}
    numbers = sorted(sets)

    def alike(a, b):
        shared = overlap(sets[a], sets[b])
        return len(sets[a]) and len(sets[b]) and shared >= 0.8 * (
            len(sets[a]) + len(sets[b]) - shared)

    label = {n: n for n in numbers}
    for at, a in enumerate(numbers):
        for b in numbers[at + 1:]:
            if alike(a, b):
                low, high = sorted((label[a], label[b]))
                label = {n: low if head == high else head for n, head in label.items()}
    assert ids == {n for n in numbers if label[n] == n}
    before, ids = kept["decontamination"]
    items = [shingles(r["text"]) for r in queries.read(spark, sf_dir, "benchmark").collect()]
    leaked = {n for n, text in before.items() for item in items
              if len(item) and overlap(item, shingles(text)) >= 0.8 * len(item)}
    assert ids == set(before) - leaked
    final = {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).select("doc_id").collect()}
    assert final == kept["tokens"][1] == ids


def test_pipeline_of_odd_rows(spark, sf_dir):
    docs = queries.read(spark, sf_dir, "documents").limit(60)
    odd = spark.createDataFrame(
        [(None, None), (10 ** 9, None), (10 ** 9 + 1, ""), (10 ** 9 + 2, "ein wort " * 40_000)],
        "doc_id long, text string")
    docs = docs.unionByName(odd, allowMissingColumns=True).unionByName(docs.limit(5)).withColumns(
        {"score": F.lit("mine"), "text_id": F.lit(None).cast("long"), "component": F.lit(1)})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "tokens":
            assert out.columns == docs.columns
            docs = out
    assert out.count() == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.filter(F.lit(False)), sf_dir).count() == 0
