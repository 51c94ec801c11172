import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coursepulse.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary.parse(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=vocabulary.ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(text=st.text(max_size=60) | st.text("ab é漢🙂'\n\t1s", max_size=200))
def test_same_ids_as_the_library(vocabulary, reference, text):
    ids = vocabulary.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert vocabulary.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "a" * 50_000, "ab" * 20_000, "\n" * 3000, "x"])
def test_long_and_plain_pieces(vocabulary, reference, text):
    assert vocabulary.encode(text) == reference.encode_ordinary(text)


@settings(max_examples=30, deadline=None)
@given(texts=st.lists(st.text("abcé漢 🙂", max_size=90), min_size=1, max_size=40))
def test_pieces_merge_side_by_side_as_alone(vocabulary, reference, texts):
    pieces = [text.encode() for text in texts if text]
    assert vocabulary.merge_all(pieces) == [vocabulary.merge(piece) for piece in pieces]
    vocabulary.memory.clear()
    assert list(vocabulary.encode_all(texts)) == [reference.encode_ordinary(t) for t in texts]


def test_equal_ranks_merge_from_the_left():
    ranks = {bytes([b]): b for b in range(256)} | {b"aa": 256, b"aaa": 257}
    assert bpe.Vocabulary(ranks, r".+").merge(b"aaaaa") == [256, 257]


def test_memory_is_bounded(vocabulary):
    small = bpe.Vocabulary(vocabulary.ranks, public_tokenizers.PATTERN)
    small.MOST_PIECES = 10
    for n in range(200):  # beyond the bound only what one run of texts holds is remembered
        assert small.encode(f"w{n} x{n}") == vocabulary.encode(f"w{n} x{n}")
        assert len(small.memory) <= 10


def test_unknown_id_is_an_error(vocabulary):
    with pytest.raises(KeyError):
        vocabulary.decode([10 ** 6])


def test_parse_skips_empty_lines():
    lines = base64.b64encode(b"a") + b" 0\n\n" + base64.b64encode(b"b") + b" 1\n"
    assert bpe.Vocabulary.parse(lines, ".").ranks == {b"a": 0, b"b": 1}


def test_columns_round_trip(spark, reference):
    rows = spark.createDataFrame([(1, "Añb c"), (2, None), (3, "")], "doc_id long, text string")
    ids = rows.withColumn("ids", bpe.encode("text", PATH, public_tokenizers.PATTERN))
    found = {r["doc_id"]: r for r in ids.withColumn(
        "back", bpe.decode("ids", PATH, public_tokenizers.PATTERN)).collect()}
    assert found[1]["ids"] == reference.encode_ordinary("Añb c")
    assert bytes(found[1]["back"]).decode() == "Añb c"
    assert found[2]["ids"] == [] and bytes(found[3]["back"]) == b""


def test_digests_of_odd_rows(spark, reference):
    rows = spark.createDataFrame(
        [(1, "hello there", "x"), (1, "hello there", "y"), (None, "a", "z"), (2, None, None)],
        "doc_id long, text string, n_tokens string")
    found = bpe.round_trip_digests(rows, PATH, public_tokenizers.PATTERN).collect()
    assert len(found) == 4
    ids = reference.encode_ordinary("hello there")
    first = next(r for r in found if r["doc_id"] == 1)
    assert first["n_tokens"] == len(ids)
    assert first["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    empty = next(r for r in found if r["doc_id"] == 2)
    assert empty["n_tokens"] == 0
    assert empty["ids_sha256"] == empty["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert bpe.round_trip_digests(
        rows.filter(F.lit(False)), PATH, public_tokenizers.PATTERN).collect() == []
