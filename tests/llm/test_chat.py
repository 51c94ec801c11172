import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coursepulse.llm import chat
from coursepulse.llm.chat import Audio, Document, Image, Reader, Text, Writer, read_parts

TEXTS = st.text(max_size=40) | st.lists(st.sampled_from(
    ["\\", "### ", "Assistant", ": ", " </turn>", "</turn>\n", "<image:0>", "#", "<", "\n", "ok", ":"]
), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "User", "a: b"])
                                | TEXTS, TEXTS), max_size=5), cut=st.integers(1, 7))
def test_whatever_is_written_is_read_back(turns, cut):
    writer, reader, found = Writer(), Reader(), []
    written = [writer.turn(role, [Text(text)]) for role, text in turns]
    whole = "".join(turn.formatted for turn in written)
    for at in range(0, len(whole), cut):  # pieces end anywhere
        found += reader.feed(whole[at : at + cut])
    assert reader.rest == "" and len(whole) == writer.length
    assert [(role, chat.unescape(body)) for role, body, _, _ in found] == turns
    for (role, text), turn in zip(turns, written):
        masked = whole[turn.loss[0] : turn.loss[1]]
        assert chat.unescape(masked) == (text if role == "assistant" else "")


def test_parts_become_placeholders_in_order():
    parts = [Text("see <image:9> "), Image("s3://a.png", 56, 29), Text("\\"), Audio("b.wav", 1.01),
             Document("c.pdf", 3), Text("end")]
    writer = Writer()
    first = writer.turn("user", parts)
    assert first.formatted == ("### User: see \\<image:9> <image:0>\\\\<audio:1><document:2>end"
                               " </turn>\n")
    assert [(a["number"], a["kind"], a["ref"], a["tokens"]) for a in first.attachments] == [
        (0, "image", "s3://a.png", 4), (1, "audio", "b.wav", 26), (2, "document", "c.pdf", 768)]
    second = writer.turn("assistant", [Image("d.png")])
    assert second.formatted == "### Assistant: <image:3> </turn>\n"
    assert second.start == len(first.formatted)
    (_, body, _, _), = Reader().feed(first.formatted)
    assert read_parts(body, {0: parts[1], 1: parts[3], 2: parts[4]}) == parts


def _brute(rows):
    text = "".join(f"{role}\n{said}\n" for role, said in rows)
    loss = "".join(said for role, said in rows if role == "assistant")
    return (len(rows), hashlib.sha256(text.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def test_digests_of_odd_rows(spark):
    rows = [(1, 1, "assistant", "b <x>"), (1, 0, "user", "a"), (1, 2, "assistant", None),
            (2, 5, "user", "z"), (2, 5, "assistant", "y"), (2, None, None, "n"),
            (None, 0, "user", "lost"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"),
            (4, 0, "assistant", "long # " * 30_000)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: tuple(r)[1:5]
             for r in chat.format_digests(given.withColumn("formatted", F.lit(1))).collect()}
    assert found[1] == _brute([("user", "a"), ("assistant", "b <x>"), ("assistant", "")])
    assert found[2] == _brute([("", "n"), ("assistant", "y"), ("user", "z")])
    assert found[3] == _brute([("assistant", "same")] * 2)
    assert found[4] == _brute([("assistant", "long # " * 30_000)])
    assert found[None] == _brute([("user", "lost")])
    assert chat.format_digests(given.filter(F.lit(False))).collect() == []
    assert chat.format_turns(given.filter(F.lit(False))).collect() == []


def test_formatted_turns_of_typed_parts(spark):
    rows = [(1, 0, "user", "unused", [("text", "look: ", None, None, None),
                                     ("image", None, "p.png", 28, 28)]),
            (1, 1, "assistant", "I <see>", None)]
    given = spark.createDataFrame(
        rows, "conv_id long, turn long, role string, text string, "
              "parts array<struct<kind:string,text:string,ref:string,width:int,height:int>>")
    found = chat.format_turns(given).orderBy("position").collect()
    whole = "".join(r["formatted"] for r in found)
    assert whole == ("### User: look: <image:0> </turn>\n### Assistant: I \\<see> </turn>\n")
    assert found[0]["attachments"][0].asDict() == {
        "number": 0, "kind": "image", "ref": "p.png", "tokens": 1}
    assert whole[found[1]["loss_from"] : found[1]["loss_to"]] == "I \\<see>"
    assert found[1]["start"] == len(found[0]["formatted"]) and found[1]["attachments"] == []


def test_conversation_longer_than_a_batch(spark):
    given = spark.range(12_000).select(
        F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.col("id").cast("string").alias("text"))
    row, = chat.format_digests(given).collect()
    assert tuple(row)[1:5] == _brute(
        [("assistant" if i % 2 else "user", str(i)) for i in range(12_000)])
