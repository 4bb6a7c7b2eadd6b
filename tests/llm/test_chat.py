"""Chat formatting: reversible escapes, spans, attachments and their tokens."""

import random

from pyspark.sql import functions as F

from sparkprep.llm.chat import PART, escaped, format_conversations, read_turns, text_content, trained_text, unescaped


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return (kind, text, ref, width, height, seconds, pages)


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("\\<[]5CB3D/s>é\n") for _ in range(rng.randrange(30))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escaped(F.col("t")))
    for r in df.withColumn("u", unescaped(F.col("e"))).collect():
        assert r["u"] == r["t"] and not set(r["e"]) & set("<[]")


def test_parts_of_all_types(spark):
    content = [
        part("text", "look <image> [x]"),
        part("image", ref="a.png", width=28, height=15),
        part("audio", ref="b.wav", seconds=1.5),
        part("text", " and "),
        part("document", ref="c.pdf", pages=3),
        part("video", "some words", ref="d"),
        part(None, "tail"),
    ]
    rows = [(1, 2, "assistant", [part("text", "yes")], "extra"), (1, 1, "user", content, "extra")]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{PART}>, parts string")
    r = format_conversations(df).first()
    body = "look \\3Cimage> \\5Bx\\5D<image><audio> and <document><video>tail"
    assert r["formatted"] == f"<s>[user] {body}</s><s>[assistant] yes</s>"
    assert [(a["number"], a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        (1, "image", "a.png", 4), (1, "audio", "b.wav", 38), (1, "document", "c.pdf", 1536), (1, "video", "d", 2),
    ]
    assert r["n_tokens"] == 3 + 4 + 38 + 1 + 1536 + 2 + 1 + 1
    assert [(x["start"], x["length"]) for x in r["loss"]] == [(r["formatted"].index("yes"), 3)]


def test_odd_rows_and_order(spark):
    rows = [
        (1, 2, "assistant", "b</s>"), (1, 1, None, None), (1, 2, "assistant", "a"), (1, None, "x] y", "first"),
        (1, 2, "assistant", "a"), (None, 1, "user", "😀"), (None, 2, "assistant", "é" * 5000),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    done = format_conversations(df.withColumn("content", text_content(F.col("text"))))
    back = done.select(
        "conv_id", read_turns(F.col("formatted")).alias("t"), trained_text(F.col("formatted"), F.col("loss")).alias("l")
    )
    found = {r["conv_id"]: ([tuple(t) for t in r["t"]], r["l"]) for r in back.collect()}
    assert found[1] == (
        [("x] y", "first"), ("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b</s>")], "aab</s>",
    )
    assert found[None] == ([("user", "😀"), ("assistant", "é" * 5000)], "é" * 5000)
    null = df.withColumn("content", F.lit(None).cast(f"array<{PART}>"))
    assert format_conversations(null).where("n_tokens <> 0").count() == 0
    assert format_conversations(df.limit(0).withColumn("content", text_content(F.col("text")))).count() == 0
