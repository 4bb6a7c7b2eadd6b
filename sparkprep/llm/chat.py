"""Chat formatting with typed content parts: text, images, audio and documents in one sequence.

DataFrame functions only. A turn is written ``<s>[role] body</s>``. Parts are flattened in order: text is escaped, any
other part becomes a placeholder ``<image>``, ``<audio>`` or ``<document>`` and a row
in the list of attachments with its reference and the tokens it expands to.

Inside roles and texts ``\\ < [ ]`` are written as a backslash and two hex digits, so no text can
hold a marker; every backslash of the output starts such a code, so reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of the markers and their codes; the escape character comes first.
CODES = (("\\", "\\5C"), ("<", "\\3C"), ("[", "\\5B"), ("]", "\\5D"))

#: Type of ``content``: a list of parts, of which only the fields of their kind are set.
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

PATCH = 14  #: side of the square of an image that is one token
AUDIO_RATE = 25  #: tokens per second of audio
PAGE_TOKENS = 512  #: tokens per page of a document


def escaped(text: Column) -> Column:
    for plain, code in CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for plain, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def text_content(text: Column) -> Column:
    """``content`` of a turn that is plain text."""
    empty = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(
        F.struct(
            F.lit("text").alias("type"),
            text.cast("string").alias("text"),
            *[F.lit(None).cast(t).alias(n) for n, t in empty.items()],
        )
    )


def _visited(part: Column) -> Column:
    """What one part contributes: its text in the output, its reference and its tokens."""
    kind = F.coalesce(part["type"], F.lit("text"))
    text = F.coalesce(part["text"], F.lit(""))

    def patches(side: Column) -> Column:
        return F.ceil(F.coalesce(side, F.lit(0)) / F.lit(PATCH))

    tokens = (
        F.when(kind == "image", patches(part["width"]) * patches(part["height"]))
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * F.lit(AUDIO_RATE)))
        .when(kind == "document", F.coalesce(part["pages"], F.lit(0)) * F.lit(PAGE_TOKENS))
        .otherwise(F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    )
    shown = F.when(kind == "text", escaped(text)).otherwise(
        F.concat(F.lit("<"), escaped(kind), F.lit(">"))
    )
    return F.struct(
        shown.alias("shown"), kind.alias("type"), part["ref"].alias("ref"), tokens.cast("long").alias("tokens")
    )


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, content: array of parts).

    Returns conv_id, formatted, n_turns, n_tokens (words of texts and expanded tokens), loss (list of start and
    length in code points of ``formatted``, one per turn of ``trained_role``, in order) and attachments
    (list of turn number, type, ref, tokens in order).

    Turns are ordered by ``turn``, null first; equal ones by role and text. Null roles, texts and
    content lists are empty, an unknown part type is a placeholder of its name with the words of its
    text as tokens. Rows with a null conv_id are one conversation. Repeated rows are turns of
    their own. Further columns are ignored; an empty table gives no rows.
    """
    content = F.coalesce(F.col("content"), F.array().cast(f"array<{PART}>"))
    flat = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.transform(content, _visited).alias("parts"),
    )
    shown = F.array_join(F.transform("parts", lambda p: p["shown"]), "")
    flat = flat.withColumn("body", shown).withColumn("head", F.concat(F.lit("<s>["), escaped(F.col("role")), F.lit("] ")))
    flat = flat.withColumn("length", F.length("head") + F.length("body") + F.lit(4))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    before = F.coalesce(F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = flat.withColumn("number", F.row_number().over(order)).withColumn("before", before)
    others = F.filter("parts", lambda p: p["type"] != "text")
    row = F.struct(
        "number",
        F.concat("head", "body", F.lit("</s>")).alias("shown"),
        (F.col("role") == trained_role).alias("trained"),
        (F.col("before") + F.length("head")).alias("start"),
        F.length("body").alias("length"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("tokens"),
        F.transform(
            others,
            lambda p: F.struct(F.col("number"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens")),
        ).alias("attachments"),
    )
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    trained = F.filter("turns", lambda t: t["trained"])
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["shown"]), "").alias("formatted"),
        F.size("turns").cast("long").alias("n_turns"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"]).alias("n_tokens"),
        F.transform(trained, lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text with placeholders) that a formatted conversation holds."""
    pieces = F.filter(F.split(formatted, "<s>"), lambda p: p != "")

    def turn(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - F.lit(5))
        role = F.substring_index(inner, "] ", 1)
        text = F.substring(inner, F.length(role) + F.lit(3), F.length(inner))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(pieces, turn)


def trained_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, read from the output by its spans."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"]))), ""
    )
