"""Registered queries of the operators for training text, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep.llm import oracles
from sparkprep.llm.alignment import aligned, with_link_counts
from sparkprep.llm.chat import format_conversations, read_turns, text_content, trained_text
from sparkprep.llm.common import Scratch, read
from sparkprep.llm.embeddings import near_embeddings
from sparkprep.llm.fingerprints import fingerprint_edits
from sparkprep.llm.language import identify_languages
from sparkprep.llm.lines import dedup_lines
from sparkprep.llm.mixing import n_words, with_copies
from sparkprep.llm.near_documents import near_documents
from sparkprep.llm.packing import pack_documents
from sparkprep.llm.pages import extract_pages
from sparkprep.llm.ranked_search import search
from sparkprep.llm.repeated_passages import remove_repeated_passages
from sparkprep.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read(spark, sf_dir, "pages"))


def near_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(read(spark, sf_dir, "embeddings"))


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = read(spark, sf_dir, "documents").select("doc_id", "source", n_words("text").alias("size"))
    sized = Scratch(spark, "mix-sources").keep(sized, "sizes")
    counted = with_copies(sized, F.col("size"))
    return counted.select(
        "doc_id",
        "size",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("size") * F.col("__copies")).alias("taken"),
    )


def near_document_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_documents(read(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select(
        "doc_id",
        F.col("__lines").alias("n_lines"),
        F.col("__removed").alias("n_removed"),
        F.sha2(F.coalesce("__kept", F.lit("")), 256).alias("kept_sha256"),
    )


def repeated_passage_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeated_passages(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def chat_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formats every conversation and one that holds the markers of a common template."""
    marked = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        marked.alias("text"),
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = format_conversations(rows.withColumn("content", text_content(F.col("text"))))
    turns = read_turns(F.col("formatted"))
    lines = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    back = done.withColumn("turns", lines).withColumn("trained", trained_text(F.col("formatted"), F.col("loss")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(docs).select("doc_id", "held_out", "lang_pred", "score")


def pack_all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


def document_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    done = with_link_counts(aligned(read(spark, sf_dir, "documents"), a, b, digest=True), a, b)
    return done.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        F.col("groups").alias("groups_sha256"),
    )


def ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_fingerprints": document_fingerprints,
    "op2_mix_sources": mix_sources,
    "op3_page_texts": page_texts,
    "op4_near_embeddings": near_embedding_groups,
    "op5_line_dedup": line_dedup,
    "op6_repeated_passages": repeated_passage_removal,
    "op7_near_documents": near_document_groups,
    "op8_chat_format": chat_read_back,
    "op9_languages": document_languages,
    "op10_pack_documents": pack_all_documents,
    "op11_toxicity": document_toxicity,
    "op12_token_alignment": token_alignment,
    "op13_ranked_search": ranked_search,
}

ORACLES: dict[str, str] = {
    "op2_mix_sources": oracles.MIX_SOURCES,
    "op8_chat_format": oracles.CHAT_FORMAT,
    "op13_ranked_search": oracles.RANKED_SEARCH,
}
