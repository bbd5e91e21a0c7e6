"""The operators bound to the benchmark tables, with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiolume.llm import oracles
from regiolume.llm.chat import digests, events_of, format_conversations, number_copies
from regiolume.llm.common import table
from regiolume.llm.curve_packing import pack_along_curve
from regiolume.llm.decontam import find_contamination
from regiolume.llm.jaccard import jaccard_components
from regiolume.llm.language import identify, markup_language, markup_text, train, url_host, url_language
from regiolume.llm.line_dedup import dedup_lines
from regiolume.llm.packing import id_lengths, pack_documents
from regiolume.llm.repeats import remove_repeats
from regiolume.llm.sharding import shuffle_into_shards
from regiolume.llm.token_output import read_token_ids, write_token_ids
from regiolume.llm.term_search import rank_documents
from regiolume.llm.topk import exact_top_k
from regiolume.llm.whitening import whiten


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return read_token_ids(write_token_ids(table(spark, sf_dir, "documents"), vocabulary))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, width=3, percent=90).withColumnRenamed("id", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(id_lengths(table(spark, sf_dir, "documents"), vocabulary)).withColumnRenamed("id", "doc_id")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.coalesce(F.col("text"), F.lit(""))
    return shuffle_into_shards(table(spark, sf_dir, "documents")).select(
        "doc_id",
        (F.octet_length(whole).cast("long") + 8).alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, and documents with their label as the declared language and their source as the host."""
    documents, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = train(documents.select(F.col("doc_id").alias("key"), "text", "lang"))
    none = F.lit(None)
    rows = documents.select(
        "doc_id", none.cast("long").alias("page_id"), "text", F.col("lang").alias("declared"),
        none.cast("string").alias("suffix"), F.col("source").alias("host"),
    ).unionByName(pages.select(
        none.cast("long").alias("doc_id"), "page_id", markup_text(F.col("html")).alias("text"),
        markup_language(F.col("html")).alias("declared"), url_language(F.col("url")).alias("suffix"),
        url_host(F.col("url")).alias("host"),
    ))
    evidence = [F.col(c) for c in ("text", "declared", "suffix", "host")]
    return identify(rows, model, *evidence, keep=["doc_id", "page_id"])


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    tricky = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame(
        [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string"
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(format_conversations(events_of(number_copies(given.unionByName(planted)))))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_along_curve(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_token_output": op4_token_output,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_sharding": op8_sharding,
    "op9_language_id": op9_language_id,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_whitening": op11_whitening,
    "op12_curve_packing": op12_curve_packing,
    "op13_lexical_search": op13_lexical_search,
}
SQL = {
    "op1_top_k": oracles.TOP_K,
    "op2_decontamination": oracles.DECONTAMINATION,
    "op5_jaccard_join": oracles.JACCARD,
    "op6_line_dedup": oracles.LINE_DEDUP,
    "op10_chat_formatting": oracles.CHAT,
    "op13_lexical_search": oracles.LEXICAL,
}
