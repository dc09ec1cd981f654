"""The registered queries of the text operators, over the whole test tables, with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnflow.llm import bpe, chunk_dedup, conversation_repair, decontaminate, filter_audit, html_extract, near_duplicates, quality, sharding, suffix_dedup, token_counts, token_store, warc

from churnflow.llm.columns import shared_path

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Content of a public tokenizer's file; read on the driver, then sent to the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_file()
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer)
    return bpe.decode(encoded, tokenizer).select(
        "doc_id", (F.length("ids") / bpe.ID.itemsize).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = shared_path(spark, "bpe-blocks")
    encoded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file(), blocks_at=blocks, compact=False)
    return token_store.round_trip(encoded, end_id=2, spent=blocks)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "n_links")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("text", F.lit(b"")), 256).alias("kept_sha256"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        initial, inner = token_counts.vocabulary(file.read())
    return token_counts.count(table(spark, sf_dir, "documents").select("doc_id", "text"), initial, inner).drop("text")


def op9_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_chunks", "n_removed", "n_spans", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), "text")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

def op11_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    records = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long").alias("key"),
    )
    return sharding.assign(records, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that ``op12_conversation_repair`` mends; ``times`` says how often a row stands there."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.withColumn("fault", F.crc32(name.cast("binary")) % 20)
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(F.col("fault") == 0, 0).when(F.col("fault") == 3, 2).otherwise(1).alias("times"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.summary(conversation_repair.repair(rows, F.col("times")))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_bpe": op2_bpe,
    "op3_token_store": op3_token_store,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_html_extract": op6_html_extract,
    "op7_decontaminate": op7_decontaminate,
    "op8_token_counts": op8_token_counts,
    "op9_chunk_dedup": op9_chunk_dedup,
    "op10_quality_rules": op10_quality_rules,
    "op11_sampled_splitters": op11_sampled_splitters,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_filter_audit": op13_filter_audit,
}
