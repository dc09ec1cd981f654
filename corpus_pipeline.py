"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next.

Stages whose decisions change a text set ``n_chars``, if there is one, to its new length. A document of which nothing is left
after a stage goes. Null and empty texts fail the quality rules and go in the first stage; an empty table stays empty. Of repeated
rows, as of all copies, one stays: of equal texts that with the smallest id (nulls last), of rows equal in both any one. Passages are
kept where the smallest id has them. Texts of any length pass whole, within the memory of a few of the longest.

Other columns pass through all stages, whatever their names. The last stage puts ``n_tokens``, ``ids``, ``ids_sha256`` and
``decoded_sha256`` in place of ``text`` and ``n_chars``, and of columns that have these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from churnflow.llm import bpe, chunk_dedup, decontaminate, near_duplicates, quality
from churnflow.llm.columns import delete, scratch, shared_path, stored
from churnflow.llm.queries import tokenizer_file


def _with_row(docs: DataFrame) -> DataFrame:
    """Id and text, and all other columns in one, so that no operator's results can take their names."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_chars")]
    return docs.select("doc_id", "text", F.struct(*others).alias("others"))


def _shortened(changed: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of ``documents``, without documents that lost all of their text."""
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return changed.filter("text <> ''").select(*(own.get(c, F.col(f"others.`{c}`")).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality.keep_good(docs)


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_duplicates.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return _shortened(chunk_dedup.dedup(_with_row(docs)), docs.columns)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of benchmark items; documents that are mostly such go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _shortened(decontaminate.clean(_with_row(docs), items), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, with digests of the ids and of their decoding."""
    tokenizer = tokenizer_file()
    encoded = bpe.encode(_with_row(docs), tokenizer)
    results = {
        "n_tokens": (F.length("ids") / bpe.ID.itemsize).cast("long"), "ids": F.col("ids"),
        "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256),
    }
    others = [F.col(f"others.`{c}`").alias(c) for c in docs.columns if c not in ("text", "n_chars", *results)]
    return bpe.decode(encoded, tokenizer, text="decoded").select(*others, *(value.alias(name) for name, value in results.items()))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_groups),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_items),
    ("bpe", token_ids),
]

# Hashes of shingles and chunks, suffix automata and byte pairs are beyond SQL; tests compare the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What a stage leaves behind goes as soon as its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        with scratch(spark):
            docs = stored(stage(spark, docs, sf_dir), name, path)
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
