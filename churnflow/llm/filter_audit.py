"""Filter interaction audit: what each filter removes in every order of a filter chain, from min-plus removal ranks.

Documents are counted by part and by the set of filters they fail, at most ``2 ** filters`` sets a part. The
mask matrix of a part (0 where a set has a filter, infinity where not) combined with the position matrix (where each order,
a permutation, puts each filter: the permutation's inverse) by minimum of sums gives the step at which each order
removes each set. Counts scattered to those steps, with the documents, the good and the toxic ones as weights, are
all the numbers asked for.

Filters judge a document's whole text, a null one as empty. Words are runs of characters other than space and the
controls 9 to 13. A document is a copy if a smaller id has the same text, whether that one is removed or not; a null id
is neither smaller nor larger than any, so it makes no copies and is none; rows with the same id and text are no copies
of each other. Labels are taken by id: one that says good, or toxic, is enough, repeated labels count a document once, and
a null id has none. Rows with a null part are those of the empty part. Ties in nothing else matter: rows are only
counted. An empty table has no parts and gives no rows; long texts cost in proportion; other columns are not read.

Texts never leave their task: what is shuffled is an id, a digest of 32 bytes and small numbers. Of the copies of
a text, each task sends one row for the least id. Joins are on (digest, id), so no group of copies meets in one
task, and null ids are dealt out. Rows that share one id but not their text meet its label in the tasks to which
Spark splits a skewed join.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from churnflow.llm.columns import require

_WORDS = r"filter(split(text, r'[\x20\x09-\x0D]+'), w -> w <> '')"

# Failure conditions of a text over ``words`` and ``text``; COPY, judged table-wide, comes last.
TEXT_FILTERS = {
    "A": "size(words) < 100",
    "B": "100L * size(array_distinct(words)) < 80L * size(words)",
    "C": "100L * (length(text) - length(regexp_replace(text, r'[A-Z]+', ''))) > 10L * length(text)",
    "D": "text rlike r'[#$%&*|]'",
}
COPY = "E"

_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_SPREAD = 1024


def removal_steps(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Min-plus product: for each mask (a row, true where a filter fails) and each order, the removing step.

    ``positions[order, filter]`` counts from 1; a mask that fails nothing has the step after the last.
    """
    never = positions.shape[1] + 1
    steps = np.full((len(masks), len(positions)), never, np.int64)
    for f in range(positions.shape[1]):  # one term of the product at a time: memory is the result's
        np.minimum(steps, np.where(masks[:, f, None], positions[None, :, f], never), out=steps)
    return steps


def audit_counts(masks: np.ndarray, weights: np.ndarray, orders: list[tuple[int, ...]]) -> dict[str, np.ndarray]:
    """The numbers of ``_COUNTS`` for one part, each an array of (order, step).

    ``weights`` has a row a mask: documents, good ones, toxic ones.
    """
    n_filters = masks.shape[1]
    permuted = np.array(orders, np.int64)
    positions = np.argsort(permuted, axis=1) + 1
    steps = removal_steps(masks, positions)
    lost = np.zeros((3, len(orders), n_filters + 1), np.int64)  # by order and step, the last one for what stays
    order = np.broadcast_to(np.arange(len(orders)), steps.shape)
    for k in range(3):
        np.add.at(lost[k], (order, steps - 1), np.broadcast_to(weights[:, k, None], steps.shape))
    removed, good, toxic = lost[:, :, :n_filters]
    documents = weights[:, 0]
    fails = documents @ masks
    alone = documents @ (masks & (masks.sum(axis=1, keepdims=True) == 1))
    by_filter = np.zeros(n_filters, np.int64)
    np.add.at(by_filter, permuted, removed)
    return {
        "kept": documents.sum() - np.cumsum(removed, axis=1), "removed": removed, "redundant": fails[permuted] - removed,
        "unique_fails": alone[permuted], "good_lost": good, "toxic_lost": toxic, "shapley": by_filter[permuted],
    }


def failures(documents: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", filters: Mapping[str, str] = TEXT_FILTERS) -> DataFrame:
    """(part, mask, documents, good, toxic): documents by what they fail, bit k of ``mask`` for the k-th filter."""
    require(documents, "doc_id", text, part)
    require(labels, "doc_id", "quality", "toxic")
    rows = documents.select(
        F.col("doc_id"), F.coalesce(F.col(f"`{part}`"), F.lit("")).alias("part"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    ).withColumn("words", F.expr(_WORDS))
    mask = sum((F.expr(f"IF({broken}, {1 << k}, 0)") for k, broken in enumerate(filters.values())), F.lit(0))
    rows = rows.select("doc_id", "part", mask.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest"))

    first = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    met = rows.join(first, ["digest", "doc_id"], "left")
    spread = F.when(F.col("doc_id").isNull(), F.pmod(F.hash("digest"), F.lit(_SPREAD)) + 1).otherwise(0)
    met = met.withColumn("spread", spread).join(known.withColumn("spread", F.lit(0)), ["doc_id", "spread"], "left")
    copy = F.col("is_first").isNull() & F.col("doc_id").isNotNull()

    def total(flag: Column) -> Column:
        return F.sum(F.coalesce(flag, F.lit(0)).cast("long"))

    return met.groupBy("part", (F.col("mask") + F.when(copy, 1 << len(filters)).otherwise(0)).alias("mask")).agg(
        F.count("*").alias("documents"), total(F.col("good")).alias("good"), total(F.col("toxic")).alias("toxic"))


def audit(documents: DataFrame, labels: DataFrame, part: str = "lang", text: str = "text", filters: Mapping[str, str] = TEXT_FILTERS) -> DataFrame:
    """One row per part, order of the filters and step, with the counts of ``_COUNTS``."""
    names = [*filters, COPY]
    orders = list(permutations(range(len(names))))
    labelled = ["".join(names[f] for f in order) for order in orders]
    width = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a part: its sets of failures with their counts."""
        for batch in batches:
            for value, sets in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.array([s["mask"] for s in sets], np.int64)
                weights = np.array([[s["documents"], s["good"], s["toxic"]] for s in sets], np.int64)
                counts = audit_counts((found[:, None] >> np.arange(width)) & 1 == 1, weights, orders)
                yield pa.RecordBatch.from_arrays([
                    pa.array([value] * (len(orders) * width), pa.string()), pa.array(np.repeat(labelled, width)),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(orders))),
                    *[pa.array(counts[c].ravel().astype(np.int64)) for c in _COUNTS],
                ], names=["part", "filter_order", "step", *_COUNTS])

    sets = failures(documents, labels, part, text, filters).groupBy("part").agg(F.collect_list(F.struct("mask", "documents", "good", "toxic")).alias("sets"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)
    return sets.mapInArrow(run, schema)
