"""Sharding by sampled splitters: contiguous ranges of a key, cut so that all shards have nearly equal bytes.

1. A key sample is drawn in which a row's chance grows with its size, about ``OVERSAMPLE`` rows a range.
2. Splitters are the quantiles of the sample's weight; they part the keys into as many ranges as the session has
   shuffle partitions, ``shards`` at least.
3. Ranges are measured. Those of over twice the size asked for, such as that of one text with very many copies,
   are subdivided at quantiles of the same sample taken by key, tie and number of the row.
4. Sums over the ranges, then running sums inside each, give every row the exact number of bytes before it,
   and so its shard and its slot there. The sample decides who does the work, never the result.

Rows are ordered by key, then tie (nulls first). Rows equal in both are in the order in which they were written
aside, which is of no matter where rows are the same in all columns; any order obeys the law. A shard differs from the mean by no
more than the size of the row at either of its ends. Rows of one key are neighbours, so they share a shard unless its end
falls among them. Nulls in key or tie sort first; a null size counts as 0. An empty table gives an empty result, a long
text is one row of its size. Columns of the input pass through, but for ``shard`` and ``slot``, which are replaced.

Bounded by the number of ranges, and handled in one task or on the driver: the sample, the splitters and the
ranges' sums. A range is at most about twice total / ranges, or one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from churnflow.llm.columns import delete, require, shared_path, stored

OVERSAMPLE = 64
OVERFULL = 2
_DRAWS = 1 << 40


def _splitters(sample: DataFrame, target: int) -> DataFrame:
    """``place`` of the sampled rows at which the weight of their ``part`` passes a multiple of ``target``."""
    ordered = Window.partitionBy("part").orderBy("place")
    weighed = sample.withColumn("bucket", F.floor((F.sum("weight").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight") / 2) / target))
    first = F.col("bucket") > F.lag("bucket", 1, 0).over(ordered)
    return weighed.withColumn("first", first).filter("first").select("place")


def _with_range(rows: DataFrame, splitters: DataFrame) -> DataFrame:
    """``rows`` with ``range``: the number of splitters not above ``place``, found in two steps of a square root each.

    Every so many-th splitter is a literal of the plan; the others come in a table of a row for each of those.
    """
    numbered = splitters.withColumn("number", F.row_number().over(Window.orderBy("place")))
    fan = max(1, round(splitters.count() ** 0.5))
    heads = numbered.filter(F.col("number") % fan == 0).orderBy("number").collect()
    kind = splitters.schema["place"].dataType
    literals = [F.struct(*[F.lit(r.place[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields]) for r in heads]
    coarse = F.size(F.filter(F.array(*literals), lambda s: s <= F.col("place"))) if literals else F.lit(0)
    fine = numbered.groupBy(F.floor(F.col("number") / fan).cast("int").alias("coarse")).agg(F.collect_list(F.when(F.col("number") % fan != 0, F.col("place"))).alias("fine"))
    met = rows.withColumn("coarse", coarse).join(F.broadcast(fine), "coarse", "left")
    inside = F.coalesce(F.size(F.filter("fine", lambda s: s <= F.col("place"))), F.lit(0))
    return met.withColumn("range", (F.col("coarse") * fan + F.when(F.col("fine").isNull(), 0).otherwise(inside)).cast("int")).drop("coarse", "fine")


def assign(records: DataFrame, shards: int, size: str = "size", key: str = "key", tie: str = "doc_id") -> DataFrame:
    """``records`` with ``shard`` (int, from 0) and ``slot`` (long, without gaps from 0 in each shard)."""
    require(records, size, key, tie)
    spark = records.sparkSession
    own = [c for c in records.columns if c not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in own])
    place = F.struct(F.col(f"`{key}`").alias("key"), F.col(f"`{tie}`").alias("tie"), F.monotonically_increasing_id().alias("n"))
    paths = [shared_path(spark, name) for name in ("shard-rows", "shard-sample", "shard-coarse", "shard-splitters")]
    try:
        weight = F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0)).alias("size")
        rows = stored(records.select(row.alias("row"), weight, place.alias("place")), "", paths[0])
        total, count = rows.agg(F.sum("size"), F.count("*")).first()
        if not count:
            return records.select(*[F.col(f"`{c}`") for c in own], F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
        total = max(1, total)
        ranges = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
        target = max(1, total // ranges)

        rate = OVERSAMPLE / target
        drawn = F.pmod(F.xxhash64("place", F.lit(1)), F.lit(_DRAWS)) < F.col("size") * (rate * _DRAWS)
        sample = stored(rows.filter(drawn).select("place", F.greatest("size", F.lit(1 / rate)).alias("weight")), "", paths[1])
        kind = sample.schema["place"].dataType
        of_key = F.struct(F.col("place.key").alias("key"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields[1:]])
        coarse = stored(_splitters(sample.select(F.lit(0).alias("part"), of_key.alias("place"), "weight"), target).distinct(), "", paths[2])

        overfull = _with_range(rows, coarse).groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
        overfull = overfull.filter((F.col("bytes") > OVERFULL * target) & (F.col("n") > 1)).select(F.col("range").alias("part"))
        crowded = _with_range(sample, coarse).withColumnRenamed("range", "part").join(F.broadcast(overfull), "part", "left_semi")
        splitters = stored(coarse.union(_splitters(crowded, target)).distinct(), "", paths[3])

        ranged = _with_range(rows, splitters)
        before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        sums = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).select(
            "range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"))
        inside = Window.partitionBy("range").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
        middle = 2 * (F.col("bytes_before") + F.sum("size").over(inside)) - F.col("size")
        placed = ranged.join(F.broadcast(sums), "range").select(
            "row", F.least(F.lit(shards - 1), F.floor(middle * shards / (2 * total))).cast("int").alias("shard"),
            (F.col("rows_before") + F.row_number().over(Window.partitionBy("range").orderBy("place")) - 1).alias("rank"),
        )
        placed = stored(placed, "shard-placed")
    finally:
        for path in paths:
            delete(spark, path)
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # a row per shard
    return placed.join(F.broadcast(first), "shard").select("row.*", "shard", (F.col("rank") - F.col("first")).alias("slot"))


def write(placed: DataFrame, folder: str, rows_per_file: int = 1_000_000) -> None:
    """Rows with ``shard`` and ``slot`` as Parquet, a folder a shard, each file a run of slots in order."""
    run = F.floor(F.col("slot") / rows_per_file)
    placed.repartition("shard", run).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
