"""How features move between snapshots, and what they look like: drift indices, profiles, and limits taken from profiles.

Numbers and categories are laid out as (feature, value) inside each row, so all features are counted in one
aggregation that is reduced on the map side: what is shuffled is a row per task, snapshot, feature and bin. A number
that is missing, or not a number, counts as missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Row, functions as F

from churnflow.functions import date_literal
from churnflow.operators.modeling import present
from churnflow.operators.quality import Check
from churnflow.schemas import BINARY_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES

MISSING = "missing"
# A bin that one side lacks counts as this share of it, since the logarithm needs one.
EMPTY_SHARE = 0.0001
DRIFTED = 0.2
# Nominal errors of the sketches: ranks by KLL with k = 200, distinct counts by HyperLogLog with 2 ** 13 registers.
RANK_ERROR = 0.0266
DISTINCT_ERROR = 0.05
QUANTILES = (0.01, 0.25, 0.5, 0.75, 0.99)


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def _numbers(rows: DataFrame) -> list[str]:
    return present([*NUMERIC_FEATURES, *BINARY_FEATURES], rows)


def decile_edges(rows: DataFrame) -> dict[str, tuple[float, ...]]:
    """The deciles of every number, for all features in one pass: nine values a feature reach the driver."""
    tenths = [i / 10 for i in range(1, 10)]
    found = rows.agg(*(F.percentile_approx(_number(c), tenths, 10_000).alias(c) for c in _numbers(rows))).first()
    return {c: tuple(sorted(set(found[c] or ()))) for c in found.asDict()}


def bin_counts(rows: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(snapshot_date, feature, bin, n): how many edges a number has reached, a category's value, or ``missing``."""
    def entry(name: str, bin_: Column) -> Column:
        return F.struct(F.lit(name).alias("feature"), F.coalesce(bin_, F.lit(MISSING)).alias("bin"))

    def reached(name: str) -> Column:
        return sum(((_number(name) >= e).cast("int") for e in edges[name]), F.lit(0) + F.when(_number(name).isNotNull(), 0))

    entries = [entry(c, reached(c).cast("string")) for c in _numbers(rows) if c in edges]
    entries += [entry(c, F.col(c)) for c in present(CATEGORICAL_FEATURES, rows)]
    return rows.select("snapshot_date", F.inline(F.array(*entries))).groupBy("snapshot_date", "feature", "bin").agg(F.count("*").alias("n"))


def drift(counts: DataFrame, baseline: date) -> DataFrame:
    """(snapshot_date, feature, n_rows, psi, drifted) of every other snapshot against ``baseline``.

    The population stability index is the sum over bins of (p - q) ln(p / q), of the shares p of the snapshot and q of
    the baseline.
    """
    shape = counts.groupBy("snapshot_date", "feature").agg(
        F.sum("n").alias("n_rows"), F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("bins"))
    is_base = F.col("snapshot_date") == date_literal(baseline)
    base = shape.filter(is_base).select("feature", F.col("n_rows").alias("base_rows"), F.col("bins").alias("base_bins"))

    def share(bins: str, total: str, bin_: Column) -> Column:
        return F.greatest(F.coalesce(F.try_element_at(bins, bin_), F.lit(0)) / F.col(total), F.lit(EMPTY_SHARE))

    def term(total: Column, bin_: Column) -> Column:
        p, q = share("bins", "n_rows", bin_), share("base_bins", "base_rows", bin_)
        return total + (p - q) * F.log(p / q)

    every = F.array_sort(F.array_union(F.map_keys("bins"), F.map_keys("base_bins")))
    met = shape.filter(~is_base).join(base, "feature")
    return met.select("snapshot_date", "feature", "n_rows", F.aggregate(every, F.lit(0.0), term).alias("psi")).withColumn("drifted", F.col("psi") >= DRIFTED)


def feature_values(rows: DataFrame) -> DataFrame:
    """(snapshot_date, feature, number, label): a row per value, categories as labels."""
    none = F.lit(None)
    entries = [F.struct(F.lit(c).alias("feature"), _number(c).alias("number"), none.cast("string").alias("label")) for c in _numbers(rows)]
    entries += [F.struct(F.lit(c).alias("feature"), none.cast("double").alias("number"), F.col(c).alias("label")) for c in present(CATEGORICAL_FEATURES, rows)]
    return rows.select("snapshot_date", F.inline(F.array(*entries)))


def profile(rows: DataFrame) -> DataFrame:
    """One row per snapshot and feature, in one pass, of a kind that ``merged`` can put together.

    Counts, extremes, mean and ``spread`` (squared deviations added up) are exact; ``distinct_sketch`` and, of numbers,
    ``quantile_sketch`` are estimates of bounded size.
    """
    text = F.coalesce("label", F.col("number").cast("string"))
    return feature_values(rows).groupBy("snapshot_date", "feature").agg(
        F.count("*").alias("n_rows"),
        F.count_if(text.isNull()).alias("missing"),
        F.count_if(F.col("number") == 0).alias("zeros"),
        F.min("number").alias("least"),
        F.max("number").alias("greatest"),
        F.avg("number").alias("mean"),
        (F.var_pop("number") * F.count("number")).alias("spread"),
        F.hll_sketch_agg(text, F.lit(13)).alias("distinct_sketch"),
        F.kll_sketch_agg_double("number").alias("quantile_sketch"),
    )


def merged(profiles: DataFrame) -> DataFrame:
    """One row per feature over all snapshots of ``profiles``, without looking at the rows again."""
    n = F.col("n_rows") - F.col("missing")
    total = F.sum(n * F.col("mean"))
    mean = total / F.sum(F.when(F.col("mean").isNotNull(), n))
    return profiles.groupBy("feature").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("missing").alias("missing"), F.sum("zeros").alias("zeros"),
        F.min("least").alias("least"), F.max("greatest").alias("greatest"), mean.alias("mean"),
        F.greatest(F.lit(0.0), F.sum("spread") + F.sum(n * F.col("mean") * F.col("mean")) - total * mean).alias("spread"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def described(profiles: DataFrame) -> DataFrame:
    """Profiles with what their sketches say: ``distinct_values``, ``quantiles``, and the standard deviation."""
    n = F.col("n_rows") - F.col("missing")
    known = F.col("mean").isNotNull()
    quantiles = F.array(*(F.when(known, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))) for q in QUANTILES))
    kept = [c for c in profiles.columns if c not in ("spread", "distinct_sketch", "quantile_sketch")]
    return profiles.select(
        *kept, F.when(n > 1, F.sqrt(F.col("spread") / (n - 1))).alias("stddev"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_values"), F.when(known, quantiles).alias("quantiles"))


def profile_limits(profiles: DataFrame, widen: float = 3.0) -> DataFrame:
    """(feature, low, high, missing_share): the range that numbers keep to, by all profiles given.

    The range from the first to the last percentile, ``widen`` times as wide again on both sides; a number outside is out of the
    ordinary, whatever the distribution looks like. ``missing_share`` is the share of missing values so far.
    """
    found = described(merged(profiles))
    low, high = F.col("quantiles")[0], F.col("quantiles")[len(QUANTILES) - 1]
    room = (high - low) * widen
    return found.select(
        "feature", (low - room).alias("low"), (high + room).alias("high"), (F.col("missing") / F.col("n_rows")).alias("missing_share"))


def limit_checks(limits: Iterable[Row], features: DataFrame) -> list[Check]:
    """A check per number, that it keeps to its limits: to be counted or required with all others in one pass."""
    numbers = set(_numbers(features))
    return [
        Check(f"{r.feature}_out_of_range", ~_number(r.feature).between(r.low, r.high))
        for r in sorted(limits, key=lambda r: r.feature) if r.feature in numbers and r.low is not None
    ]
