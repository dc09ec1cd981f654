"""Drift, profiles and their limits, and tuning by folds of customers, on small tables."""

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from churnflow.operators import monitoring as mon
from churnflow.operators.evaluation import counts_by_score, roc_auc
from churnflow.operators.quality import DataQualityError
from churnflow.operators.tuning import fold_metrics, held_out_scores, setting_metrics, with_fold
from churnflow.plans import check_snapshot, profile_snapshots, snapshot_drift, train_and_register, tune
from churnflow.plans.tuning import SETTINGS
from churnflow.schemas import FEATURE_PROFILES, FEATURES, LABEL, TRAINING_RUNS, TUNING_RUNS

S = date(2019, 5, 26)
WEEK = timedelta(weeks=1)
NOW = datetime(2024, 1, 1)


def rows_of(spark, values, label="labeled_churn double"):
    return spark.createDataFrame(values, f"customer_id long, snapshot_date date, spent_7d double, has_inversion boolean, gender string, {label}")


def test_drift_against_brute_force(spark):
    rng = random.Random(4)
    values = [(i, S - w * WEEK, rng.choice([None, float("nan"), rng.gauss(10 * w, 30)]), rng.random() < 0.2 + 0.2 * w, rng.choice(["m", "f", None][: 2 + w % 2]), 0.0)
              for w in range(3) for i in range(200)]
    edges = {"spent_7d": (-20.0, 0.0, 20.0), "has_inversion": (1.0,)}
    found = {(r.snapshot_date, r.feature): (r.n_rows, r.psi, r.drifted) for r in mon.drift(mon.bin_counts(rows_of(spark, values), edges), S).collect()}

    def bins(week, feature):
        counts = {}
        for _, day, spent, invested, gender, _ in values:
            if day == S - week * WEEK:
                number = {"spent_7d": spent, "has_inversion": float(invested), "gender": gender}[feature]
                if number is None or number != number:
                    number = "missing"
                elif feature != "gender":
                    number = sum(number >= e for e in edges[feature])
                counts[number] = counts.get(number, 0) + 1
        return counts

    assert len(found) == 6
    for (day, feature), (n, psi, drifted) in found.items():
        here, base = bins((S - day) // WEEK, feature), bins(0, feature)
        shares = [[max(side.get(b, 0) / 200, 0.0001) for side in (here, base)] for b in {*here, *base}]
        want = sum((p - q) * math.log(p / q) for p, q in shares)
        assert n == 200 and psi == pytest.approx(want, abs=1e-12) and drifted == (want >= 0.2)


def test_drift_of_equal_snapshots_is_none_and_of_nothing_is_empty(spark):
    same = rows_of(spark, [(i, S - w * WEEK, float(i), False, None, 0.0) for w in (0, 1) for i in range(40)])
    edges = mon.decile_edges(same)
    assert len(edges["spent_7d"]) == 9 and edges["has_inversion"] == (0.0,)
    assert {r.psi for r in mon.drift(mon.bin_counts(same, edges), S).collect()} == {0.0}
    assert mon.drift(mon.bin_counts(same.filter("false"), edges), S).count() == 0


def test_profiles_merge_to_the_profile_of_all(spark):
    rng = random.Random(6)
    values = [(i, S - (i % 4) * WEEK, rng.choice([None, 0.0, rng.gauss(100, 9)]), None if i % 4 == 1 else i % 3 == 0, rng.choice("abc"), 0.0) for i in range(4000)]
    rows = rows_of(spark, values)
    got = {r.feature: r for r in mon.described(mon.merged(mon.profile(rows))).collect()}
    once = {r.feature: r for r in mon.described(mon.profile(rows.withColumn("snapshot_date", F.lit(S)))).collect()}
    for name in ("spent_7d", "has_inversion", "gender"):
        for c in ("n_rows", "missing", "zeros", "least", "greatest"):
            assert got[name][c] == once[name][c]
    numbers = sorted(v[2] for v in values if v[2] is not None)
    mean = sum(numbers) / len(numbers)
    assert got["spent_7d"].mean == pytest.approx(mean)
    assert got["spent_7d"].stddev == pytest.approx(math.sqrt(sum((n - mean) ** 2 for n in numbers) / (len(numbers) - 1)))
    assert abs(got["spent_7d"].distinct_values - len(set(numbers))) <= mon.DISTINCT_ERROR * len(set(numbers))
    for q, value in zip(mon.QUANTILES, got["spent_7d"].quantiles, strict=True):
        assert sum(n < value for n in numbers) <= (q + mon.RANK_ERROR) * len(numbers)
        assert sum(n <= value for n in numbers) >= (q - mon.RANK_ERROR) * len(numbers)
    assert got["gender"].quantiles is None and got["gender"].distinct_values == 3


def features(spark, values):
    names = {"customer_id", "snapshot_date", "spent_7d", "has_inversion", "gender", "labeled_churn"}
    full = rows_of(spark, values).withColumn("created_at", F.lit(NOW))
    return full.select(*(F.col(f.name).cast(f.dataType) if f.name in names | {"created_at"} else F.lit(None if f.dataType.typeName() in ('string', 'date') else 0).cast(f.dataType).alias(f.name) for f in FEATURES.schema.fields))


def test_kept_profiles_give_the_checks_of_the_next_snapshot(spark, lake):
    rng = random.Random(2)
    values = [(i, S - w * WEEK, rng.gauss(100, 10), i % 2 == 0, "m", 0.0) for w in range(4) for i in range(300)]
    lake.append(features(spark, values), FEATURES)
    check_snapshot(lake, S - 3 * WEEK)  # nothing is known yet
    profile_snapshots(lake, [S - 3 * WEEK, S - 2 * WEEK])
    profile_snapshots(lake, [S - WEEK])
    profile_snapshots(lake, [S - WEEK])  # again: in place of the first
    assert lake.read(FEATURE_PROFILES).count() == 3 * 18
    check_snapshot(lake, S)
    lake.append(features(spark, [(1000 + i, S, 1e6, False, "m", 0.0) for i in range(30)]), FEATURES)
    with pytest.raises(DataQualityError, match="spent_7d_out_of_range: 30 of 330 rows"):
        check_snapshot(lake, S)
    check_snapshot(lake, S, allowed=0.1)
    shifted = {r.feature: r.drifted for r in snapshot_drift(lake, S - WEEK).filter(F.col("snapshot_date") == S).collect()}
    assert not shifted["gender"] and not shifted["has_inversion"]


def test_folds_keep_a_customer_on_one_side(spark):
    rows = spark.range(4000).select((F.col("id") % 400).alias("customer_id"), F.date_sub(F.lit(S), F.col("id").cast("int")).alias("snapshot_date"))
    folded = with_fold(rows, 5)
    assert folded.groupBy("customer_id").agg(F.count_distinct("fold").alias("n")).filter("n <> 1").count() == 0
    assert all(50 <= r["count"] / 10 <= 110 for r in folded.groupBy("fold").count().collect()) and folded.select("fold").distinct().count() == 5
    with pytest.raises(ValueError, match="two folds"):
        with_fold(rows, 1)


def test_areas_of_all_groups_in_one_go(spark):
    rng = random.Random(9)
    values = [(rng.choice("ab"), rng.randint(0, 2), round(rng.random(), 2), float(rng.random() < 0.4)) for _ in range(900)] + [("a", 7, 0.5, 1.0)]
    rows = spark.createDataFrame(values, f"setting string, fold int, score double, {LABEL} double").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    found = {(r.setting, r.fold): r for r in fold_metrics(rows).collect()}
    assert found["a", 7].roc_auc is None and found["a", 7].n_rows == 1  # one class only
    for (setting, fold), r in found.items():
        own = [(s, y) for g, f, s, y in values if (g, f) == (setting, fold)]
        pairs = [(p, n) for p, y in own if y for n, z in own if not z]
        if pairs:
            assert r.roc_auc == pytest.approx(sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs))
        assert r.accuracy == pytest.approx(sum((s >= 0.5) == bool(y) for s, y in own) / len(own)) and r.positives == sum(y for _, y in own)
    alone = roc_auc(counts_by_score(rows.filter("setting = 'b' AND fold = 1"))).first().roc_auc
    assert alone == pytest.approx(found["b", 1].roc_auc)
    means = {r.setting: (r.folds, r.roc_auc) for r in setting_metrics(fold_metrics(rows)).collect()}
    own = [found["b", f].roc_auc for f in range(3)]
    assert means["b"] == (3, pytest.approx(sum(own) / 3)) and means["a"][0] == 3


def test_tuning_measures_rows_that_the_models_have_not_seen(spark, lake):
    rng = random.Random(1)
    values = []
    for c in range(120):
        churned = float(rng.random() < 0.5)
        values += [(c, S - w * WEEK, 100 * churned + rng.gauss(0, 60), rng.random() < 0.5, rng.choice("mf"), churned) for w in range(3)]
    lake.append(features(spark, values), FEATURES)
    settings = {"plain": SETTINGS["plain"], "lasso": {"regParam": 5.0, "elasticNetParam": 1.0}}  # the latter knows no feature any more
    assert tune(lake, S, settings, folds=3, run_ts=NOW) == "plain"
    found = lake.read(TUNING_RUNS).collect()
    assert {(r.setting, r.fold) for r in found} == {(s, f) for s in settings for f in range(3)}
    assert all(r.roc_auc == 0.5 for r in found if r.setting == "lasso") and sum(r.n_rows for r in found if r.setting == "plain") == 360
    rows = with_fold(lake.read(FEATURES).fillna("unknown").select("customer_id", "snapshot_date", F.col("spent_7d").cast("double"), F.col(LABEL).cast("double")), 3).cache()
    one = held_out_scores(rows, {"plain": {}}).filter("fold = 1")
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol=LABEL, numBins=0).evaluate(one)
    exact = fold_metrics(one).first().roc_auc
    assert exact == pytest.approx(area) and exact > 0.7
    train_and_register(lake, S, run_ts=NOW, setting=settings["lasso"])
    assert lake.read(TRAINING_RUNS).first().params["regParam"] == "5.0"
