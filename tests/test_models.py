from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

import gapped
from churnflow.operators.evaluation import accuracy, counts_by_score, roc_auc
from churnflow.operators.features import build_features
from churnflow.operators.modeling import category_index, churn_estimator, training_set, with_split
from churnflow.operators.registry import PROMOTED, REGISTERED, current_model, model_versions, next_version
from churnflow.operators.scoring import (
    CATEGORY_VALUES,
    FEATURE_DESCRIPTIONS,
    TYPICAL_CUSTOMER,
    apply_threshold,
    category_domain_check,
    feature_catalog,
    prepare_scoring_features,
    scenario_grid,
    score,
)
from churnflow.plans import load_production_model, score_snapshot, train_and_register, update_features
from churnflow.plans.training import fit_and_evaluate
from churnflow.schemas import BINARY_FEATURES, CATEGORICAL_FEATURES, FEATURES, LABEL, MODEL_LOG, NUMERIC_FEATURES, SCORES, TRAINING_RUNS

NOW = datetime(2024, 1, 1)
S = date(2001, 6, 3)
INPUTS = [*NUMERIC_FEATURES, *BINARY_FEATURES, *CATEGORICAL_FEATURES]


@pytest.fixture(scope="module")
def features(spark):
    dates = [S - timedelta(weeks=w) for w in range(9)]
    return build_features(gapped.sources(spark, "0.001"), dates, NOW).cache()


@pytest.fixture(scope="module")
def model(features):
    train = with_split(training_set(features, S)).filter("split = 'train'")
    return churn_estimator(train).fit(train)


def test_training_window_and_label_filter(spark):
    rows = [(1, S), (2, S - timedelta(days=56)), (3, S - timedelta(days=57)), (4, S + timedelta(days=1)), (5, S)]
    df = spark.createDataFrame(rows, "customer_id long, snapshot_date date").withColumn(
        LABEL, F.when(F.col("customer_id") != 5, F.lit(1)).cast("decimal(18,6)"))
    assert sorted(r.customer_id for r in training_set(df, S).collect()) == [1, 2]


def test_training_set_drops_repeats_fills_categories_and_leaves_numbers(spark):
    df = spark.createDataFrame(
        [(1, S, None, None, 1)] * 2, "customer_id long, snapshot_date date, spent_7d decimal(18,2), gender string, labeled_churn int")
    out = training_set(df, S)
    assert [tuple(r) for r in out.collect()] == [(1, S, None, 1.0, "unknown")]
    assert out.columns == ["customer_id", "snapshot_date", "spent_7d", LABEL, "gender"]


def test_split_does_not_depend_on_partitioning(features):
    rows = training_set(features, S)
    a = with_split(rows.repartition(1)).select("customer_id", "snapshot_date", "split")
    b = with_split(rows.repartition(13, "spent_90d")).select("customer_id", "snapshot_date", "split")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    share = a.filter("split = 'train'").count() / a.count()
    assert 0.75 < share < 0.85


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("seed,distinct", [(1, 5), (2, 400), (3, 10**9)])
def test_auc_is_exact(spark, seed, distinct):
    rng = random.Random(seed)
    # A third of all rows share one score; the rest crowd near zero.
    pairs = []
    for i in range(1500):
        s = 0.25 if i % 3 == 0 else (rng.randrange(distinct) / distinct) ** 6
        pairs.append((s, float(rng.random() < 0.3 + 0.4 * s)))
    df = apply_threshold(spark.createDataFrame(pairs, f"score double, {LABEL} double"))
    got = roc_auc(counts_by_score(df)).first().roc_auc
    assert got == pytest.approx(brute_auc(pairs), abs=1e-12)
    exact = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol=LABEL, numBins=0).evaluate(df)
    assert got == pytest.approx(exact, abs=1e-9)
    hits = sum((s >= 0.5) == (y == 1) for s, y in pairs) / len(pairs)
    assert accuracy(counts_by_score(df)).first().accuracy == pytest.approx(hits, abs=1e-12)


def test_auc_of_one_class_is_undefined(spark):
    df = apply_threshold(spark.createDataFrame([(0.1, 1.0), (0.7, 1.0)], f"score double, {LABEL} double"))
    assert roc_auc(counts_by_score(df)).first().roc_auc is None
    assert roc_auc(counts_by_score(df.filter("false"))).first().roc_auc is None


def test_category_index_matches_the_fitted_indexer(features, model):
    train = with_split(training_set(features, S)).filter("split = 'train'")
    mine = {f: [] for f in CATEGORICAL_FEATURES}
    for r in category_index(train).orderBy("feature", "idx").collect():
        mine[r.feature].append(r.label)
    assert [mine[c] for c in CATEGORICAL_FEATURES] == [list(labels) for labels in model.stages[0].labelsArray]


def test_missing_columns_get_defaults(features):
    row = prepare_scoring_features(features.drop("mau_mp_3", "has_inversion", "estado")).first()
    assert (row.mau_mp_3, row.has_inversion, row.estado) == (0.0, 0, "unknown")
    assert prepare_scoring_features(features).columns == [*INPUTS, "customer_id", "snapshot_date"]


def test_unseen_and_missing_categories_and_numbers_are_scored(features, model):
    strange = features.limit(3).withColumns({
        "gender": F.when(F.col("customer_id") % 2 == 0, F.lit("x")), "estado": F.lit(None).cast("string"),
        "spent_7d": F.lit(None).cast("decimal(28,6)")})
    got = score(strange, model, "3", NOW).collect()
    assert len(got) == 3 and all(0 <= r.score <= 1 and r.model_version == "3" for r in got)


def test_threshold_tie_is_positive(spark):
    df = spark.createDataFrame([(0.5,), (0.4999999,), (0.9,)], "score double")
    assert [r.prediction for r in apply_threshold(df).collect()] == [1, 0, 1]
    assert [r.prediction for r in apply_threshold(df, 0.6).collect()] == [0, 0, 1]


def test_saved_model_gives_the_same_scores(features, model, tmp_path):
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    order = lambda m: [r.score for r in score(features, m, "1", NOW).orderBy("customer_id", "snapshot_date").collect()]
    assert order(model) == order(again)


def test_scenarios_override_and_leave_the_rest(features, model):
    grid = scenario_grid(features.limit(4), {"as_is": {}, "typical": TYPICAL_CUSTOMER, "richer": {"plata_cuenta_1": 1e6}})
    assert grid.groupBy("scenario").count().filter("count = 4").count() == 3
    typical = grid.filter("scenario = 'typical'").select(*INPUTS).distinct().collect()
    assert [r.asDict() for r in typical] == [TYPICAL_CUSTOMER]
    by_id = {}
    for r in grid.collect():
        by_id.setdefault((r.customer_id, r.snapshot_date), {})[r.scenario] = r
    for rows in by_id.values():
        assert rows["richer"].plata_cuenta_1 == 1e6 and rows["richer"].spent_90d == rows["as_is"].spent_90d
    scored = score(grid, model, "1", NOW)
    assert scored.count() == 12 and "scenario" in scored.columns
    with pytest.raises(ValueError, match="unknown features"):
        scenario_grid(features, {"bad": {"nothing": 1}})


def test_category_domain(spark):
    df = spark.createDataFrame(
        [("male", "01.Menor de 18 años", "Other", "cordoba"), ("x", None, "Other", "cordoba"), ("x", None, "Gold", "otros"), (None, None, "Other", "otros")],
        "gender string, rango_edad string, tarjetas string, estado string")
    got = sorted(map(tuple, category_domain_check(df).collect()))
    assert got == [("gender", "x", 2), ("rango_edad", "unknown", 3), ("tarjetas", "Gold", 1)]


def test_feature_catalog_covers_the_model_inputs(spark):
    rows = feature_catalog(spark).orderBy("position").collect()
    assert [r.feature for r in rows] == INPUTS == list(FEATURE_DESCRIPTIONS)
    assert {r.feature: r.allowed_values for r in rows if r.allowed_values} == CATEGORY_VALUES


def log(spark, *events):
    rows = [("m", v, f"p{v}", e, NOW + timedelta(days=i)) for i, (v, e) in enumerate(events)]
    return spark.createDataFrame(rows, MODEL_LOG.schema)


def test_promotion_leaves_one_version_in_production(spark):
    events = [(1, REGISTERED), (1, PROMOTED), (2, REGISTERED), (2, PROMOTED), (3, REGISTERED), (3, PROMOTED), (4, REGISTERED)]
    stages = {r.version: r.stage for r in model_versions(log(spark, *events)).collect()}
    assert stages == {1: "Archived", 2: "Archived", 3: "Production", 4: "None"}
    back = log(spark, *events, (1, PROMOTED))
    assert {r.version: r.stage for r in model_versions(back).collect()} == {1: "Production", 2: "Archived", 3: "Archived", 4: "None"}
    assert [(r.version, r.path) for r in current_model(back).collect()] == [(1, "p1")]
    assert next_version(back, "m") == 5 and next_version(back, "other") == 1


def test_train_twice_then_score(spark, lake):
    dates = [S - timedelta(weeks=w) for w in range(3)]
    update_features(lake, dates, NOW, gapped.sources(spark, "0.001"))
    with pytest.raises(RuntimeError, match="no promoted version"):
        score_snapshot(lake, S)
    assert train_and_register(lake, S, run_ts=NOW) == 1
    assert train_and_register(lake, S, lookback_weeks=1, run_ts=NOW + timedelta(days=1)) == 2

    runs = {r.model_version: r for r in lake.read(TRAINING_RUNS).collect()}
    assert runs[1].params["lookback_weeks"] == "8" and runs[2].params["lookback_weeks"] == "1"
    assert runs[1].params["categorical_features"] == "gender,rango_edad,tarjetas,estado"
    assert runs[1].params["numeric_features"].endswith("has_inversion,gender_oh,rango_edad_oh,tarjetas_oh,estado_oh")
    assert runs[1].tags == {"model_version": "1", "production_ready": "True"}
    assert 0 <= runs[1].roc_auc <= 1 and 0 <= runs[1].accuracy <= 1
    assert runs[1].train_rows + runs[1].test_rows == 450 and runs[2].train_rows + runs[2].test_rows == 300
    assert {r.version: r.stage for r in model_versions(lake.read(MODEL_LOG)).collect()} == {1: "Archived", 2: "Production"}

    for _ in range(2):
        assert score_snapshot(lake, S, run_ts=NOW) == 2
    scores = lake.read(SCORES)
    assert scores.count() == 150 and scores.dropDuplicates(["customer_id", "snapshot_date", "model_version"]).count() == 150
    loaded, version = load_production_model(lake)
    assert version == 2
    again = score(lake.read(FEATURES).filter(F.col("snapshot_date") == S), loaded, "2", NOW)
    same = scores.select("customer_id", "score", "prediction").exceptAll(again.select("customer_id", "score", "prediction"))
    assert same.isEmpty()
    with pytest.raises(ValueError, match="the feature table holds nothing"):
        score_snapshot(lake, date(1999, 1, 1))


def test_metrics_agree_with_the_evaluator(features):
    rows = with_split(training_set(features, S)).cache()
    model, metrics = fit_and_evaluate(rows)
    predicted = model.transform(rows.filter("split = 'test'"))
    auc = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0).evaluate(predicted)
    assert metrics["roc_auc"] == pytest.approx(auc, abs=1e-9)
    hit = predicted.select(F.avg((F.col("prediction") == F.col(LABEL)).cast("double"))).first()[0]
    assert metrics["accuracy"] == pytest.approx(hit, abs=1e-12)
    rates = {r.split: r[1] for r in rows.groupBy("split").agg(F.avg(LABEL)).collect()}
    assert metrics["positive_rate_train"] == rates["train"] and metrics["positive_rate_test"] == rates["test"]


def test_empty_split_is_reported(spark, features):
    with pytest.raises(ValueError, match="split is empty"):
        fit_and_evaluate(with_split(training_set(features.filter("false"), S)))
