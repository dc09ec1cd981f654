"""Every query over the test tables: ``name -> function(spark, sf_dir) -> DataFrame``.

Results are given in plain types (decimals as double, integers as bigint) and without audit
timestamps, so that they can be compared with those of another SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegerType, TimestampType

from churnflow.functions import date_literal, latest_date, timestamp_literal
from churnflow.operators import events as ev
from churnflow.operators import features as ft
from churnflow.operators import quality as dq
from churnflow.operators.evaluation import accuracy, counts_by_score, roc_auc
from churnflow.operators.labels import with_labels
from churnflow.operators.modeling import (
    category_index,
    category_stages,
    split_summary,
    training_set,
    with_split,
)
from churnflow.operators.monitoring import DISTINCT_ERROR, QUANTILES, RANK_ERROR, bin_counts, described, drift, feature_values, profile
from churnflow.operators.registry import PROMOTED, REGISTERED, current_model, model_versions
from churnflow.operators.scoring import (
    SCENARIO,
    TYPICAL_CUSTOMER,
    apply_threshold,
    category_domain_check,
    prepare_scoring_features,
    scenario_grid,
    score_output,
)
from churnflow.operators.tuning import fold_metrics, with_fold
from churnflow.plans import score_scenarios, score_snapshot, train_and_register, update_features, update_ledger
from churnflow.plans.training import MODEL_NAME
from churnflow.schemas import (
    CATEGORICAL_FEATURES,
    EVENT_KEY,
    FEATURE_KEY,
    FEATURES,
    LABEL,
    LEDGER,
    MODEL_LOG,
    PRICE,
    RAW_EVENTS,
    RAW_OUTCOMES,
    RAW_PAYMENTS,
    SCORES,
    TRAINING_RUNS,
    UNITS,
    UNKNOWN,
)
from churnflow.sources import Lake, literal_rows, param_query, read_snapshot, read_window, stage, staged
from workload.adapters import customer_sources, view
from workload.stored import RUN_TS, SNAPSHOT, WEEKS, feature_lake, feature_table, new_lake

DS = date(2024, 1, 20)
AS_OF = date(2024, 1, 31)
EARLY_AS_OF = date(2024, 1, 26)
LATER = date(2001, 6, 10)
EARLIER_RUN_TS = datetime(2024, 1, 19, 6, 0, 0)

# The golden event rows (the last one repeats the fourth).
SEED_EVENTS = [
    ("ARGENTINA", 100000, "1/1/2023", "BTC", "20000", "2"),
    ("ARGENTINA", 100012, "1/1/2023", "BTC", "20010", "1.4"),
    ("BRASIL", 200234, "1/1/2023", "BTC", "20200", "0.5"),
    ("BRASIL", 200234, "1/2/2023", "ETH", "1200", "1.3"),
    ("ARGENTINA", 105013, "2/1/2023", "USDC", "1", "4000"),
    ("ARGENTINA", 116821, "2/1/2023", "ETH", "1350", "0.5"),
    ("ARGENTINA", 143159, "2/1/2023", "BTC", "19983", "5"),
    ("ARGENTINA", 132169, "2/1/2023", "ETH", "1246", "1.2"),
    ("MEXICO", 315951, "3/1/2023", "BTC", "20200", "0.5"),
    ("MEXICO", 356479, "14/1/2023", "ETH", "1200", "1.3"),
    ("BRASIL", 200234, "1/1/2023", "USDC", "1", "5500"),
    ("BRASIL", 200234, "1/2/2023", "ETH", "1200", "1.3"),
]

NO_SPEND = {
    "spent_7d": 0.0, "spent_30d": 0.0, "spent_90d": 0.0, "payments_30d": 0.0, "payments_90d": 0.0,
    "total_discount_30d": 0.0,
}
SCENARIOS = {"as_is": {}, "no_spend": NO_SPEND, "typical": TYPICAL_CUSTOMER}


def plain(df: DataFrame) -> DataFrame:
    def cast(name: str, kind) -> Column:
        if isinstance(kind, DecimalType):
            return F.col(name).cast("double").alias(name)
        if isinstance(kind, IntegerType):
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*(cast(f.name, f.dataType) for f in df.schema.fields if not isinstance(f.dataType, TimestampType)))


def seed_events(spark: SparkSession) -> DataFrame:
    text = literal_rows(
        spark, SEED_EVENTS,
        "site_id string, user_id bigint, purchase_date string, crypto_type string, price string, units string")
    return text.select(
        "site_id", "user_id", "purchase_date", "crypto_type",
        F.col("price").cast(RAW_EVENTS.schema["purchase_price"].dataType).alias("purchase_price"),
        F.col("units").cast(RAW_EVENTS.schema["purchase_units"].dataType).alias("purchase_units"))


def stored_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as of the run date: older prices, and sign-ups switched off by an earlier run."""
    known = ev.stage_events(view(spark, sf_dir, "raw_crypto")).filter(F.col("purchase_date") <= date_literal(DS))
    old_price = (F.col("purchase_price") * F.lit("0.9").cast("decimal(2,1)")).cast(PRICE)
    return known.withColumn("purchase_price", old_price).select(
        *EVENT_KEY, "purchase_price", "purchase_units",
        (F.col("purchase_price") * F.col("purchase_units")).cast(UNITS).alias("purchase_value"),
        (F.col("crypto_type") != "SIGNUP").alias("is_active"),
        timestamp_literal(EARLIER_RUN_TS).alias("updated_at"))


def ledger_lake(spark: SparkSession, sf_dir: str) -> Lake:
    lake = new_lake(spark)
    lake.append(stored_ledger(spark, sf_dir), LEDGER)
    return lake


def incoming_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Today's full reload of the source, from which one type was withdrawn."""
    return view(spark, sf_dir, "raw_crypto").filter(F.col("crypto_type") != "error")


def with_refresh(ledger: DataFrame) -> DataFrame:
    """Ledger rows, with ``refreshed`` in place of the update time."""
    return plain(ledger.drop("purchase_month").withColumn("refreshed", F.col("updated_at") == timestamp_literal(RUN_TS)))


def rule_score() -> Column:
    """A score any SQL engine computes to the last bit: half from inactivity, half from lack of spend."""
    idle = F.least(F.greatest(F.col("days_since_activity"), F.lit(0)), F.lit(120)).cast("double") / F.lit(240.0)
    spent = F.least(F.col("spent_90d").cast("double"), F.lit(1000000.0)) / F.lit(2000000.0)
    return idle + (F.lit(0.5) - spent)


def rule_predictions(rows: DataFrame) -> DataFrame:
    return apply_threshold(rows.withColumn("score", rule_score()))


def rule_probability(rows: DataFrame) -> DataFrame:
    """The score as a fitted classifier gives it: a vector of both class probabilities."""
    chance = rule_score()
    return rows.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - chance, chance)))


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_split(training_set(feature_table(spark, sf_dir), SNAPSHOT, keys_unique=True))


def held_out_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = training_rows(spark, sf_dir).filter(F.col("split") == "test")
    return stage(counts_by_score(rule_predictions(test)), "counts-by-score")


def _clean_events(spark, d):
    return plain(ev.clean_events(view(spark, d, "raw_crypto")))


def _dedupe_latest(spark, d):
    return plain(ev.stage_events(view(spark, d, "raw_crypto")))


def _seed_literal_rows(spark, d):
    raw = view(spark, d, "raw_crypto").unionByName(seed_events(spark))
    return plain(ev.stage_events(raw))


def _param_query(spark, d):
    return plain(param_query(
        spark,
        """SELECT cus_cust_id_buy AS customer_id, COUNT(*) AS n_payments, SUM(spent) AS spent
           FROM {payments}
           WHERE fecha BETWEEN :first AND :last AND spent >= :least
           GROUP BY cus_cust_id_buy""",
        {"first": date(2000, 6, 1), "last": date(2001, 5, 31), "least": 250000},
        payments=view(spark, d, "raw_payments")))


def _snapshot_read(spark, d):
    return plain(read_snapshot(feature_table(spark, d), date(2001, 5, 6)))


def _lookback_window(spark, d):
    window = read_window(feature_table(spark, d), date(2001, 5, 27), 3)
    return plain(window.select(*FEATURE_KEY, "spent_30d", "days_since_activity", LABEL))


def _dq_staging(spark, d):
    return dq.count_broken(ev.stage_events(view(spark, d, "raw_crypto")), dq.staged_event_checks(EARLY_AS_OF))


def _dq_features(spark, d):
    return dq.snapshot_summary(feature_table(spark, d))


def _dq_not_null(spark, d):
    raw = view(spark, d, "raw_crypto")
    raw_checks = [dq.Check(f"raw.{c}", F.col(c).isNull()) for c in dq.STAGED_REQUIRED]
    return (
        dq.count_broken(raw, raw_checks)
        .unionByName(dq.count_broken(stored_ledger(spark, d), dq.not_null_checks(LEDGER)))
        .unionByName(dq.count_broken(feature_table(spark, d), dq.not_null_checks(FEATURES))))


def _dq_unique_key(spark, d):
    cleaned = ev.clean_events(view(spark, d, "raw_crypto"))

    def named(name: str, df: DataFrame, key) -> DataFrame:
        return dq.key_repeats(df, key).select(F.lit(name).alias("table_name"), "repeated_keys", "surplus_rows")

    return (
        named("cleaned events", cleaned, EVENT_KEY)
        .unionByName(named("staged events", ev.dedupe_latest(cleaned), EVENT_KEY))
        .unionByName(named("features", feature_table(spark, d), FEATURE_KEY)))


def _missing_from_source(spark, d):
    staged = ev.stage_events(incoming_events(spark, d))
    return plain(ev.missing_from_source(stored_ledger(spark, d), staged, DS))


def _upsert_ledger(spark, d):
    lake = ledger_lake(spark, d)
    with staged(ev.stage_events(incoming_events(spark, d)), "staged-events") as events:
        lake.upsert(ev.as_ledger_rows(events, RUN_TS), LEDGER, F.lit(True))
    return with_refresh(lake.read(LEDGER))


def _deactivate_missing(spark, d):
    staged = ev.stage_events(incoming_events(spark, d))
    return with_refresh(ev.deactivate_missing(stored_ledger(spark, d), staged, DS, RUN_TS))


def _event_etl(spark, d):
    lake = ledger_lake(spark, d)
    update_ledger(lake, DS, AS_OF, RUN_TS, incoming_events(spark, d))
    return with_refresh(lake.read(LEDGER))


def _upsert_features(spark, d):
    raw = customer_sources(spark, d)
    raw["outcomes"] = literal_rows(spark, [], RAW_OUTCOMES.schema)  # a re-run that knows no outcomes
    lake = new_lake(spark)
    lake.append(feature_table(spark, d), FEATURES)
    update_features(lake, [SNAPSHOT, LATER], RUN_TS, raw)
    return plain(lake.read(FEATURES))


def _replace_slice(spark, d):
    rows = feature_table(spark, d)
    lake = new_lake(spark)
    for version in ("1", "2"):
        lake.append(score_output(rule_probability(rows), version, EARLIER_RUN_TS), SCORES)
    rescored = rule_probability(read_snapshot(rows, SNAPSHOT).withColumn("spent_90d", F.lit(0)))
    lake.replace_partitions(score_output(rescored, "2", RUN_TS), SCORES)
    return plain(lake.read(SCORES))


def _customer_base(spark, d):
    return ft.customer_base(customer_sources(spark, d))


def _payment_metrics(spark, d):
    return plain(ft.payment_metrics(view(spark, d, "raw_payments"), [SNAPSHOT]))


def _activity_metrics(spark, d):
    return plain(ft.activity_metrics(view(spark, d, "raw_active_user")))


def _balance_metrics(spark, d):
    return plain(ft.balance_metrics(view(spark, d, "raw_dinero_cuenta")))


def _demographics(spark, d):
    return ft.demographics(view(spark, d, "raw_demograficos"))


def _marketplace_metrics(spark, d):
    return plain(ft.marketplace_metrics(view(spark, d, "raw_marketplace_data")))


def _feature_build(spark, d):
    return plain(ft.build_features(customer_sources(spark, d), [SNAPSHOT], RUN_TS))


def _multi_snapshot_features(spark, d):
    return plain(ft.build_features(customer_sources(spark, d), WEEKS, RUN_TS))


def _incremental_features(spark, d):
    """Three weekly runs that keep payment totals: the first takes the history in, the others one week each."""
    lake, raw = new_lake(spark), customer_sources(spark, d)
    lake.replace(raw.pop("payments"), RAW_PAYMENTS)
    for week in WEEKS[-3:]:
        update_features(lake, [week], RUN_TS, raw, incremental=True)
    return plain(lake.read(FEATURES))


def _churn_label(spark, d):
    activity = feature_table(spark, d).select(
        *FEATURE_KEY, latest_date(F.col("last_payment_date"), F.col("last_login_date")).alias("last_activity_date"))
    return plain(with_labels(activity, view(spark, d, "raw_evaluate")))


def _training_set(spark, d):
    return plain(training_set(feature_table(spark, d), SNAPSHOT))


def _deterministic_split(spark, d):
    return training_rows(spark, d).select(*FEATURE_KEY, "split")


def _split_counts(spark, d):
    return split_summary(training_rows(spark, d)).select("split", "n_rows")


def _positive_rate(spark, d):
    return split_summary(training_rows(spark, d)).select("split", "positive_rate")


def _accuracy(spark, d):
    return accuracy(held_out_by_score(spark, d))


def _roc_auc(spark, d):
    return roc_auc(held_out_by_score(spark, d)).select(F.round("roc_auc", 6).alias("roc_auc"))


def _training_metrics(spark, d):
    by_score = held_out_by_score(spark, d)
    return split_summary(training_rows(spark, d)).agg(
        F.max(F.when(F.col("split") == "train", F.col("positive_rate"))).alias("positive_rate_train"),
        F.max(F.when(F.col("split") == "test", F.col("positive_rate"))).alias("positive_rate_test"),
    ).select(
        F.round(roc_auc(by_score).scalar(), 6).alias("roc_auc"),
        accuracy(by_score).scalar().alias("accuracy"),
        "positive_rate_train", "positive_rate_test")


def _string_index(spark, d):
    return plain(category_index(feature_table(spark, d)))


def _one_hot(spark, d):
    rows = feature_table(spark, d).fillna(UNKNOWN, subset=CATEGORICAL_FEATURES)
    fitted = Pipeline(stages=category_stages(CATEGORICAL_FEATURES)).fit(rows)
    sizes = dict(zip(CATEGORICAL_FEATURES, fitted.stages[-1].categorySizes))
    arrays = fitted.transform(rows).select(
        *FEATURE_KEY, *(vector_to_array(f"{c}_oh").alias(c) for c in CATEGORICAL_FEATURES))
    return arrays.select(*FEATURE_KEY, *(
        F.col(c)[slot].cast("bigint").alias(f"{c}_{slot}") for c in CATEGORICAL_FEATURES for slot in range(sizes[c])))


def model_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per means of payment and one version per snapshot; all but the last were promoted."""
    trained = feature_table(spark, sf_dir).groupBy("tarjetas", "snapshot_date").agg(F.avg(LABEL).alias("rate"))
    week = F.col("snapshot_date")
    version = (F.date_diff(week, date_literal(WEEKS[0])) / 7 + 1).cast("int")
    events = F.when(week < date_literal(SNAPSHOT), F.array(F.lit(REGISTERED), F.lit(PROMOTED))).otherwise(
        F.array(F.lit(REGISTERED)))
    name = F.concat(F.lit("churn-"), F.lower("tarjetas"))
    return trained.select(
        name.alias("model_name"), version.alias("version"),
        F.concat(name, F.lit("/v="), version.cast("string"), F.lit("/rate="),
                 F.round(F.col("rate").cast("double"), 4).cast("string")).alias("path"),
        F.explode(events).alias("event"), week.cast("timestamp").alias("logged_at"))


def _promote_model(spark, d):
    return plain(model_versions(model_log(spark, d)).drop("path"))


def _current_model(spark, d):
    return plain(current_model(model_log(spark, d)).drop("path"))


def _prepare_scoring_features(spark, d):
    lacking = feature_table(spark, d).drop("mau_mp_3", "has_inversion", "estado")
    return plain(prepare_scoring_features(lacking))


def _apply_threshold(spark, d):
    rows = feature_table(spark, d).withColumn("score", rule_score())
    return plain(apply_threshold(rows, 0.5).select(*FEATURE_KEY, "score", "prediction"))


def _score_output(spark, d):
    return plain(score_output(rule_probability(feature_table(spark, d)), "7", RUN_TS))


def _scenario_grid(spark, d):
    grid = scenario_grid(feature_table(spark, d), SCENARIOS)
    return plain(rule_predictions(grid).select(
        *FEATURE_KEY, SCENARIO, "spent_90d", "mau_mp_3", "has_inversion", "gender", "tarjetas", "score", "prediction"))


def _category_domain_check(spark, d):
    return category_domain_check(feature_table(spark, d))


def _train_and_score(spark, d):
    """Fit, register and promote a model on the stored features, then score the last snapshot with it."""
    lake = feature_lake(spark, d)
    train_and_register(lake, SNAPSHOT, run_ts=RUN_TS)
    version = score_snapshot(lake, SNAPSHOT, run_ts=RUN_TS)
    scores = lake.read(SCORES).filter((F.col("model_version") == str(version)) & (F.col("snapshot_date") == date_literal(SNAPSHOT)))
    # What holds for any fitted model: one row a customer, a chance, the decision made from it, and its registration.
    promotions = lake.read(MODEL_LOG).filter((F.col("version") == version) & (F.col("event") == PROMOTED)).count()
    runs = lake.read(TRAINING_RUNS).filter(F.col("model_version") == version).count()
    return scores.select(
        *FEATURE_KEY, F.col("score").between(0, 1).alias("score_is_a_chance"),
        (F.col("prediction") == (F.col("score") >= 0.5).cast("int")).alias("prediction_follows"),
        F.lit(promotions).cast("bigint").alias("promotions"), F.lit(runs).cast("bigint").alias("runs"))


# Fixed coefficients of a model for scoring that SQL can follow; the intercept is the last.
MODEL_WEIGHTS = {"days_since_activity": 0.011, "spent_90d": -0.0000021, "payments_30d": -0.23, "mau_mp_1": -0.05, "has_inversion": -0.31}
MODEL_INTERCEPT = -0.4


def fixed_model_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake with one feature snapshot and, promoted, a logistic model of the fixed coefficients."""
    lake = new_lake(spark)
    lake.append(read_snapshot(feature_table(spark, sf_dir), SNAPSHOT), FEATURES)
    context = spark.sparkContext
    weights = _py2java(context, Vectors.dense(list(MODEL_WEIGHTS.values())))
    made = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel("fixed", weights, MODEL_INTERCEPT)
    model = PipelineModel([
        VectorAssembler(inputCols=list(MODEL_WEIGHTS), outputCol="features"), LogisticRegressionModel._from_java(made)])
    path = f"{lake.root}/models/{MODEL_NAME}/v=1"
    model.write().save(path)
    events = [(MODEL_NAME, 1, path, event, RUN_TS) for event in (REGISTERED, PROMOTED)]
    lake.append(spark.createDataFrame(events, MODEL_LOG.schema), MODEL_LOG)
    return lake


def _rounded(scores: DataFrame) -> DataFrame:
    return plain(scores.withColumn("score", F.round("score", 9)).drop("created_at"))


def _score_with_model(spark, d):
    lake = fixed_model_lake(spark, d)
    score_snapshot(lake, SNAPSHOT, run_ts=RUN_TS)
    return _rounded(lake.read(SCORES))


def _what_if_scores(spark, d):
    return _rounded(score_scenarios(fixed_model_lake(spark, d), SNAPSHOT, SCENARIOS, run_ts=RUN_TS))


def _exact_numbers(spark, d):
    """Prices of 12 digits behind the point and account ids of 5, each rounded once."""
    events = view(spark, d, "raw_crypto").withColumn(
        "purchase_price", F.col("purchase_price") + F.lit("0.000049960004").cast("decimal(18,12)"))
    accounts = view(spark, d, "raw_dinero_cuenta").withColumn(
        "cus_cust_id_buy", F.col("cus_cust_id_buy") + F.lit("0.89996").cast("decimal(6,5)"))
    prices = ev.clean_events(events).groupBy("purchase_price").agg(F.count("*").alias("n"))
    ids = ft.balance_metrics(accounts).select(F.col("customer_id").cast("decimal(18,4)").alias("number"), F.lit(1).cast("bigint").alias("n"))
    return plain(prices.select(F.lit("price").alias("kind"), F.col("purchase_price").alias("number"), "n").unionByName(ids.select(F.lit("id").alias("kind"), "number", "n")))


# Fixed bin edges of the drift measure.
DRIFT_EDGES = {
    **{c: (1.0, 50_000.0, 100_000.0, 200_000.0, 400_000.0) for c in ("spent_7d", "spent_30d", "spent_90d")},
    **{c: (1.0, 2.0, 4.0, 6.0) for c in ("payments_30d", "payments_90d")},
    "total_discount_30d": (1.0, 2_000.0, 8_000.0, 20_000.0),
    **{c: (1.0, 2.0, 3.0, 5.0, 8.0) for c in ("mau_mp_1", "mau_ml_1", "mau_mp_3", "mau_ml_3")},
    **{c: (-500.0, 0.0, 1_000.0, 5_000.0, 9_000.0) for c in ("plata_cuenta_1", "plata_cuenta_2")},
    "days_since_activity": (0.0, 7.0, 15.0, 30.0, 60.0, 120.0, 365.0), "has_inversion": (1.0,),
}


def _drift_psi(spark, d):
    found = drift(bin_counts(feature_table(spark, d), DRIFT_EDGES), WEEKS[0])
    return plain(found.withColumn("psi", F.round("psi", 9)))


def _feature_profile(spark, d):
    """The exact figures, and whether the sketches keep to their errors, by ranks and distinct values counted in full."""
    rows = feature_table(spark, d)
    found = described(profile(rows))
    key = ["snapshot_date", "feature"]
    near = feature_values(rows).join(F.broadcast(found.select(*key, "quantiles")), key).groupBy(*key).agg(
        F.count("number").alias("n"), F.count_distinct(F.coalesce("label", F.col("number").cast("string"))).alias("n_distinct"),
        *(F.count_if(F.col("number") < F.col("quantiles")[i]).alias(f"below_{i}") for i in range(len(QUANTILES))),
        *(F.count_if(F.col("number") <= F.col("quantiles")[i]).alias(f"upto_{i}") for i in range(len(QUANTILES))))
    ranks = [(F.col(f"below_{i}") <= F.col("n") * (q + RANK_ERROR)) & (F.col(f"upto_{i}") >= F.col("n") * (q - RANK_ERROR)) for i, q in enumerate(QUANTILES)]
    distinct = F.abs(F.col("distinct_values") - F.col("n_distinct")) <= F.col("n_distinct") * DISTINCT_ERROR
    return plain(found.join(near, key).select(
        *key, "n_rows", "missing", "zeros", "least", "greatest", F.round("mean", 5).alias("mean"), F.round("stddev", 3).alias("stddev"),
        reduce(lambda a, b: a & b, ranks).alias("quantiles_hold"), distinct.alias("distinct_holds")))


FOLDS = 5


def _customer_folds(spark, d):
    return plain(with_fold(training_rows(spark, d), FOLDS).select(*FEATURE_KEY, "fold"))


def _cross_validation(spark, d):
    """Metrics of every fold for three formulas in place of fitted models."""
    rows = with_fold(training_rows(spark, d), FOLDS)
    idle, spent = rule_score(), F.least(F.col("spent_90d").cast("double"), F.lit(1000000.0)) / F.lit(2000000.0)
    formulas = {"both": idle, "idle": idle - F.lit(0.5) + spent + F.lit(0.25), "spend": F.lit(0.75) - spent}
    grid = rows.select("fold", LABEL, F.inline(F.array(*(
        F.struct(F.lit(name).alias("setting"), F.round(score, 9).alias("score")) for name, score in formulas.items()))))
    return plain(fold_metrics(apply_threshold(grid)).withColumn("roc_auc", F.round("roc_auc", 6)))


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "seed_literal_rows": _seed_literal_rows,
    "param_query": _param_query,
    "snapshot_read": _snapshot_read,
    "lookback_window": _lookback_window,
    "clean_events": _clean_events,
    "dedupe_latest": _dedupe_latest,
    "dq_staging": _dq_staging,
    "dq_features": _dq_features,
    "dq_not_null": _dq_not_null,
    "dq_unique_key": _dq_unique_key,
    "missing_from_source": _missing_from_source,
    "upsert_ledger": _upsert_ledger,
    "upsert_features": _upsert_features,
    "deactivate_missing": _deactivate_missing,
    "replace_slice": _replace_slice,
    "event_etl": _event_etl,
    "customer_base": _customer_base,
    "payment_metrics": _payment_metrics,
    "activity_metrics": _activity_metrics,
    "balance_metrics": _balance_metrics,
    "demographics": _demographics,
    "marketplace_metrics": _marketplace_metrics,
    "feature_build": _feature_build,
    "incremental_features": _incremental_features,
    "churn_label": _churn_label,
    "multi_snapshot_features": _multi_snapshot_features,
    "training_set": _training_set,
    "deterministic_split": _deterministic_split,
    "split_counts": _split_counts,
    "positive_rate": _positive_rate,
    "accuracy": _accuracy,
    "roc_auc": _roc_auc,
    "string_index": _string_index,
    "one_hot": _one_hot,
    "training_metrics": _training_metrics,
    "promote_model": _promote_model,
    "current_model": _current_model,
    "prepare_scoring_features": _prepare_scoring_features,
    "apply_threshold": _apply_threshold,
    "score_output": _score_output,
    "scenario_grid": _scenario_grid,
    "category_domain_check": _category_domain_check,
    "train_and_score": _train_and_score,
    "score_with_model": _score_with_model,
    "what_if_scores": _what_if_scores,
    "exact_numbers": _exact_numbers,
    "drift_psi": _drift_psi,
    "feature_profile": _feature_profile,
    "customer_folds": _customer_folds,
    "cross_validation": _cross_validation,
}
