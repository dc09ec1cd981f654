"""The physical plans: what is read, what is shuffled, and what never happens."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from churnflow.operators import events as ev
from churnflow.operators import features as ft
from churnflow.operators.evaluation import counts_by_score
from churnflow.operators.merge import survivors
from churnflow.operators.scoring import scenario_grid
from churnflow.plans import update_features
from churnflow.schemas import EVENT_KEY, FEATURE_KEY, FEATURES, LEDGER, PAYMENT_DAYS, PAYMENT_MONTHS, RAW_CUSTOMER_TABLES, RAW_EVENTS, RAW_PAYMENTS, STAGED_EVENTS
from churnflow.sources import Lake
from churnflow.sources.lake import conform, stored_schema
from workload.queries import SCENARIOS, rule_predictions

S = date(2019, 5, 26)
NOW = datetime(2024, 1, 1)


@pytest.fixture
def big(spark):
    """A session that takes every table for a large one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def stored(spark, tmp_path, table):
    path = str(tmp_path / table.zone / table.name)
    spark.createDataFrame([], stored_schema(table)).write.parquet(path)
    return spark.read.schema(stored_schema(table)).parquet(path)


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "SinglePartition"):
        assert unwanted not in text, unwanted
    return text


def exchanges(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_feature_build_shuffles_do_not_grow_with_the_snapshots(big, tmp_path):
    raw = {name: stored(big, tmp_path, table) for name, table in RAW_CUSTOMER_TABLES.items()}
    texts = [
        plan(ft.build_features(raw, [S - timedelta(weeks=w) for w in range(n)], NOW)) for n in (1, 9, 14, 60)]
    # Last days between snapshots, those by customer, payments per day, those by customer, and all other sources.
    assert [exchanges(t) for t in texts] == [5] * 4
    assert all(t.count("SortMergeJoin") == 2 for t in texts)
    assert [len(re.findall(r"FileScan parquet \[.*fecha", t)) for t in texts] == [2] * 4


def test_payment_history_reads_two_columns_and_amounts_only_recent_days(big, tmp_path):
    payments = stored(big, tmp_path, RAW_CUSTOMER_TABLES["payments"]).drop("pay_month")
    scans = [line for line in plan(ft._payers(ft.history_of(payments, [S]), [S])).splitlines() if "FileScan" in line]
    history, = [s for s in scans if "spent" not in s.split("Batched")[0]]
    recent, = [s for s in scans if "spent" in s.split("Batched")[0]]
    assert re.search(r"FileScan parquet \[fecha#\d+,cus_cust_id_buy#\d+L\]", history)
    assert "GreaterThanOrEqual(fecha,2019-02-25)" in recent and "LessThan(fecha,2019-05-26)" in recent
    assert "tpv_segment_detail" not in recent.split("Batched")[0]


def by_month(spark, tmp_path, table, day):
    """The table with a row in each month of seven years, as the lake lays it out."""
    lake = Lake(spark, str(tmp_path))
    months = spark.sql(f"SELECT explode(sequence(DATE '2013-01-15', DATE '2019-12-15', INTERVAL 1 MONTH)) AS {day}, 1L AS cus_cust_id_buy, 1L AS customer_id")
    lake.append(months, table)
    return lake.read(table)


def folders_read(df):
    """How many folders each scan reads."""
    text = plan(df)
    assert text.count("FileScan") == text.count("PartitionFilters: [") and "PartitionFilters: []" not in text
    executed = df._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    leaves = executed.collectLeaves()
    return [leaves.apply(i).metrics().apply("numPartitions").value() for i in range(leaves.size())]


@pytest.mark.parametrize("dates", [[S], [S - timedelta(weeks=w) for w in range(13)], [date(2014, 1, 7) + timedelta(days=33 * i) for i in range(60)]])
def test_windows_read_their_months_only(big, tmp_path, dates):
    big.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dates = sorted(dates)
        wanted = {(d - timedelta(days=n)).replace(day=1) for d in dates for n in range(1, 91)}
        own = {d.replace(day=1) for d in dates}
        raw = ft.history_of(by_month(big, tmp_path, RAW_PAYMENTS, "fecha"), dates)
        assert folders_read(raw.days) == [len(wanted)]
        days, months = (by_month(big, tmp_path, t, d) for t, d in ((PAYMENT_DAYS, "fecha"), (PAYMENT_MONTHS, "last_day")))
        kept = ft.history_from_state(days, months, dates)
        assert folders_read(kept.days) == [len(wanted)]
        assert folders_read(kept.seen) == [84 - len(own), len(own)]
    finally:
        big.conf.unset("spark.sql.adaptive.enabled")


def test_dedupe_reduces_before_its_only_shuffle(big, tmp_path):
    text = plan(ev.stage_events(stored(big, tmp_path, RAW_EVENTS)))
    assert exchanges(text) == 1 and "Window" not in text
    assert text.index("functions=[max(") < text.index("Exchange hashpartitioning") < text.index("functions=[partial_max(")


def in_buckets(spark, root, buckets, **rows):
    lake = Lake(spark, str(root), buckets)
    for name, table in RAW_CUSTOMER_TABLES.items():
        full = [tuple(r.get(c) for c in table.columns) for r in rows.get(name, [])]
        lake.replace(spark.createDataFrame(full, table.schema), table)
    return lake, {name: lake.read(table) for name, table in RAW_CUSTOMER_TABLES.items()}


def test_sources_in_buckets_are_joined_and_aggregated_where_they_are(big, tmp_path):
    one, many = Decimal("1"), range(1, 40)
    rows = {
        "payments": [{"cus_cust_id_buy": c, "fecha": S - timedelta(days=3 * c), "spent": one, "descuento": one} for c in many for _ in range(c % 3 + 1)],
        "marketplace": [{"cus_cust_id_buy": 100 + c} for c in range(5)],
        "active_user": [{"cus_cust_id_buy": c, "mau_mp_1": one, "last_login_mp_date_1": S - timedelta(days=c)} for c in many if c % 2],
        "demographics": [{"cus_cust_id_buy": c, "gender": "m" if c % 3 else None, "estado": "x"} for c in range(20, 60)],
        "balances": [{"cus_cust_id_buy": Decimal(c) - Decimal("0.4"), "plata_cuenta_1": one, "inversion": "Active"} for c in range(1, 70, 7)],
        "outcomes": [{"cus_cust_id_buy": c, "churn": one} for c in (3, 5, 500)],
    }
    dates = [S, S - timedelta(days=30)]
    lake, placed = in_buckets(big, tmp_path / "b", 4, **rows)
    _, plain = in_buckets(big, tmp_path / "p", None, **rows)
    built = ft.build_features(placed, dates, NOW, placed=True)
    assert "Exchange" not in plan(built)
    want = sorted(map(repr, ft.build_features(plain, dates, NOW).collect()))
    assert sorted(map(repr, built.collect())) == want and len(want) > 100
    update_features(lake, dates, NOW)
    assert sorted(map(repr, lake.read(FEATURES).select(*FEATURES.columns).collect())) == want
    again = Lake(big, lake.root)  # a lake without the setting reads, and can lay out anew
    assert again.buckets_of(RAW_PAYMENTS) == 4 and again.read(RAW_PAYMENTS).count() == len(rows["payments"])
    with pytest.raises(ValueError, match="only be replaced as a whole"):
        again.append(again.read(RAW_PAYMENTS).limit(1), RAW_PAYMENTS)
    again.replace(plain["payments"], RAW_PAYMENTS)
    assert again.buckets_of(RAW_PAYMENTS) is None and again.read(RAW_PAYMENTS).count() == len(rows["payments"])


def test_top_rows_and_text_maxima_are_hashed(big, tmp_path):
    texts = [plan(ev.stage_events(stored(big, tmp_path, RAW_EVENTS)))]
    raw = {name: stored(big, tmp_path, table) for name, table in RAW_CUSTOMER_TABLES.items()}
    people = [("x", i, g, a, "c", None) for i, g, a in ((1, "male", "01"), (1, "female", None), (2, None, None))]
    raw["demographics"] = big.createDataFrame(people, RAW_CUSTOMER_TABLES["demographics"].schema)
    texts += [plan(ft.demographics(raw["demographics"])), plan(ft.build_features(raw, [S], NOW))]
    assert all("HashAggregate" in t and "SortAggregate" not in t for t in texts)
    found = {r.customer_id: tuple(r)[1:] for r in ft.demographics(raw["demographics"]).collect()}
    assert found == {1: ("male", "01", "c", None), 2: (None, None, "c", None)}


def test_upsert_shuffles_only_keys_of_the_source(big, tmp_path):
    ledger, staged = stored(big, tmp_path, LEDGER), stored(big, tmp_path, STAGED_EVENTS)
    text = plan(survivors(ledger, staged, EVENT_KEY))
    staged_scan = [line for line in text.splitlines() if "FileScan" in line][1]
    assert exchanges(text) == 2 and "purchase_price" not in staged_scan.split("Batched")[0]


def test_upsert_sends_no_keys_to_every_task(spark, tmp_path):
    """Also where Spark takes both tables for small."""
    for table, key in ((FEATURES, FEATURE_KEY), (LEDGER, EVENT_KEY)):
        target, source = stored(spark, tmp_path / "old", table), stored(spark, tmp_path / "new", table)
        text = plan(survivors(target, source, key))
        assert "Broadcast" not in text and text.count("SortMergeJoin") == 1


def test_first_upsert_joins_nothing(spark, tmp_path, lake):
    source = stored(spark, tmp_path, FEATURES)
    rows = survivors(lake.read_or_empty(FEATURES).filter(F.col("snapshot_date").isin([S])), source, FEATURE_KEY)
    text = plan(conform(source, FEATURES).unionByName(conform(rows, FEATURES)))
    assert "Join" not in text and "Exchange" not in text and text.count("FileScan") == 1


def test_fused_merge_has_one_join(big, tmp_path):
    ledger, staged = stored(big, tmp_path, LEDGER), stored(big, tmp_path, STAGED_EVENTS)
    text = plan(ev.merge_events(ledger, staged, date(2024, 1, 20), NOW))
    assert text.count("SortMergeJoin") == 1 and exchanges(text) == 2


def test_soft_delete_shuffles_only_recent_rows(big, tmp_path):
    ledger, staged = stored(big, tmp_path, LEDGER), stored(big, tmp_path, STAGED_EVENTS)
    text = plan(ev.deactivate_missing(ledger, staged, date(2024, 1, 20), NOW))
    old, recent, keys = [line for line in text.splitlines() if "FileScan" in line]
    assert "LessThan(purchase_date,2024-01-15)" in old
    assert "GreaterThanOrEqual(purchase_date,2024-01-15)" in recent and "GreaterThanOrEqual(purchase_date,2024-01-15)" in keys


def test_scenarios_need_no_join_and_no_shuffle(big, tmp_path):
    text = plan(rule_predictions(scenario_grid(stored(big, tmp_path, FEATURES), SCENARIOS)))
    assert "Join" not in text and "Exchange" not in text


def test_metrics_are_reduced_before_the_shuffle(big, tmp_path):
    text = plan(counts_by_score(rule_predictions(stored(big, tmp_path, FEATURES))))
    assert exchanges(text) == 1 and "partial_count" in text
