from __future__ import annotations

import random
import re
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import gapped
from churnflow.operators import features as ft
from churnflow.operators.labels import with_labels
from churnflow.operators.merge import upsert
from churnflow.operators.quality import DataQualityError
from churnflow.plans import payments_covered_until, update_features, update_payment_totals
from churnflow.schemas import FEATURE_KEY, FEATURES, RAW_CUSTOMER_TABLES, RAW_PAYMENTS
from churnflow.sources import Lake

NOW = datetime(2024, 1, 1)
S = date(2019, 5, 26)


def tables(spark, **rows):
    """Raw tables from dicts; columns not given are NULL."""
    made = {}
    for name, table in RAW_CUSTOMER_TABLES.items():
        full = [tuple(r.get(c) for c in table.columns) for r in rows.get(name, [])]
        made[name] = spark.createDataFrame(full, table.schema)
    return made


def pay(customer, day, spent="10", discount="1"):
    return {"cus_cust_id_buy": customer, "fecha": day, "spent": spent and Decimal(spent), "descuento": discount and Decimal(discount)}


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


def plain(df):
    return sorted(map(tuple, df.drop("created_at").collect()), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_feature_totals(spark, sf):
    built = ft.build_features(gapped.sources(spark, sf), [date(2001, 6, 3)], NOW)
    row = built.agg(
        F.count("*").alias("customers"),
        *(F.sum(c).cast("decimal(28,2)").cast("string").alias(c) for c in ("spent_7d", "spent_90d", "total_discount_30d", "plata_cuenta_2")),
        F.sum("payments_30d").alias("payments_30d"),
        *(F.sum(c).cast("bigint").alias(c) for c in ("mau_mp_1", "labeled_churn")),
        F.count_if("has_inversion").alias("has_inversion"),
        F.count("last_payment_date").alias("last_payment_date"),
        F.count("last_login_date").alias("last_login_date"),
        F.min("days_since_activity").alias("days_min"),
        F.max("days_since_activity").alias("days_max"),
        F.sum("days_since_activity").alias("days_sum"),
    ).first()
    assert row.asDict() == gapped.FEATURE_TOTALS[sf]


def test_several_snapshots_equal_single_builds(spark):
    raw = gapped.sources(spark, "0.001")
    dates = [date(2001, 6, 3) - timedelta(weeks=w) for w in (0, 1, 2, 17, 60, 400)]
    together = ft.build_features(raw, dates, NOW)
    apart = [r for d in dates for r in plain(ft.build_features(raw, [d], NOW))]
    assert plain(together) == sorted(apart, key=repr)


def test_many_snapshots_equal_a_single_build(spark):
    raw = gapped.sources(spark, "0.001")
    dates = [date(2001, 6, 3) - timedelta(weeks=w) for w in range(15)]
    built = ft.build_features(raw, dates, NOW)
    assert built.groupBy("snapshot_date").count().filter("count = 150").count() == len(dates)
    last = built.filter(F.col("snapshot_date") == dates[-1])
    assert plain(last) == plain(ft.build_features(raw, dates[-1:], NOW))


def test_spend_grows_with_the_window(spark):
    built = ft.build_features(gapped.sources(spark, "0.001"), [date(2001, 6, 3)], NOW)
    assert built.filter("spent_7d > spent_30d OR spent_30d > spent_90d OR payments_30d > payments_90d").count() == 0


def test_payment_metrics_against_brute_force(spark):
    rng = random.Random(5)
    # Customer 1 holds a third of all payments; some amounts and some ids are missing.
    payments = [
        pay(rng.choice([1, 1, 2, 3, 4, None]), S + timedelta(days=rng.randint(-400, 10)),
            rng.choice([None, f"{rng.randint(1, 9999)}.25"]), rng.choice([None, "0.10"]))
        for _ in range(600)
    ]
    payments.append(pay(77, S))  # paid on the snapshot date only
    dates = [S, S - timedelta(weeks=1), S - timedelta(weeks=20)]
    got = {
        (r.customer_id, r.snapshot_date): r.asDict()
        for r in ft.payment_metrics(tables(spark, payments=payments)["payments"], dates).collect()
    }
    want = {}
    for d in dates:
        for c in {p["cus_cust_id_buy"] for p in payments}:
            mine = [p for p in payments if p["cus_cust_id_buy"] == c and p["fecha"] < d]
            if not mine:
                continue

            def total(column, days):
                found = [p[column] for p in mine if p["fecha"] >= d - timedelta(days=days) and p[column] is not None]
                return sum(found) if found else None

            want[(c, d)] = {
                "customer_id": c, "snapshot_date": d, "last_payment_date": max(p["fecha"] for p in mine),
                **{f"spent_{n}d": total("spent", n) for n in (7, 30, 90)},
                **{f"discount_{n}d": total("descuento", n) for n in (30, 90)},
                **{f"payments_{n}d": sum(p["fecha"] >= d - timedelta(days=n) for p in mine) for n in (30, 90)},
            }
    assert got == want


def test_windows_are_half_open(spark):
    payments = [pay(1, S - timedelta(days=n), str(10 ** i)) for i, n in enumerate((0, 1, 7, 8, 30, 31, 90, 91))]
    row = one(ft.payment_metrics(tables(spark, payments=payments)["payments"], [S]))
    assert (row.spent_7d, row.spent_30d, row.spent_90d) == (110, 11110, 1111110)
    assert (row.payments_30d, row.payments_90d, row.last_payment_date) == (4, 6, S - timedelta(days=1))


def test_known_user_without_logins_or_payments(spark):
    row = one(ft.build_features(tables(spark, active_user=[{"cus_cust_id_buy": 5}]), [S], NOW))
    assert (row.last_login_date, row.last_payment_date, row.labeled_churn) == (date(1970, 1, 1), None, 1)
    assert row.days_since_activity == (S - date(1970, 1, 1)).days
    assert (row.spent_90d, row.payments_90d, row.mau_mp_1, row.has_inversion, row.gender) == (0, 0, 0, False, None)


def test_customer_known_only_from_demographics_has_no_login_date(spark):
    row = one(ft.build_features(tables(spark, demographics=[{"cus_cust_id_buy": 5, "gender": "male"}]), [S], NOW))
    assert (row.last_login_date, row.gender, row.labeled_churn) == (None, "male", 1)


def test_label_rule_and_precedence(spark):
    raw = tables(
        spark,
        payments=[pay(1, S - timedelta(days=59)), pay(2, S - timedelta(days=60)), pay(3, S - timedelta(days=1)), pay(4, S - timedelta(days=1))],
        outcomes=[{"cus_cust_id_buy": 3, "churn": Decimal(1)}, {"cus_cust_id_buy": 4, "churn": None}, {"cus_cust_id_buy": 99, "churn": Decimal(1)}],
    )
    labels = {r.customer_id: int(r.labeled_churn) for r in ft.build_features(raw, [S], NOW).collect()}
    assert labels == {1: 0, 2: 1, 3: 1, 4: 0}  # a known outcome wins, and adds no customer of its own


def test_activity_after_the_snapshot_counts(spark):
    raw = tables(spark, active_user=[{"cus_cust_id_buy": 1, "last_login_ml_date_1": S + timedelta(days=10)}])
    assert one(ft.build_features(raw, [S], NOW)).days_since_activity == -10


def test_attributes_are_maximised_separately_and_ids_rounded(spark):
    raw = tables(
        spark,
        demographics=[{"cus_cust_id_buy": 1, "gender": "male", "estado": "a"}, {"cus_cust_id_buy": 1, "gender": "female", "estado": "b"}],
        balances=[
            {"cus_cust_id_buy": Decimal("0.6"), "plata_cuenta_1": Decimal(5), "inversion": "none"},
            {"cus_cust_id_buy": Decimal("1.4"), "plata_cuenta_2": Decimal(7), "inversion": "InVested"},
        ],
    )
    row = one(ft.build_features(raw, [S], NOW))
    assert (row.customer_id, row.gender, row.estado, row.plata_cuenta_1, row.plata_cuenta_2, row.has_inversion) == (1, "male", "b", 5, 7, True)


def test_future_payments_make_a_customer_without_metrics(spark):
    row = one(ft.build_features(tables(spark, payments=[pay(1, S), pay(1, None)]), [S], NOW))
    assert (row.customer_id, row.last_payment_date, row.payments_90d) == (1, None, 0)


def test_several_outcomes_for_a_customer_fail(spark):
    raw = tables(spark, payments=[pay(1, S - timedelta(days=1))], outcomes=[{"cus_cust_id_buy": 1, "churn": Decimal(1)}] * 2)
    with pytest.raises(PySparkException, match="several known outcomes for customer 1"):
        ft.build_features(raw, [S], NOW).collect()


@pytest.mark.parametrize("source", ["payments", "active_user", "balances", "marketplace", "demographics"])
def test_missing_customer_id_fails(spark, source):
    with pytest.raises(PySparkException, match="no customer id"):
        ft.build_features(tables(spark, **{source: [{}]}), [S], NOW).collect()


def test_base_is_the_union_of_five_sources(spark):
    raw = tables(
        spark, payments=[pay(1, S), pay(1, S)], marketplace=[{"cus_cust_id_buy": 2}], active_user=[{"cus_cust_id_buy": 3}],
        demographics=[{"cus_cust_id_buy": 1}], balances=[{"cus_cust_id_buy": Decimal("4.0")}], outcomes=[{"cus_cust_id_buy": 9}])
    assert sorted(r.customer_id for r in ft.customer_base(raw).collect()) == [1, 2, 3, 4]


def test_label_operator_keeps_every_row(spark):
    activity = spark.createDataFrame([(1, S, None), (2, S, S - timedelta(days=60))], "customer_id long, snapshot_date date, last_activity_date date")
    outcomes = tables(spark, outcomes=[{"cus_cust_id_buy": 2, "churn": Decimal(0)}])["outcomes"]
    got = [(r.customer_id, r.days_since_activity, int(r.labeled_churn)) for r in with_labels(activity, outcomes).orderBy("customer_id").collect()]
    assert got == [(1, 0, 1), (2, 60, 0)]


def test_upsert_features_replaces_and_keeps(spark):
    old = ft.build_features(tables(spark, payments=[pay(1, S), pay(2, S)]), [S], NOW)
    new = ft.build_features(tables(spark, payments=[pay(2, S - timedelta(days=1)), pay(3, S)]), [S], NOW + timedelta(days=1))
    got = {r.customer_id: (r.payments_90d, r.created_at) for r in upsert(old, new, FEATURE_KEY).collect()}
    assert got == {1: (0, NOW), 2: (1, NOW + timedelta(days=1)), 3: (0, NOW + timedelta(days=1))}


def test_feature_job_upserts_into_stored_partitions(spark, lake, tmp_path):
    week = timedelta(weeks=1)
    update_features(lake, [S, S + week], NOW, tables(spark, payments=[pay(1, S), pay(2, S)]))
    folder = tmp_path / "lake/features/churn_weekly_features" / f"snapshot_date={S}"
    before = sorted(p.name for p in folder.glob("*.parquet"))
    update_features(lake, [S + week], NOW + week, tables(spark, payments=[pay(2, S), pay(3, S)]))
    assert sorted(p.name for p in folder.glob("*.parquet")) == before
    got = {(r.customer_id, r.snapshot_date): r.created_at for r in lake.read(FEATURES).collect()}
    assert got == {
        (1, S): NOW, (2, S): NOW,
        (1, S + week): NOW, (2, S + week): NOW + week, (3, S + week): NOW + week,
    }


def test_feature_job_fails_without_customers(spark, lake):
    with pytest.raises(DataQualityError, match=f"nothing was built for {S}"):
        update_features(lake, [S], NOW, tables(spark))
    assert lake.read_or_empty(FEATURES).count() == 0


def test_feature_job_fails_for_each_absent_raw_table(spark, lake):
    given = tables(spark, payments=[pay(1, S)])
    update_features(lake, [S], NOW, given)
    before = lake.read(FEATURES).count()
    for absent, table in RAW_CUSTOMER_TABLES.items():
        other = Lake(spark, f"{lake.root}-without-{absent}")
        for name, rows in given.items():
            if name != absent:
                other.append(rows, RAW_CUSTOMER_TABLES[name])
        with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
            update_features(other, [S], NOW)
    assert lake.read(FEATURES).count() == before


def stored_features(lake):
    return lake.read(FEATURES).select(*FEATURES.columns)


def with_payments(spark, lake, payments, people=(1, 2, 3)):
    """Stores the payments; the other sources, and what a full build says of a date."""
    made = tables(spark, payments=payments, demographics=[{"cus_cust_id_buy": c, "gender": "x"} for c in people])
    lake.replace(made.pop("payments"), RAW_PAYMENTS)
    return made, lambda *days: plain(ft.build_features({**made, "payments": lake.read(RAW_PAYMENTS)}, days, NOW))


def test_incremental_builds_equal_full_builds_on_every_date(spark, lake):
    rng = random.Random(8)
    # Customer 1 holds a third of all payments; some amounts, some days are missing; 900 pays on the last day only.
    every = [pay(1 if rng.random() < 1 / 3 else rng.randint(2, 25), S - timedelta(days=rng.randint(-9, 260)), rng.choice(["5", "7.25", None]), rng.choice(["1", None])) for _ in range(600)]
    every += [pay(30, None), pay(31, S - timedelta(days=200)), pay(900, S + timedelta(days=8))]
    dates = [S - timedelta(days=d) for d in (140, 90, 0)] + [S + timedelta(days=14)]
    for day in dates:
        known = [p for p in every if p["fecha"] is None or p["fecha"] < day]
        raw, full = with_payments(spark, lake, known)
        update_features(lake, [day], NOW, raw, incremental=True)
        assert plain(stored_features(lake).filter(F.col("snapshot_date") == day)) == full(day)
    # Earlier dates again, from the totals as they are by now: equal to full builds over all that is known by now.
    replay = dates[:-1]
    update_features(lake, replay, NOW, raw, incremental=True)
    assert plain(stored_features(lake).filter(F.col("snapshot_date").isin(replay))) == full(*replay)


def test_incremental_builds_read_new_payments_only(spark, lake, monkeypatch):
    raw, _ = with_payments(spark, lake, [pay(1, S - timedelta(days=d)) for d in range(1, 120)])
    update_features(lake, [S - timedelta(days=7)], NOW, raw, incremental=True)
    scans = []
    totals = ft.daily_totals

    def watched(payments):
        scans.append(payments._jdf.queryExecution().executedPlan().toString())
        return totals(payments)

    monkeypatch.setattr("churnflow.plans.feature_build.daily_totals", watched)
    update_features(lake, [S], NOW, raw, incremental=True)
    text, = scans
    assert re.search(r"fecha#\d+ >= 2019-05-19", text) and re.search(r"fecha#\d+ < 2019-05-26", text)
    assert "pay_month" in text.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert payments_covered_until(lake) == S
    monkeypatch.setattr("churnflow.plans.feature_build.daily_totals", lambda _: pytest.fail("nothing is new"))
    update_features(lake, [S], NOW, raw, incremental=True)


def test_corrected_payments_are_taken_anew(spark, lake):
    first = [pay(1, date(2019, 3, 5)), pay(1, date(2019, 4, 5)), pay(2, date(2019, 5, 5))]
    raw, _ = with_payments(spark, lake, first)
    update_features(lake, [S], NOW, raw, incremental=True)
    raw, full = with_payments(spark, lake, [pay(1, date(2019, 3, 5), "70"), pay(2, date(2019, 5, 5))])  # one changed, April is gone
    for _ in range(2):
        update_payment_totals(lake, S, since=date(2019, 3, 1))
        update_features(lake, [S], NOW, raw, incremental=True)
        assert plain(stored_features(lake)) == full(S)


@pytest.mark.parametrize("step", [1, 2, 3])
def test_an_incremental_build_that_breaks_off_can_be_repeated(spark, lake, monkeypatch, step):
    raw, full = with_payments(spark, lake, [pay(c, S - timedelta(days=20 * c)) for c in range(1, 9)])
    write, calls = lake._write, iter(range(1, 100))

    def failing(*args, **options):
        if next(calls) == step:
            raise OSError("lost")
        write(*args, **options)

    with monkeypatch.context() as broken:
        broken.setattr(lake, "_write", failing)
        with pytest.raises(OSError, match="lost"):
            update_features(lake, [S], NOW, raw, incremental=True)
    update_features(lake, [S], NOW, raw, incremental=True)
    assert plain(stored_features(lake)) == full(S)


def test_attributes_of_many_labels_are_compared_as_texts(spark, monkeypatch):
    people = [{"cus_cust_id_buy": c % 7, "gender": f"é{c}" if c % 2 else f"z{c}", "estado": "Z" if c % 3 else None} for c in range(50)]
    raw = tables(spark, demographics=people)["demographics"]
    few = plain(ft.demographics(raw))
    monkeypatch.setattr(ft, "MOST_LABELS", 10)
    assert plain(ft.demographics(raw)) == few
    want = {c: max((p["gender"] for p in people if p["cus_cust_id_buy"] == c), key=str.encode) for c in range(7)}
    assert {r[0]: r[1] for r in few} == want


def test_a_missing_login_counts_as_1970_after_the_maximum(spark):
    def login(customer, wallet, market):
        return {"cus_cust_id_buy": customer, "last_login_mp_date_1": wallet, "last_login_ml_date_1": market}

    users = [login(1, date(1965, 1, 1), None), login(1, None, date(1960, 1, 1)), login(2, date(1965, 1, 1), None), login(3, None, None)]
    raw = tables(spark, active_user=users, demographics=[{"cus_cust_id_buy": 4}])
    want = {1: date(1965, 1, 1), 2: date(1970, 1, 1), 3: date(1970, 1, 1)}
    assert {r.customer_id: r.last_login_date for r in ft.activity_metrics(raw["active_user"]).collect()} == want
    assert {r.customer_id: r.last_login_date for r in ft.build_features(raw, [S], NOW).collect()} == want | {4: None}
