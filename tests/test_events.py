from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import gapped
from churnflow.operators import events as ev
from churnflow.operators.merge import matched_keys, upsert
from churnflow.operators.quality import DataQualityError, count_broken, staged_event_checks
from churnflow.plans import update_ledger
from churnflow.schemas import EVENT_KEY, LEDGER, RAW_EVENTS, STAGED_EVENTS
from workload.queries import seed_events

DAY1, DAY2 = datetime(2023, 2, 2, 6), datetime(2023, 2, 3, 6)


def raw(spark, *rows):
    text = spark.createDataFrame(
        list(rows), "site_id string, user_id long, purchase_date string, crypto_type string, p string, u string")
    return text.select(
        "site_id", "user_id", "purchase_date", "crypto_type",
        F.col("p").cast(RAW_EVENTS.schema["purchase_price"].dataType).alias("purchase_price"),
        F.col("u").cast(RAW_EVENTS.schema["purchase_units"].dataType).alias("purchase_units"))


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_golden_seed(spark):
    staged = ev.stage_events(seed_events(spark))
    total = staged.agg(F.count("*"), F.sum("purchase_value"), F.min("purchase_date"), F.max("purchase_date"),
                       F.countDistinct("purchase_date")).first()
    assert tuple(total) == (11, Decimal("202919.20000000"), date(2023, 1, 1), date(2023, 2, 1), 5)


def test_cleaning_trims_and_upper_cases_and_keeps_empty_text(spark):
    df = ev.clean_events(raw(spark, (" argentina", 1, "1/1/2023", "btc ", "1.00005", "2.123456785"), ("", 2, "01/02/2023", "x", "1", "1")))
    assert rows(df.select("site_id", "purchase_date", "crypto_type", "purchase_price", "purchase_units"), "user_id") == [
        ("ARGENTINA", date(2023, 1, 1), "BTC", Decimal("1.0001"), Decimal("2.12345679")),
        ("", date(2023, 2, 1), "X", Decimal("1.0000"), Decimal("1.00000000")),
    ]


@pytest.mark.parametrize("position", range(6))
def test_a_missing_required_field_drops_the_row(spark, position):
    full = ["A", 1, "1/1/2023", "BTC", "1", "1"]
    broken = list(full)
    broken[position] = None
    assert ev.clean_events(raw(spark, tuple(full), tuple(broken))).count() == 1


def test_impossible_date_fails_the_load(spark):
    with pytest.raises(PySparkException):
        ev.clean_events(raw(spark, ("A", 1, "31/2/2023", "BTC", "1", "1"))).collect()


def test_dedupe_prefers_price_then_units(spark):
    df = ev.stage_events(raw(
        spark,
        ("A", 1, "1/1/2023", "BTC", "10", "9"), ("a ", 1, "01/01/2023", "btc", "11", "1"),
        ("A", 2, "1/1/2023", "BTC", "10", "1"), ("A", 2, "1/1/2023", "BTC", "10", "3"), ("A", 2, "1/1/2023", "BTC", "10", "2")))
    assert rows(df.select("user_id", "purchase_price", "purchase_units", "purchase_value"), "user_id") == [
        (1, Decimal("11.0000"), Decimal("1.00000000"), Decimal("11.00000000")),
        (2, Decimal("10.0000"), Decimal("3.00000000"), Decimal("30.00000000")),
    ]


def test_checks_count_each_kind_of_offence(spark):
    staged = ev.stage_events(seed_events(spark)).withColumns({
        "purchase_value": F.when(F.col("user_id") == 100000, F.lit(1)).otherwise(F.col("purchase_value")).cast("decimal(18,8)"),
        "crypto_type": F.when(F.col("user_id") != 315951, F.col("crypto_type")),
    })
    counts = {r.check_name: r.offending_rows for r in count_broken(staged, staged_event_checks(date(2023, 1, 13))).collect()}
    # 14 January is the day after, so only the two rows of 1 February are in the future; they are one event.
    assert counts == {"required_value_missing": 1, "dated_after_tomorrow": 1, "value_is_not_price_times_units": 1}


def test_failed_check_names_it_and_changes_nothing(spark, lake):
    with pytest.raises(DataQualityError, match="dated_after_tomorrow: 1 rows"):
        update_ledger(lake, date(2023, 1, 14), date(2023, 1, 14), DAY1, seed_events(spark))
    assert lake.read_or_empty(LEDGER).count() == 0


def staged_of(spark, *specs):
    return ev.stage_events(raw(spark, *(("A", user, day, "BTC", price, "1") for user, day, price in specs)))


def ledger_state(df):
    return rows(df.select("user_id", "purchase_price", "is_active", "updated_at"), "user_id")


def test_upsert_then_deactivate_equals_the_fused_merge(spark):
    ds = date(2023, 2, 3)
    first = staged_of(spark, (1, "1/1/2023", "1"), (2, "1/2/2023", "1"), (3, "2/2/2023", "1"), (4, "29/1/2023", "1"), (5, "28/1/2023", "1"))
    ledger = ev.as_ledger_rows(first, DAY1)
    second = staged_of(spark, (3, "2/2/2023", "7"), (6, "9/2/2023", "1"))
    step = upsert(ledger, ev.as_ledger_rows(second, DAY2), EVENT_KEY)
    stepwise = ev.deactivate_missing(step, second, ds, DAY2)
    fused = ev.merge_events(ledger, second, ds, DAY2)
    assert ledger_state(fused) == ledger_state(stepwise) == [
        (1, Decimal("1.0000"), True, DAY1),   # old: untouched
        (2, Decimal("1.0000"), False, DAY2),
        (3, Decimal("7.0000"), True, DAY2),   # updated
        (4, Decimal("1.0000"), False, DAY2),  # the first day of the range
        (5, Decimal("1.0000"), True, DAY1),   # the day before it
        (6, Decimal("1.0000"), True, DAY2),   # new
    ]


def test_upsert_twice_is_upsert_once(spark):
    ledger = ev.as_ledger_rows(staged_of(spark, (1, "1/1/2023", "1"), (2, "1/1/2023", "1")), DAY1)
    source = ev.as_ledger_rows(staged_of(spark, (2, "1/1/2023", "5"), (3, "1/1/2023", "1")), DAY2)
    once = upsert(ledger, source, EVENT_KEY)
    assert rows(upsert(once, source, EVENT_KEY)) == rows(once)


def test_empty_source_switches_recent_rows_off(spark, lake):
    as_of = date(2023, 12, 31)
    update_ledger(lake, date(2023, 2, 3), as_of, DAY1, seed_events(spark))
    update_ledger(lake, date(2023, 2, 3), as_of, DAY2, seed_events(spark).filter("false"))
    assert lake.read(LEDGER).count() == 11
    assert [r.purchase_date for r in lake.read(LEDGER).filter("NOT is_active").collect()] == [date(2023, 2, 1)]


def test_returning_row_is_active_again(spark):
    ds = date(2023, 2, 3)
    known = staged_of(spark, (1, "1/2/2023", "1"))
    off = ev.merge_events(ev.as_ledger_rows(known, DAY1), known.filter("false"), ds, DAY2)
    assert [r.is_active for r in off.collect()] == [False]
    on = ev.merge_events(off, known, ds, DAY2)
    assert [r.is_active for r in on.collect()] == [True]


def test_inactive_recent_rows_are_touched_again_and_old_ones_stay_inactive(spark):
    known = staged_of(spark, (1, "1/2/2023", "1"), (2, "1/1/2023", "1"))
    ledger = ev.as_ledger_rows(known, DAY1).withColumn("is_active", F.lit(False))
    after = ev.deactivate_missing(ledger, known.filter("false"), date(2023, 2, 3), DAY2)
    assert ledger_state(after) == [(1, Decimal("1.0000"), False, DAY2), (2, Decimal("1.0000"), False, DAY1)]


@pytest.mark.parametrize("sf", sorted(gapped.MERGE_TOTALS))
def test_merge_totals(spark, lake, sf):
    want = gapped.MERGE_TOTALS[sf]
    numbered = gapped.numbered_events(spark, sf)
    before = ev.stage_events(numbered.filter("event_id % 5 <> 0").drop("event_id"))
    incoming = numbered.filter("event_id % 4 <> 1").drop("event_id")
    staged = ev.stage_events(incoming)
    ledger = ev.as_ledger_rows(before, DAY1)
    lake.append(ledger, LEDGER)
    update_ledger(lake, date(2024, 1, 20), date(2024, 1, 31), DAY2, incoming)
    after = lake.read(LEDGER)
    total = after.agg(F.count("*"), F.count_if(~F.col("is_active")), F.sum("purchase_price").cast("decimal(18,2)")).first()
    assert {
        "before": ledger.count(), "staged": staged.count(), "matched": matched_keys(ledger, staged, EVENT_KEY).count(),
        "after": total[0], "deactivated": total[1], "price": str(total[2]),
    } == want


def test_ledger_job_rewrites_only_what_it_touches(spark, lake, tmp_path):
    as_of = date(2023, 12, 31)
    everything = seed_events(spark).unionByName(raw(spark, ("CHILE", 9, "15/11/2022", "BTC", "3", "2")))
    update_ledger(lake, date(2023, 2, 3), as_of, DAY1, everything)
    assert lake.read(LEDGER).count() == 12
    files = lambda month: sorted(p.name for p in (tmp_path / "lake/ops/crypto_events" / f"purchase_month={month}").glob("*.parquet"))
    untouched, touched = files("2022-11-01"), files("2023-02-01")

    # A reload without the old Chilean row and without the recent event of 1 February.
    update_ledger(lake, date(2023, 2, 3), as_of, DAY2, seed_events(spark).filter("purchase_date <> '1/2/2023'"))
    assert files("2022-11-01") == untouched and files("2023-02-01") != touched
    state = {(r.user_id, r.purchase_date, r.crypto_type): (r.is_active, r.updated_at) for r in lake.read(LEDGER).collect()}
    assert len(state) == 12
    assert state[(9, date(2022, 11, 15), "BTC")] == (True, DAY1)
    assert state[(200234, date(2023, 2, 1), "ETH")] == (False, DAY2)
    assert state[(356479, date(2023, 1, 14), "ETH")] == (True, DAY2)
    assert lake.read(STAGED_EVENTS).select("load_ts").distinct().count() == 1

    # Running it again changes nothing.
    before = rows(lake.read(LEDGER))
    update_ledger(lake, date(2023, 2, 3), as_of, DAY2, seed_events(spark).filter("purchase_date <> '1/2/2023'"))
    assert rows(lake.read(LEDGER)) == before


def test_a_second_run_of_the_day_writes_no_month(spark, lake):
    as_of, ds = date(2023, 12, 31), date(2023, 2, 3)
    run = lambda when, events: update_ledger(lake, ds, as_of, when, events, keep_unchanged=True)
    run(DAY1, seed_events(spark))
    files, before = set(lake.read(LEDGER).inputFiles()), rows(lake.read(LEDGER))
    run(DAY2, seed_events(spark))
    assert set(lake.read(LEDGER).inputFiles()) == files and rows(lake.read(LEDGER)) == before
    run(DAY2, seed_events(spark).filter("purchase_date <> '1/2/2023'"))
    changed = {f.split("purchase_month=")[1].split("/")[0] for f in files - set(lake.read(LEDGER).inputFiles())}
    assert changed == {"2023-02-01"}
    times = {r.purchase_month: r.updated_at for r in lake.read(LEDGER).select("purchase_month", "updated_at").distinct().collect()}
    assert times == {date(2023, 1, 1): DAY1, date(2023, 2, 1): DAY2}


def test_event_job_fails_without_the_raw_table_and_leaves_the_ledger(spark, lake):
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        update_ledger(lake, date(2023, 2, 3))
    assert lake.read_or_empty(LEDGER).isEmpty()


def test_packed_prices_and_units_order_as_the_pair(spark):
    numbers = [("-99999999999999.9999", "-9999999999.99999999"), ("-0.0001", "9999999999.99999999"), ("0", "-0.00000001"), ("0", "0"), ("0", "0.00000001"),
               ("0.0001", "-9999999999.99999999"), ("12.5", "3"), ("99999999999999.9999", "9999999999.99999999")]
    pairs = [(Decimal(p), Decimal(u)) for p, u in numbers]
    df = spark.createDataFrame(pairs, "p decimal(18,4), u decimal(18,8)")
    pair = ev._packed(F.col("p"), F.col("u"))
    found = df.select("p", "u", pair.alias("k"), *(c.alias(n) for c, n in zip(ev._unpacked(pair), ("p2", "u2")))).orderBy("k").collect()
    assert [(r.p, r.u) for r in found] == sorted(pairs) and all((r.p, r.u) == (r.p2, r.u2) for r in found)
