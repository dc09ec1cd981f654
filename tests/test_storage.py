from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from churnflow.operators.events import stage_events
from churnflow.operators.features import balance_metrics
from churnflow.operators.merge import replace_slice
from churnflow.operators.quality import (
    Check,
    DataQualityError,
    count_broken,
    key_repeats,
    not_null_checks,
    require,
    require_snapshots,
    require_unique_key,
)
from churnflow.plans import load_raw_tables
from churnflow.schemas import RAW_BALANCES, RAW_DEMOGRAPHICS, RAW_EVENTS, RAW_MARKETPLACE, RAW_PAYMENTS, SCORES, STAGED_EVENTS, TRAINING_RUNS, Table
from churnflow.sources import literal_rows, load_csv, param_query, read_snapshot, read_window, stage, staged
from churnflow.sources.lake import conform
from churnflow.sources.scratch import scratch_root

from pyspark.sql import functions as F

NOW = datetime(2024, 1, 1)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_keeps_quoted_empty_apart_from_missing(spark, tmp_path):
    path = write(tmp_path / "d.csv", 'City,ID,g,r,t,e\n"",1,,"a, ""b""",x,"y"\n,2,male,,,\n')
    rows = load_csv(spark, path, RAW_DEMOGRAPHICS.schema).orderBy("cus_cust_id_buy").collect()
    assert [tuple(r) for r in rows] == [
        ("", 1, None, 'a, "b"', "x", "y"),
        (None, 2, "male", None, None, None),
    ]


def test_csv_reads_types_by_position(spark, tmp_path):
    path = write(tmp_path / "p.csv", "whatever,b,c,d,e,f\n2019-05-01,7,8,10.5,seg,\n")
    row = load_csv(spark, path, RAW_PAYMENTS.schema).first()
    assert tuple(row) == (date(2019, 5, 1), 7, 8, Decimal("10.500000"), "seg", None)


@pytest.mark.parametrize("line", ["x,1,2019-01-01,1", "1,1,2019-01-01", "1,1,2019-01-01,1,9", "1,1,01/02/2019,1"])
def test_csv_bad_row_fails_the_load(spark, tmp_path, lake, line):
    path = write(tmp_path / "m.csv", f"a,b,c,d\n1,1.5,2019-01-01,2\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        lake.append(load_csv(spark, path, RAW_MARKETPLACE.schema), RAW_MARKETPLACE)


def test_csv_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "d.csv", 'c,i,g,r,t,e\n"two\nlines",1,,,,\n')
    assert load_csv(spark, path, RAW_DEMOGRAPHICS.schema, multiline=True).first().city == "two\nlines"


def test_reload_replaces_raw_tables(spark, tmp_path, lake):
    path = write(tmp_path / "b.csv", "i,a,b,v\n1.0,5,,Active\n2.0,6,,\n")
    for _ in range(2):
        load_raw_tables(lake, {"dinero_cuenta": path})
    assert lake.read(RAW_BALANCES).count() == 2
    with pytest.raises(ValueError, match="unknown raw tables"):
        load_raw_tables(lake, {"nothing": path})


def folders(spark):
    root = Path(scratch_root(spark)) / "churnflow"
    return set(root.iterdir()) if root.exists() else set()


def scores(spark, *rows):
    return spark.createDataFrame(
        [(c, d, s, int(s >= 0.5), v, NOW) for c, d, s, v in rows], SCORES.schema)


D1, D2 = date(2019, 5, 19), date(2019, 5, 26)


def state(df):
    return sorted((r.customer_id, r.snapshot_date, r.model_version, r.score) for r in df.collect())


def test_slice_replace_leaves_other_slices(spark, lake):
    before = scores(spark, (1, D1, 0.1, "1"), (1, D2, 0.2, "1"), (2, D2, 0.3, "1"), (1, D2, 0.4, "02"))
    lake.append(before, SCORES)
    new = scores(spark, (1, D2, 0.9, "1"))
    expected = [(1, D1, "1", 0.1), (1, D2, "02", 0.4), (1, D2, "1", 0.9)]
    for _ in range(2):
        lake.replace_partitions(new, SCORES)
        assert state(lake.read(SCORES)) == expected
    assert state(replace_slice(before, new, D2, "1")) == expected


def test_upsert_into_a_stored_table(spark, lake):
    touched = F.col("snapshot_date") == D2
    first = scores(spark, (1, D2, 0.1, "1"), (2, D2, 0.2, "1"))
    lake.append(scores(spark, (9, D1, 0.9, "1")), SCORES)
    lake.upsert(first, SCORES, touched)
    lake.upsert(scores(spark, (2, D2, 0.7, "1"), (3, D2, 0.3, "1")), SCORES, touched)
    expected = [(1, D2, "1", 0.1), (2, D2, "1", 0.7), (3, D2, "1", 0.3), (9, D1, "1", 0.9)]
    assert state(lake.read(SCORES)) == expected
    with pytest.raises(DataQualityError, match="1 repeated values of key"):
        lake.upsert(first.unionByName(first.limit(1)), SCORES, touched)
    assert state(lake.read(SCORES)) == expected


def test_an_upsert_that_breaks_off_leaves_the_old_or_the_new_table(spark, lake, monkeypatch):
    touched = F.col("snapshot_date") == D2
    lake.append(scores(spark, (1, D2, 0.1, "1"), (2, D2, 0.2, "1"), (9, D1, 0.9, "1")), SCORES)
    old = state(lake.read(SCORES))
    source = scores(spark, (2, D2, 0.7, "1"))
    before = folders(spark)
    with monkeypatch.context() as broken:  # before the rows are set aside
        broken.setattr(lake, "_set_note", lambda *_: pytest.fail("nothing was written aside"))
        failing = source.withColumn("score", F.raise_error(F.lit("lost")).cast("double"))
        with pytest.raises(PySparkException, match="lost"):
            lake.upsert(failing, SCORES, touched, keys_unique=True)
    assert state(lake.read(SCORES)) == old and folders(spark) == before
    with monkeypatch.context() as broken:  # during the swap
        broken.setattr(lake, "_write", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            lake.upsert(source, SCORES, touched)
    with pytest.raises(RuntimeError, match="is being replaced"):
        lake.read(SCORES)
    for _ in range(2):
        lake.recover(SCORES)
        assert state(lake.read(SCORES)) == [(1, D2, "1", 0.1), (2, D2, "1", 0.7), (9, D1, "1", 0.9)]
    assert folders(spark) == before


@pytest.mark.parametrize("write", ["replace", "replace_partitions"])
def test_every_replacement_is_all_or_nothing(spark, lake, monkeypatch, write):
    lake.append(scores(spark, (1, D2, 0.1, "1"), (9, D1, 0.9, "1")), SCORES)
    old, new = state(lake.read(SCORES)), scores(spark, (2, D2, 0.7, "1"))
    failing = new.withColumn("score", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(PySparkException, match="lost"):
        getattr(lake, write)(failing, SCORES)
    assert state(lake.read(SCORES)) == old
    with monkeypatch.context() as broken:
        broken.setattr(lake, "_write", lambda *_, **__: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            getattr(lake, write)(new, SCORES)
    aside, = (p for p in Path(f"{lake.root}/_aside").iterdir() if p.is_dir())
    again = type(lake)(spark, lake.root)  # another session finds it below the same root
    with pytest.raises(RuntimeError, match="is being replaced"):
        again.read(SCORES)
    hidden = aside.rename(aside.with_suffix(".hidden"))
    with pytest.raises(RuntimeError, match="are gone"):
        again.recover(SCORES)
    hidden.rename(aside)
    again.recover(SCORES)
    assert state(again.read(SCORES)) == [(2, D2, "1", 0.7)] + ([] if write == "replace" else [(9, D1, "1", 0.9)])
    assert not list(Path(f"{lake.root}/_aside").iterdir()) or all(p.name.startswith(".") for p in Path(f"{lake.root}/_aside").iterdir())


def test_a_repeated_key_fails_the_write(spark, lake):
    lake.append(scores(spark, (1, D1, 0.1, "1"), (1, D2, 0.1, "1")), SCORES)
    old = state(lake.read(SCORES))
    for bad in (scores(spark, (1, D2, 0.5, "1")), scores(spark, (7, D2, 0.5, "1"), (7, D2, 0.6, "1"))):
        with pytest.raises(DataQualityError, match="1 repeated values of key"):
            lake.append(bad, SCORES)
    with pytest.raises(DataQualityError, match="1 repeated values of key"):
        lake.replace_partitions(scores(spark, (7, D2, 0.5, "1"), (7, D2, 0.6, "1")), SCORES)
    assert state(lake.read(SCORES)) == old
    lake.append(scores(spark, (1, D2, 0.5, "2")), SCORES)
    run = {"model_name": "m", "model_version": 1, "created_at": NOW}
    rows = spark.createDataFrame([tuple(run.get(c) for c in TRAINING_RUNS.columns)], TRAINING_RUNS.schema)
    lake.append(rows, TRAINING_RUNS)
    with pytest.raises(DataQualityError, match="1 repeated values of key"):
        lake.append(rows, TRAINING_RUNS)
    assert lake.read(TRAINING_RUNS).count() == 1


def test_partitions_with_the_same_rows_are_not_written(spark, lake):
    first = scores(spark, (1, D1, 0.1, "1"), (1, D2, 0.2, "1"), (2, D2, 0.2, "1"))
    by_date = Table("ops", "by_date", SCORES.schema, key=SCORES.key, partition_by=("snapshot_date",))
    lake.append(first, by_date)
    files = set(lake.read(by_date).inputFiles())
    later = first.withColumn("created_at", F.lit(datetime(2025, 1, 1)))
    same = [c for c in by_date.columns if c != "created_at"]
    lake.publish(first.filter("false"), later.repartition(3), by_date, unless_same=same)
    assert set(lake.read(by_date).inputFiles()) == files
    lake.publish(first.filter("false"), later.withColumn("score", F.when(F.col("snapshot_date") == D2, 0.25).otherwise(F.col("score"))), by_date, unless_same=same)
    kept = {f for f in lake.read(by_date).inputFiles() if str(D1) in f}
    assert kept == {f for f in files if str(D1) in f} and not files & set(lake.read(by_date).inputFiles()) - kept
    assert sorted(r.score for r in lake.read(by_date).collect()) == [0.1, 0.25, 0.25]


def test_append_of_nothing_changes_nothing(spark, lake):
    lake.append(scores(spark, (1, D1, 0.1, "1")), SCORES)
    lake.append(scores(spark), SCORES)
    assert lake.read(SCORES).count() == 1


def test_replace_and_its_rule_for_empty_input(spark, lake):
    lake.append(scores(spark, (1, D1, 0.1, "1")), SCORES)
    lake.replace(scores(spark), SCORES, skip_empty=True)
    assert lake.read(SCORES).count() == 1
    lake.replace(scores(spark, (5, D2, 0.5, "2")), SCORES, skip_empty=True)
    assert state(lake.read(SCORES)) == [(5, D2, "2", 0.5)]
    lake.replace(scores(spark), SCORES)
    assert lake.read(SCORES).count() == 0


def test_conform_orders_casts_and_fills_defaults(spark):
    df = spark.range(1).selectExpr("'x' AS extra", "7 AS purchase_units", "1 AS user_id", "'A' AS site_id",
                                   "DATE '2023-01-01' AS purchase_date", "'B' AS crypto_type", "2 AS purchase_price", "14 AS purchase_value")
    out = conform(df, STAGED_EVENTS, load_ts=NOW)
    assert [(f.name, f.dataType) for f in out.schema.fields] == [(f.name, f.dataType) for f in STAGED_EVENTS.schema.fields]
    assert out.first().load_ts == NOW
    with pytest.raises(ValueError, match="load_ts is required"):
        conform(df, STAGED_EVENTS)


def test_snapshot_and_window_prune_partitions(spark, lake):
    lake.append(scores(spark, (1, D1, 0.1, "1"), (1, D2, 0.2, "1")), SCORES)
    one = read_snapshot(lake.read(SCORES), D2)
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(snapshot_date" in one._jdf.queryExecution().executedPlan().toString()


def test_window_includes_both_ends(spark):
    days = spark.createDataFrame([(date(2019, 5, 26),), (date(2019, 3, 31),), (date(2019, 3, 30),), (date(2019, 5, 27),)], "snapshot_date date")
    assert sorted(r[0] for r in read_window(days, date(2019, 5, 26), 8).collect()) == [date(2019, 3, 31), date(2019, 5, 26)]


def test_param_query_binds_values_and_keeps_columns_when_empty(spark):
    df = literal_rows(spark, [(1, "a'b"), (2, "c")], "id long, name string")
    assert [r.id for r in param_query(spark, "SELECT id FROM {t} WHERE name = :n", {"n": "a'b"}, t=df).collect()] == [1]
    empty = param_query(spark, "SELECT id, name FROM {t} WHERE id > :n", {"n": 9}, t=df)
    assert empty.columns == ["id", "name"] and empty.isEmpty()


def test_stage_uses_the_shared_folder(spark):
    rows = stage(spark.range(5), "numbers")
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(scratch_root(spark) in path for path in rows.inputFiles()) and rows.count() == 5


def test_staged_rows_go_after_success_and_after_failure(spark):
    before = folders(spark)
    with staged(spark.range(5), "numbers") as rows:
        assert rows.count() == 5 and len(folders(spark) - before) == 1
    with pytest.raises(RuntimeError), staged(spark.range(5).filter("false"), "numbers") as rows:
        assert rows.isEmpty()
        raise RuntimeError
    assert folders(spark) == before


def test_absent_tables_are_an_error(spark, lake):
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        lake.read(SCORES)
    assert lake.read_or_empty(SCORES).isEmpty()


def test_failed_load_keeps_the_old_rows(spark, tmp_path, lake):
    good = write(tmp_path / "good.csv", "i,a,b,v\n1.0,5,,Active\n")
    load_raw_tables(lake, {"dinero_cuenta": good})
    before = folders(spark)
    bad = write(tmp_path / "bad.csv", "i,a,b,v\n2.0,5,,Active\nx,1,,\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        load_raw_tables(lake, {"dinero_cuenta": bad})
    assert [int(r.cus_cust_id_buy) for r in lake.read(RAW_BALANCES).collect()] == [1]
    assert folders(spark) == before


def test_load_reads_line_breaks_inside_quotes(spark, tmp_path, lake):
    path = write(tmp_path / "d.csv", 'c,i,g,r,t,e\n"two\nlines",1,,,,\n')
    load_raw_tables(lake, {"demograficos": path}, multiline=True)
    assert lake.read(RAW_DEMOGRAPHICS).first().city == "two\nlines"


def test_numbers_are_rounded_once(spark, tmp_path, lake):
    """Prices keep their digits until they get their type, and ids theirs until they become whole."""
    events = write(tmp_path / "c.csv", "s,u,d,t,p,n\nA,1,1/1/2023,B,1.23444996,1\n")
    accounts = write(tmp_path / "b.csv", "i,a,b,v\n1.49996,5,,Active\n")
    load_raw_tables(lake, {"crypto_transaction_history": events, "dinero_cuenta": accounts})
    assert stage_events(lake.read(RAW_EVENTS)).first().purchase_price == Decimal("1.2344")
    assert balance_metrics(lake.read(RAW_BALANCES)).first().customer_id == 1


def test_required_columns_reject_rows_on_write(spark, lake):
    rows = scores(spark, (1, D1, 0.1, "1")).withColumn("customer_id", F.lit(None).cast("long"))
    with pytest.raises(PySparkException, match="churn_scoring.customer_id is required"):
        lake.append(rows, SCORES)


def test_checks(spark):
    df = spark.range(10)
    require(df, [Check("negative", F.col("id") < 0)])
    with pytest.raises(DataQualityError, match="big: 3 rows"):
        require(df, [Check("negative", F.col("id") < 0), Check("big", F.col("id") > 6)])
    assert {r.check_name: r.offending_rows for r in count_broken(df.filter("false"), [Check("any", F.col("id") >= 0)]).collect()} == {"any": 0}


def test_key_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a")], "k long, v string")
    assert tuple(key_repeats(df, ["k"]).first()) == (1, 2)
    assert tuple(key_repeats(df.filter("false"), ["k"]).first()) == (0, 0)
    with pytest.raises(DataQualityError, match=r"1 repeated values of key \(k\)"):
        require_unique_key(df, ["k"])


def test_not_null_checks_follow_the_declared_columns(spark):
    names = [c.name for c in not_null_checks(SCORES)]
    assert names == [f"churn_scoring.{c}" for c in ("customer_id", "snapshot_date", "model_version", "created_at")]


def test_required_snapshots(spark):
    df = spark.createDataFrame([(1, D1), (None, D2)], "customer_id long, snapshot_date date")
    require_snapshots(df, [D1])
    with pytest.raises(DataQualityError, match="1 rows lack a customer"):
        require_snapshots(df, [D1, D2])
