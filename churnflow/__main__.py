"""Run one job: ``spark-submit --py-files ... churnflow/__main__.py --lake ROOT JOB ...``

    load payments=PAYMENTS.csv evaluate=EVALUATE.csv ...   reload raw tables from CSV files
    events [--date D] [--keep-unchanged]   daily event load into the ledger
    features [--date D ...] [--incremental]   weekly feature build, one or many snapshot dates
    payments --since D --date D   take changed payments anew into the totals that incremental builds use
    watch [--date D]           check a snapshot against the profiles of earlier ones, then keep its own
    tune [--date D]            choose the model's setting by cross-validation on the training window
    train [--date D] [--setting NAME]   monthly training and promotion
    score [--date D]           weekly scoring

Dates are YYYY-MM-DD and default to today (UTC).
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from churnflow.plans import (
    check_snapshot,
    load_raw_tables,
    profile_snapshots,
    score_snapshot,
    train_and_register,
    tune,
    update_features,
    update_ledger,
    update_payment_totals,
)
from churnflow.plans.tuning import SETTINGS
from churnflow.sources import Lake


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="churnflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--lake", required=True, help="root folder of all tables")
    parser.add_argument("--buckets", type=int, help="lay raw customer tables out in so many buckets when loading them")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load")
    load.add_argument("files", nargs="+", metavar="TABLE=PATH")
    load.add_argument("--multiline", action="store_true", help="fields may hold line breaks; one task reads a file")
    today = datetime.now(timezone.utc).date().isoformat()
    for job in ("events", "watch", "tune", "train", "score", "payments"):
        jobs.add_parser(job).add_argument("--date", default=today)
    jobs.choices["events"].add_argument("--keep-unchanged", action="store_true", help="leave months alone in which only update times would change")
    jobs.choices["train"].add_argument("--lookback-weeks", type=int, default=8)
    jobs.choices["train"].add_argument("--setting", choices=sorted(SETTINGS), default="plain")
    jobs.choices["score"].add_argument("--threshold", type=float, default=0.5)
    jobs.choices["payments"].add_argument("--since")
    features = jobs.add_parser("features")
    features.add_argument("--date", nargs="+", default=[today])
    features.add_argument("--incremental", action="store_true", help="read only payments newer than the kept totals")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"churnflow-{options.job}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    lake = Lake(spark, options.lake, options.buckets)
    if options.job == "load":
        load_raw_tables(lake, dict(item.split("=", 1) for item in options.files), multiline=options.multiline)
    elif options.job == "events":
        update_ledger(lake, options.date, keep_unchanged=options.keep_unchanged)
    elif options.job == "features":
        update_features(lake, options.date, incremental=options.incremental)
    elif options.job == "payments":
        update_payment_totals(lake, options.date, options.since)
    elif options.job == "watch":
        check_snapshot(lake, options.date)
        profile_snapshots(lake, [options.date])
    elif options.job == "tune":
        print(tune(lake, options.date))
    elif options.job == "train":
        print(train_and_register(lake, options.date, options.lookback_weeks, setting=SETTINGS[options.setting]))
    else:
        print(score_snapshot(lake, options.date, options.threshold))


if __name__ == "__main__":
    main()
