"""Customer features: one row per customer and snapshot date.

Every source is reduced to one row per customer before it meets another source, with partial
sums on the map side, so a customer (or a missing id) holding a large share of the rows is
harmless. Several snapshot dates share the same scans and shuffles; rows are multiplied by the
number of dates only at the very end, in place.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from churnflow.functions import date_literal, fail_when, latest_date, timestamp_literal, whole_id
from churnflow.operators.labels import churn_label, days_since
from churnflow.schemas import FEATURES

# Account states that count as holding an investment.
INVESTED_STATES = ["eligible", "active", "invested"]

WINDOWS = (7, 30, 90)

CUSTOMER_SOURCES = ("payments", "marketplace", "active_user", "demographics", "balances")


def _customer(source: str, stored: Sequence[str] = ()) -> Column:
    """The customer of a row; tables in buckets have that of a balance as a column of its own."""
    if "customer_id" in stored:
        return F.col("customer_id")
    buyer = F.col("cus_cust_id_buy")
    return (whole_id(buyer) if source == "balances" else buyer).alias("customer_id")


def customer_base(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Every customer id found in any of the five sources, once. Known outcomes add no customers."""
    ids = (raw[source].select(_customer(source, raw[source].columns)) for source in CUSTOMER_SOURCES)
    return reduce(DataFrame.unionByName, ids).distinct()


def _ordered(snapshots: Sequence[date]) -> list[date]:
    if not snapshots:
        raise ValueError("no snapshot dates given")
    return sorted(set(snapshots))


def _dates(snapshots: Sequence[date]) -> Column:
    return F.array(*(date_literal(s) for s in snapshots))


def _covered(payments: DataFrame, snapshots: Sequence[date]) -> Column:
    """Whether a payment lies in the longest window of some snapshot: one range for windows that touch.

    Where payments lie by month, the months of the ranges are named too, so no other folder is read.
    """
    ranges: list[list[date]] = []
    for snapshot in snapshots:
        first = snapshot - timedelta(days=WINDOWS[-1])
        if ranges and first <= ranges[-1][1]:
            ranges[-1][1] = snapshot
        else:
            ranges.append([first, snapshot])
    by_month = "pay_month" in payments.columns
    return reduce(lambda a, b: a | b, (between_days(first, end, by_month) for first, end in ranges))


def between_days(first: date | None, end: date, by_month: bool) -> Column:
    """From ``first`` on, before ``end``; with ``by_month``, also said of the month that partitions the table."""
    inside = F.col("fecha") < date_literal(end)
    if by_month:
        inside = inside & (F.col("pay_month") <= date_literal((end - timedelta(days=1)).replace(day=1)))
    if first is not None:
        inside = inside & (F.col("fecha") >= date_literal(first))
        if by_month:
            inside = inside & (F.col("pay_month") >= date_literal(first.replace(day=1)))
    return inside


def daily_totals(payments: DataFrame) -> DataFrame:
    """Payments added up per customer and day, which bounds a customer's rows by the number of days."""
    return payments.groupBy(_customer("payments"), "fecha").agg(
        F.sum("spent").alias("spent"), F.sum("descuento").alias("discount"), F.count("*").alias("payments"))


class PaymentHistory(NamedTuple):
    """What the build needs to know of payments.

    ``days``: totals per customer and day, for the days that some window covers. ``seen``: customer and ``day``, with
    at least each customer's last day before every snapshot, and every customer who ever paid. ``placed``: both lie by
    customer, so nothing brings them together again.
    """

    days: DataFrame
    seen: DataFrame
    placed: bool = False


def history_of(payments: DataFrame, snapshots: Sequence[date], placed: bool = False) -> PaymentHistory:
    """From the payments themselves: customer and date of all of them, amounts of the days in windows."""
    return PaymentHistory(
        daily_totals(payments.filter(_covered(payments, snapshots))), payments.select(_customer("payments"), F.col("fecha").alias("day")), placed)


def history_from_state(days: DataFrame, months: DataFrame, snapshots: Sequence[date]) -> PaymentHistory:
    """From the kept totals (``PAYMENT_DAYS``) and last days of months (``PAYMENT_MONTHS``).

    Days are read for the months of the windows only. The last day of a month says all that a snapshot needs of a
    month it does not lie in; of its own month the days are read.
    """
    own = F.coalesce(F.col("pay_month").isin(sorted({s.replace(day=1) for s in snapshots})), F.lit(False))
    seen = months.filter(~own).select("customer_id", F.col("last_day").alias("day"))
    return PaymentHistory(
        days.filter(_covered(days, snapshots)).select("customer_id", "fecha", "spent", "discount", "payments"),
        seen.unionByName(days.filter(own).select("customer_id", F.col("fecha").alias("day"))))


def _window_totals(days: DataFrame, snapshots: Sequence[date], placed: bool = False) -> DataFrame:
    """(customer_id, totals) where ``totals`` maps a snapshot date to its sums over the windows.

    The days of a customer are brought together once; both later groupings, by snapshot and by
    customer, use that same partitioning. A day goes to the dates in whose longest window it lies, and to no others.
    """
    daily = days if placed else days.repartition("customer_id")
    reached = F.filter(_dates(snapshots), lambda s: (s > F.col("fecha")) & (s <= F.date_add("fecha", WINDOWS[-1])))
    ahead = daily.withColumn("snapshot_date", F.explode(reached))

    def total(column: str, days: int) -> Column:
        inside = F.col("fecha") >= F.date_sub("snapshot_date", days)
        return F.sum(F.when(inside, F.col(column))).alias(f"{column}_{days}d")

    totals = ahead.groupBy("customer_id", "snapshot_date").agg(
        *(total("spent", days) for days in WINDOWS),
        *(total("payments", days) for days in WINDOWS[1:]),
        *(total("discount", days) for days in WINDOWS[1:]),
    )
    entry = F.struct("snapshot_date", F.struct(*(c for c in totals.columns if c not in ("customer_id", "snapshot_date"))))
    return totals.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(entry)).alias("totals"))


def _payers(known: PaymentHistory, snapshots: Sequence[date], *, match_null: bool = False) -> DataFrame:
    """One row per paying customer: the last payment days between snapshots, and the window totals.

    The last day after each snapshot and before the next is kept, at most one per date. ``match_null`` also finds the
    totals of payments without a customer, at the price of shuffling the customers again.
    """
    passed = F.size(F.filter(_dates(snapshots), lambda s: s <= F.col("day"))).alias("passed")
    between = known.seen.groupBy("customer_id", passed).agg(F.max("day").alias("day"))
    between = between if known.placed else between.repartition("customer_id")
    history = between.groupBy("customer_id").agg(
        F.collect_list(F.struct("passed", "day")).alias("last_days"))
    totals = _window_totals(known.days, snapshots, known.placed)
    if not match_null:
        return history.join(totals, "customer_id", "left")
    same = history["customer_id"].eqNullSafe(totals["customer_id"])
    return history.join(totals, same, "left").drop(totals["customer_id"])


def _one_row_per_snapshot(payers: DataFrame, snapshots: Sequence[date]) -> DataFrame:
    """Spreads ``payers`` over the snapshot dates. Sums are NULL, and counts 0, where nothing was paid."""
    kept = [c for c in payers.columns if c not in ("totals", "last_days")]
    rows = payers.select("*", F.posexplode(_dates(snapshots)).alias("number", "snapshot_date")).withColumn(
        "t", F.try_element_at("totals", F.col("snapshot_date")))
    before = F.filter("last_days", lambda d: d["passed"] <= F.col("number"))
    return rows.select(
        *kept, "snapshot_date",
        *(F.col(f"t.{c}_{days}d").alias(f"{c}_{days}d") for c, days in (
            ("spent", 7), ("spent", 30), ("spent", 90), ("discount", 30), ("discount", 90))),
        *(F.coalesce(F.col(f"t.payments_{days}d"), F.lit(0)).alias(f"payments_{days}d") for days in WINDOWS[1:]),
        F.array_max(F.transform(before, lambda d: d["day"])).alias("last_payment_date"),
    )


def payment_metrics(payments: DataFrame, snapshots: Sequence[date]) -> DataFrame:
    """Spend, payment counts and discounts over the 7/30/90 days before each snapshot date.

    Customers without any payment before a date have no row for it. Sums are NULL, and counts 0,
    when no payment falls in the window.
    """
    dates = _ordered(snapshots)
    rows = _one_row_per_snapshot(_payers(history_of(payments, dates), dates, match_null=True), dates)
    return rows.filter(F.col("last_payment_date").isNotNull())


# Columns of which a customer's greatest value counts, by source.
ACTIVITY = ("mau_mp_1", "mau_ml_1", "mau_mp_3", "mau_ml_3")
LOGINS = ("last_login_mp_date_1", "last_login_ml_date_1")
BALANCES = ("plata_cuenta_1", "plata_cuenta_2")


def _greatest(columns: Sequence[str]) -> list[Column]:
    return [F.max(c).alias(c) for c in columns]


def _last_login() -> Column:
    """Of the greatest days of both logins; one that is missing counts as 1970-01-01, after the maximum."""
    return latest_date(*(F.max(c) for c in LOGINS))


def activity_metrics(active_user: DataFrame) -> DataFrame:
    """Monthly-active figures and last logins. A known user without logins last logged in on 1970-01-01."""
    return active_user.groupBy(_customer("active_user")).agg(
        *_greatest((*ACTIVITY, *LOGINS)), _last_login().alias("last_login_date"))


def _invested() -> Column:
    return F.coalesce(F.lower("inversion").isin(INVESTED_STATES), F.lit(False))


def balance_metrics(balances: DataFrame) -> DataFrame:
    """Highest balances, and whether any account holds an investment."""
    return balances.groupBy(_customer("balances", balances.columns)).agg(
        *_greatest(BALANCES),
        F.bool_or(_invested()).alias("has_inversion"),
    )


ATTRIBUTES = ("gender", "rango_edad", "tarjetas", "estado")
# Labels are coded if there are so few that they fit the plan; else they are compared as texts, by sorting.
MOST_LABELS = 2_000


class _Labels:
    """Numbers that order as the labels of an attribute do, so that maxima are taken in a hash table."""

    def __init__(self, people: DataFrame) -> None:
        pairs = people.select(F.inline(F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(c).alias("label")) for c in ATTRIBUTES))))
        found = pairs.filter("label IS NOT NULL").distinct().limit(MOST_LABELS + 1).collect()
        self.few = 0 < len(found) <= MOST_LABELS
        self._lists = {c: sorted((r.label for r in found if r.attribute == c), key=str.encode) for c in ATTRIBUTES}

    def code(self, attribute: str) -> Column:
        if not self.few:
            return F.col(attribute)
        return F.nullif(F.array_position(self._array(attribute), F.col(attribute)), F.lit(0)).cast("int").alias(attribute)

    def label(self, attribute: str) -> Column:
        return F.get(self._array(attribute), F.col(attribute) - 1).alias(attribute) if self.few else F.col(attribute)

    def _array(self, attribute: str) -> Column:
        return F.array(*map(F.lit, self._lists[attribute])).cast("array<string>")


def demographics(people: DataFrame) -> DataFrame:
    """The greatest value of each attribute, taken separately, in binary string order."""
    labels = _Labels(people)
    coded = people.select(_customer("demographics"), *(labels.code(c) for c in ATTRIBUTES))
    return coded.groupBy("customer_id").agg(*(F.max(c).alias(c) for c in ATTRIBUTES)).select("customer_id", *(labels.label(c) for c in ATTRIBUTES))


def marketplace_metrics(marketplace: DataFrame) -> DataFrame:
    return marketplace.groupBy(_customer("marketplace")).agg(
        *(F.max(c).alias(c) for c in ("spent_ml", "recency_ml", "frequency_ml")),
    )


def _profiles(raw: Mapping[str, DataFrame]) -> DataFrame:
    """One row per customer from every source but payments, in one aggregation.

    The sources are stacked rather than joined: each fills its own columns and leaves the others
    NULL, which maxima ignore. That takes one shuffle where five joins would take ten.
    """
    labels = _Labels(raw["demographics"])
    people = raw["demographics"].select(
        _customer("demographics"), *(labels.code(c) for c in ATTRIBUTES), F.lit(True).alias("is_customer"))
    activity = raw["active_user"].select(
        _customer("active_user"), *ACTIVITY, *LOGINS, F.lit(True).alias("is_user"), F.lit(True).alias("is_customer"))
    balances = raw["balances"].select(
        _customer("balances", raw["balances"].columns), *BALANCES, _invested().alias("has_inversion"),
        F.lit(True).alias("is_customer"))
    buyers = raw["marketplace"].select(_customer("marketplace"), F.lit(True).alias("is_customer"))
    outcomes = raw["outcomes"].filter(F.col("cus_cust_id_buy").isNotNull()).select(
        _customer("outcomes"), F.col("churn").alias("outcome"), F.lit(1).alias("outcome_rows"))

    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [people, activity, balances, buyers, outcomes])
    found = stacked.groupBy("customer_id").agg(
        *_greatest((*ATTRIBUTES, *ACTIVITY, *BALANCES, "outcome")),
        F.when(F.bool_or("is_user"), _last_login()).alias("last_login_date"),
        F.bool_or("has_inversion").alias("has_inversion"),
        F.bool_or("is_customer").alias("is_customer"),
        F.sum("outcome_rows").alias("outcome_rows"),
    )
    return found.withColumns({c: labels.label(c) for c in ATTRIBUTES})


def _placed_profiles(raw: Mapping[str, DataFrame]) -> DataFrame:
    """``_profiles`` of sources that lie in buckets by customer: each is aggregated, and joined to the list of customers, where it is."""
    listed = (raw[source].select(_customer(source, raw[source].columns)) for source in CUSTOMER_SOURCES if source != "payments")
    rows = reduce(DataFrame.union, listed).groupBy("customer_id").agg(F.lit(True).alias("is_customer"))
    activity = raw["active_user"].groupBy(_customer("active_user")).agg(*_greatest(ACTIVITY), _last_login().alias("last_login_date"))
    outcomes = raw["outcomes"].groupBy(_customer("outcomes")).agg(F.max("churn").alias("outcome"), F.count("*").alias("outcome_rows"))
    for one in (demographics(raw["demographics"]), activity, balance_metrics(raw["balances"]), outcomes):
        rows = rows.join(one.hint("merge"), "customer_id", "left")
    return rows


def build_features(raw: Mapping[str, DataFrame], snapshots: Sequence[date], run_ts: datetime, history: Callable[[Sequence[date]], PaymentHistory] | None = None, *, placed: bool = False) -> DataFrame:
    """The feature table's rows for every customer at every given snapshot date.

    ``history`` gives what is known of payments; without it, ``raw["payments"]`` is read whole. ``placed`` says
    that all sources lie in as many buckets by customer; then nothing but the labels of attributes is shuffled.

    Payments and the other sources meet once, in a full outer join on the customer, by which both
    are already partitioned. A customer with several known outcomes, or a missing customer id,
    fails the build.
    """
    dates = _ordered(snapshots)
    known = history(dates) if history else history_of(raw["payments"], dates, placed)
    payers = _payers(known, dates).withColumn("has_paid", F.lit(True))
    profiles = _placed_profiles(raw) if placed else _profiles(raw)
    customers = payers.join(profiles, "customer_id", "full").filter(F.col("has_paid") | F.col("is_customer"))
    return _finished(_one_row_per_snapshot(customers, dates), run_ts)


def _finished(rows: DataFrame, run_ts: datetime) -> DataFrame:
    last_activity = latest_date(F.col("last_payment_date"), F.col("last_login_date"))
    label = fail_when(
        F.col("outcome_rows") > 1,
        F.concat(F.lit("several known outcomes for customer "), F.col("customer_id").cast("string")),
        churn_label(F.col("outcome"), F.col("snapshot_date"), last_activity),
        FEATURES.schema["labeled_churn"].dataType,
    )
    customer = fail_when(
        F.col("customer_id").isNull(), F.lit("a source row has no customer id"), F.col("customer_id"), LongType())
    zero_filled = {
        c: F.coalesce(F.col(c), F.lit(0))
        for c in (
            "spent_7d", "spent_30d", "spent_90d", "payments_30d", "payments_90d",
            "mau_mp_1", "mau_ml_1", "mau_mp_3", "mau_ml_3", "plata_cuenta_1", "plata_cuenta_2")
    }
    values = zero_filled | {
        "customer_id": customer,
        "total_discount_30d": F.coalesce(F.col("discount_30d"), F.lit(0)),
        "has_inversion": F.coalesce(F.col("has_inversion"), F.lit(False)),
        "days_since_activity": days_since(last_activity, F.col("snapshot_date")),
        "labeled_churn": label,
        "created_at": timestamp_literal(run_ts),
    }
    return rows.select(*(
        values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in FEATURES.schema.fields))
