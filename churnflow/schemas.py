"""Table definitions: declared column types, keys, required columns and partitioning.

Nothing is ever inferred from data. A column declared ``nullable=False`` and a table's ``key``
are constraints that parquet does not enforce; ``operators.quality`` turns them into checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Numbers as they arrive, kept to 18 digits on both sides of the point, so that they are rounded once, on use.
RAW_NUMBER = DecimalType(38, 18)
# Amounts of unstated precision. Sums widen to (28,6), so totals stay exact and order-independent.
AMOUNT = DecimalType(18, 6)
AMOUNT_TOTAL = DecimalType(28, 6)
PRICE = DecimalType(18, 4)
UNITS = DecimalType(18, 8)


def _columns(required: dict[str, DataType] | None = None, **optional: DataType) -> StructType:
    fields = [StructField(name, kind, False) for name, kind in (required or {}).items()]
    fields += [StructField(name, kind, True) for name, kind in optional.items()]
    return StructType(fields)


@dataclass(frozen=True)
class Table:
    """A stored table.

    ``derived`` holds the directory columns that are not columns of the table: the SQL that
    computes each, and its type. ``bucket`` names the column by whose hash a bucketed lake lays the table out, and the
    SQL that computes it.
    """

    zone: str
    name: str
    schema: StructType
    key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    derived: dict[str, tuple[str, DataType]] = field(default_factory=dict)
    bucket: tuple[str, str] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


TEXT, DAY, ID = StringType(), DateType(), LongType()

_BY_CUSTOMER = ("cus_cust_id_buy", "cus_cust_id_buy")

RAW_EVENTS = Table("raw", "crypto_transaction_history", _columns(
    site_id=TEXT, user_id=ID, purchase_date=TEXT, crypto_type=TEXT,
    purchase_price=RAW_NUMBER, purchase_units=RAW_NUMBER,
))
RAW_MARKETPLACE = Table("raw", "marketplace_data", _columns(
    cus_cust_id_buy=ID, spent_ml=RAW_NUMBER, recency_ml=DAY, frequency_ml=IntegerType(),
), bucket=_BY_CUSTOMER)
# Payments lie in a folder a month, so that a window or a week reads its months only.
_BY_MONTH = {"partition_by": ("pay_month",), "derived": {"pay_month": ("trunc(fecha, 'MM')", DAY)}}
RAW_PAYMENTS = Table("raw", "payments", _columns(
    fecha=DAY, cus_cust_id_sel=ID, cus_cust_id_buy=ID, spent=RAW_NUMBER,
    tpv_segment_detail=TEXT, descuento=RAW_NUMBER,
), bucket=_BY_CUSTOMER, **_BY_MONTH)
RAW_ACTIVE_USER = Table("raw", "active_user", _columns(
    cus_cust_id_buy=ID,
    mau_mp_3=RAW_NUMBER, mau_ml_3=RAW_NUMBER, mau_mp_2=RAW_NUMBER, mau_ml_2=RAW_NUMBER, mau_mp_1=RAW_NUMBER, mau_ml_1=RAW_NUMBER,
    last_login_mp_date_1=DAY, last_login_ml_date_1=DAY,
), bucket=_BY_CUSTOMER)
RAW_DEMOGRAPHICS = Table("raw", "demograficos", _columns(
    city=TEXT, cus_cust_id_buy=ID, gender=TEXT, rango_edad=TEXT, tarjetas=TEXT, estado=TEXT,
), bucket=_BY_CUSTOMER)
# Account ids arrive as decimals and are rounded to whole ids on use.
RAW_BALANCES = Table("raw", "dinero_cuenta", _columns(
    cus_cust_id_buy=RAW_NUMBER, plata_cuenta_1=RAW_NUMBER, plata_cuenta_2=RAW_NUMBER, inversion=TEXT,
), bucket=("customer_id", "CAST(round(cus_cust_id_buy) AS BIGINT)"))
RAW_OUTCOMES = Table("raw", "evaluate", _columns(cus_cust_id_buy=ID, churn=RAW_NUMBER), bucket=_BY_CUSTOMER)

EVENT_KEY = ("site_id", "user_id", "purchase_date", "crypto_type")
_EVENT = {
    "site_id": TEXT, "user_id": ID, "purchase_date": DAY, "crypto_type": TEXT,
    "purchase_price": PRICE, "purchase_units": UNITS, "purchase_value": UNITS,
}

STAGED_EVENTS = Table("staging", "crypto_transaction_history", _columns({**_EVENT, "load_ts": TimestampType()}))
LEDGER = Table(
    "ops", "crypto_events",
    _columns({**_EVENT, "is_active": BooleanType(), "updated_at": TimestampType()}),
    key=EVENT_KEY,
    partition_by=("purchase_month",),
    derived={"purchase_month": ("trunc(purchase_date, 'MM')", DAY)},
)

# What the weekly build keeps of payments: sums per customer and day, the last day of each month, and how far they go.
PAYMENT_DAYS = Table("features", "payment_days", _columns(
    customer_id=ID, fecha=DAY, spent=RAW_NUMBER, discount=RAW_NUMBER, payments=LongType(),
), **_BY_MONTH)
PAYMENT_MONTHS = Table("features", "payment_months", _columns(
    customer_id=ID, last_day=DAY), partition_by=("pay_month",), derived={"pay_month": ("trunc(last_day, 'MM')", DAY)})
PAYMENT_LOG = Table("features", "payment_log", _columns({"covered_until": DAY, "run_ts": TimestampType()}, read_from=DAY))

FEATURE_KEY = ("customer_id", "snapshot_date")
FEATURES = Table(
    "features", "churn_weekly_features",
    StructType([
        StructField("customer_id", ID, False),
        StructField("snapshot_date", DAY, False),
        StructField("spent_7d", AMOUNT_TOTAL),
        StructField("spent_30d", AMOUNT_TOTAL),
        StructField("payments_30d", IntegerType()),
        StructField("total_discount_30d", AMOUNT_TOTAL),
        StructField("spent_90d", AMOUNT_TOTAL),
        StructField("payments_90d", IntegerType()),
        StructField("mau_mp_1", AMOUNT),
        StructField("mau_ml_1", AMOUNT),
        StructField("mau_mp_3", AMOUNT),
        StructField("mau_ml_3", AMOUNT),
        StructField("plata_cuenta_1", AMOUNT),
        StructField("plata_cuenta_2", AMOUNT),
        StructField("has_inversion", BooleanType()),
        StructField("gender", TEXT),
        StructField("rango_edad", TEXT),
        StructField("tarjetas", TEXT),
        StructField("estado", TEXT),
        StructField("days_since_activity", IntegerType()),
        StructField("last_payment_date", DAY),
        StructField("last_login_date", DAY),
        StructField("labeled_churn", AMOUNT),
        StructField("created_at", TimestampType(), False),
    ]),
    key=FEATURE_KEY,
    partition_by=("snapshot_date",),
)

# Profiles of snapshots: exact figures, and sketches that can be merged over dates.
FEATURE_PROFILES = Table(
    "features", "feature_profiles", _columns(
        {"snapshot_date": DAY, "feature": TEXT, "n_rows": LongType(), "missing": LongType(), "zeros": LongType()},
        least=DoubleType(), greatest=DoubleType(), mean=DoubleType(), spread=DoubleType(),
        distinct_sketch=BinaryType(), quantile_sketch=BinaryType()),
    key=("snapshot_date", "feature"), partition_by=("snapshot_date",),
)

SCORE_KEY = ("customer_id", "snapshot_date", "model_version")
SCORES = Table(
    "ops", "churn_scoring",
    StructType([
        StructField("customer_id", ID, False),
        StructField("snapshot_date", DAY, False),
        StructField("score", DoubleType()),
        StructField("prediction", IntegerType()),
        StructField("model_version", TEXT, False),
        StructField("created_at", TimestampType(), False),
    ]),
    key=SCORE_KEY,
    partition_by=("snapshot_date", "model_version"),
)

# One row per training run, and an append-only log of what happened to each model version.
TRAINING_RUNS = Table("ops", "training_runs", _columns(
    {"model_name": TEXT, "model_version": IntegerType(), "created_at": TimestampType()},
    roc_auc=DoubleType(), accuracy=DoubleType(),
    positive_rate_train=DoubleType(), positive_rate_test=DoubleType(),
    train_rows=LongType(), test_rows=LongType(),
    params=MapType(TEXT, TEXT), tags=MapType(TEXT, TEXT),
), key=("model_name", "model_version"))
TUNING_RUNS = Table("ops", "tuning_runs", _columns(
    {"snapshot_date": DAY, "setting": TEXT, "fold": IntegerType(), "run_ts": TimestampType()},
    n_rows=LongType(), positives=LongType(), roc_auc=DoubleType(), accuracy=DoubleType(),
), key=("snapshot_date", "setting", "fold", "run_ts"))
MODEL_LOG = Table("ops", "model_log", _columns({
    "model_name": TEXT, "version": IntegerType(), "path": TEXT, "event": TEXT, "logged_at": TimestampType(),
}))

RAW_CUSTOMER_TABLES = {
    "payments": RAW_PAYMENTS,
    "marketplace": RAW_MARKETPLACE,
    "active_user": RAW_ACTIVE_USER,
    "demographics": RAW_DEMOGRAPHICS,
    "balances": RAW_BALANCES,
    "outcomes": RAW_OUTCOMES,
}

RAW_TABLES = {table.name: table for table in (RAW_EVENTS, *RAW_CUSTOMER_TABLES.values())}

# The model's input columns, in assembly order.
NUMERIC_FEATURES = [
    "spent_7d",
    "spent_30d",
    "spent_90d",
    "payments_30d",
    "payments_90d",
    "total_discount_30d",
    "mau_mp_1",
    "mau_ml_1",
    "mau_mp_3",
    "mau_ml_3",
    "plata_cuenta_1",
    "plata_cuenta_2",
    "days_since_activity",
]
BINARY_FEATURES = ["has_inversion"]
CATEGORICAL_FEATURES = ["gender", "rango_edad", "tarjetas", "estado"]
LABEL = "labeled_churn"
UNKNOWN = "unknown"
