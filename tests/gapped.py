"""Adapter views in which every source lacks some customers, and the totals known for them.

They exist to exercise missing rows on every side; the registered queries read whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from workload.adapters import VIEWS, view

DATA = "/root/testdata"

DINERO = """
    SELECT CAST(c_custkey AS DECIMAL(20,1)) AS cus_cust_id_buy,
      CAST(c_acctbal AS DECIMAL(18,2)) AS plata_cuenta_1,
      CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) * 2 END AS plata_cuenta_2,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'Eligible' WHEN 'AUTOMOBILE' THEN 'ACTIVE' WHEN 'MACHINERY' THEN 'none' END AS inversion
    FROM {customer} WHERE c_custkey % 10 <> 0"""
EVALUATE = "SELECT c_custkey AS cus_cust_id_buy, CAST(c_custkey % 2 AS DECIMAL(10,0)) AS churn FROM {customer} WHERE c_custkey % 7 = 0"

MARKETPLACE = """
    SELECT o_custkey AS cus_cust_id_buy, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent_ml,
      MAX(CAST(o_orderdate AS DATE)) AS recency_ml, CAST(COUNT(*) AS INT) AS frequency_ml
    FROM {orders} WHERE o_orderstatus = 'F' GROUP BY o_custkey"""

FEATURE_TOTALS = {
    "0.001": {
        "customers": 150, "spent_7d": "1082082.74", "spent_90d": "10492152.85", "payments_30d": 12,
        "total_discount_30d": "98262.86", "mau_mp_1": 119, "plata_cuenta_2": "1044952.38", "has_inversion": 53,
        "last_payment_date": 136, "last_login_date": 15, "days_min": -10, "days_max": 11476, "days_sum": 170665,
        "labeled_churn": 109,
    },
    "0.01": {
        "customers": 1500, "spent_7d": "10317377.81", "spent_90d": "125829172.51", "payments_30d": 175,
        "total_discount_30d": "1758437.68", "mau_mp_1": 1334, "plata_cuenta_2": "10826606.24", "has_inversion": 532,
        "last_payment_date": 1361, "last_login_date": 150, "days_min": -10, "days_max": 11476, "days_sum": 1729447,
        "labeled_churn": 1040,
    },
    "0.1": {
        "customers": 14999, "spent_7d": "106323344.02", "spent_90d": "1259918724.94", "payments_30d": 1672,
        "total_discount_30d": "17665197.30", "mau_mp_1": 13453, "plata_cuenta_2": "109222195.10", "has_inversion": 5412,
        "last_payment_date": 13635, "last_login_date": 1500, "days_min": -10, "days_max": 11476, "days_sum": 17030381,
        "labeled_churn": 10365,
    },
}

MERGE_TOTALS = {
    "0.001": {"before": 666, "staged": 623, "matched": 529, "after": 760, "deactivated": 71, "price": "40979.70"},
    "0.01": {"before": 6634, "staged": 6324, "matched": 5301, "after": 7657, "deactivated": 710, "price": "406896.83"},
}


def sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    d = f"{DATA}/sf{sf}"
    customer = spark.read.parquet(f"{d}/customer.parquet")
    return {
        "payments": view(spark, d, "raw_payments").filter(F.col("cus_cust_id_buy") % 11 != 0),
        "marketplace": spark.sql(MARKETPLACE, orders=spark.read.parquet(f"{d}/orders.parquet")),
        "active_user": view(spark, d, "raw_active_user"),
        "demographics": view(spark, d, "raw_demograficos").filter(F.col("cus_cust_id_buy") % 13 != 0),
        "balances": spark.sql(DINERO, customer=customer),
        "outcomes": spark.sql(EVALUATE, customer=customer),
    }


def numbered_events(spark: SparkSession, sf: str) -> DataFrame:
    text = VIEWS["raw_crypto"].replace("AS purchase_units", "AS purchase_units, event_id")
    return spark.sql(text, events=spark.read.parquet(f"{DATA}/sf{sf}/events.parquet"))
