"""Views that give the synthetic test tables the raw schemas of the library.

Each view reads its tables whole. The text runs in Spark and in DuckDB alike; ``{name}`` stands
for a test table. Login dates are moved back 8266 days so that they fall near the order dates.
Account ids are written a little below the customer's number, so that only rounding recovers it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "raw_payments": """
        SELECT CAST(o.o_orderdate AS DATE) AS fecha, d.cus_cust_id_sel, o.o_custkey AS cus_cust_id_buy,
          CAST(o.o_totalprice AS DECIMAL(18,2)) AS spent, o.o_orderpriority AS tpv_segment_detail, d.descuento
        FROM {orders} o LEFT JOIN (
          SELECT l_orderkey, MIN(l_suppkey) AS cus_cust_id_sel,
            CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS descuento
          FROM {lineitem} GROUP BY l_orderkey) d ON d.l_orderkey = o.o_orderkey""",
    "raw_active_user": """
        SELECT user_id AS cus_cust_id_buy,
          COUNT(*) FILTER (WHERE event_type IN ('view','purchase')) AS mau_mp_3,
          COUNT(*) FILTER (WHERE event_type IN ('click','signup')) AS mau_ml_3,
          COUNT(*) FILTER (WHERE event_type IN ('view','purchase') AND CAST(ts AS DATE) >= DATE '2024-01-11') AS mau_mp_2,
          COUNT(*) FILTER (WHERE event_type IN ('click','signup') AND CAST(ts AS DATE) >= DATE '2024-01-11') AS mau_ml_2,
          COUNT(*) FILTER (WHERE event_type IN ('view','purchase') AND CAST(ts AS DATE) >= DATE '2024-01-21') AS mau_mp_1,
          COUNT(*) FILTER (WHERE event_type IN ('click','signup') AND CAST(ts AS DATE) >= DATE '2024-01-21') AS mau_ml_1,
          CAST(MAX(CASE WHEN event_type = 'view' THEN CAST(ts AS DATE) END) - INTERVAL 8266 DAY AS DATE) AS last_login_mp_date_1,
          CAST(MAX(CASE WHEN event_type = 'click' AND user_id % 3 = 0 THEN CAST(ts AS DATE) END) - INTERVAL 8266 DAY AS DATE) AS last_login_ml_date_1
        FROM {events} GROUP BY user_id""",
    "raw_demograficos": """
        SELECT n.n_name AS city, c.c_custkey AS cus_cust_id_buy,
          CASE c.c_custkey % 3 WHEN 0 THEN 'male' WHEN 1 THEN 'female' END AS gender,
          CONCAT('0', CAST(c.c_custkey % 8 + 1 AS STRING)) AS rango_edad,
          c.c_mktsegment AS tarjetas, r.r_name AS estado
        FROM {customer} c JOIN {nation} n ON n.n_nationkey = c.c_nationkey JOIN {region} r ON r.r_regionkey = n.n_regionkey""",
    "raw_dinero_cuenta": """
        SELECT CAST(c_custkey AS DECIMAL(20,1)) - CAST(0.4 AS DECIMAL(2,1)) AS cus_cust_id_buy,
          CAST(c_acctbal AS DECIMAL(18,2)) AS plata_cuenta_1,
          CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) * 2 END AS plata_cuenta_2,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'Eligible' WHEN 'AUTOMOBILE' THEN 'ACTIVE' WHEN 'MACHINERY' THEN 'none' END AS inversion
        FROM {customer}""",
    "raw_marketplace_data": """
        SELECT o_custkey AS cus_cust_id_buy, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spent_ml,
          MAX(CAST(o_orderdate AS DATE)) AS recency_ml, CAST(COUNT(*) AS INT) AS frequency_ml
        FROM {orders} GROUP BY o_custkey""",
    "raw_evaluate": """
        SELECT doc_id AS cus_cust_id_buy, CAST(quality AS DECIMAL(10,0)) AS churn FROM {labels}""",
    "raw_crypto": """
        SELECT CASE WHEN event_id % 97 = 0 THEN NULL WHEN user_id % 3 = 0 THEN ' argentina' WHEN user_id % 3 = 1 THEN 'BRASIL ' ELSE 'Mexico' END AS site_id,
          user_id, CONCAT(CAST(day(ts) AS STRING), '/', CAST(month(ts) AS STRING), '/', CAST(year(ts) AS STRING)) AS purchase_date,
          event_type AS crypto_type, CAST(value AS DECIMAL(18,4)) AS purchase_price,
          CAST(event_id % 100 + 1 AS DECIMAL(10,0)) * CAST(0.125 AS DECIMAL(4,3)) AS purchase_units
        FROM {events}""",
}

TEST_TABLES = ("region", "nation", "customer", "orders", "lineitem", "events", "labels")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TEST_TABLES if "{" + t + "}" in text}
    return spark.sql(text, **tables)


def customer_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "payments": view(spark, sf_dir, "raw_payments"),
        "marketplace": view(spark, sf_dir, "raw_marketplace_data"),
        "active_user": view(spark, sf_dir, "raw_active_user"),
        "demographics": view(spark, sf_dir, "raw_demograficos"),
        "balances": view(spark, sf_dir, "raw_dinero_cuenta"),
        "outcomes": view(spark, sf_dir, "raw_evaluate"),
    }


def view_sql(*names: str) -> str:
    """The named views as common table expressions over the plain table names."""
    plain = {t: t for t in TEST_TABLES}
    return ",\n".join(f"{name} AS ({VIEWS[name].format(**plain)})" for name in names)
