"""View of the generic test tables as raw events, vendors, invoices, expenses and entities.

Every mapping is a row-wise expression that Spark SQL and DuckDB read alike, so that the SQL
checks start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import require_utc

AS_OF = "2024-01-31 00:00:00"

RAW_EVENTS = {
    "event_id": "event_id",
    "event_version": "'v1'",
    "tenant_id": "CASE WHEN event_id % 101 = 7 THEN NULL WHEN event_id % 101 = 8 THEN '0' "
    "WHEN event_id % 101 = 9 THEN 'abc' ELSE CAST(1 + (user_id - user_id % 10) % 3 AS STRING) END",
    "transaction_id": "CAST(event_id AS STRING)",
    "transaction_reference": "concat('EVT-', CAST(event_id AS STRING))",
    "account_id": "CASE WHEN event_id % 103 = 5 THEN NULL WHEN event_id % 103 = 6 THEN '   ' "
    "ELSE concat('ACC-', CAST(user_id - user_id % 10 AS STRING)) END",
    "amount": "CASE event_id % 107 WHEN 3 THEN '0' WHEN 4 THEN '-150.0' WHEN 5 THEN '99999999.99' "
    "WHEN 6 THEN 'abc' ELSE CAST(CAST(value * 100 AS DECIMAL(18,2)) AS STRING) END",
    "currency": "CASE WHEN event_id % 109 = 3 THEN 'XYZ' WHEN event_id % 109 = 4 THEN '123' "
    "WHEN event_id % 109 = 5 THEN 'myr' WHEN user_id % 4 = 0 THEN 'MYR' WHEN user_id % 4 = 1 THEN 'USD' "
    "WHEN user_id % 4 = 2 THEN 'SGD' ELSE 'EUR' END",
    "direction": "CASE WHEN event_id % 113 = 3 THEN 'SIDEWAYS' WHEN event_type = 'purchase' THEN 'DEBIT' "
    "WHEN event_type = 'view' THEN 'DR' WHEN event_type = 'click' THEN 'OUT' "
    "WHEN event_type = 'signup' THEN 'CREDIT' ELSE 'in' END",
    "status": "CASE WHEN event_id % 127 = 3 THEN 'BOGUS' ELSE CASE event_id % 8 WHEN 0 THEN 'BOOKED' "
    "WHEN 1 THEN 'POSTED' WHEN 2 THEN 'PENDING' WHEN 3 THEN 'SETTLED' WHEN 4 THEN 'COMPLETED' "
    "WHEN 5 THEN 'FAILED' WHEN 6 THEN 'VOID' ELSE 'REVERSED' END END",
    "event_ts": "CASE event_id % 131 WHEN 3 THEN 'not-a-date' WHEN 4 THEN '2022-01-01 00:00:00' "
    "WHEN 5 THEN '2024-02-15 00:00:00' ELSE CAST(date_trunc('second', ts) AS STRING) END",
    "vendor_code": "CASE WHEN event_id % 10 < 7 THEN concat('VEND-', CAST(user_id % 20 AS STRING)) END",
    "employee_id": "CASE WHEN event_id % 10 < 4 THEN concat('EMP-', CAST(user_id % 12 AS STRING)) END",
}

VENDORS = {
    "tenant_id": "1",
    "vendor_code": "concat('VEND-', CAST(s_suppkey AS STRING))",
    "name": "s_name",
    "country_code": "CASE s_nationkey % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'MY' WHEN 2 THEN 'SG' WHEN 3 THEN 'GB' ELSE 'JP' END",
    "risk_level": "CASE s_suppkey % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH' ELSE 'CRITICAL' END",
    "vendor_risk_score": "CAST(s_suppkey % 10 AS DOUBLE) / 10",
    "onboarding_date": "make_date(2020, CAST(1 + s_suppkey % 12 AS INT), CAST(1 + s_suppkey % 28 AS INT))",
    "is_active": "s_acctbal > 0",
}

_SUBTOTAL = "CAST(l_extendedprice AS DECIMAL(18,2))"
_TAX = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2))"
INVOICES = {
    "id": "l_orderkey * 10 + l_linenumber",
    "tenant_id": "1",
    "invoice_number": "concat('INV-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING))",
    "vendor_id": "concat('VEND-', CAST(l_suppkey AS STRING))",
    "employee_id": "concat('EMP-', CAST(l_orderkey % 12 AS STRING))",
    "invoice_date": "CAST(l_shipdate AS DATE)",
    "currency": "'USD'",
    "subtotal_amount": _SUBTOTAL,
    "tax_amount": _TAX,
    "total_amount": f"CAST({_SUBTOTAL} + {_TAX} AS DECIMAL(18,2))",
    "status": "CASE WHEN l_returnflag = 'R' THEN 'REJECTED' WHEN l_linestatus = 'F' THEN 'PAID' "
    "WHEN l_returnflag = 'A' THEN 'APPROVED' ELSE 'OVERDUE' END",
    "cost_center_code": "concat('CC-', CAST(l_partkey % 10 AS STRING))",
}

EXPENSES = {
    "id": "o_orderkey",
    "tenant_id": "1",
    "expense_reference": "concat('EXP-', CAST(o_orderkey AS STRING))",
    "employee_id": "concat('EMP-', CAST(o_custkey % 12 AS STRING))",
    "invoice_id": "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey * 10 + 1 END",
    "transaction_id": "CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END",
    "expense_date": "CAST(o_orderdate AS DATE)",
    "amount": "CAST(o_totalprice AS DECIMAL(18,2))",
    "category": "CASE o_orderkey % 6 WHEN 0 THEN 'TRAVEL' WHEN 1 THEN 'MEALS' WHEN 2 THEN 'ACCOMMODATION' "
    "WHEN 3 THEN 'OFFICE_SUPPLIES' WHEN 4 THEN 'CLIENT_ENTERTAINMENT' ELSE 'OTHER' END",
    "status": "CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'SUBMITTED' ELSE 'APPROVED' END",
    "cost_center_code": "concat('CC-', CAST(o_custkey % 10 AS STRING))",
}

ENTITIES = {
    "id": "c_custkey",
    "entity_id": "concat('ACC-', CAST(c_custkey AS STRING))",
    "name": "c_name",
    "type": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'COMPANY' WHEN 'BUILDING' THEN 'VENDOR' "
    "WHEN 'AUTOMOBILE' THEN 'MERCHANT' WHEN 'HOUSEHOLD' THEN 'PERSON' ELSE 'EMPLOYEE' END",
    "risk_score": "CAST(c_custkey % 101 AS INT)",
}

# Residue of the event id modulo 149 -> how its tenant is written.
TENANT_KINDS = {3: "$1.0", 4: '"$1.0"', 5: "true"}

VIEWS = {
    "raw_events": ("events", RAW_EVENTS),
    "vendors": ("supplier", VENDORS),
    "invoices": ("lineitem", INVOICES),
    "expenses": ("orders", EXPENSES),
    "entities": ("customer", ENTITIES),
}


def load(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    require_utc(spark)
    table, columns = VIEWS[view]
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    out = df.select(*[F.expr(sql).alias(name) for name, sql in columns.items()])
    return out.withColumnRenamed("event_ts", "timestamp") if view == "raw_events" else out


def view_sql(view: str) -> str:
    """The same mapping as a SELECT statement."""
    table, columns = VIEWS[view]
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + f" FROM {table}"


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text, with some broken texts, some ids of the wrong type, and some tenants that are sent as
    1.0, "1.0" or true."""
    raw = load(spark, sf_dir, "raw_events").withColumn(
        "transaction_id",
        F.when(F.expr("event_id % 139 = 3"), F.concat(F.lit("T"), "transaction_id")).otherwise(F.col("transaction_id")),
    )
    body = F.to_json(F.struct(*[c for c in raw.columns if c != "event_id"]))
    for residue, typed in TENANT_KINDS.items():
        body = F.when(F.expr(f"event_id % 149 = {residue}"), F.regexp_replace(body, '"tenant_id":"([1-9])"', f'"tenant_id":{typed}')).otherwise(body)
    return raw.select(
        "event_id", F.when(F.expr("event_id % 137 = 3"), F.lit("{bad")).otherwise(body).alias("value")
    )
