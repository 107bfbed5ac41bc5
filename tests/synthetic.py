"""Synthetic transaction events: account profiles with their own spend range, partners and bursts.

Every draw is a hash of (seed, row, purpose), so the rows do not depend on how the range is
partitioned and a recomputed task yields the same events.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------- Fixed values
# account, weight, amount from, amount to, vendors, employees, burst probability
PROFILES = [
    ("ACC-ENT-001", 8, 10, 500, ["VEND-001", "VEND-002"], [], 0.01),
    ("ACC-ENT-002", 8, 50, 800, ["VEND-003"], ["EMP-001"], 0.02),
    ("ACC-ENT-003", 7, 20, 300, [], [], 0.01),
    ("ACC-ENT-004", 7, 100, 1200, ["VEND-004", "VEND-005"], ["EMP-002"], 0.02),
    ("ACC-ENT-005", 7, 30, 600, ["VEND-001"], [], 0.01),
    ("ACC-ENT-006", 5, 500, 5000, ["VEND-010", "VEND-011"], ["EMP-003"], 0.05),
    ("ACC-ENT-007", 5, 300, 4000, ["VEND-012"], ["EMP-004"], 0.06),
    ("ACC-ENT-008", 5, 1000, 8000, ["VEND-013", "VEND-014"], [], 0.07),
    ("ACC-ENT-009", 4, 200, 3500, [], ["EMP-005"], 0.05),
    ("ACC-ENT-010", 4, 800, 6000, ["VEND-015"], ["EMP-006"], 0.08),
    ("ACC-ENT-011", 3, 5000, 50000, ["VEND-777", "VEND-888"], ["EMP-007"], 0.20),
    ("ACC-ENT-012", 2, 8000, 80000, ["VEND-999"], ["EMP-008"], 0.25),
    ("ACC-ENT-013", 2, 3000, 30000, ["VEND-777"], [], 0.15),
    ("ACC-ENT-014", 2, 10000, 95000, [], ["EMP-009"], 0.30),
    ("ACC-ENT-015", 2, 4000, 40000, ["VEND-888", "VEND-999"], ["EMP-010"], 0.20),
]
CURRENCIES = {"MYR": 0.70, "USD": 0.15, "SGD": 0.10, "EUR": 0.05}
STATUSES = {"BOOKED": 0.70, "POSTED": 0.20, "PENDING": 0.10}
DIRECTIONS = {"DEBIT": 0.65, "CREDIT": 0.35}
VENDOR_ABSENT, EMPLOYEE_ABSENT = 0.3, 0.4
BURST_FROM, BURST_TO = 3, 10
DAYS_BACK = 90
FIRST_ID = 10_000


def _draw(seed: int, purpose: str) -> Column:
    """Uniform number in [0, 1) for each row."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(purpose), F.col("id")), F.lit(1 << 53)) / F.lit(float(1 << 53))


def _whole(seed: int, purpose: str, upto: int) -> Column:
    return F.floor(_draw(seed, purpose) * (upto + 1)).cast("int")


def _weighted(u: Column, values: list, weights: list[float]) -> Column:
    total = sum(weights)
    expr = None
    for v, edge in zip(values[:-1], accumulate(weights)):
        hit = u < edge / total
        expr = F.when(hit, F.lit(v)) if expr is None else expr.when(hit, F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


def synthetic_events(spark: SparkSession, count: int, seed: int = 1, as_of: Column | None = None, tenant_id: int = 1) -> DataFrame:
    """``count`` events with text timestamps spread over the last 90 days before ``as_of``."""
    rows = spark.range(FIRST_ID, FIRST_ID + count)
    index = _weighted(_draw(seed, "profile"), list(range(len(PROFILES))), [p[1] for p in PROFILES])
    table = F.array(*[
        F.struct(
            F.lit(a).alias("account_id"), F.lit(float(lo)).alias("lo"), F.lit(float(hi)).alias("hi"),
            F.array(*map(F.lit, vendors)).cast("array<string>").alias("vendors"),
            F.array(*map(F.lit, employees)).cast("array<string>").alias("employees"), F.lit(burst).alias("burst"),
        )
        for a, _, lo, hi, vendors, employees, burst in PROFILES
    ])
    r = rows.select("id", F.get(table, index).alias("p"))
    bursting = _draw(seed, "burst") < F.col("p.burst")
    low = F.when(bursting, F.col("p.hi") * BURST_FROM).otherwise(F.col("p.lo"))
    high = F.when(bursting, F.col("p.hi") * BURST_TO).otherwise(F.col("p.hi"))

    def choice(field: str, absent: float) -> Column:
        n = F.size(f"p.{field}")
        pick = F.get(f"p.{field}", F.floor(_draw(seed, f"{field} pick") * n).cast("int"))
        return F.when((n > 0) & (_draw(seed, f"{field} present") > absent), pick)

    back = (
        _whole(seed, "days", DAYS_BACK) * 86400 + _whole(seed, "hours", 23) * 3600
        + _whole(seed, "minutes", 59) * 60 + _whole(seed, "seconds", 59)
    )
    moment = F.date_trunc("second", F.current_timestamp() if as_of is None else as_of)
    return r.select(
        F.lit("v1").alias("event_version"), F.lit(tenant_id).alias("tenant_id"), F.col("id").alias("transaction_id"),
        F.concat(F.lit("SYN-"), F.upper(F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.col("id"))), 1, 10))).alias("transaction_reference"),
        F.col("p.account_id").alias("account_id"),
        F.round(low + (high - low) * _draw(seed, "amount"), 2).alias("amount"),
        _weighted(_draw(seed, "currency"), list(CURRENCIES), list(CURRENCIES.values())).alias("currency"),
        _weighted(_draw(seed, "direction"), list(DIRECTIONS), list(DIRECTIONS.values())).alias("direction"),
        _weighted(_draw(seed, "status"), list(STATUSES), list(STATUSES.values())).alias("status"),
        F.date_format(F.timestamp_seconds(F.unix_seconds(moment) - back), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        choice("vendors", VENDOR_ABSENT).alias("vendor_code"),
        choice("employees", EMPLOYEE_ABSENT).alias("employee_id"),
    )


def as_payloads(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct(*events.columns), {"ignoreNullFields": "false"}).alias("value"))
