"""Fixed values and tunable settings.

The lists, limits and weights under "Fixed values" must keep exactly these values, otherwise
results change. The dataclasses hold what a deployment may tune.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------- Fixed values: validation
MIN_AMOUNT = 0.01
MAX_AMOUNT = 10_000_000.00
MAX_FUTURE_SECONDS = 300
MAX_PAST_DAYS = 365

CURRENCIES = [
    "MYR", "USD", "SGD", "EUR", "GBP", "JPY", "AUD", "CAD",
    "HKD", "CNY", "THB", "IDR", "PHP", "VND", "INR",
]
RAW_DIRECTIONS = ["DEBIT", "CREDIT", "DR", "CR", "IN", "OUT"]
RAW_STATUSES = [
    "PENDING", "POSTED", "REVERSED", "CANCELLED",
    "BOOKED", "AUTHORIZED", "AUTHORISED", "SETTLED",
    "COMPLETED", "SUCCESS", "FAILED", "DECLINED", "VOID",
]
REQUIRED_FIELDS = [
    "transaction_id", "transaction_reference", "account_id", "amount",
    "currency", "direction", "status", "timestamp",
]
EVENT_FIELDS = [
    "event_version", "tenant_id", "transaction_id", "transaction_reference", "account_id",
    "amount", "currency", "direction", "status", "timestamp", "vendor_code", "employee_id",
]

# ---------------------------------------------------------------- Fixed values: normalisation
STATUSES = ["PENDING", "POSTED", "REVERSED", "CANCELLED"]
STATUS_ALIASES = {
    "BOOKED": "PENDING", "AUTHORIZED": "PENDING", "AUTHORISED": "PENDING",
    "SETTLED": "POSTED", "COMPLETED": "POSTED", "SUCCESS": "POSTED",
    "FAILED": "CANCELLED", "DECLINED": "CANCELLED", "VOID": "CANCELLED",
}
DIRECTIONS = ["DEBIT", "CREDIT"]
DIRECTION_ALIASES = {"DR": "DEBIT", "CR": "CREDIT", "IN": "CREDIT", "OUT": "DEBIT"}

TX_DEFAULTS = {"country_code": "XX", "merchant_category": "UNKNOWN", "channel": "KAFKA"}

# ---------------------------------------------------------------- Fixed values: enum domains
INVOICE_STATUSES = ["DRAFT", "PENDING_APPROVAL", "APPROVED", "PAID", "OVERDUE", "CANCELLED", "REJECTED"]
VENDOR_RISK_LEVELS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
EXPENSE_STATUSES = ["DRAFT", "SUBMITTED", "APPROVED", "REJECTED", "PAID", "CANCELLED"]
EXPENSE_CATEGORIES = ["TRAVEL", "MEALS", "ACCOMMODATION", "OFFICE_SUPPLIES", "CLIENT_ENTERTAINMENT", "OTHER"]
ENTITY_TYPES = ["PERSON", "COMPANY", "VENDOR", "EMPLOYEE", "ACCOUNT", "MERCHANT", "UNKNOWN"]

# ---------------------------------------------------------------- Fixed values: risk thresholds
HIGH_RISK_THRESHOLD = 500
VELOCITY_24H_THRESHOLD = 20
KPI_HIGH = 700
KPI_CRITICAL = 850
SCORE_MAX = 999

# Band sets: ascending cut points and one more label than cuts.
BANDS = {
    "severity": ([200, 500, 800], ["LOW", "MEDIUM", "HIGH", "CRITICAL"]),
    "kpi": ([700, 850], ["NORMAL", "HIGH", "CRITICAL"]),
    "badge": ([350, 650, 850], ["LOW", "MEDIUM", "HIGH", "CRITICAL"]),
    "bar": ([400, 700, 850], ["LOW", "MEDIUM", "HIGH", "CRITICAL"]),
    "entity": ([30, 60, 80], ["LOW", "MEDIUM", "HIGH", "CRITICAL"]),
    "consecutive": ([2, 5], ["ok", "warn", "danger"]),
    "high_risk_count": ([4, 11], ["ok", "warn", "danger"]),
}

# code -> (label, category, tone)
RULE_LABELS = {
    "R_HIGH_AMOUNT_10K": ("High amount ≥ 10,000", "Amount", "danger"),
    "R_WEEKEND_DEBIT": ("Weekend debit", "Time", "warning"),
    "R_LARGE_NIGHT_TXN": ("Large transaction at night", "Time", "warning"),
}

ML_FEATURES = [
    "amount_raw", "amount_log", "hour_of_day", "day_of_week",
    "is_weekend", "direction_is_credit", "vendor_risk_level_num", "has_employee_expense_link",
]
ML_AMOUNT_SCALE = 10_000.0
ML_FALLBACK_VERSION = "v2.0.0-dev"
ML_MODEL_VERSION = "v2.0.0"

NO_SIGNAL_EXPLANATION = "No risk signals available; defaulting to low risk."

PAGE_DEFAULT = 100
PAGE_MAX = 500


@dataclass(frozen=True)
class FusionWeights:
    """Relative weight of each scoring engine in the fused score."""

    rule: float = 0.4
    ml: float = 0.4
    graph: float = 0.2


@dataclass(frozen=True)
class GraphWeights:
    """Points per unit of each graph metric (fixed values of the graph score formula)."""

    degree: float = 5.0
    community: float = 2.0
    pagerank: float = 200.0
    neighbor_risk: float = 400.0
