"""The named queries once more as plain SQL, written independently of the DataFrame code."""

from __future__ import annotations

import re

from riskloom import config as C
from riskloom.plans.queries import DESCRIPTIONS, PAGERANK_ROUNDS, PLANTED, PREVIOUS_RUN, RULE_TEXTS
from riskloom.plans.views import SECOND_ALERT
from riskloom.sources.testdata import AS_OF, view_sql

NOW = f"TIMESTAMP '{AS_OF}'"
FIRST_DAY, LAST_DAY = "DATE '2024-01-01'", "DATE '2024-01-31'"


def _in(values) -> str:
    return "(" + ", ".join(f"'{x}'" for x in values) + ")"


def _list_text(values) -> str:
    return "[" + ", ".join(f"''{x}''" for x in sorted(values)) + "]"


def _half_up(total: str, n: str) -> str:
    """total / n to two places, halves away from zero, in whole numbers (values are not negative)."""
    return f"CAST((2 * CAST(100 * ({total}) AS HUGEINT) + ({n})) // (2 * ({n})) AS DOUBLE) / 100"


def _band(column: str, name: str) -> str:
    cuts, labels = C.BANDS[name]
    arms = " ".join(f"WHEN {column} < {c} THEN '{label}'" for c, label in zip(cuts, labels))
    return f"CASE {arms} ELSE '{labels[-1]}' END"


def _alias_map(column: str, aliases: dict, domain, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{x}'" for k, x in {**{d: d for d in domain}, **aliases}.items())
    return f"CASE upper(trim({column})) {arms} ELSE '{default}' END"


def _fuse(r: str, m: str, g: str) -> str:
    def num(c, w):
        return f"CASE WHEN {c} IS NULL THEN 0::DOUBLE ELSE {c}::DOUBLE / 999 * ({w}::DOUBLE / w) END"

    def weight(c, w):
        return f"CASE WHEN {c} IS NULL THEN 0::DOUBLE ELSE {w}::DOUBLE END"

    total = f"{weight(r, 0.4)} + {weight(m, 0.4)} + {weight(g, 0.2)}"
    parts = f"{num(r, 0.4)} + {num(m, 0.4)} + {num(g, 0.2)}".replace("/ w)", f"/ nullif({total}, 0))")
    return f"CAST(round_even(least(1::DOUBLE, coalesce({parts}, 0)) * 999, 0) AS BIGINT)"


_blank_first = " ".join(
    f"WHEN {c} IS NULL OR trim({c}) = '' THEN '{f}'"
    for f, c in ((f, "event_ts" if f == "timestamp" else f) for f in C.REQUIRED_FIELDS)
)

CTES: dict[str, str] = {
    "raw_events": view_sql("raw_events"),
    "vendors": view_sql("vendors"),
    "invoices": view_sql("invoices"),
    "expenses": view_sql("expenses"),
    "entities": view_sql("entities"),
    "judged": f"""
        SELECT *, CASE
            WHEN coalesce(TRY_CAST(tenant_id AS BIGINT), 0) <= 0 THEN 'INVALID_TENANT'
            WHEN (CASE {_blank_first} END) IS NOT NULL THEN 'MISSING_FIELD'
            WHEN coalesce(TRY_CAST(amount AS DOUBLE), -1) NOT BETWEEN 0.01 AND 10000000 THEN 'INVALID_AMOUNT'
            WHEN upper(trim(currency)) NOT IN {_in(C.CURRENCIES)} THEN 'INVALID_CURRENCY'
            WHEN upper(trim(direction)) NOT IN {_in(C.RAW_DIRECTIONS)} THEN 'INVALID_DIRECTION'
            WHEN upper(trim(status)) NOT IN {_in(C.RAW_STATUSES)} THEN 'INVALID_STATUS'
            WHEN TRY_CAST(event_ts AS TIMESTAMP) IS NULL OR TRY_CAST(event_ts AS TIMESTAMP) > {NOW} + INTERVAL 300 SECOND THEN 'INVALID_TIMESTAMP'
            WHEN TRY_CAST(event_ts AS TIMESTAMP) < {NOW} - INTERVAL 365 DAY THEN 'STALE_EVENT'
        END AS code FROM raw_events""",
    "reasons": f"""
        SELECT event_id, code, CASE code
            WHEN 'INVALID_TENANT' THEN CASE WHEN tenant_id IS NULL THEN 'tenant_id is missing'
                WHEN TRY_CAST(tenant_id AS BIGINT) IS NULL THEN 'tenant_id is not a valid integer: ''' || tenant_id || ''''
                ELSE 'tenant_id must be positive integer, got ' || tenant_id END
            WHEN 'MISSING_FIELD' THEN 'Required field ''' || (CASE {_blank_first} END) || ''' is missing or empty'
            WHEN 'INVALID_AMOUNT' THEN CASE WHEN TRY_CAST(amount AS DOUBLE) IS NULL THEN 'amount is not a valid number: ''' || amount || ''''
                WHEN TRY_CAST(amount AS DOUBLE) < 0.01 THEN 'amount ' || CAST(TRY_CAST(amount AS DOUBLE) AS VARCHAR) || ' is below minimum 0.01 (zero or negative amounts rejected)'
                ELSE 'amount ' || format('{{:,.2f}}', TRY_CAST(amount AS DOUBLE)) || ' exceeds ceiling 10,000,000.00' END
            WHEN 'INVALID_CURRENCY' THEN 'currency ''' || upper(trim(currency)) || ''' is not in the allowed list. Allowed: {_list_text(C.CURRENCIES)}'
            WHEN 'INVALID_DIRECTION' THEN 'direction ''' || direction || ''' is not valid. Allowed: {_list_text(C.RAW_DIRECTIONS)}'
            WHEN 'INVALID_STATUS' THEN 'status ''' || status || ''' is not valid. Allowed: {_list_text(C.RAW_STATUSES)}'
            WHEN 'INVALID_TIMESTAMP' THEN CASE WHEN TRY_CAST(event_ts AS TIMESTAMP) IS NULL
                THEN 'timestamp ''' || event_ts || ''' could not be parsed: Invalid isoformat string: ''' || event_ts || ''''
                ELSE 'timestamp ' || replace(event_ts, ' ', 'T') || '+00:00 is ' || CAST(date_diff('second', {NOW}, TRY_CAST(event_ts AS TIMESTAMP)) % 86400 AS VARCHAR) || 's in the future (max allowed: 300s)' END
            WHEN 'STALE_EVENT' THEN 'timestamp ' || replace(event_ts, ' ', 'T') || '+00:00 is more than 365 days in the past'
        END AS reason FROM judged""",
    "tx": f"""
        SELECT event_id AS id, CAST(tenant_id AS BIGINT) AS tenant_id, transaction_id AS tx_id, account_id,
            CAST(event_ts AS TIMESTAMP) AS tx_time, CAST(amount AS DECIMAL(18,2)) AS amount, CAST(amount AS DOUBLE) AS amount_raw,
            upper(trim(currency)) AS currency,
            {_alias_map('direction', C.DIRECTION_ALIASES, C.DIRECTIONS, 'DEBIT')} AS direction, direction AS direction_raw,
            {_alias_map('status', C.STATUS_ALIASES, C.STATUSES, 'PENDING')} AS status,
            'XX' AS country_code, 'UNKNOWN' AS merchant_category, 'KAFKA' AS channel,
            'ref=' || transaction_reference AS description, transaction_reference, vendor_code, employee_id
        FROM judged WHERE code IS NULL""",
    "hits": """
        SELECT *, amount_raw >= 10000 AS h1, direction = 'DEBIT' AND isodow(tx_time) >= 6 AS h2,
            amount_raw >= 5000 AND (hour(tx_time) >= 22 OR hour(tx_time) < 6) AS h3 FROM tx""",
    "engines": """
        SELECT *, least(999, CASE WHEN h1 THEN 500 ELSE 0 END + CASE WHEN h2 THEN 200 ELSE 0 END + CASE WHEN h3 THEN 250 ELSE 0 END)::BIGINT AS rule_score,
            concat_ws(',', CASE WHEN h1 THEN 'R_HIGH_AMOUNT_10K' END, CASE WHEN h2 THEN 'R_WEEKEND_DEBIT' END, CASE WHEN h3 THEN 'R_LARGE_NIGHT_TXN' END) AS triggered_rules,
            greatest(0, least(1, amount_raw / 10000::DOUBLE)) AS xgb_score,
            CAST(trunc(greatest(0, least(1, amount_raw / 10000::DOUBLE)) * 999) AS BIGINT) AS ml_score,
            CASE WHEN vendor_code IS NOT NULL AND employee_id IS NOT NULL THEN 200 WHEN vendor_code IS NOT NULL THEN 134
                 WHEN employee_id IS NOT NULL THEN 75 ELSE 9 END::BIGINT AS graph_score,
            CASE WHEN vendor_code IS NOT NULL AND employee_id IS NOT NULL THEN 'High-degree node (degree=6) | In dense community (size=16) | Neighbors show elevated risk'
                 WHEN vendor_code IS NOT NULL THEN 'In dense community (size=11) | Neighbors show elevated risk' END AS graph_motifs
        FROM hits""",
    "scored": f"""
        SELECT *, {_band('risk_score', 'severity')} AS severity
        FROM (SELECT *, {_fuse('rule_score', 'ml_score', 'graph_score')} AS risk_score FROM engines)""",
    "alerts": "SELECT id AS alert_id, id AS transaction_id, tx_time AS scored_at, * EXCLUDE (id) FROM scored",
    "messy": f"""
        SELECT alert_id, tenant_id, CASE WHEN alert_id % 211 = 0 THEN -1 ELSE transaction_id END AS transaction_id, risk_score, scored_at FROM alerts
        UNION ALL
        SELECT alert_id + {SECOND_ALERT}, tenant_id, CASE WHEN alert_id % 211 = 0 THEN -1 ELSE transaction_id END, least(999, risk_score + 150), scored_at
        FROM alerts WHERE alert_id % 50 = 0""",
    "joined_messy": "SELECT t.tenant_id, t.account_id, m.risk_score FROM messy m JOIN tx t ON t.id = m.transaction_id",
    "plain_features": f"""
        SELECT t.tenant_id, t.account_id, count(*) AS n, count(*) FILTER (WHERE tx_time >= {NOW} - INTERVAL 24 HOUR) AS n24,
            count(*) FILTER (WHERE tx_time >= {NOW} - INTERVAL 7 DAY) AS n7, sum(amount) AS total, max(amount) AS top,
            min(tx_time) AS first_seen, max(tx_time) AS last_seen, max(risk_score) AS max_score,
            sum(risk_score) AS sum_score, count(*) FILTER (WHERE risk_score >= 500) AS n_high
        FROM scored t GROUP BY ALL""",
    "features": f"""
        SELECT tenant_id, account_id, n::BIGINT AS tx_count_total, n24::BIGINT AS tx_count_24h, n7::BIGINT AS tx_count_7d,
            total::DOUBLE AS amount_total, {_half_up('total', 'n')} AS amount_avg, top::DOUBLE AS amount_max, top::DOUBLE AS amount_last,
            max_score::BIGINT AS latest_risk_score, {_half_up('sum_score', 'n')} AS risk_score_avg, n_high::BIGINT AS high_risk_tx_count,
            n24 > 20 AS is_velocity_flagged, 0::BIGINT AS consecutive_high_risk,
            CAST(first_seen AS VARCHAR) AS first_seen_at, CAST(last_seen AS VARCHAR) AS last_seen_at
        FROM plain_features""",
    "earlier": f"SELECT * FROM scored WHERE tx_time < TIMESTAMP '{PREVIOUS_RUN}'",
    "earlier_rank": """
        SELECT *, row_number() OVER (PARTITION BY tenant_id, account_id ORDER BY tx_time DESC, tx_id DESC) AS back,
            max(CASE WHEN risk_score < 500 THEN 0 ELSE 1 END) OVER (PARTITION BY tenant_id, account_id) AS any_high FROM earlier""",
    "earlier_run": """
        SELECT tenant_id, account_id, coalesce(min(back) FILTER (WHERE risk_score < 500) - 1, count(*))::BIGINT AS run,
            max(amount) FILTER (WHERE back = 1)::DOUBLE AS last_amount
        FROM earlier_rank GROUP BY ALL""",
    "merged_features": """
        SELECT f.* REPLACE (coalesce(r.last_amount, f.amount_last) AS amount_last, coalesce(r.run, f.consecutive_high_risk) AS consecutive_high_risk)
        FROM features f LEFT JOIN earlier_run r USING (tenant_id, account_id)""",
    "one_invoice": """
        SELECT tenant_id, id, amount, vendor_code FROM (SELECT tenant_id, id, total_amount AS amount, vendor_id AS vendor_code,
            row_number() OVER (PARTITION BY tenant_id, id ORDER BY total_amount, vendor_id) AS k FROM invoices) WHERE k = 1""",
    "graded": """
        SELECT i.id, i.amount, v.vendor_risk_score AS vr, i.amount >= 100000 AS t1,
            CASE WHEN i.amount >= 100000 THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END AS s1,
            coalesce(v.vendor_risk_score >= 0.8::DOUBLE, false) AS t2, coalesce(v.vendor_risk_score, 0.05::DOUBLE) AS s2
        FROM one_invoice i LEFT JOIN vendors v USING (vendor_code)""",
    "graded_score": """
        SELECT *, least(1, (s1 * (CASE WHEN t1 THEN 2::DOUBLE ELSE 1::DOUBLE END) + s2 * (CASE WHEN t2 THEN 2::DOUBLE ELSE 1::DOUBLE END))
            / ((CASE WHEN t1 THEN 2 ELSE 1 END) + (CASE WHEN t2 THEN 2 ELSE 1 END))) AS rule_score FROM graded""",
    "pairs": """
        SELECT tenant_id, 'ACCOUNT:' || account_id AS a, 'VENDOR:' || vendor_code AS b FROM tx
        UNION SELECT tenant_id, 'ACCOUNT:' || account_id, 'EMPLOYEE:' || employee_id FROM tx
        UNION SELECT tenant_id, 'VENDOR:' || vendor_code, 'EMPLOYEE:' || employee_id FROM tx
        UNION SELECT 1, 'VENDOR:' || i.vendor_id, 'EMPLOYEE:' || e.employee_id FROM expenses e JOIN invoices i ON i.id = e.invoice_id""",
    "edges": "SELECT DISTINCT tenant_id, least(a, b) AS src, greatest(a, b) AS dst FROM pairs WHERE a IS NOT NULL AND b IS NOT NULL",
    "links": "SELECT tenant_id, src AS node, dst AS other FROM edges UNION ALL SELECT tenant_id, dst, src FROM edges",
    "degree": "SELECT tenant_id, node, count(*) AS degree FROM links GROUP BY ALL",
    "reach": """
        SELECT tenant_id, node, node AS seen FROM links UNION
        SELECT r.tenant_id, r.node, l.other FROM reach r JOIN links l ON l.tenant_id = r.tenant_id AND l.node = r.seen""",
    "component": "SELECT tenant_id, node, min(seen) AS component, count(DISTINCT seen) AS community_size FROM reach GROUP BY ALL",
    "node_count": "SELECT tenant_id, count(*) AS n FROM degree GROUP BY ALL",
    "rank0": "SELECT d.tenant_id, d.node, d.degree, c.n, 1::DOUBLE / c.n AS pr FROM degree d JOIN node_count c USING (tenant_id)",
    "node_risk": """
        SELECT tenant_id, node, sum(risk_score) / count(*) / 999::DOUBLE AS risk FROM (
            SELECT tenant_id, risk_score, unnest(['ACCOUNT:' || account_id, 'VENDOR:' || vendor_code, 'EMPLOYEE:' || employee_id]) AS node FROM alerts)
        WHERE node IS NOT NULL GROUP BY ALL""",
    "neighbor": """
        SELECT l.tenant_id, l.node, avg(coalesce(r.risk, 0)) AS avg_neighbor_risk
        FROM links l LEFT JOIN node_risk r ON r.tenant_id = l.tenant_id AND r.node = l.other GROUP BY ALL""",
    "ml": """
        SELECT id, amount_raw, ln(1 + amount_raw) AS amount_log, hour(tx_time)::DOUBLE AS hour_of_day, (isodow(tx_time) - 1)::DOUBLE AS day_of_week,
            CASE WHEN isodow(tx_time) >= 6 THEN 1::DOUBLE ELSE 0::DOUBLE END AS is_weekend,
            CASE WHEN upper(direction_raw) = 'CREDIT' THEN 1::DOUBLE ELSE 0::DOUBLE END AS direction_is_credit,
            0::DOUBLE AS vendor_risk_level_num, 0::DOUBLE AS has_employee_expense_link FROM tx""",
    "ml_mean": "SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in C.ML_FEATURES) + " FROM ml WHERE amount_raw <= 8000",
    "ml_error": "SELECT id, amount_raw, sqrt(" + " + ".join(f"({c} - m_{c}) ** 2" for c in C.ML_FEATURES) + ") AS error FROM ml, ml_mean",
    "ml_profile": """
        SELECT count(*) AS n_rows, avg(error) AS error_mean, stddev_pop(error) AS error_std, avg(error) + 3 * stddev_pop(error) AS threshold
        FROM ml_error WHERE amount_raw <= 8000""",
}
for _i in range(1, PAGERANK_ROUNDS + 1):
    CTES[f"rank{_i}"] = f"""
        SELECT a.tenant_id, a.node, a.degree, a.n, 0.15::DOUBLE / a.n + 0.85::DOUBLE * sum(b.pr / b.degree) AS pr
        FROM rank{_i - 1} a JOIN links l ON l.tenant_id = a.tenant_id AND l.node = a.node
        JOIN rank{_i - 1} b ON b.tenant_id = l.tenant_id AND b.node = l.other GROUP BY a.tenant_id, a.node, a.degree, a.n"""


def with_ctes(body: str) -> str:
    """Prefix a statement with the common table expressions it reads, in dependency order."""
    needed: list[str] = []

    def visit(sql: str, inside: frozenset[str]) -> None:
        for name in CTES:
            if name in needed or name in inside or not re.search(rf"(\bFROM|\bJOIN|,)\s+{name}\b", sql):
                continue
            visit(CTES[name], inside | {name})
            if name not in needed:
                needed.append(name)

    visit(body, frozenset())
    if not needed:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


def _table_count(cols: str, table: str, name: str) -> str:
    return f"""SELECT '{name}' AS table_name, '{cols}' AS key_columns, count(*) AS n_keys, coalesce(sum(n - 1), 0)::BIGINT AS n_extra_rows
        FROM (SELECT count(*) AS n FROM {table} GROUP BY {cols} HAVING count(*) > 1)"""


def _orphan_count(relation: str, child: str, column: str, parent: str) -> str:
    return f"""SELECT '{relation}' AS relation, count(DISTINCT (c.tenant_id, c.{column})) AS n_values, count(*) AS n_rows
        FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.id = c.{column} AND p.tenant_id = c.tenant_id)"""


def _check(table: str, source: str, name: str, bad: str) -> str:
    return f"SELECT '{table}' AS table_name, '{name}' AS check_name, count(*) FILTER (WHERE {bad}) AS n_rows FROM {source}"


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_TX = "id, tenant_id, tx_id, account_id"
_TIME = "CAST(tx_time AS VARCHAR) AS tx_time"
_REJECTED = """j.event_id AS source_id, 'raw' AS pipeline_stage, r.code AS rejection_code, r.reason AS rejection_reason,
    TRY_CAST(tenant_id AS BIGINT) AS tenant_id, transaction_reference AS event_id_text, account_id,
    CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, transaction_reference AS payload_reference, amount AS payload_amount"""
_FEATURES = "tenant_id, account_id, " + ", ".join([
    "tx_count_total", "tx_count_24h", "tx_count_7d", "amount_total", "amount_avg", "amount_max", "amount_last",
    "latest_risk_score", "risk_score_avg", "high_risk_tx_count", "is_velocity_flagged", "consecutive_high_risk",
    "first_seen_at", "last_seen_at",
])
_RUNS = """SELECT *, sum(CASE WHEN risk_score < 500 THEN 1 ELSE 0 END) OVER (PARTITION BY tenant_id, account_id ORDER BY tx_time, tx_id ROWS UNBOUNDED PRECEDING) AS island FROM scored"""
_NEW_RISK = "least((latest_risk_score + 5) // 10, 100)"


def _daily(source: str, n: str, k: str, s: str, m: str, h: str, debit: str, credit: str, total: str) -> str:
    return f"""SELECT tenant_id, account_id, CAST(d AS VARCHAR) AS summary_date, ({n})::BIGINT AS tx_count, ({debit})::BIGINT AS tx_count_debit,
        ({credit})::BIGINT AS tx_count_credit, ({total})::DOUBLE AS amount_total, {_half_up(total, n)} AS amount_avg,
        max(amount)::DOUBLE AS amount_max, min(amount)::DOUBLE AS amount_min,
        CASE WHEN {k} = 0 THEN 0::DOUBLE ELSE {_half_up(s, f'greatest({k}, 1)')} END AS risk_score_avg,
        coalesce({m}, 0)::BIGINT AS risk_score_max, ({h})::BIGINT AS high_risk_tx_count
        FROM ({source}) GROUP BY tenant_id, account_id, d"""


_IN_RANGE = f"CAST(tx_time AS DATE) BETWEEN {FIRST_DAY} AND {LAST_DAY}"
_LATEST_ALERT = "(SELECT transaction_id, arg_max(risk_score, alert_id) AS score FROM messy GROUP BY ALL)"

_graph_cols = """d.degree AS degree, c.community_size AS size, k.pr AS pr, nb.avg_neighbor_risk AS nr"""

# Events whose tenant is sent as 1.0, "1.0" or true.
_RESPELLED = "(event_id % 149 IN (3, 4, 5) AND regexp_full_match(coalesce(tenant_id, ''), '[1-9]'))"


def _planted(name: str, source: str) -> str:
    return f"(SELECT * REPLACE ({', '.join(f'{x} AS {c}' for c, x in PLANTED[name].items())}) FROM {source})"


def _report(name: str, source: str, keys: list[str], checks: dict[str, str]) -> list[str]:
    rows = _planted(name, source)
    out = [f"SELECT '{name}' AS table_name, 'unique {k}' AS check_name, coalesce(sum(n - 1), 0)::BIGINT AS n_rows FROM (SELECT count(*) AS n FROM {rows} GROUP BY {k})" for k in keys]
    return out + [f"SELECT '{name}', '{n}', count(*) FILTER (WHERE {bad}) FROM {rows}" for n, bad in checks.items()]


def _outside(column: str, values) -> dict[str, str]:
    return {f"{column} in domain": f"{column} NOT IN {_in(values)}"}


def _beyond(columns, low: int, high: int) -> dict[str, str]:
    return {f"{c} in {low}..{high}": f"{c} < {low} OR {c} > {high}" for c in columns}


def _longer(limits: dict[str, int]) -> dict[str, str]:
    return {f"{c}<={n}": f"length({c}) > {n}" for c, n in limits.items()}


def _missing(*columns: str) -> dict[str, str]:
    return {f"{c} not null": f"{c} IS NULL" for c in columns}


def _two_tenants(source: str, columns: str, ids: str, keep: str = "true") -> str:
    return f"""(SELECT 1 AS tenant_id, {ids}, {columns} FROM {source}
        UNION ALL SELECT 2, CASE WHEN {ids} % 3 = 1 THEN {ids} + 1000000000 ELSE {ids} END, {columns} FROM {source} WHERE {keep})"""


QUERIES: dict[str, str] = {
    "decode_payload": f"""SELECT event_id, event_id % 137 <> 3 AS parse_ok, CASE WHEN NOT {_RESPELLED} THEN tenant_id WHEN event_id % 149 = 5 THEN 'true' ELSE tenant_id || '.0' END AS tenant_id,
            CASE WHEN {_RESPELLED} AND event_id % 149 = 3 THEN CAST(tenant_id AS BIGINT) WHEN {_RESPELLED} AND event_id % 149 = 5 THEN 1 END AS tenant_number, CASE WHEN event_id % 139 = 3 THEN 'T' || transaction_id ELSE transaction_id END AS transaction_id,
        transaction_reference, account_id, amount, currency, direction, status, event_ts, vendor_code, employee_id FROM raw_events WHERE event_id % 137 <> 3
        UNION ALL SELECT event_id, false, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM raw_events WHERE event_id % 137 = 3""",
    "validate_events": "SELECT event_id, code IS NULL AS valid, code AS rejection_code, reason AS rejection_reason FROM reasons",
    "rejected_events": f"SELECT {_REJECTED} FROM judged j JOIN reasons r ON r.event_id = j.event_id WHERE j.code IS NOT NULL",
    "valid_events": """SELECT CAST(tenant_id AS BIGINT) AS tenant_id, event_id AS transaction_id, transaction_reference, account_id, CAST(amount AS DOUBLE) AS amount,
        upper(currency) AS currency, direction, status, event_ts AS event_time, vendor_code, employee_id FROM judged WHERE code IS NULL""",
    "schema_errors": """SELECT event_id AS source_id, 'SCHEMA_ERROR' AS rejection_code,
        CASE WHEN event_id % 137 = 3 THEN 'payload is not a JSON object' ELSE 'transaction_id is not a valid integer: ''T' || transaction_id || '''' END AS rejection_reason
        FROM judged WHERE event_id % 137 = 3 OR (code IS NULL AND event_id % 139 = 3 AND event_id % 149 <> 4)""",
    "typed_ids": f"""SELECT event_id, CASE WHEN event_id % 137 = 3 OR ({_RESPELLED} AND event_id % 149 = 4) THEN NULL WHEN {_RESPELLED} AND event_id % 149 = 5 THEN 1 ELSE TRY_CAST(tenant_id AS BIGINT) END AS tenant_id,
            CASE WHEN event_id % 137 = 3 THEN 'SCHEMA_ERROR' WHEN {_RESPELLED} AND event_id % 149 = 4 THEN 'INVALID_TENANT' WHEN code IS NULL AND event_id % 139 = 3 THEN 'SCHEMA_ERROR' ELSE code END AS rejection_code
        FROM judged""",
    "reject_profile": "SELECT 'raw' AS pipeline_stage, code AS rejection_code, count(*) AS n_events FROM judged WHERE code IS NOT NULL GROUP BY code",
    "rejects_latest": """SELECT j.event_id AS source_id, r.code AS rejection_code, r.reason AS rejection_reason, j.account_id
        FROM judged j JOIN reasons r ON r.event_id = j.event_id WHERE j.code IS NOT NULL ORDER BY j.event_id DESC LIMIT 10""",
    "normalize_tx": f"""SELECT {_TX}, NULL::VARCHAR AS customer_id, NULL::BIGINT AS invoice_id, {_TIME}, CAST(tx_time AS VARCHAR) AS booking_time,
        amount::DOUBLE AS amount, currency, direction, status, country_code, merchant_category, channel, description FROM tx""",
    "severity_bands": "SELECT id, risk_score, severity FROM scored",
    "risk_bands_all": "SELECT alert_id, risk_score, "
    + ", ".join(f"{_band('risk_score', n)} AS {n}" for n in ("severity", "kpi", "badge", "bar"))
    + ", round(risk_score::DOUBLE / 999 * 100, 4) AS percent FROM alerts",
    "entity_bands": f"""SELECT f.tenant_id, f.account_id, e.risk_score::BIGINT AS entity_risk, {_band('e.risk_score', 'entity')} AS entity_band,
        f.consecutive_high_risk, {_band('f.consecutive_high_risk', 'consecutive')} AS consecutive_tone, f.high_risk_tx_count,
        CASE WHEN f.high_risk_tx_count > 10 THEN 'danger' WHEN f.high_risk_tx_count > 3 THEN 'warn' ELSE 'ok' END AS high_risk_tone
        FROM merged_features f JOIN entities e ON e.entity_id = f.account_id""",
    "tx_reference": f"""SELECT id, CASE WHEN d LIKE '%ref=%' AND trim(substr(d, strpos(d, 'ref=') + 4)) <> '' THEN trim(substr(d, strpos(d, 'ref=') + 4)) ELSE tx_id END AS transaction_reference
        FROM (SELECT id, tx_id, trim({DESCRIPTIONS}) AS d FROM tx)""",
    "parse_rules": f"""SELECT id, len(l)::BIGINT AS n_rules, array_to_string(l, ',') AS rules_text FROM (
        SELECT id, list_filter(list_transform(CASE WHEN id % 5 = 2 THEN ['Y_' || tx_id, 'Z', ''] ELSE string_split(coalesce({RULE_TEXTS}, ''), ',') END, lambda x: trim(x)), lambda x: x <> '') AS l
        FROM (SELECT *, triggered_rules AS stored FROM scored))""",
    "parse_rule_results": """SELECT id, CASE id % 7 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE 2 END::BIGINT AS n_results,
        CASE id % 7 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN 'a' WHEN 3 THEN '' ELSE 'high_amount,vendor_risk' END AS names,
        CASE id % 7 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE (CASE WHEN t1 THEN 1 ELSE 0 END + CASE WHEN t2 THEN 1 ELSE 0 END) END::BIGINT AS n_triggered FROM graded""",
    "tx_view": """SELECT id, tenant_id, tx_id, transaction_reference, account_id, NULL::VARCHAR AS customer_id, NULL::BIGINT AS invoice_id,
        CAST(tx_time AS VARCHAR) AS tx_time, CAST(tx_time AS VARCHAR) AS "timestamp", CAST(tx_time AS VARCHAR) AS booking_time,
        CASE WHEN id % 9 = 0 THEN 0::DOUBLE ELSE amount::DOUBLE END AS amount, currency, direction, status, country_code, merchant_category, channel, description FROM tx""",
    "rule_hits_labelled": """SELECT id, rule_id, CASE rule_id WHEN 'R_HIGH_AMOUNT_10K' THEN 'High amount ≥ 10,000' WHEN 'R_WEEKEND_DEBIT' THEN 'Weekend debit'
            WHEN 'R_LARGE_NIGHT_TXN' THEN 'Large transaction at night' ELSE rule_id END AS label,
        CASE rule_id WHEN 'R_HIGH_AMOUNT_10K' THEN 'Amount' WHEN 'R_UNKNOWN' THEN 'Other' ELSE 'Time' END AS category,
        CASE rule_id WHEN 'R_HIGH_AMOUNT_10K' THEN 'danger' WHEN 'R_UNKNOWN' THEN 'neutral' ELSE 'warning' END AS tone
        FROM (SELECT id, 'R_HIGH_AMOUNT_10K' AS rule_id FROM hits WHERE h1 UNION ALL SELECT id, 'R_WEEKEND_DEBIT' FROM hits WHERE h2
            UNION ALL SELECT id, 'R_LARGE_NIGHT_TXN' FROM hits WHERE h3 UNION ALL SELECT id, 'R_UNKNOWN' FROM hits WHERE id % 11 = 0)""",
    "backfill_ts": f"""SELECT id, CAST(CASE WHEN id % 3 <> 0 THEN tx_time ELSE {NOW} END AS VARCHAR) AS created_at,
        CAST(CASE WHEN id % 4 <> 0 THEN tx_time ELSE {NOW} END AS VARCHAR) AS updated_at FROM tx""",
    "score_type_repair": "SELECT id, CAST(round_even(CASE WHEN id % 10 = 9 THEN 0::DOUBLE ELSE (risk_score - 50) / 2::DOUBLE END, 0) AS BIGINT) AS score FROM entities",
    "entity_features_view": """SELECT e.id, e.entity_id, e.entity_id AS account_id, coalesce(tx_count_total, 0) AS tx_count_total, coalesce(tx_count_24h, 0) AS tx_count_24h,
        coalesce(tx_count_7d, 0) AS tx_count_7d, coalesce(amount_total, 0) AS amount_total, coalesce(amount_avg, 0) AS amount_avg,
        coalesce(amount_max, 0) AS amount_max, coalesce(amount_last, 0) AS amount_last, coalesce(latest_risk_score, e.risk_score)::BIGINT AS latest_risk_score,
        coalesce(risk_score_avg, 0) AS risk_score_avg, coalesce(high_risk_tx_count, 0) AS high_risk_tx_count,
        coalesce(is_velocity_flagged, false) AS is_velocity_flagged, coalesce(consecutive_high_risk, 0) AS consecutive_high_risk,
        first_seen_at, last_seen_at, CASE WHEN f.account_id IS NULL THEN 'entity_only' ELSE 'entity_features' END AS source
        FROM entities e LEFT JOIN features f ON f.account_id = e.entity_id AND f.tenant_id = 1""",
    "rules_v1": """SELECT id, 'high_amount' AS rule_name, t1 AS triggered, s1 AS score,
            CASE WHEN t1 THEN 'High amount detected: ' || CAST(amount::DOUBLE AS VARCHAR) ELSE '' END AS reasons FROM graded
        UNION ALL SELECT id, 'vendor_risk', t2, s2, CASE WHEN t2 THEN 'Vendor risk score=' || CAST(vr AS VARCHAR) ELSE '' END FROM graded""",
    "rule_score_v1": "SELECT id, round(rule_score, 6) AS rule_score FROM graded_score",
    "fused_v1": """SELECT id, (id % 100) / 100::DOUBLE AS anomaly_score,
        CAST(round_even((rule_score * 0.5::DOUBLE + (id % 100) / 100::DOUBLE * 0.5::DOUBLE) * 999, 0) AS BIGINT) AS risk_score FROM graded_score""",
    "rule_hits": """SELECT id, rule_score, unnest(string_split(triggered_rules, ',')) AS rule_id FROM scored WHERE triggered_rules <> ''""",
    "rule_hit_counts": """SELECT rule_id, severity, count(*) AS n_hits FROM (SELECT severity, unnest(string_split(triggered_rules, ',')) AS rule_id FROM scored WHERE triggered_rules <> '') GROUP BY ALL""",
    "ml_features": "SELECT * REPLACE (round(amount_log, 6) AS amount_log) FROM ml",
    "ml_scores": "SELECT id, xgb_score, xgb_score * 0.5::DOUBLE AS ae_score, ml_score, 'v2.0.0-dev' AS model_version FROM scored",
    "graph_scores": "SELECT id, graph_score, graph_motifs FROM scored",
    "fusion": """SELECT id, rule_score, ml_score, graph_score, risk_score,
        'Rules=' || rule_score || ' | ML=' || ml_score || ' | Graph=' || graph_score AS explanation FROM scored""",
    "fusion_missing": f"""SELECT id, {_fuse('r', 'm', 'g')} AS risk_score,
        coalesce(nullif(concat_ws(' | ', 'Rules=' || r, 'ML=' || m, 'Graph=' || g), ''), '{C.NO_SIGNAL_EXPLANATION}') AS explanation
        FROM (SELECT id, CASE WHEN id % 2 = 0 THEN rule_score END AS r, CASE WHEN id % 3 = 0 THEN ml_score END AS m, CASE WHEN id % 5 = 0 THEN graph_score END AS g FROM scored)""",
    "risk_preview": "SELECT transaction_reference, risk_score, rule_score, ml_score, graph_score, triggered_rules, graph_motifs FROM scored",
    "alerts": """SELECT alert_id, tenant_id, transaction_id, transaction_reference, account_id, vendor_code, employee_id, risk_score, severity,
        rule_score, ml_score, graph_score, triggered_rules, graph_motifs, NULL::VARCHAR AS rule_results_json, CAST(scored_at AS VARCHAR) AS scored_at FROM alerts""",
    "alerts_json": """SELECT transaction_reference AS key, 'v1' AS event_version, CAST(tenant_id AS VARCHAR) AS tenant_id, CAST(transaction_id AS VARCHAR) AS transaction_id,
        account_id, vendor_code, CAST(risk_score AS VARCHAR) AS risk_score,
        '[' || CASE WHEN triggered_rules = '' THEN '' ELSE '"' || replace(triggered_rules, ',', '","') || '"' END || ']' AS triggered_rules,
        strftime(scored_at, '%Y-%m-%dT%H:%M:%S.000Z') AS scored_at FROM alerts""",
    "entity_features_batch": f"""SELECT f.* REPLACE (coalesce(g.hi, 0)::BIGINT AS latest_risk_score, coalesce(g.av, 0) AS risk_score_avg, coalesce(g.nh, 0)::BIGINT AS high_risk_tx_count)
        FROM features f LEFT JOIN (SELECT tenant_id, account_id, max(risk_score) AS hi, {_half_up('sum(risk_score)', 'count(*)')} AS av,
            count(*) FILTER (WHERE risk_score >= 500) AS nh FROM joined_messy GROUP BY tenant_id, account_id) g USING (tenant_id, account_id)""",
    "alert_agg": f"""SELECT tenant_id, account_id, {_half_up('sum(risk_score)', 'count(*)')} AS risk_score_avg, max(risk_score)::BIGINT AS latest_risk_score,
        count(*) FILTER (WHERE risk_score >= 500) AS high_risk_tx_count FROM joined_messy GROUP BY tenant_id, account_id""",
    "daily_summary": _daily(
        f"SELECT t.*, CAST(tx_time AS DATE) AS d, a.score FROM tx t LEFT JOIN {_LATEST_ALERT} a ON a.transaction_id = t.id WHERE {_IN_RANGE}",
        "count(*)", "count(score)", "sum(score)", "max(score)", "count(*) FILTER (WHERE score >= 500)",
        "count(*) FILTER (WHERE direction = 'DEBIT')", "count(*) FILTER (WHERE direction = 'CREDIT')", "sum(amount)"),
    "daily_summary_fanout": _daily(
        f"SELECT t.*, CAST(tx_time AS DATE) AS d, a.risk_score AS score FROM tx t LEFT JOIN messy a ON a.transaction_id = t.id WHERE {_IN_RANGE}",
        "count(*)", "count(score)", "sum(score)", "max(score)", "count(*) FILTER (WHERE score >= 500)",
        "count(*) FILTER (WHERE direction = 'DEBIT')", "count(*) FILTER (WHERE direction = 'CREDIT')", "sum(amount)"),
    "entity_risk_sync": f"""SELECT e.id, e.entity_id, e.risk_score::BIGINT AS old_risk_score, {_NEW_RISK}::BIGINT AS risk_score
        FROM entities e JOIN features f ON f.account_id = e.entity_id AND f.tenant_id = 1 WHERE {_NEW_RISK} <> e.risk_score""",
    "risk_sync_dryrun": f"SELECT count(*) AS n_changes FROM entities e JOIN features f ON f.account_id = e.entity_id WHERE {_NEW_RISK} <> e.risk_score",
    "dryrun_counts": f"""SELECT count(DISTINCT account_id) AS n_entities,
        count(DISTINCT account_id || '/' || CAST(CAST(tx_time AS DATE) AS VARCHAR)) FILTER (WHERE {_IN_RANGE}) AS n_daily_rows FROM tx""",
    "summary_extent": """SELECT count(*) AS n_rows, CAST(min(d) AS VARCHAR) AS first_date, CAST(max(d) AS VARCHAR) AS last_date
        FROM (SELECT DISTINCT tenant_id, account_id, CAST(tx_time AS DATE) AS d FROM tx)""",
    "velocity_flags": "SELECT tenant_id, account_id, tx_count_24h, is_velocity_flagged FROM features",
    "velocity_sliding": """SELECT tenant_id, account_id, CAST(s AS VARCHAR) AS window_start, count(*) AS tx_count FROM (
            SELECT tenant_id, account_id, unnest(generate_series(date_trunc('hour', tx_time) - INTERVAL 23 HOUR, date_trunc('hour', tx_time), INTERVAL 1 HOUR)) AS s FROM tx)
        GROUP BY tenant_id, account_id, s HAVING count(*) > 20""",
    "rolling_velocity": """SELECT tenant_id, account_id, CAST(tx_time AS VARCHAR) AS tx_time, id, amount::DOUBLE AS amount,
            count(*) OVER d AS count_24h, sum(amount) OVER d::DOUBLE AS sum_24h, count(*) OVER w AS count_7d, sum(amount) OVER w::DOUBLE AS sum_7d
        FROM tx WINDOW d AS (PARTITION BY tenant_id, account_id ORDER BY tx_time RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW),
            w AS (PARTITION BY tenant_id, account_id ORDER BY tx_time RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""",
    "consecutive_high_risk": f"""SELECT tenant_id, account_id, count(*) FILTER (WHERE risk_score >= 500 AND island = last_island) AS consecutive_high_risk
        FROM (SELECT *, max(island) OVER (PARTITION BY tenant_id, account_id) AS last_island FROM ({_RUNS})) GROUP BY ALL""",
    "high_risk_runs": f"""SELECT id, tenant_id, account_id, {_TIME}, risk_score,
        count(*) FILTER (WHERE risk_score >= 500) OVER (PARTITION BY tenant_id, account_id, island ORDER BY tx_time, tx_id ROWS UNBOUNDED PRECEDING) AS consecutive_high_risk
        FROM ({_RUNS})""",
    "latest_state": """SELECT tenant_id, account_id, amount::DOUBLE AS amount_last, risk_score AS latest_risk_score, tx_id AS last_tx_id, CAST(tx_time AS VARCHAR) AS last_seen_at
        FROM (SELECT *, row_number() OVER (PARTITION BY tenant_id, account_id ORDER BY tx_time DESC, tx_id DESC) AS k FROM scored) WHERE k = 1""",
    "running_risk_avg": f"""SELECT id, tenant_id, account_id, n AS tx_count, {_half_up('s', 'n')} AS risk_score_avg FROM (
            SELECT id, tenant_id, account_id, count(*) OVER w AS n, sum(risk_score) OVER w AS s FROM scored
            WINDOW w AS (PARTITION BY tenant_id, account_id ORDER BY tx_time, tx_id ROWS UNBOUNDED PRECEDING))""",
    "tx_spikes": """SELECT tenant_id, account_id, CAST(d AS VARCHAR) AS tx_date, n AS tx_count, k AS trailing_days, s::BIGINT AS trailing_count,
        k > 1 AND k * n > s AND (k * n - s) ** 2 > 4 * (k * q - s * s) AS is_spike FROM (
            SELECT tenant_id, account_id, d, n, count(*) OVER w AS k, coalesce(sum(n) OVER w, 0) AS s, coalesce(sum(n * n) OVER w, 0) AS q FROM (
                SELECT tenant_id, account_id, CAST(tx_time AS DATE) AS d, count(*) AS n FROM tx GROUP BY ALL)
            WINDOW w AS (PARTITION BY tenant_id, account_id ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))""",
    "tx_duplicates": f"""SELECT id, tenant_id, account_id, amount::DOUBLE AS amount, {_TIME}, CAST(p AS VARCHAR) AS previous_time FROM (
            SELECT *, lag(tx_time) OVER (PARTITION BY tenant_id, account_id, amount ORDER BY tx_time, tx_id) AS p FROM tx)
        WHERE date_diff('second', p, tx_time) <= 86400""",
    "invoice_duplicates": """SELECT id, invoice_number, tenant_id::BIGINT AS tenant_id, vendor_id, subtotal_amount::DOUBLE AS subtotal_amount, CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(p AS VARCHAR) AS previous_date FROM (
            SELECT *, lag(invoice_date) OVER (PARTITION BY tenant_id, vendor_id, subtotal_amount ORDER BY invoice_date, id) AS p FROM (
                SELECT id, invoice_number, tenant_id, vendor_id, subtotal_amount, invoice_date FROM invoices
                UNION ALL SELECT id + 1000000000000, invoice_number, tenant_id, vendor_id, subtotal_amount, CAST(invoice_date + CAST(CASE WHEN (id // 10) % 2 = 0 THEN 100 ELSE 500 END AS INTEGER) AS DATE) FROM invoices WHERE id % 5 = 0))
        WHERE date_diff('day', p, invoice_date) <= 365""",
    "expense_patterns": f"""SELECT category, cost_center_code, grouping(category, cost_center_code)::BIGINT AS level, count(*) AS n_expenses, sum(amount)::DOUBLE AS amount_total, max(amount)::DOUBLE AS amount_max,
        count(DISTINCT employee_id) AS n_employees, {_half_up('sum(amount)', 'count(*)')} AS amount_avg
        FROM (SELECT * REPLACE (CASE WHEN id % 9 <> 0 THEN cost_center_code END AS cost_center_code) FROM expenses) GROUP BY ROLLUP (category, cost_center_code)""",
    "expense_linkage": """SELECT e.id, e.employee_id, e.amount::DOUBLE AS amount, e.invoice_id, e.transaction_id, i.vendor_code AS vendor_id, i.amount::DOUBLE AS invoice_amount, t.amount::DOUBLE AS payment_amount,
        CASE WHEN e.invoice_id IS NOT NULL AND i.id IS NULL AND e.transaction_id IS NOT NULL AND t.id IS NULL THEN 'BOTH_MISSING'
             WHEN e.invoice_id IS NOT NULL AND i.id IS NULL THEN 'INVOICE_MISSING' WHEN e.transaction_id IS NOT NULL AND t.id IS NULL THEN 'PAYMENT_MISSING' ELSE 'OK' END AS link_status
        FROM expenses e LEFT JOIN one_invoice i ON i.id = e.invoice_id AND i.tenant_id = e.tenant_id LEFT JOIN tx t ON t.id = e.transaction_id AND t.tenant_id = e.tenant_id""",
    "enrich_vendor": """SELECT t.id, t.vendor_code, v.risk_level AS vendor_risk_level, v.country_code AS vendor_country_code, v.vendor_risk_score, v.country_code = 'US' AS is_high_risk_country
        FROM tx t LEFT JOIN vendors v ON v.tenant_id = t.tenant_id AND v.vendor_code = t.vendor_code""",
    "seed_entities": """SELECT 'ACC:' || a AS entity_id, 'Account ' || a AS name, 'ACCOUNT' AS type, 0::BIGINT AS risk_score FROM (
            SELECT DISTINCT account_id AS a FROM tx WHERE account_id NOT IN (SELECT 'ACC-' || CAST(id * 20 AS VARCHAR) FROM entities))
        UNION ALL SELECT 'CUST:' || c, 'Customer ' || c, 'PERSON', 0 FROM (SELECT DISTINCT employee_id AS c FROM tx WHERE employee_id IS NOT NULL)""",
    "alerts_summary": """SELECT count(*) AS total_alerts, count(*) FILTER (WHERE risk_score >= 700) AS high_risk_alerts,
        count(*) FILTER (WHERE risk_score >= 850) AS critical_alerts, round(avg(risk_score), 4) AS avg_risk_score FROM alerts""",
    "alerts_list": """SELECT alert_id, risk_score, severity, CAST(scored_at AS VARCHAR) AS scored_at FROM alerts WHERE risk_score >= 300 AND severity = 'HIGH'
        ORDER BY alerts.risk_score DESC, alerts.scored_at DESC, alert_id DESC LIMIT 100 OFFSET 20""",
    "alerts_latest": "SELECT alert_id, risk_score, severity, account_id FROM alerts ORDER BY alert_id DESC LIMIT 5",
    "alerts_sorted": "SELECT alert_id, CAST(scored_at AS VARCHAR) AS scored_at, risk_score FROM alerts ORDER BY alerts.scored_at, alert_id LIMIT 100",
    "alerts_search": "SELECT alert_id, transaction_reference, account_id FROM alerts WHERE lower(transaction_reference) LIKE '%acc-1%' OR lower(account_id) LIKE '%acc-1%'",
    "alert_detail": f"""SELECT m.alert_id, m.transaction_id, m.risk_score, t.tx_id, CAST(t.tx_time AS VARCHAR) AS tx_time, t.amount::DOUBLE AS amount, t.direction, t.status, t.description
        FROM messy m JOIN tx t ON t.id = m.transaction_id""",
    "alerts_detached": "SELECT alert_id, transaction_id FROM messy WHERE transaction_id NOT IN (SELECT id FROM tx)",
    "transactions_list": f"""SELECT id, account_id, CAST(tx_time AS VARCHAR) AS tx_time, amount::DOUBLE AS amount FROM tx
        WHERE account_id = 'ACC-0' AND tx.tx_time BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 12:00:00' ORDER BY tx.tx_time DESC, id DESC LIMIT 100""",
    "invoices_list": """SELECT id, invoice_number, vendor_id, CAST(invoice_date AS VARCHAR) AS invoice_date, total_amount::DOUBLE AS total_amount, status FROM invoices
        WHERE vendor_id = 'VEND-7' AND invoices.invoice_date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' ORDER BY invoices.invoice_date DESC, id DESC, subtotal_amount DESC LIMIT 100""",
    "expenses_list": """SELECT id, employee_id, category, status, CAST(expense_date AS VARCHAR) AS expense_date, amount::DOUBLE AS amount FROM expenses
        WHERE employee_id = 'EMP-3' AND category = 'MEALS' AND status = 'PAID' AND expenses.expense_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
        AND expenses.amount BETWEEN 1000 AND 400000 ORDER BY expenses.expense_date DESC, id DESC LIMIT 100""",
    "vendors_list": """SELECT vendor_code, name, country_code, risk_level, CAST(onboarding_date AS VARCHAR) AS onboarding_date FROM vendors
        WHERE country_code = 'US' AND risk_level = 'HIGH' AND vendors.onboarding_date BETWEEN DATE '2020-01-01' AND DATE '2020-12-31' ORDER BY name, vendor_code LIMIT 100""",
    "entities_search": "SELECT id, entity_id, name, type, risk_score::BIGINT AS risk_score FROM entities WHERE name LIKE '%ACC-1%' OR entity_id LIKE '%ACC-1%' ORDER BY id LIMIT 50",
    "entities_filter": """SELECT id, entity_id, name, type, risk_score::BIGINT AS risk_score FROM entities
        WHERE type = 'COMPANY' AND coalesce(entities.risk_score, 0) >= 60 AND (lower(name) LIKE '%customer#%' OR lower(entity_id) LIKE '%customer#%')""",
    "entity_risk_histogram": """SELECT count(*) FILTER (WHERE risk_score < 30) AS low, count(*) FILTER (WHERE risk_score BETWEEN 30 AND 59) AS medium,
        count(*) FILTER (WHERE risk_score BETWEEN 60 AND 79) AS high, count(*) FILTER (WHERE risk_score >= 80) AS critical, count(*) AS total FROM entities""",
    "severity_share": """SELECT band, n AS n_alerts, CAST(round(n * 100::DOUBLE / total) AS BIGINT) AS percent, CAST(round(av) AS BIGINT) AS avg_risk_score FROM (
        SELECT 'LOW' AS band, count(*) FILTER (WHERE risk_score < 700) AS n, count(*) AS total, avg(risk_score) AS av FROM alerts
        UNION ALL SELECT 'HIGH', count(*) FILTER (WHERE risk_score >= 700), count(*), avg(risk_score) FROM alerts
        UNION ALL SELECT 'CRITICAL', count(*) FILTER (WHERE risk_score >= 850), count(*), avg(risk_score) FROM alerts)""",
    "entity_types": "SELECT DISTINCT type FROM entities",
    "top_entities": """SELECT tenant_id, account_id, tx_count_total, tx_count_24h, tx_count_7d, amount_avg, latest_risk_score, is_velocity_flagged
        FROM features ORDER BY tx_count_total DESC, tenant_id, account_id LIMIT 10""",
    "lookup_by_keys": f"SELECT id, account_id, amount::DOUBLE AS amount, {_TIME} FROM tx WHERE id IN (SELECT transaction_id FROM expenses)",
    "tx_upsert": f"""SELECT tenant_id, tx_id, account_id, CAST(tx_time AS VARCHAR) AS tx_time, amount::DOUBLE AS amount, status,
            CASE WHEN hi = 0 THEN 'kept' WHEN lo = 1 THEN 'inserted' ELSE 'updated' END AS change FROM (
        SELECT *, min(src) OVER k AS lo, max(src) OVER k AS hi, row_number() OVER (PARTITION BY tenant_id, tx_id ORDER BY src DESC, tx_time DESC, amount DESC) AS pick FROM (
            SELECT tenant_id, tx_id, account_id, tx_time, amount, status, 0 AS src FROM tx
            UNION ALL SELECT tenant_id, CASE WHEN id % 7 = 0 THEN 'N' || tx_id ELSE tx_id END, account_id, tx_time, amount + 1, status, 1 FROM tx
            UNION ALL SELECT tenant_id, tx_id, account_id, tx_time, amount, status, 1 FROM tx WHERE amount > 100)
        WINDOW k AS (PARTITION BY tenant_id, tx_id)) WHERE pick = 1""",
    "features_upsert": f"SELECT {_FEATURES} FROM merged_features",
    "ingest_new_invoices": """SELECT tenant_id::BIGINT AS tenant_id, invoice_number, vendor_id, CAST(invoice_date AS VARCHAR) AS invoice_date, subtotal_amount::DOUBLE AS subtotal_amount,
            tax_amount::DOUBLE AS tax_amount, status, cost_center_code, n AS n_offered FROM (
        SELECT *, count(*) OVER (PARTITION BY tenant_id, invoice_number) AS n, min(invoice_date) OVER (PARTITION BY tenant_id, invoice_number) AS oldest,
            row_number() OVER (PARTITION BY tenant_id, invoice_number ORDER BY vendor_id, invoice_date, subtotal_amount, tax_amount, status, cost_center_code) AS k FROM invoices)
        WHERE k = 1 AND oldest >= DATE '1998-01-01'""",
    "ingest_invoice_report": """SELECT count(*) FILTER (WHERE NOT known) AS n_new, coalesce(sum(n - 1) FILTER (WHERE NOT known), 0)::BIGINT AS n_repeated, coalesce(sum(n) FILTER (WHERE known), 0)::BIGINT AS n_present
        FROM (SELECT tenant_id, invoice_number, count(*) AS n, min(invoice_date) < DATE '1998-01-01' AS known FROM invoices GROUP BY ALL)""",
    "dedupe_keep_first": """SELECT min(id) AS id, tenant_id::BIGINT AS tenant_id, vendor_id, CAST(invoice_date AS VARCHAR) AS invoice_date FROM invoices GROUP BY tenant_id, vendor_id, invoices.invoice_date""",
    "orphan_alerts": "SELECT alert_id, CASE WHEN transaction_id IN (SELECT id FROM tx) THEN transaction_id END AS transaction_id, risk_score FROM messy",
    "dq_duplicates": _union([
        _table_count("tenant_id,tx_id", "tx", "transactions"), _table_count("entity_id", "entities", "entities"),
        _table_count("tenant_id,account_id", "features", "entity_features"),
        "SELECT 'entity_daily_summary', 'tenant_id,account_id,summary_date', 0, 0",
        _table_count("tenant_id,invoice_number", "invoices", "invoices"), _table_count("tenant_id,vendor_code", "vendors", "vendors"),
    ]),
    "dq_orphans": _union([
        _orphan_count("alerts->transactions", "messy", "transaction_id", "tx"),
        _orphan_count("expenses->invoices", "expenses", "invoice_id", "invoices"),
        _orphan_count("expenses->transactions", "expenses", "transaction_id", "tx"),
        _orphan_count("transactions->invoices", "(SELECT tenant_id, id * 10 + 1 AS invoice_id FROM tx)", "invoice_id", "invoices"),
    ]),
    "dq_lengths": _union(
        [_check("transactions", "tx", f"{c}<={n}", f"length({c}) > {n}") for c, n in (("currency", 3), ("country_code", 2), ("merchant_category", 8), ("channel", 32))]
        + [_check("transactions", "tx", f"{c} not null", f"{c} IS NULL") for c in ("tx_id", "account_id", "tx_time", "amount")]
        + [_check("raw_events", "raw_events", f"{c}<={n}", f"length({c}) > {n}") for c, n in (("currency", 3), ("account_id", 6))]
        + [_check("raw_events", "raw_events", f"{c} not null", f"{c} IS NULL") for c in ("tenant_id", "account_id")]
        + [_check("vendors", "vendors", "country_code<=2", "length(country_code) > 2")]
        + [_check("vendors", "vendors", f"{c} not null", f"{c} IS NULL") for c in ("vendor_code", "name")]
    ),
    "dq_domains": _union([
        _check(t, s, c, f"{c} NOT IN {_in(d)}") for t, s, c, d in (
            ("transactions", "tx", "direction", C.DIRECTIONS), ("transactions", "tx", "status", C.STATUSES),
            ("raw_events", "raw_events", "direction", C.DIRECTIONS), ("raw_events", "raw_events", "status", C.STATUSES),
            ("invoices", "invoices", "status", C.INVOICE_STATUSES), ("vendors", "vendors", "risk_level", C.VENDOR_RISK_LEVELS),
            ("employee_expenses", "expenses", "status", C.EXPENSE_STATUSES), ("employee_expenses", "expenses", "category", C.EXPENSE_CATEGORIES),
            ("entities", "entities", "type", C.ENTITY_TYPES),
        )
    ]),
    "dq_ranges": _union(
        [_check("alerts", "alerts", c, f"{c} NOT BETWEEN 0 AND 999") for c in ("risk_score", "rule_score", "ml_score", "graph_score")]
        + [_check("ml_scores", "scored", "xgb_score", "xgb_score NOT BETWEEN 0 AND 1"), _check("ml_scores", "scored", "ae_score", "xgb_score * 0.5::DOUBLE NOT BETWEEN 0 AND 0.4::DOUBLE")]
        + [_check("entities", "entities", "risk_score", "risk_score NOT BETWEEN 0 AND 99")]
    ),
    "dq_report": _union([
        *_report("transactions", "tx", ["tenant_id,tx_id"], {
            **_longer({"currency": 3, "country_code": 2, "merchant_category": 8, "channel": 32}), **_missing("tx_id", "account_id", "tx_time", "amount"),
            **_outside("direction", C.DIRECTIONS), **_outside("status", C.STATUSES)}),
        *_report("alerts", "alerts", [], _beyond(("risk_score", "rule_score", "ml_score", "graph_score"), 0, 999)),
        *_report("ml_scores", "(SELECT id, xgb_score, xgb_score / 2 AS ae_score FROM scored)", [], _beyond(("xgb_score", "ae_score"), 0, 1)),
        *_report("entity_features", "features", ["tenant_id,account_id"], {}),
        *_report("invoices", "invoices", ["tenant_id,invoice_number"], _outside("status", C.INVOICE_STATUSES)),
        *_report("vendors", "vendors", ["tenant_id,vendor_code"], {
            **_longer({"country_code": 2}), **_missing("vendor_code", "name"), **_outside("risk_level", C.VENDOR_RISK_LEVELS)}),
        *_report("employee_expenses", "expenses", [], {**_outside("status", C.EXPENSE_STATUSES), **_outside("category", C.EXPENSE_CATEGORIES)}),
        *_report("entities", "entities", ["entity_id"], {**_outside("type", C.ENTITY_TYPES), **_beyond(("risk_score",), 0, 999)}),
    ]),
    "tenants_linkage": f"""SELECT e.tenant_id || ':' || e.id AS id, i.amount::DOUBLE AS invoice_amount, t.amount::DOUBLE AS payment_amount,
        CASE WHEN e.invoice_id IS NOT NULL AND i.id IS NULL AND e.transaction_id IS NOT NULL AND t.id IS NULL THEN 'BOTH_MISSING'
             WHEN e.invoice_id IS NOT NULL AND i.id IS NULL THEN 'INVOICE_MISSING' WHEN e.transaction_id IS NOT NULL AND t.id IS NULL THEN 'PAYMENT_MISSING' ELSE 'OK' END AS link_status
        FROM {_two_tenants('expenses', 'invoice_id, transaction_id', 'id')} e
        LEFT JOIN (SELECT tenant_id, id, min((total_amount, vendor_id))[1] AS amount FROM {_two_tenants('invoices', 'total_amount, vendor_id', 'id', 'id % 2 = 0')} GROUP BY ALL) i
            ON i.id = e.invoice_id AND i.tenant_id = e.tenant_id
        LEFT JOIN {_two_tenants('tx', 'amount', 'id', 'id % 4 = 0')} t ON t.id = e.transaction_id AND t.tenant_id = e.tenant_id""",
    "tenants_alerts": f"""SELECT * FROM (WITH t2 AS {_two_tenants('tx', 'account_id', 'id', 'id % 4 = 0')}, a2 AS {_two_tenants('messy', 'risk_score', 'transaction_id', 'transaction_id % 3 = 0')},
        j AS (SELECT a2.tenant_id, t2.account_id, a2.risk_score FROM a2 JOIN t2 ON t2.id = a2.transaction_id AND t2.tenant_id = a2.tenant_id),
        lost AS (SELECT tenant_id, count(*) AS n_lost FROM a2 WHERE NOT EXISTS (SELECT 1 FROM t2 WHERE t2.id = a2.transaction_id AND t2.tenant_id = a2.tenant_id) GROUP BY tenant_id)
        SELECT j.tenant_id::BIGINT AS tenant_id, account_id, {_half_up('sum(risk_score)', 'count(*)')} AS risk_score_avg, max(risk_score)::BIGINT AS latest_risk_score,
            count(*) FILTER (WHERE risk_score >= 500) AS high_risk_tx_count, n_lost FROM j JOIN lost ON lost.tenant_id = j.tenant_id GROUP BY ALL)""",
    "graph_edges": "SELECT tenant_id, src, dst FROM edges",
    "graph_degree": "SELECT tenant_id, node, degree FROM degree",
    "graph_components": "SELECT tenant_id, node, component, community_size FROM component",
    "graph_pagerank": f"SELECT tenant_id, node, round(pr, 8) AS pagerank FROM rank{PAGERANK_ROUNDS}",
    "graph_neighbor_risk": "SELECT tenant_id, node, round(avg_neighbor_risk, 6) AS avg_neighbor_risk FROM neighbor",
    "graph_scores_real": f"""SELECT id, tenant_id, account_id,
            CAST(trunc(least(999, coalesce(5 * degree + 2 * size + 200::DOUBLE * pr + 400::DOUBLE * nr, 0))) AS BIGINT) AS graph_score,
            nullif(concat_ws(' | ', CASE WHEN degree >= 5 THEN 'High-degree node (degree=' || degree || ')' END,
                CASE WHEN size >= 10 THEN 'In dense community (size=' || size || ')' END, CASE WHEN nr > 0.1 THEN 'Neighbors show elevated risk' END), '') AS graph_motifs
        FROM (SELECT t.id, t.tenant_id, t.account_id, {_graph_cols} FROM tx t
            LEFT JOIN degree d ON d.tenant_id = t.tenant_id AND d.node = 'ACCOUNT:' || t.account_id
            LEFT JOIN component c ON c.tenant_id = t.tenant_id AND c.node = d.node
            LEFT JOIN rank{PAGERANK_ROUNDS} k ON k.tenant_id = t.tenant_id AND k.node = d.node
            LEFT JOIN neighbor nb ON nb.tenant_id = t.tenant_id AND nb.node = d.node)""",
    "anomaly_threshold": "SELECT n_rows, round(error_mean, 4) AS error_mean, round(error_std, 4) AS error_std, round(threshold, 4) AS threshold FROM ml_profile",
    "anomaly_scores": "SELECT id, round(error, 4) AS error, error > threshold AS is_anomaly FROM ml_error, ml_profile",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in QUERIES.items()}
