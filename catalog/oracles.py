"""SQL (for DuckDB) that states the expected result of each query over the same tables."""

from __future__ import annotations

from catalog import fixtures as fx
from catalog.queries import ERRORS
from sluice.spec import BANKING, LINEITEM, ORDERS

ORACLES: dict[str, str] = {}


def _fault(key: str, faults: dict[str, tuple[int, int]]) -> str:
    arms = " ".join(f"WHEN {key} % {m} = {r} THEN '{name}'" for name, (m, r) in faults.items())
    return f"CASE {arms} ELSE 'none' END"


def _event_id(spec, file: str, kind: str = "event", row: str = "r") -> str:
    return f"substr(sha256('{kind}|{spec.schema_id}|{file}|' || {row}), 1, 32)"


def _group(spec, file: str) -> str:
    return f"'{spec.schema_id}-{file}-' || (r // {spec.group_size})"


N = ORDERS.group_size
NO_CONTROL = "g % {} = {}".format(*fx.GROUP_WITHOUT_CONTROL)
LOSSY = "g % {} = {}".format(*fx.GROUP_WITH_LOSS)

# Rows in file order, numbered from 0
O = f"""o AS (
  SELECT *, r // {N} AS g, {_group(ORDERS, 'orders')} AS trade_group_id,
         {_event_id(ORDERS, 'orders')} AS event_id
  FROM (SELECT *, row_number() OVER () - 1 AS r FROM orders))"""
L = f"""l AS (
  SELECT *, {_group(LINEITEM, 'lineitem')} AS trade_group_id
  FROM (SELECT *, row_number() OVER () - 1 AS r,
               l_orderkey || '-' || l_linenumber AS id FROM lineitem))"""

# Orders as sent: some twice
SENT = f"""{O}, sent AS (
  SELECT *, 2 * r + copy AS arrival FROM (
    SELECT *, {_fault('o_orderkey', fx.INTAKE_FAULTS)} AS fault,
           unnest(CASE WHEN {_fault('o_orderkey', fx.INTAKE_FAULTS)} = 'twice'
                  THEN [0, 1] ELSE [0] END) AS copy
    FROM o))"""

_ATTEMPT = "CAST({} AS INTEGER)"


def _decided(attempt: str) -> str:
    """Outcomes of the orders with intake faults."""
    return f"""{SENT}, decided AS (
  SELECT *, CASE WHEN outcome <> 'DLQ_ROUTED' THEN NULL
                 WHEN fault IN ('malformed', 'new_member') THEN 'FATAL_PARSE_ERROR'
                 WHEN fault = 'no_group' THEN 'FATAL_MISSING_FIELDS'
                 ELSE 'NO_CONTROL_DOC' END AS failure_reason
  FROM (SELECT *, {attempt} AS attempt_count,
          CASE WHEN fault IN ('malformed', 'new_member', 'no_group') THEN 'DLQ_ROUTED'
               WHEN {NO_CONTROL} THEN CASE WHEN {attempt} >= 3 THEN 'DLQ_ROUTED' ELSE 'RETRY_ROUTED' END
               WHEN copy = 1 THEN 'DUPLICATE' ELSE 'SUCCESS' END AS outcome
        FROM sent))"""


# Orders with group faults: what was sent and what became of each group
GROUPS = f"""{SENT}, flagged AS (
  SELECT *, ({LOSSY} AND r % {N} = {N - 1}) AS lost FROM sent),
states AS (
  SELECT g, trade_group_id, CAST(count(*) AS INTEGER) AS expected_count,
         count(*) FILTER (WHERE lost) AS missing_count,
         CASE WHEN count(*) FILTER (WHERE lost) > 0 THEN 'FAIL' ELSE 'SUCCESS' END AS status
  FROM flagged WHERE copy = 0 AND NOT ({NO_CONTROL}) GROUP BY ALL)"""

# Line items: which ids of a group arrived under it first
LINE_GROUPS = f"""{L}, firsts AS (SELECT id, min(r) AS first_r FROM l GROUP BY id),
ids AS (
  SELECT l.trade_group_id, l.id, bool_or(l.r = f.first_r) AS came
  FROM l JOIN firsts f USING (id) GROUP BY ALL),
sizes AS (SELECT trade_group_id, count(*) AS n FROM l GROUP BY ALL),
states AS (
  SELECT s.trade_group_id, CAST(s.n AS INTEGER) AS expected_count,
         CASE WHEN s.n = count(*) AND bool_and(came) THEN 'SUCCESS' ELSE 'FAIL' END AS status,
         count(*) FILTER (WHERE came) AS actual_count,
         count(*) FILTER (WHERE NOT came) AS missing_count
  FROM sizes s JOIN ids i USING (trade_group_id) GROUP BY s.trade_group_id, s.n)"""

# Orders with payload faults
FAULTY_ORDERS = f"""{O}, p AS (
  SELECT *, {_fault('o_orderkey', fx.ORDER_FAULTS)} AS fault FROM o),
d AS (
  SELECT *, fault IN ('missing', 'type', 'unknown') AS breaking_change,
         fault IN ('missing', 'type', 'unknown', 'extra') AS drift_detected,
         CASE fault WHEN 'missing' THEN 'MISSING_FIELD' WHEN 'unknown' THEN 'MISSING_FIELD'
                    WHEN 'type' THEN 'TYPE_CHANGE' WHEN 'extra' THEN 'NEW_FIELD' END AS drift_type
  FROM p),
q AS (
  SELECT *, CASE WHEN breaking_change THEN 0.0 WHEN fault = 'price' THEN 8.0 / 11.0 ELSE 1.0 END AS score
  FROM d),
v AS (
  SELECT *, CASE WHEN breaking_change THEN 'REJECTED' ELSE 'PASSED' END AS validation_status FROM q)"""

# Banking events with payload faults, each rule evaluated, scored and judged
FAULTY_BANKING = f"""b AS (
  SELECT *, {_fault('event_id', fx.BANK_FAULTS)} AS fault, event_id AS k,
         {_group(BANKING, 'events')} AS trade_group_id,
         'TXN' || event_id AS idempotency_key, {_event_id(BANKING, 'events')} AS eid
  FROM (SELECT *, row_number() OVER () - 1 AS r FROM events)),
p AS (
  SELECT *,
         CASE WHEN fault = 'blank' THEN '   ' ELSE idempotency_key END AS transaction_id,
         CASE WHEN fault = 'messy' THEN strftime(ts, '%Y/%m/%d') ELSE strftime(ts, '%Y-%m-%d') END
           AS transaction_date,
         CASE WHEN fault = 'missing' THEN NULL WHEN fault = 'price' THEN -value ELSE value END AS amount,
         CASE WHEN fault = 'messy' THEN -1.5 WHEN k % 17 <> 0 THEN value + k % 1000 END AS balance,
         CASE WHEN k % 13 <> 0 THEN CAST(250 + k % 700 AS INTEGER) END AS credit,
         CASE WHEN fault = 'messy' THEN 'Unknown' WHEN k % 4 = 0 THEN 'Success'
              WHEN k % 4 = 1 THEN 'Failed' WHEN k % 4 = 2 THEN 'Pending' ELSE 'success' END AS status
  FROM b),
w AS (
  SELECT *, fault IN ('missing', 'type', 'unknown') AS breaking_change,
         fault IN ('missing', 'type', 'unknown', 'extra') AS drift_detected,
         CASE fault WHEN 'missing' THEN 'MISSING_FIELD' WHEN 'unknown' THEN 'MISSING_FIELD'
                    WHEN 'type' THEN 'TYPE_CHANGE' WHEN 'extra' THEN 'NEW_FIELD' END AS drift_type,
         fault <> 'blank' AS ok_id,
         fault NOT IN ('missing', 'type', 'price') AS ok_amount,
         fault <> 'messy' AS ok_date,
         status IN ('Success', 'Failed', 'Pending') AS ok_status,
         balance IS NULL OR balance >= 0 AS ok_balance,
         credit IS NULL OR credit BETWEEN 300 AND 900 AS ok_credit
  FROM p),
q AS (
  SELECT *, CASE WHEN breaking_change OR NOT ok_id THEN 0.0
                 ELSE (12 + 3 * ok_amount::INT + 3 * ok_date::INT + 2 * ok_status::INT
                       + 2 * ok_balance::INT + ok_credit::INT) / 23.0 END AS score
  FROM w),
v AS (
  SELECT *, CASE WHEN breaking_change THEN 'REJECTED' WHEN score >= 0.7 THEN 'PASSED'
                 WHEN score >= 0.5 THEN 'QUARANTINED' ELSE 'REJECTED' END AS validation_status,
         concat_ws(',', CASE WHEN NOT ok_id THEN 'transaction_id.not_null' END,
                   CASE WHEN NOT ok_amount THEN 'amount.positive' END,
                   CASE WHEN NOT ok_date THEN 'transaction_date.iso_format' END,
                   CASE WHEN NOT ok_status THEN 'transaction_status.valid_value' END,
                   CASE WHEN NOT ok_balance THEN 'balance.non_negative' END,
                   CASE WHEN NOT ok_credit THEN 'credit_score.in_range' END) AS failed,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS taken_at
  FROM q)"""

_REASON = """CASE WHEN breaking_change THEN 'SCHEMA_BREAKING_CHANGE:' || drift_type
       ELSE printf('QUALITY_REJECTED:score=%.2f', CAST(score AS DOUBLE)) END"""


def _sql(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = f"WITH {ctes}\n{select}" if ctes else select


# --- raw tables ---------------------------------------------------------------------

_sql("csv_scan", "", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders""")
_sql("column_aliases", "", """SELECT event_id AS transaction_id,
  strftime(ts, '%Y-%m-%d') AS transaction_date, user_id, event_type AS transaction_type,
  value AS amount, props AS description FROM events""")
_sql("nan_to_null", "", """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
  CASE WHEN l_partkey % 10 <> 0 THEN l_quantity END AS l_quantity FROM lineitem""")

# --- publisher ------------------------------------------------------------------------

_sql("row_groups", O, "SELECT trade_group_id, CAST(o_orderkey AS VARCHAR) AS trade_id FROM o")
_sql("row_groups_lineitem", L, """SELECT trade_group_id, count(*) AS rows,
  count(DISTINCT id) AS ids, min(id) AS first_id, max(id) AS last_id FROM l GROUP BY ALL""")
_sql("control_docs", L, f"""SELECT trade_group_id, CAST(count(*) AS INTEGER) AS expected_count,
  string_agg(id, ',' ORDER BY r) AS trade_ids, '{fx.PUBLISHED_AT}' AS timestamp,
  'cloud' AS source, '1.0.0' AS pipeline_version, '{LINEITEM.schema_id}' AS schema_id
  FROM l GROUP BY trade_group_id""")
_sql("envelope_orders", O, f"""SELECT event_id AS key, event_id, '1.0' AS event_version,
  '{ORDERS.event_type}' AS event_type, {_event_id(ORDERS, 'orders', 'trace')} AS trace_id,
  CAST(o_orderkey AS VARCHAR) AS idempotency_key, '{fx.PUBLISHED_AT}' AS sent_at,
  '{ORDERS.schema_id}' AS schema_id, trade_group_id, CAST(o_orderkey AS VARCHAR) AS trade_id,
  o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS order_date,
  'banking-transactions' AS topic FROM o""")
_sql("idempotency_keys", "", """SELECT l_orderkey || '-' || l_linenumber AS idempotency_key,
  count(*) AS copies FROM lineitem GROUP BY 1""")
_sql("sha_fallback_keys", "", """SELECT c_custkey, sha256('{"c_acctbal": ' || c_acctbal
  || ', "c_custkey": ' || c_custkey || ', "c_mktsegment": "' || c_mktsegment
  || '", "c_name": "' || c_name || '", "c_nationkey": ' || c_nationkey || '}')
  AS idempotency_key FROM customer""")

# --- intake ---------------------------------------------------------------------------

_sql("intake_outcomes", _decided("0"), "SELECT arrival, outcome, failure_reason FROM decided")
_sql("intake_counts", _decided("0"), """SELECT count(*) AS total,
  count(*) FILTER (WHERE outcome = 'SUCCESS') AS success,
  count(*) FILTER (WHERE outcome = 'DUPLICATE') AS duplicates,
  count(*) FILTER (WHERE outcome = 'RETRY_ROUTED') AS retry_routed,
  count(*) FILTER (WHERE outcome = 'DLQ_ROUTED') AS dlq_routed FROM decided""")
_sql("missing_fields_dlq", _decided("0"), """SELECT event_id AS key, failure_reason,
  'banking-transactions' AS original_topic, '0' AS attempt_count
  FROM decided WHERE outcome = 'DLQ_ROUTED'""")
_sql("processed_events", SENT, f"""SELECT arrival, event_id,
  CASE WHEN fault <> 'no_group' THEN trade_group_id END AS trade_group_id,
  CAST(o_orderkey AS VARCHAR) AS trade_id, CAST(o_orderkey AS VARCHAR) AS idempotency_key,
  '{ORDERS.event_type}' AS event_type, '{ORDERS.schema_id}' AS schema_id, 'cloud' AS source,
  '1.0.0' AS pipeline_version, o_custkey FROM sent
  WHERE fault NOT IN ('malformed', 'new_member')""")
_sql("dedup_events", "", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY r) AS n
  FROM (SELECT *, row_number() OVER () AS r FROM events)) WHERE n = 1""")
_sql("dedup_lineitem", L, """SELECT id AS line_item_id, l_partkey, l_suppkey, l_quantity,
  strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY r) AS n FROM l) WHERE n = 1""")

# --- group ledger -----------------------------------------------------------------------

_TID = "CAST(o_orderkey AS VARCHAR) AS trade_id"
_sql("no_control_doc", GROUPS, f"""SELECT arrival, trade_group_id, {_TID}
  FROM flagged WHERE NOT lost AND {NO_CONTROL}""")
_sql("announced_events", GROUPS, f"""SELECT arrival, trade_group_id, {_TID}
  FROM flagged WHERE NOT lost AND NOT ({NO_CONTROL})""")
_sql("first_control_doc", O, """SELECT trade_group_id, CAST(count(*) AS INTEGER) AS expected_count,
  CAST(count(*) AS INTEGER) AS ids FROM o GROUP BY trade_group_id""")
_sql("group_status", GROUPS, """SELECT trade_group_id, status, expected_count,
  expected_count - missing_count AS actual_count, missing_count FROM states""")
_sql("group_status_lineitem", LINE_GROUPS, """SELECT trade_group_id, status, expected_count,
  actual_count, missing_count FROM states""")
_sql("missing_ids", GROUPS, f"""SELECT trade_group_id, {_TID} FROM flagged
  WHERE lost AND copy = 0 AND NOT ({NO_CONTROL})""")
_sql("missing_ids_lineitem", LINE_GROUPS,
     "SELECT trade_group_id, id AS trade_id FROM ids WHERE NOT came")
_sql("failed_group_records", LINE_GROUPS, """SELECT trade_group_id AS key, trade_group_id,
  'BATCH_TIMEOUT' AS failure_reason, CAST(expected_count AS BIGINT) AS expected_count,
  actual_count, missing_count, 'BATCH_TIMEOUT' AS header_reason
  FROM states WHERE status = 'FAIL'""")
_sql("ready_events", GROUPS, f"""SELECT arrival, f.trade_group_id, {_TID}, event_id
  FROM flagged f JOIN states s USING (g) WHERE s.status = 'SUCCESS' AND copy = 0""")
_sql("incomplete_events", GROUPS, f"""SELECT arrival, f.trade_group_id, {_TID}
  FROM flagged f JOIN states s USING (g) WHERE s.status = 'FAIL' AND copy = 0 AND NOT lost""")

# --- drift ------------------------------------------------------------------------------

_sql("schema_lookup", f"{FAULTY_BANKING}, po AS (SELECT *, {_fault('o_orderkey', fx.ORDER_FAULTS)} AS fault FROM orders)",
     f"""SELECT schema_id, version, fields, required, count(*) AS events FROM (
  SELECT CASE WHEN fault = 'unknown' THEN 'tpch_orders_v9' ELSE '{ORDERS.schema_id}' END AS schema_id,
         CASE WHEN fault <> 'unknown' THEN '1.0' END AS version,
         CASE WHEN fault <> 'unknown' THEN 9 END AS fields,
         CASE WHEN fault <> 'unknown' THEN 3 END AS required FROM po
  UNION ALL
  SELECT CASE WHEN fault = 'unknown' THEN 'banking_transaction_v9' ELSE '{BANKING.schema_id}' END,
         CASE WHEN fault <> 'unknown' THEN '1.0' END, CASE WHEN fault <> 'unknown' THEN 20 END,
         CASE WHEN fault <> 'unknown' THEN 3 END FROM v
  UNION ALL
  SELECT '{LINEITEM.schema_id}', '1.0', 17, 4 FROM lineitem) GROUP BY ALL""")

_KEY = "CAST(o_orderkey AS VARCHAR) AS idempotency_key"
_sql("drift_missing", FAULTY_ORDERS, f"""SELECT {_KEY},
  CASE fault WHEN 'missing' THEN 'o_custkey' ELSE 'schema_id' END AS field,
  CASE fault WHEN 'missing' THEN 'number' ELSE 'registered schema' END AS expected_type,
  CASE fault WHEN 'missing' THEN 'null' ELSE 'unknown' END AS actual_type,
  'MISSING_FIELD' AS violation_type FROM v WHERE fault IN ('missing', 'unknown')""")
_sql("drift_type_change", FAULTY_ORDERS, f"""SELECT {_KEY}, 'o_totalprice' AS field,
  'number' AS expected_type, 'string' AS actual_type, 'TYPE_CHANGE' AS violation_type
  FROM v WHERE fault = 'type'""")
_sql("drift_new_field", FAULTY_ORDERS, f"""SELECT {_KEY}, x.field, 'undefined' AS expected_type,
  x.actual_type, 'NEW_FIELD' AS violation_type
  FROM v, (VALUES ('o_gift', 'boolean'), ('o_note', 'unknown')) x(field, actual_type)
  WHERE fault = 'extra'""")
_SUMMARY = """CASE fault WHEN 'unknown' THEN 'unknown' ELSE '1.0' END AS schema_version,
  NOT breaking_change AS schema_valid, drift_detected, drift_type, breaking_change,
  CASE WHEN breaking_change THEN 'NONE' WHEN drift_detected THEN 'BACKWARD' ELSE 'FULL' END
    AS compatibility,
  CASE WHEN breaking_change THEN 'REJECT' ELSE 'AUTO_EVOLVE' END AS recommended_action"""
_sql("drift_summary", FAULTY_ORDERS, f"""SELECT {_KEY}, {_SUMMARY},
  CASE fault WHEN 'extra' THEN 2 WHEN 'none' THEN 0 WHEN 'price' THEN 0 ELSE 1 END AS violations
  FROM v""")
_sql("unknown_schema", FAULTY_BANKING, f"""SELECT idempotency_key, {_SUMMARY},
  'schema_id' AS field, 'registered schema' AS expected_type, 'unknown' AS actual_type
  FROM v WHERE fault = 'unknown'""")

# --- quality ----------------------------------------------------------------------------

_KNOWN = "FROM v WHERE fault <> 'unknown'"
_sql("rule_not_null", FAULTY_BANKING, f"""SELECT idempotency_key, 'CRITICAL' AS severity,
  ok_id AS passed, transaction_id AS actual_value,
  CASE WHEN NOT ok_id THEN 'transaction_id must not be null or blank' END AS message {_KNOWN}""")
_sql("rule_positive", FAULTY_BANKING, f"""SELECT idempotency_key, 'HIGH' AS severity,
  ok_amount AS passed, round(amount, 6) AS actual_number, NOT ok_amount AS has_message {_KNOWN}""")
_sql("rule_iso_date", FAULTY_BANKING, f"""SELECT idempotency_key, 'HIGH' AS severity,
  ok_date AS passed, transaction_date AS actual_value, CASE WHEN NOT ok_date THEN
  'transaction_date must be yyyy-MM-dd, got: ' || transaction_date END AS message {_KNOWN}""")
_sql("rule_status", FAULTY_BANKING, f"""SELECT idempotency_key, 'MEDIUM' AS severity,
  ok_status AS passed, status AS actual_value, CASE WHEN NOT ok_status THEN
  'transaction_status must be one of [Success, Failed, Pending], got: ' || status END AS message
  {_KNOWN}""")
_sql("rule_balance", FAULTY_BANKING, f"""SELECT idempotency_key, 'MEDIUM' AS severity,
  ok_balance AS passed, round(balance, 6) AS actual_number,
  balance IS NULL OR NOT ok_balance AS has_message {_KNOWN}""")
_sql("rule_credit_score", FAULTY_BANKING, f"""SELECT idempotency_key, 'LOW' AS severity,
  ok_credit AS passed, coalesce(CAST(credit AS VARCHAR), 'null') AS actual_value,
  CASE WHEN credit IS NULL THEN 'credit_score absent — skipped'
       WHEN NOT ok_credit THEN 'credit_score must be 300–900, got: ' || credit END AS message
  {_KNOWN}""")
_SCORES = """round(CAST(score AS DOUBLE), 6) AS quality_score,
  NOT breaking_change AND score >= 0.7 AS quality_passed,
  CAST(CASE WHEN breaking_change THEN 0.0 ELSE 0.7 END AS DOUBLE) AS quality_threshold"""
_sql("quality_score_banking", FAULTY_BANKING, f"SELECT idempotency_key, {_SCORES} FROM v")
_sql("quality_score_orders", FAULTY_ORDERS, f"SELECT {_KEY}, {_SCORES} FROM v")
_sql("quality_score_lineitem", "", """SELECT CAST(1.0 AS DOUBLE) AS quality_score,
  true AS quality_passed, 'PASSED' AS validation_status, count(*) AS events
  FROM lineitem WHERE l_quantity > 0""")
_sql("failed_rules", FAULTY_BANKING, """SELECT idempotency_key,
  CASE WHEN breaking_change THEN '' ELSE failed END AS failed_rules FROM v""")

# --- verdict ----------------------------------------------------------------------------

_sql("verdicts", FAULTY_BANKING, f"""SELECT idempotency_key, validation_status, breaking_change,
  '{fx.INGESTED_AT}' AS ingestion_time, 'banking-transactions' AS source_topic FROM v""")
_sql("rejection_reasons", FAULTY_BANKING, f"""SELECT idempotency_key, {_REASON} AS rejection_reason
  FROM v WHERE validation_status = 'REJECTED'""")
_BOTH = (FAULTY_BANKING
         + ", ov AS (SELECT *, CASE WHEN fault IN ('missing', 'type', 'unknown') THEN 0.0"
         + " WHEN fault = 'price' THEN 8.0 / 11.0 ELSE 1.0 END AS score FROM (SELECT *, "
         + _fault("o_orderkey", fx.ORDER_FAULTS) + " AS fault FROM orders)), "
         + f"""judged AS (
  SELECT '{BANKING.event_type}' AS event_type, validation_status, CAST(score AS DOUBLE) AS score,
         drift_detected FROM v
  UNION ALL
  SELECT '{ORDERS.event_type}', CASE WHEN score = 0 THEN 'REJECTED' ELSE 'PASSED' END,
         CAST(score AS DOUBLE), fault IN ('missing', 'type', 'unknown', 'extra') FROM ov)""")
_sql("route_counts", _BOTH, """SELECT event_type, validation_status, count(*) AS events,
  round(avg(score), 6) AS mean_score FROM judged GROUP BY ALL""")
_sql("dlq_records", FAULTY_BANKING, f"""SELECT eid AS key, eid AS event_id, trade_group_id,
  idempotency_key,
  CASE WHEN fault = 'unknown' THEN 'banking_transaction_v9' ELSE '{BANKING.schema_id}' END AS schema_id,
  transaction_id, {_REASON} AS header_failure_reason,
  'banking-transactions' AS header_original_topic, 'intelligence-layer' AS header_source
  FROM v WHERE validation_status = 'REJECTED'""")

# --- stored record, lake ------------------------------------------------------------------

_sql("stored_record", FAULTY_ORDERS, f"""SELECT event_id, trade_group_id, {_TID}, {_KEY},
  '{ORDERS.event_type}' AS event_type, '{fx.PUBLISHED_AT}' AS sent_at, 'cloud' AS source,
  '1.0.0' AS pipeline_version,
  CASE WHEN fault = 'unknown' THEN 'tpch_orders_v9' ELSE '{ORDERS.schema_id}' END AS schema_id,
  CASE WHEN fault <> 'missing' THEN o_custkey END AS o_custkey, validation_status,
  CASE fault WHEN 'unknown' THEN 'unknown' ELSE '1.0' END AS schema_version,
  NOT breaking_change AS schema_valid, drift_detected, drift_type, breaking_change,
  CASE WHEN breaking_change THEN 'NONE' WHEN drift_detected THEN 'BACKWARD' ELSE 'FULL' END
    AS compatibility, drift_type AS first_violation,
  CAST(CASE WHEN breaking_change THEN 0 ELSE 3 END AS BIGINT) AS rule_count, {_SCORES},
  '{fx.INGESTED_AT}' AS ingestion_time, 'banking-transactions' AS source_topic FROM v""")
_sql("partition_columns", "", """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
  strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour, 'cloud' AS source, count(*) AS events
  FROM events GROUP BY ALL""")

STORED = f"""{FAULTY_BANKING}, stored AS (
  SELECT eid AS event_id, idempotency_key, validation_status,
         round(CAST(score AS DOUBLE), 6) AS quality_score, taken_at AS ingestion_time,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, 'cloud' AS source
  FROM v WHERE validation_status <> 'REJECTED')"""
_PASSED = "FROM stored WHERE validation_status = 'PASSED'"
_sql("parquet_round_trip", STORED, "SELECT * FROM stored")
_sql("query_pruned", STORED, f"""SELECT * {_PASSED} AND year = 2024 AND month = 1 AND day = 7
  AND hour = 5 AND source = 'cloud'""")
_sql("query_any_level", STORED, f"SELECT * {_PASSED} AND hour = 23")
_sql("query_where", STORED, """SELECT * FROM stored WHERE validation_status = 'QUARANTINED'
  AND month = 1 AND (quality_score < 0.69 OR day > 20)""")
_sql("query_count", STORED, f"""SELECT count(*) AS total_rows {_PASSED} AND year = 2024
  AND (quality_score >= 0.9)""")
_sql("query_page", STORED, f"""SELECT * {_PASSED} AND year = 2024 AND month = 1
  ORDER BY ingestion_time, event_id LIMIT 150 OFFSET 300""")

_sql("query_deep_page", STORED, f"""SELECT * {_PASSED} AND year = 2024
  ORDER BY ingestion_time, event_id LIMIT 200 OFFSET 600""")
_sql("query_result", STORED, f"""SELECT count(*) AS total_rows,
  CAST(greatest(0, least(150, count(*) - 300)) AS INTEGER) AS returned_rows, 3 AS page, 150 AS page_size,
  CAST(greatest(1, ceil(count(*) / 150.0)) AS BIGINT) AS total_pages, 'spark' AS engine,
  '/data/year=2024/month=01' AS folder, 28 AS columns, true AS timed
  {_PASSED} AND year = 2024 AND month = 1""")
ORACLES["filter_errors"] = """WITH k AS (SELECT min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders)
  SELECT unnest(['month', 'day', 'hour', 'page', 'page_size']) AS field,
         unnest([13 + low % 5, high % 20 + 1, 24 + high % 9, -(low % 3), 10001 + high]) AS value,
         unnest([false, true, false, false, false]) AS valid FROM k"""

# --- reports ----------------------------------------------------------------------------


def _share(name: str) -> str:
    hit = f"count(*) FILTER (WHERE validation_status = '{name.upper()}')"
    return f"{hit} AS {name}, round(100.0 * {hit} / count(*), 1) AS {name}_pct"


_sql("batch_report", _BOTH, f"""SELECT count(*) AS total, {_share('passed')},
  {_share('quarantined')}, {_share('rejected')},
  count(*) FILTER (WHERE drift_detected) AS schema_drift,
  round(coalesce(avg(score), 0.0), 6) AS avg_quality_score FROM judged""")
_sql("run_counters", _decided("arrival % 4"), """SELECT count(*) AS total,
  count(*) FILTER (WHERE outcome = 'SUCCESS' AND attempt_count = 0) AS processed_normally,
  count(*) FILTER (WHERE outcome = 'RETRY_ROUTED' AND attempt_count = 0) AS retry_routed_control_doc,
  CAST(0 AS BIGINT) AS retry_routed_other,
  count(*) FILTER (WHERE outcome = 'SUCCESS' AND attempt_count > 0) AS retry_recovered,
  count(*) FILTER (WHERE outcome = 'DUPLICATE') AS duplicates,
  count(*) FILTER (WHERE failure_reason = 'NO_CONTROL_DOC') AS quarantined_control_doc,
  count(*) FILTER (WHERE outcome = 'DLQ_ROUTED' AND failure_reason <> 'NO_CONTROL_DOC') AS quarantined_other,
  round(100.0 * count(*) FILTER (WHERE outcome = 'RETRY_ROUTED' AND attempt_count = 0) / count(*), 2)
    AS retry_pct FROM decided""")
_sql("drift_deviations", FAULTY_BANKING, """SELECT eid AS event_id, drift_type, breaking_change,
  1 AS violations FROM v WHERE drift_detected""")
_SEVERE = """replace(replace(replace(replace(replace(replace(failed,
  'transaction_id.not_null', 'transaction_id.not_null[CRITICAL]'),
  'amount.positive', 'amount.positive[HIGH]'),
  'transaction_date.iso_format', 'transaction_date.iso_format[HIGH]'),
  'transaction_status.valid_value', 'transaction_status.valid_value[MEDIUM]'),
  'balance.non_negative', 'balance.non_negative[MEDIUM]'),
  'credit_score.in_range', 'credit_score.in_range[LOW]')"""
_sql("quality_deviations", FAULTY_BANKING, f"""SELECT eid AS event_id, validation_status,
  round(CAST(score AS DOUBLE), 6) AS quality_score, {_SEVERE} AS failed_rules FROM v
  WHERE validation_status <> 'PASSED' AND NOT breaking_change""")
_sql("partition_stats", STORED, f"""SELECT 'year=' || year || '/month=' || lpad(month::VARCHAR, 2, '0')
  || '/day=' || lpad(day::VARCHAR, 2, '0') || '/hour=' || lpad(hour::VARCHAR, 2, '0')
  || '/source=' || source AS partition, count(*) AS records {_PASSED} GROUP BY 1""")

# --- retries ----------------------------------------------------------------------------

REPLAY = f"""{GROUPS}, waiting AS (
  SELECT *, arrival % 4 AS attempt_count, arrival % 6 = 5 AS unreadable,
         CASE WHEN arrival % 6 = 5 THEN {fx.NOW_MS}
              ELSE {fx.NOW_MS} + (arrival % 5 - 2) * 1000 END AS due_at
  FROM flagged WHERE NOT lost),
replayed AS (
  SELECT *, CASE WHEN {NO_CONTROL} THEN CASE WHEN attempt_count >= 3 THEN 'DLQ_ROUTED' ELSE 'RETRY_ROUTED' END
                 WHEN row_number() OVER (PARTITION BY o_orderkey ORDER BY arrival) = 1 THEN 'SUCCESS'
                 ELSE 'DUPLICATE' END AS outcome
  FROM waiting WHERE due_at <= {fx.NOW_MS})"""
_sql("retry_step", REPLAY, """SELECT arrival, CAST(attempt_count AS INTEGER) AS attempt_count, outcome,
  CASE WHEN outcome = 'DLQ_ROUTED' THEN 'NO_CONTROL_DOC' END AS failure_reason FROM replayed""")
_sql("retry_waiting", REPLAY, f"""SELECT attempt_count, retry_after, count(*) AS records FROM (
  SELECT CAST(attempt_count AS VARCHAR) AS attempt_count, CAST(due_at AS VARCHAR) AS retry_after
  FROM waiting WHERE due_at > {fx.NOW_MS}
  UNION ALL
  SELECT CAST(attempt_count + 1 AS VARCHAR),
         CAST({fx.NOW_MS} + 2000 * CAST(2 ** attempt_count AS BIGINT) AS VARCHAR)
  FROM replayed WHERE outcome = 'RETRY_ROUTED') GROUP BY ALL""")
_sql("due_order", REPLAY, """SELECT arrival, due_at AS retry_after FROM replayed
  ORDER BY due_at, arrival""")
_sql("retry_backoff", _decided("arrival % 4"), """SELECT arrival,
  CAST(attempt_count + 1 AS INTEGER) AS next_attempt,
  2000 * CAST(2 ** attempt_count AS BIGINT) AS backoff_ms
  FROM decided WHERE outcome = 'RETRY_ROUTED'""")
_NAMES = "[" + ", ".join(f"'{e}'" for e in ERRORS) + "]"
_sql("error_class", f"""e AS (
  SELECT event_id, {_NAMES}[event_id % {len(ERRORS)} + 1] AS error, event_id % 5 AS attempt
  FROM events),
c AS (SELECT *, CASE WHEN error IN ('ConnectException', 'SocketTimeoutException', 'IOException')
                     THEN 'TRANSIENT' ELSE 'FATAL' END AS error_class FROM e)""",
     """SELECT event_id, error_class,
  CASE WHEN error_class = 'FATAL' OR attempt >= 3 THEN 'DLQ_ROUTED' ELSE 'RETRY_ROUTED' END AS outcome,
  CASE WHEN error_class = 'FATAL' THEN 'FATAL:' || error
       WHEN attempt >= 3 THEN 'RETRY_EXHAUSTED' END AS failure_reason FROM c""")

# --- scalar functions -------------------------------------------------------------------

_sql("scalar_functions", "", """SELECT l_orderkey || '-' || l_linenumber AS id,
  lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS line,
  sha256(l_orderkey || '-' || l_linenumber) AS hash, l_partkey, l_quantity FROM lineitem""")

# --- flagship -----------------------------------------------------------------------------

_sql("orders_verdicts", "", f"""SELECT '{ORDERS.schema_id}' AS schema_id,
  'PASSED' AS validation_status, count(*) AS events, CAST(1.0 AS DOUBLE) AS mean_score,
  CAST(0 AS BIGINT) AS drifted FROM orders WHERE o_totalprice > 0""")
_sql("lineitem_verdicts", LINE_GROUPS, f"""SELECT '{LINEITEM.schema_id}' AS schema_id,
  'PASSED' AS validation_status, CAST(sum(n) AS BIGINT) AS events,
  CAST(1.0 AS DOUBLE) AS mean_score, CAST(0 AS BIGINT) AS drifted FROM (
    SELECT count(*) AS n FROM firsts
    UNION ALL SELECT coalesce(sum(expected_count), 0) FROM states WHERE status = 'SUCCESS')""")

# --- runs in a row ------------------------------------------------------------------------

# Which run brought a row, what was stored after the second, what each run decided
RUNS = f"""{GROUPS}, came AS (
  SELECT *, CASE WHEN r % 2 = 0 THEN 1 ELSE 2 END AS run, {NO_CONTROL} AS announced_late
  FROM flagged WHERE NOT lost),
sizes AS (SELECT g, trade_group_id, CAST(count(*) AS INTEGER) AS expected_count,
                 bool_or(lost) AS lossy FROM flagged WHERE copy = 0 GROUP BY ALL),
stored AS (
  SELECT came.* FROM came JOIN sizes USING (g) WHERE copy = 0 AND NOT lossy)"""
_STORED_RUN = f"""SELECT event_id, trade_group_id, {_TID},
  'PASSED' AS validation_status, CAST(1.0 AS DOUBLE) AS quality_score FROM stored WHERE """
_sql("group_pending", RUNS, """SELECT sizes.trade_group_id,
  CASE WHEN count(came.r) = expected_count THEN 'SUCCESS' ELSE 'PENDING' END AS status,
  expected_count, count(came.r) AS actual_count, expected_count - count(came.r) AS missing_count
  FROM sizes LEFT JOIN came ON came.g = sizes.g AND copy = 0 AND run = 1
  WHERE sizes.{} GROUP BY sizes.trade_group_id, expected_count""".format(
      "g % {} <> {}".format(*fx.GROUP_WITHOUT_CONTROL)))
_sql("two_runs_verdicts", RUNS, _STORED_RUN + "NOT announced_late")
_sql("retry_recovered", RUNS, _STORED_RUN + "announced_late")
_sql("run_outcomes", RUNS, """SELECT arrival,
  CAST(CASE WHEN run = 1 THEN 1 ELSE 0 END AS INTEGER) AS attempt_count,
  CASE WHEN copy = 1 THEN 'DUPLICATE' ELSE 'SUCCESS' END AS outcome,
  CAST(NULL AS VARCHAR) AS failure_reason FROM came WHERE run = 2 OR announced_late""")
_sql("group_timeout", RUNS, """SELECT trade_group_id AS key, 'BATCH_TIMEOUT' AS failure_reason,
  CAST(expected_count AS BIGINT) AS expected_count, CAST(1 AS BIGINT) AS missing_count
  FROM sizes WHERE lossy""")
_sql("replayed_batch", RUNS, "SELECT event_id, CAST(1 AS BIGINT) AS copies FROM stored")

# --- CSV to lake ----------------------------------------------------------------------------

_sql("csv_verdicts", """c AS (
  SELECT 'TXN' || event_id AS id, value AS amount,
         CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 5 = 0 THEN -1.5 ELSE 10.25 END AS balance,
         event_id % 19 = 0 AS odd FROM events),
s AS (SELECT *, (23 - CASE WHEN amount > 0 THEN 0 ELSE 3 END - CASE WHEN odd THEN 2 ELSE 0 END
                 - CASE WHEN balance < 0 THEN 2 ELSE 0 END) / 23.0 AS score FROM c)""",
     """SELECT id AS idempotency_key, id AS trade_id,
  CASE WHEN score >= 0.7 THEN 'PASSED' WHEN score >= 0.5 THEN 'QUARANTINED' ELSE 'REJECTED' END
    AS validation_status, CAST(round(score, 6) AS DOUBLE) AS quality_score, amount,
  CAST(balance AS DOUBLE) AS balance FROM s""")

_sql("file_records", """f AS (SELECT file, count(*) AS n FROM (
  SELECT (row_number() OVER () - 1) // 400 AS file FROM orders) GROUP BY file)""",
     """SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS records,
  round(avg(n), 1) AS records_mean, round(median(n), 1) AS records_median FROM f""")
ORACLES["file_fill"] = "SELECT count(*) AS records, true AS filled FROM orders"
ORACLES["iso_times"] = """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events"""

_sql("topic_records", O, f"""SELECT '{ORDERS.topics.primary}' AS topic, count(*) AS records,
  count(DISTINCT r) AS keys, CAST(sum(r % 4) AS BIGINT) AS attempts FROM o
  UNION ALL SELECT '{ORDERS.topics.control}', count(DISTINCT g), count(DISTINCT g), CAST(0 AS BIGINT) FROM o""")

# --- streams ----------------------------------------------------------------------------

ORACLES["stream_group_status"] = ORACLES["group_status"]
_sql("stream_events", GROUPS, f"""SELECT
  CASE WHEN s.status = 'FAIL' THEN 'incomplete' ELSE 'event' END AS kind, f.trade_group_id, {_TID},
  CASE WHEN s.status IS NULL THEN 'DLQ_ROUTED' WHEN s.status = 'SUCCESS' THEN 'SUCCESS' END AS outcome,
  CASE WHEN s.status IS NULL THEN 'NO_CONTROL_DOC' END AS failure_reason
  FROM flagged f LEFT JOIN states s USING (g) WHERE copy = 0 AND NOT lost""")
_sql("stream_dedup", GROUPS, """SELECT CAST(o_orderkey AS VARCHAR) AS idempotency_key, event_id,
  trade_group_id FROM flagged WHERE copy = 0 AND NOT lost""")
_STREAM = """CASE WHEN copy = 0 AND s.status = 'FAIL' THEN 'incomplete' ELSE 'event' END AS kind,
  CASE WHEN copy = 1 THEN 'DUPLICATE' WHEN s.status IS NULL THEN 'DLQ_ROUTED'
       WHEN s.status = 'SUCCESS' THEN 'SUCCESS' END AS outcome,
  CASE WHEN copy = 0 AND s.status IS NULL THEN 'NO_CONTROL_DOC' END AS failure_reason"""
_sql("stream_outcomes", GROUPS, f"""SELECT f.trade_group_id, {_TID}, {_STREAM},
  CAST(1 AS BIGINT) AS decisions, CAST(1 AS BIGINT) AS records
  FROM flagged f LEFT JOIN states s USING (g) WHERE NOT lost""")
_sql("stream_late", GROUPS, f"""SELECT f.trade_group_id, {_TID},
  CASE WHEN copy = 0 AND r % 2 = 0 AND s.g IS NOT NULL THEN 'incomplete' ELSE 'event' END AS kind,
  CASE WHEN copy = 1 THEN 'DUPLICATE'
       WHEN r % 2 = 1 OR s.g IS NULL THEN 'DLQ_ROUTED' END AS outcome,
  CASE WHEN copy = 0 AND (r % 2 = 1 OR s.g IS NULL) THEN 'NO_CONTROL_DOC' END AS failure_reason,
  CAST(1 AS BIGINT) AS decisions, CAST(1 AS BIGINT) AS records
  FROM flagged f LEFT JOIN states s USING (g) WHERE NOT lost""")
_sql("stream_state_large", O, f"""SELECT 'event' AS kind, {_TID}, 'SUCCESS' AS outcome,
  CAST(NULL AS VARCHAR) AS status, CAST(NULL AS BIGINT) AS expected_count,
  CAST(NULL AS BIGINT) AS actual_count FROM o
  UNION ALL SELECT 'group', NULL, NULL, 'SUCCESS', count(*), count(*) FROM o""")
_sql("stream_counters", GROUPS, """SELECT count(*) AS total,
  count(*) FILTER (WHERE copy = 0 AND s.status IS NOT NULL) AS processed_normally,
  count(*) FILTER (WHERE copy = 1) AS duplicates,
  count(*) FILTER (WHERE copy = 0 AND s.status IS NULL) AS quarantined_control_doc,
  (SELECT count(*) FROM states WHERE status = 'SUCCESS') AS whole_groups,
  (SELECT count(*) FROM states WHERE status = 'FAIL') AS failed_groups
  FROM flagged f LEFT JOIN states s USING (g) WHERE NOT lost""")
