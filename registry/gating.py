"""The gate over messages derived from the whole test tables."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from lendmill import contract as C
from lendmill.operators import gate as G
from lendmill.operators import report as R
from lendmill.operators.dedup import first_by
from lendmill.plans.batch import settle
from lendmill.session import work_dir
from lendmill.sinks import layers as S
from lendmill.sources import testviews as V
from lendmill.sources.messages import decode

from registry.base import VIEWS, Domain, Query, portable, rounded, sql, uuid_sql

# Judgement of every user event, restated from how its message was built.
VIEWS["judged"] = (
    ("user_events",),
    """SELECT *,
         CASE WHEN event_type IN ('click', 'view') THEN 'gsm_usage' WHEN event_type = 'purchase' THEN 'mobile_money_transaction'
              WHEN event_type = 'signup' THEN 'device_signal' WHEN violation = 5 THEN 'refund'
              WHEN violation = 11 THEN 'mobile_money_transaction' WHEN violation = 12 THEN 'loan_application'
              WHEN violation = 20 THEN 'loan_decision' WHEN violation = 21 THEN 'repayment' ELSE 'gsm_usage' END AS kind,
         CASE WHEN violation IN (0, 1, 2, 18) THEN 'invalid_json' WHEN violation = 3 THEN 'missing_event_id'
              WHEN violation = 4 THEN 'unsupported_schema_version' WHEN violation = 5 THEN 'unknown_event_type'
              WHEN violation = 6 THEN 'payload_type_mismatch' WHEN violation = 7 THEN 'missing_customer_id'
              WHEN violation = 8 THEN 'missing_country' WHEN violation = 9 THEN 'missing_occurred_at'
              WHEN violation IN (10, 19) THEN 'invalid_event_time'
              WHEN violation = 11 OR (event_type = 'purchase' AND value <= 0) THEN 'invalid_transaction_amount'
              WHEN violation = 12 THEN 'invalid_requested_amount' WHEN violation = 13 THEN 'type_mismatch'
              WHEN violation IN (14, 15, 16, 17) OR (violation = 21 AND value <= 0) THEN 'schema_contract'
              WHEN violation IN (20, 21) THEN 'business_rule' END AS reason,
         violation NOT IN (10, 19, 20) AND NOT (violation = 21 AND value > 0)
           OR (event_type = 'purchase' AND value <= 0) AS fails_contract,
         event_type = 'view' AND k >= 95 AS late,
         CASE WHEN event_type IN ('click', 'signup') AND k < 10 THEN 2 WHEN event_type = 'purchase' AND k < 5 THEN 3
              WHEN violation = 20 THEN 2 ELSE 1 END AS sent
       FROM (SELECT *, CASE WHEN event_type = 'error' THEN
               CASE WHEN k < 80 THEN k % 20 WHEN k < 90 THEN 20 ELSE 21 END ELSE -1 END AS violation FROM user_events)""",
)
# violation -1 (not an 'error' event) must not count as a contract failure.
VIEWS["judged"] = (
    VIEWS["judged"][0],
    VIEWS["judged"][1].replace("violation NOT IN (10, 19, 20)", "violation NOT IN (-1, 10, 19, 20)"),
)
# One row per record the gate returns: failing records one by one, events once.
VIEWS["records"] = (
    ("judged",),
    """SELECT *, CASE WHEN fails_contract THEN 1 ELSE sent END AS copies, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'quarantined' END AS outcome
       FROM judged, unnest(range(CASE WHEN fails_contract THEN sent ELSE 1 END)) AS t(copy)""",
)
_EVENT_ID = uuid_sql("'event' || CAST(event_id AS VARCHAR)")
_CUSTOMER_ID = uuid_sql("CAST(user_id AS VARCHAR)")
_VALID_LOAN_MESSAGES = "(SELECT (SELECT count(*) FROM customers) + (SELECT count(*) FROM applications) + (SELECT count(*) FROM decisions) + (SELECT count(*) FROM repayments))"
_INGESTED = "CASE WHEN late THEN ts + INTERVAL 2 DAY ELSE ts + to_seconds(k) END"

_ISSUE_LOG = f"""SELECT CASE WHEN rule <> 'schema_contract' THEN {_EVENT_ID} END AS event_id, rule,
                  CASE rule WHEN 'freshness_24h' THEN 'warning' ELSE 'error' END AS severity,
                  CASE rule WHEN 'event_not_in_future' THEN 'occurred_at is in the future'
                    WHEN 'ingestion_after_occurrence' THEN 'ingested_at precedes occurred_at'
                    WHEN 'freshness_24h' THEN 'event arrived more than 24h late'
                    WHEN 'declined_amount_zero' THEN 'non-approved decision has an approved amount'
                    WHEN 'repayment_status_consistency' THEN 'late/partial payment must have positive days past due'
                    ELSE CASE WHEN violation IN (0, 1, 2, 18) THEN 'json' WHEN violation = 3 THEN 'event_id:missing'
                      WHEN violation = 4 THEN 'schema_version:choice' WHEN violation = 5 THEN 'event_type:choice'
                      WHEN violation = 6 THEN 'payload:tag' WHEN violation = 7 THEN 'customer_id:missing'
                      WHEN violation = 8 THEN 'country_code:missing' WHEN violation = 9 THEN 'occurred_at:missing'
                      WHEN violation = 12 THEN 'payload.requested_amount:range' WHEN violation = 13 THEN 'value:type'
                      WHEN violation = 14 THEN 'payload:unknown_field' WHEN violation = 15 THEN 'unknown_field'
                      WHEN violation = 16 THEN 'occurred_at:zone' WHEN violation = 17 THEN 'payload.sms_count:range'
                      ELSE 'payload.amount:range' END END AS message,
                  CAST(user_id % 6 AS INTEGER) AS kafka_partition, event_id * 4 + copy AS kafka_offset
                FROM records, unnest(CASE WHEN fails_contract THEN ['schema_contract'] WHEN violation = 10 THEN ['ingestion_after_occurrence']
                    WHEN violation = 19 THEN ['event_not_in_future', 'ingestion_after_occurrence'] WHEN late THEN ['freshness_24h']
                    WHEN violation = 20 THEN ['declined_amount_zero'] WHEN violation = 21 THEN ['repayment_status_consistency'] ELSE [] END) AS u(rule)"""
# The listed issues are the first in order of arrival.
VIEWS["issue_log"] = (("records",), _ISSUE_LOG)
VIEWS["issue_listed"] = (
    ("issue_log",),
    f"SELECT * FROM issue_log ORDER BY kafka_partition, kafka_offset, rule LIMIT {R.LISTED_ISSUES}",
)


def _gated(spark, sf, *columns):
    return G.gate(decode(V.all_messages(spark, sf)), V.AS_OF, columns=columns)


def _gated_events(spark, sf):
    return G.gate(decode(V.event_messages(spark, sf)), V.AS_OF)


def _report(spark, sf):
    """The whole report of one run of the gate; its maps and lists as JSON text."""
    gated = settle(_gated(spark, sf, *R.report_columns(S.ARRIVAL)), f"{work_dir(spark, 'report')}/gated")
    report = R.quality_report(gated, list(S.ARRIVAL), V.AS_OF)
    return portable(report.withColumns({c: F.to_json(c) for c in ("issue_counts", "issues")}))


def _typed(table: str, columns: str, body: str, *views: str) -> Query:
    def run(spark, sf):
        rows = S.typed_rows(G.accepted(_gated(spark, sf, *S.typed_columns(table))), table)
        return portable(rows.select(*C.table_schema(table).names))

    return Query(run, sql(body, *views))


_LINE_ID = "'{0}' || CAST(application_id AS VARCHAR) || strftime({1}, '%Y-%m-%d %H:%M:%S') || event_id"
_APPLICATION = uuid_sql("'application' || CAST(application_id AS VARCHAR)")
_OWNER = uuid_sql("CAST(customer_id AS VARCHAR)")

# Faults in the order of their reasons, each a change of a valid message of a transaction.
_FAULTS = {
    "missing_event_id": ('"event_id":"[^"]*",', ""),
    "unsupported_schema_version": ('"schema_version":"1.0"', '"schema_version":"2.0"'),
    "unknown_event_type": ('^(.*?)"event_type":"mobile_money_transaction"', '$1"event_type":"refund"'),
    "payload_type_mismatch": ('"payload":\\{"event_type":"[a-z_]*"', '"payload":{"event_type":"device_signal"'),
    "missing_customer_id": ('"customer_id":"[^"]*",', ""),
    "missing_country": ('"country_code":"[^"]*",', ""),
    "missing_occurred_at": ('"occurred_at":"[^"]*",', ""),
    "invalid_event_time": ('"ingested_at":"[^"]*"', '"ingested_at":"2000-01-01T00:00:00.000Z"'),
    "invalid_transaction_amount": ('"amount":[-0-9.Ee]+', '"amount":0.0'),
}
_PAIRS = list(itertools.combinations(_FAULTS, 2))


def _two_faults(spark, sf):
    """Every transaction with two faults, the pair by its id."""
    messages = decode(V.event_messages(spark, sf)).filter(F.col("raw_value").contains('"transaction_type"'))
    messages = messages.withColumn("pair", (F.floor(F.col("kafka_offset") / 4) % len(_PAIRS)).cast("int"))
    value = F.col("raw_value")
    for side in (0, 1):
        pattern, put = (F.element_at(F.array(*[F.lit(_FAULTS[pair[side]][i]) for pair in _PAIRS]), F.col("pair") + 1) for i in (0, 1))
        value = F.regexp_replace(value, pattern, put)
    gated = G.gate(messages.withColumn("raw_value", value).drop("pair"), V.AS_OF)
    pair = (F.floor(F.col("kafka_offset") / 4) % len(_PAIRS)).cast("int").alias("pair")
    return gated.groupBy(pair, "reason").agg(F.count(F.lit(1)).alias("records"))


QUERIES: dict[str, Query] = {
    "first_of_two_reasons": Query(
        _two_faults,
        sql(
            f"""SELECT CAST(event_id % {len(_PAIRS)} AS INTEGER) AS pair, list_extract([{', '.join(f"'{a}'" for a, _ in _PAIRS)}], CAST(event_id % {len(_PAIRS)} AS INTEGER) + 1) AS reason,
                  CAST(sum(sent) AS BIGINT) AS records FROM judged WHERE kind = 'mobile_money_transaction' GROUP BY 1, 2""",
            "judged",
        ),
    ),
    "gate_outcomes": Query(
        lambda spark, sf: _gated(spark, sf, "outcome", "reason")
        .groupBy("outcome", F.coalesce("reason", F.lit("none")).alias("reason"))
        .agg(F.count(F.lit(1)).alias("records"), F.sum("copies").alias("messages")),
        sql(
            f"""SELECT outcome, reason, CAST(sum(records) AS BIGINT) AS records, CAST(sum(messages) AS BIGINT) AS messages FROM (
                  SELECT outcome, coalesce(reason, 'none') AS reason, count(*) AS records, sum(copies) AS messages FROM records GROUP BY 1, 2
                  UNION ALL SELECT 'accepted', 'none', {_VALID_LOAN_MESSAGES}, {_VALID_LOAN_MESSAGES}) GROUP BY 1, 2""",
            "records", "customers", "applications", "decisions", "repayments",
        ),
    ),
    "gate_accepted_events": Query(
        lambda spark, sf: portable(
            S.event_fact_rows(G.accepted(_gated_events(spark, sf))).select(*C.EVENT_FACT_COLUMNS, "copies", "late")
        ),
        sql(
            f"""SELECT {_EVENT_ID} AS event_id, '1.0' AS schema_version, kind AS event_type, ts AS occurred_at, {_INGESTED} AS ingested_at,
                  CASE kind WHEN 'mobile_money_transaction' THEN 'mobile_money' ELSE 'gsm' END AS source_system, country_code,
                  {_CUSTOMER_ID} AS customer_id, {_CUSTOMER_ID} AS correlation_id, 'trace-' || CAST(event_id AS VARCHAR) AS trace_id,
                  CASE kind WHEN 'gsm_usage' THEN '{{"event_type":"gsm_usage","call_duration_seconds":' || k * 36 || ',"sms_count":' || k
                      || ',"data_mb":' || value || ',"unique_contacts":' || k || ',"airtime_topup_amount":' || value
                      || ',"network_tenure_days":' || k * 10 + 1 || '}}'
                    WHEN 'device_signal' THEN '{{"event_type":"device_signal","device_hash":"' || md5(CAST(user_id AS VARCHAR)) || '","sim_slot_count":' || k % 4 + 1
                      || ',"device_age_months":' || k || ',"is_rooted":' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END
                      || ',"location_cell_changes_24h":' || k * 7 || '}}'
                    ELSE '{{"event_type":"mobile_money_transaction","transaction_type":"' || ['cash_in', 'cash_out', 'p2p', 'merchant_pay', 'bill_pay'][k % 5 + 1]
                      || '","amount":' || value || ',"currency":"' || {V.CURRENCY_BY_COUNTRY} || '","counterparty_hash":"' || md5(CAST(k AS VARCHAR))
                      || '","channel":"' || ['ussd', 'app', 'agent'][k % 3 + 1] || '"}}' END AS payload_json,
                  CAST(ts AS DATE) AS processing_date, CAST(copies AS BIGINT) AS copies, late
                FROM records WHERE outcome = 'accepted'""",
            "records",
        ),
    ),
    "gate_issue_log": Query(
        lambda spark, sf: G.issue_log(_gated_events(spark, sf)).select(
            "event_id", "rule", "severity", "message", "kafka_partition", "kafka_offset"
        ),
        sql(_ISSUE_LOG, "records"),
    ),
    "gate_issue_counts": Query(
        lambda spark, sf: R.issue_counts(_gated(spark, sf, *R.ISSUES)),
        sql(
            """SELECT rule, CASE rule WHEN 'freshness_24h' THEN 'warning' ELSE 'error' END AS severity, count(*) AS issues
               FROM records, unnest(CASE WHEN fails_contract THEN ['schema_contract'] WHEN violation = 10 THEN ['ingestion_after_occurrence']
                    WHEN violation = 19 THEN ['event_not_in_future', 'ingestion_after_occurrence'] WHEN late THEN ['freshness_24h']
                    WHEN violation = 20 THEN ['declined_amount_zero'] WHEN violation = 21 THEN ['repayment_status_consistency'] ELSE [] END) AS u(rule)
               GROUP BY 1, 2""",
            "records",
        ),
    ),
    "quality_report": Query(
        _report,
        sql(
            f"""SELECT *, {rounded('accepted::DOUBLE / (received - duplicates)', 6)} AS acceptance_rate,
                  CASE WHEN accepted::DOUBLE / (received - duplicates) >= 0.99 THEN 'pass' ELSE 'warn' END AS status,
                  (SELECT '{{' || coalesce(string_agg('"' || rule || '":' || n, ',' ORDER BY rule), '') || '}}' FROM (SELECT rule, count(*) AS n FROM issue_log GROUP BY 1)) AS issue_counts,
                  (SELECT '[' || coalesce(string_agg('{{"rule":"' || rule || '","severity":"' || severity || '","message":"' || message || '"' || coalesce(',"event_id":"' || event_id || '"', '') || '}}',
                      ',' ORDER BY kafka_partition, kafka_offset, rule), '') || ']' FROM issue_listed) AS issues,
                  TIMESTAMP '{V.AS_OF}' AS generated_at
                FROM (SELECT CAST(sum(copies) AS BIGINT) + {_VALID_LOAN_MESSAGES} AS received,
                    count(*) FILTER (WHERE outcome = 'accepted') + {_VALID_LOAN_MESSAGES} AS accepted,
                    CAST(sum(copies - 1) AS BIGINT) AS duplicates, count(*) FILTER (WHERE outcome = 'quarantined') AS quarantined,
                    count(*) FILTER (WHERE outcome = 'accepted' AND late) AS late_events FROM records)""",
            "records", "issue_listed", "customers", "applications", "decisions", "repayments",
        ),
    ),
    "quality_report_first_issues": Query(
        lambda spark, sf: R.first_issues(_gated_events(spark, sf), ["kafka_partition", "kafka_offset"]).groupBy("rule", "severity").agg(
            F.count(F.lit(1)).alias("issues")
        ),
        sql(
            """SELECT rule, CASE rule WHEN 'freshness_24h' THEN 'warning' ELSE 'error' END AS severity, count(*) AS issues FROM (
                 SELECT rule FROM records, unnest(CASE WHEN fails_contract THEN ['schema_contract'] WHEN violation = 10 THEN ['ingestion_after_occurrence']
                    WHEN violation = 19 THEN ['event_not_in_future', 'ingestion_after_occurrence'] WHEN late THEN ['freshness_24h']
                    WHEN violation = 20 THEN ['declined_amount_zero'] WHEN violation = 21 THEN ['repayment_status_consistency'] ELSE [] END) AS u(rule)
                 ORDER BY user_id % 6, event_id * 4 + copy, rule LIMIT 100) GROUP BY 1, 2""",
            "records",
        ),
    ),
    "typed_customers": _typed(
        "customers", "",
        f"""SELECT {uuid_sql('event_id')} AS event_id, {_OWNER} AS customer_id, registered_at AS occurred_at, country_code,
              phone_hash, age_band, income_band, occupation, consent_version FROM customers""",
        "customers",
    ),
    "typed_gsm_usage": _typed(
        "gsm_usage", "",
        f"""SELECT {_EVENT_ID} AS event_id, {_CUSTOMER_ID} AS customer_id, ts AS occurred_at, country_code, k * 36 AS call_duration_seconds,
              k AS sms_count, value AS data_mb, k AS unique_contacts, CAST(CAST(value AS DECIMAL(20,4)) AS DOUBLE) AS airtime_topup_amount,
              k * 10 + 1 AS network_tenure_days FROM records WHERE outcome = 'accepted' AND kind = 'gsm_usage'""",
        "records",
    ),
    "typed_mobile_money": _typed(
        "mobile_money_transactions", "",
        f"""SELECT {_EVENT_ID} AS event_id, {_CUSTOMER_ID} AS customer_id, ts AS occurred_at, country_code,
              ['cash_in', 'cash_out', 'p2p', 'merchant_pay', 'bill_pay'][k % 5 + 1] AS transaction_type,
              CAST(CAST(value AS DECIMAL(20,4)) AS DOUBLE) AS amount, {V.CURRENCY_BY_COUNTRY} AS currency, md5(CAST(k AS VARCHAR)) AS counterparty_hash,
              ['ussd', 'app', 'agent'][k % 3 + 1] AS channel FROM records WHERE outcome = 'accepted' AND kind = 'mobile_money_transaction'""",
        "records",
    ),
    "typed_loan_applications": _typed(
        "loan_applications", "",
        f"""SELECT {uuid_sql('event_id')} AS event_id, {_OWNER} AS customer_id, applied_at AS occurred_at, country_code, {_APPLICATION} AS application_id,
              CAST(requested_amount AS DOUBLE) AS requested_amount, currency, term_days, product_code, stated_purpose FROM applications""",
        "applications",
    ),
    "typed_loan_decisions": _typed(
        "loan_decisions", "",
        f"""SELECT {uuid_sql(_LINE_ID.format('D', 'decided_at'))} AS event_id, {_OWNER} AS customer_id, decided_at AS occurred_at, country_code,
              {_APPLICATION} AS application_id, decision, score, CAST(approved_amount AS DOUBLE) AS approved_amount,
              CAST(interest_rate AS DOUBLE) AS interest_rate, reason_code, model_version FROM decisions""",
        "decisions",
    ),
    "typed_repayments": _typed(
        "repayments", "",
        f"""SELECT {uuid_sql(_LINE_ID.format('R', 'paid_at'))} AS event_id, {_OWNER} AS customer_id, paid_at AS occurred_at, country_code,
              {uuid_sql('loan_id')} AS loan_id, {_APPLICATION} AS application_id, CAST(amount AS DOUBLE) AS amount, currency, days_past_due, payment_status
            FROM repayments""",
        "repayments",
    ),
    "dead_letters": Query(
        lambda spark, sf: S.dead_letters(S.quarantine_rows(_gated_events(spark, sf))).select(
            "key",
            F.get_json_object("value", "$.quality_reason").alias("quality_reason"),
            F.get_json_object("value", "$.kafka_partition").cast("int").alias("kafka_partition"),
            F.get_json_object("value", "$.kafka_offset").cast("bigint").alias("kafka_offset"),
        ),
        sql(
            f"""SELECT {_CUSTOMER_ID} AS key, reason AS quality_reason, CAST(user_id % 6 AS INTEGER) AS kafka_partition,
                  event_id * 4 + copy AS kafka_offset FROM records WHERE outcome = 'quarantined'""",
            "records",
        ),
    ),
    "first_line_of_order": Query(
        lambda spark, sf: portable(
            first_by(
                V.table(spark, sf, "lineitem"), ["l_orderkey"],
                ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey"], copies="lines",
            )
        ),
        """SELECT * EXCLUDE (rn) FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS lines,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
    ),
    "first_application_of_customer": Query(
        lambda spark, sf: portable(first_by(Domain(spark, sf).applications, ["customer_id"], ["applied_at", "event_id"])),
        sql(
            """SELECT * EXCLUDE (rn) REPLACE (CAST(requested_amount AS DOUBLE) AS requested_amount) FROM (SELECT *,
                 row_number() OVER (PARTITION BY customer_id ORDER BY applied_at, event_id) AS rn FROM applications) WHERE rn = 1""",
            "applications",
        ),
    ),
}
