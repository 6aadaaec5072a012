"""Domain tables and raw messages derived from the star-schema test tables.

The given tables hold orders, line items and user events, not loans. These projections
turn them, row by row and without leaving any out, into the tables and messages that
the library works on.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-01-31 00:00:00"
#: Rows of a table whose messages one task builds.
ROWS_PER_TASK = 100_000

COUNTRY_BY_REGION = """CASE r_name WHEN 'AFRICA' THEN 'KEN' WHEN 'AMERICA' THEN 'UGA'
  WHEN 'ASIA' THEN 'GHA' WHEN 'EUROPE' THEN 'TZA' ELSE 'ZMB' END"""
CURRENCY_BY_COUNTRY = """CASE country_code WHEN 'KEN' THEN 'KES' WHEN 'UGA' THEN 'UGX'
  WHEN 'GHA' THEN 'GHS' WHEN 'TZA' THEN 'TZS' ELSE 'ZMW' END"""
COUNTRY_BY_USER = """CASE user_id % 5 WHEN 0 THEN 'KEN' WHEN 1 THEN 'UGA'
  WHEN 2 THEN 'GHA' WHEN 3 THEN 'TZA' ELSE 'ZMB' END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer_id and country_code; nation and region are small dimension tables."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    country = nation.selectExpr("n_nationkey", f"{COUNTRY_BY_REGION} AS country_code")
    return table(spark, sf_dir, "customer").join(country, F.col("c_nationkey") == F.col("n_nationkey"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_country(spark, sf_dir).selectExpr(
        "concat('C', lpad(cast(c_custkey AS string), 12, '0')) AS event_id",
        "c_custkey AS customer_id",
        "cast(date_add(date'1994-12-31', cast(c_custkey % 60 AS int)) AS timestamp) AS occurred_at",
        "country_code",
        "sha2(c_name, 256) AS phone_hash",
        """CASE c_custkey % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44'
           WHEN 3 THEN '45-54' ELSE '55+' END AS age_band""",
        """CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 3000 THEN 'lower_middle'
           WHEN c_acctbal < 6000 THEN 'upper_middle' ELSE 'high' END AS income_band""",
        """CASE c_mktsegment WHEN 'FURNITURE' THEN 'farmer' WHEN 'BUILDING' THEN 'merchant'
           WHEN 'AUTOMOBILE' THEN 'salaried' WHEN 'MACHINERY' THEN 'gig_worker'
           ELSE 'other' END AS occupation""",
        "'v2.1' AS consent_version",
    )


def loan_applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = customer_country(spark, sf_dir).select("c_custkey", "country_code")
    orders = table(spark, sf_dir, "orders").join(owner, F.col("o_custkey") == F.col("c_custkey"))
    return orders.selectExpr(
        "concat('A', lpad(cast(o_orderkey AS string), 12, '0')) AS event_id",
        "o_custkey AS customer_id",
        "cast(o_orderdate AS timestamp) AS occurred_at",
        "country_code",
        "o_orderkey AS application_id",
        "cast(o_totalprice AS decimal(20,4)) AS requested_amount",
        f"{CURRENCY_BY_COUNTRY} AS currency",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 7 WHEN '2-HIGH' THEN 14
           WHEN '3-MEDIUM' THEN 30 WHEN '4-NOT SPECIFIED' THEN 60 ELSE 90 END AS term_days""",
        """CASE o_orderstatus WHEN 'F' THEN 'nano' WHEN 'O' THEN 'working_capital'
           ELSE 'personal' END AS product_code""",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'emergency' WHEN '2-HIGH' THEN 'inventory'
           WHEN '3-MEDIUM' THEN 'education' WHEN '4-NOT SPECIFIED' THEN 'agriculture'
           ELSE 'other' END AS stated_purpose""",
    )


def _with_owner(spark: SparkSession, sf_dir: str, rows: DataFrame, spread: bool = False) -> DataFrame:
    """``spread``: the join deals the rows over tasks, however small the other side is."""
    owner = loan_applications(spark, sf_dir).select("application_id", "customer_id", "country_code", "currency")
    return rows.join(owner.hint("merge") if spread else owner, "application_id", "left")


def _without_owner(rows: DataFrame) -> DataFrame:
    """Owner columns left empty, for queries that do not look at them."""
    return rows.selectExpr(
        "*",
        "cast(NULL AS bigint) AS customer_id",
        "cast(NULL AS string) AS country_code",
        "cast(NULL AS string) AS currency",
    )


def loan_decisions(spark: SparkSession, sf_dir: str, with_owner: bool = False, spread: bool = False) -> DataFrame:
    """Lines of status 'O'. The owner columns need a join and are optional, since in
    the domain a decision carries them itself."""
    rows = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'O'").selectExpr(
        """concat_ws('-', lpad(cast(l_linenumber AS string), 2, '0'),
           lpad(cast(l_partkey AS string), 9, '0'), lpad(cast(l_suppkey AS string), 9, '0')) AS event_id""",
        "l_orderkey AS application_id",
        "cast(l_shipdate AS timestamp) AS occurred_at",
        """CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'declined'
           ELSE 'manual_review' END AS decision""",
        "cast(l_quantity * 20 AS int) AS score",
        """CASE l_returnflag WHEN 'A' THEN cast(l_extendedprice AS decimal(20,4))
           ELSE cast(0 AS decimal(20,4)) END AS approved_amount""",
        "cast(l_discount AS decimal(8,6)) AS interest_rate",
        """CASE l_returnflag WHEN 'A' THEN 'affordability_pass' WHEN 'R' THEN 'affordability_fail'
           ELSE 'thin_file' END AS reason_code""",
        "concat('m', cast(l_linenumber % 3 AS string)) AS model_version",
    )
    if with_owner:
        return _with_owner(spark, sf_dir, rows, spread).drop("currency")
    return _without_owner(rows).drop("currency")


def repayments(spark: SparkSession, sf_dir: str, with_owner: bool = False, spread: bool = False) -> DataFrame:
    """Lines of status 'F'."""
    rows = table(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'").selectExpr(
        """concat_ws('-', lpad(cast(l_linenumber AS string), 2, '0'),
           lpad(cast(l_partkey AS string), 9, '0'), lpad(cast(l_suppkey AS string), 9, '0')) AS event_id""",
        "l_orderkey AS application_id",
        "concat('L', lpad(cast(l_orderkey AS string), 12, '0')) AS loan_id",
        "cast(l_shipdate AS timestamp) AS occurred_at",
        "cast(l_extendedprice AS decimal(20,4)) AS amount",
        "cast(round(l_tax * 1000) AS int) AS days_past_due",
        """CASE WHEN cast(round(l_tax * 1000) AS int) = 0
                THEN CASE l_returnflag WHEN 'A' THEN 'settled' ELSE 'on_time' END
                ELSE CASE l_returnflag WHEN 'A' THEN 'partial' ELSE 'late' END END AS payment_status""",
    )
    return _with_owner(spark, sf_dir, rows, spread) if with_owner else _without_owner(rows)


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "*",
        "cast(ts AS timestamp) AS occurred_at",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        f"{COUNTRY_BY_USER} AS country_code",
    )


def gsm_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_events(spark, sf_dir).filter("event_type IN ('click', 'view')").selectExpr(
        "concat('G', lpad(cast(event_id AS string), 12, '0')) AS event_id",
        "user_id AS customer_id",
        "occurred_at",
        "country_code",
        "k * 36 AS call_duration_seconds",
        "k AS sms_count",
        "value AS data_mb",
        "k AS unique_contacts",
        "cast(value AS decimal(20,4)) AS airtime_topup_amount",
        "k * 10 + 1 AS network_tenure_days",
    )


def mobile_money_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _user_events(spark, sf_dir).filter("event_type = 'purchase'").selectExpr(
        "concat('M', lpad(cast(event_id AS string), 12, '0')) AS event_id",
        "user_id AS customer_id",
        "occurred_at",
        "country_code",
        """CASE k % 5 WHEN 0 THEN 'cash_in' WHEN 1 THEN 'cash_out' WHEN 2 THEN 'p2p'
           WHEN 3 THEN 'merchant_pay' ELSE 'bill_pay' END AS transaction_type""",
        "cast(value AS decimal(20,4)) AS amount",
        f"{CURRENCY_BY_COUNTRY} AS currency",
        "md5(cast(k AS string)) AS counterparty_hash",
        "CASE k % 3 WHEN 0 THEN 'ussd' WHEN 1 THEN 'app' ELSE 'agent' END AS channel",
    )


def event_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user event as a row of the event fact; it arrives ``k`` seconds later."""
    return _user_events(spark, sf_dir).selectExpr(
        "lpad(cast(event_id AS string), 12, '0') AS event_id",
        "'1.0' AS schema_version",
        """CASE event_type WHEN 'purchase' THEN 'mobile_money_transaction'
           WHEN 'signup' THEN 'device_signal' WHEN 'error' THEN 'repayment'
           ELSE 'gsm_usage' END AS event_type""",
        "occurred_at",
        "occurred_at + make_dt_interval(0, 0, 0, k) AS ingested_at",
        """CASE event_type WHEN 'purchase' THEN 'mobile_money' WHEN 'error' THEN 'loan_ledger'
           ELSE 'gsm' END AS source_system""",
        "country_code",
        "md5(cast(user_id AS string)) AS customer_id",
        "concat('trace-', cast(event_id AS string)) AS trace_id",
        "to_date(occurred_at) AS processing_date",
    )


# --- raw messages ----------------------------------------------------------------

LINE_EVENT = "concat('{tag}', cast(application_id AS string), cast(occurred_at AS string), event_id)"
EVENT_TEXT = "concat('{0}', cast(event_id AS string))"
APPLICATION = "concat('application', cast(application_id AS string))"
TRANSACTION_TYPE = """CASE k % 5 WHEN 0 THEN 'cash_in' WHEN 1 THEN 'cash_out' WHEN 2 THEN 'p2p'
  WHEN 3 THEN 'merchant_pay' ELSE 'bill_pay' END"""
CHANNEL = "CASE k % 3 WHEN 0 THEN 'ussd' WHEN 1 THEN 'app' ELSE 'agent' END"


def _uuid(text: str) -> str:
    return f"regexp_replace(md5({text}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"


def _iso(instant: str, zone: str = "\\'Z\\'") -> str:
    return f"date_format({instant}, 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS{zone}')"


def _struct(fields: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _tasks(given: DataFrame) -> int:
    """How many tasks build the messages of a table, whatever the number of its files."""
    return max(2 * given.sparkSession.sparkContext.defaultParallelism, math.ceil(given.count() / ROWS_PER_TASK))


def _loan_messages_of(rows: DataFrame, tasks: int | None, kind: str, source: str, event: str, payload: str) -> DataFrame:
    """One message per row of a domain table. ``payload`` lists columns; a pair written
    as name=expression derives one. The rows are dealt over ``tasks`` before the text is built, which
    is several times as long; None where a join has dealt them."""
    if tasks:
        rows = rows.repartition(tasks, *[c for c in ("event_id", "application_id") if c in rows.columns])
    pairs = [item.strip() for item in payload.split(";")]
    fields = {"event_type": f"'{kind}'"}
    for pair in pairs:
        name, _, expression = pair.partition("=")
        fields[name] = expression or name
    envelope = {
        "event_id": "event_uuid",
        "schema_version": "'1.0'",
        "event_type": f"'{kind}'",
        "occurred_at": _iso("occurred_at"),
        "ingested_at": _iso("occurred_at"),
        "source_system": f"'{source}'",
        "country_code": "country_code",
        "customer_id": "customer_uuid",
        "correlation_id": "customer_uuid",
        "trace_id": "concat('trace-', event_uuid)",
        "payload": _struct(fields),
    }
    return rows.selectExpr(
        "*", f"{_uuid(event)} AS event_uuid", f"{_uuid('cast(customer_id AS string)')} AS customer_uuid"
    ).selectExpr(
        "cast(customer_uuid AS binary) AS key",
        f"cast(to_json({_struct(envelope)}) AS binary) AS value",
        "timestamp'2024-01-01 00:00:00' AS timestamp",  # a backlog, delivered at once
        "cast(pmod(xxhash64(customer_uuid), 6) AS int) AS partition",
        "xxhash64(event_uuid) AS offset",
    )


def loan_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One valid message per customer, application, decision and repayment."""
    application = f"application_id={_uuid(APPLICATION)}"
    parts = [
        _loan_messages_of(
            customers(spark, sf_dir), _tasks(table(spark, sf_dir, "customer")), "customer_registered", "identity", "event_id",
            "phone_hash; age_band; income_band; occupation; consent_version",
        ),
        _loan_messages_of(
            loan_applications(spark, sf_dir), _tasks(table(spark, sf_dir, "orders")), "loan_application", "credit_engine", "event_id",
            f"{application}; requested_amount; currency; term_days; product_code; stated_purpose",
        ),
        _loan_messages_of(
            loan_decisions(spark, sf_dir, True, spread=True), None, "loan_decision", "credit_engine", LINE_EVENT.format(tag="D"),
            f"{application}; decision; score; approved_amount; interest_rate; reason_code; model_version",
        ),
        _loan_messages_of(
            repayments(spark, sf_dir, True, spread=True), None, "repayment", "loan_ledger", LINE_EVENT.format(tag="R"),
            f"loan_id={_uuid('loan_id')}; {application}; amount; currency; days_past_due; payment_status",
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# Which violation an 'error' event carries, from its k (0..99).
VIOLATION = "CASE WHEN k < 80 THEN k % 20 WHEN k < 90 THEN 20 ELSE 21 END"


def event_messages(spark: SparkSession, sf_dir: str, ranges: int | None = None) -> DataFrame:
    """User events as messages, spread over tasks like a topic, whatever the number of
    files of the given table: by ``ranges`` of their offsets, or by hash. The rows are spread
    before the text is built, which is several times as long."""
    rows = _user_events(spark, sf_dir)
    if ranges:  # offsets ascend with the ids
        return _event_messages(rows.repartitionByRange(ranges, "event_id"))
    return _event_messages(rows.repartition(_tasks(table(spark, sf_dir, "events")), "event_id"))


def _event_messages(events: DataFrame) -> DataFrame:
    """User events as messages.

    click, view -> gsm_usage; purchase -> mobile_money_transaction; signup ->
    device_signal; error -> one violation each, chosen by ``VIOLATION``. Views with
    k >= 95 arrive two days late. Some messages come more than once: clicks and signups
    with k < 10 twice (the second signup has another trace id), purchases with k < 5
    three times, and business-rule failures of kind 20 twice.
    """
    rows = (
        events
        .selectExpr("*", f"CASE WHEN event_type = 'error' THEN {VIOLATION} ELSE -1 END AS violation")
        .selectExpr(
            "* EXCEPT (occurred_at)",
            "IF(violation = 19, timestamp'2030-01-01 00:00:00', occurred_at) AS occurred_at",
            """CASE WHEN event_type = 'view' AND k >= 95 THEN occurred_at + INTERVAL '2' DAY
                    WHEN violation = 10 THEN occurred_at - INTERVAL '1' MINUTE
                    ELSE occurred_at + make_dt_interval(0, 0, 0, k) END AS ingested_at""",
            """CASE WHEN event_type IN ('click', 'view') THEN 'gsm_usage'
                    WHEN event_type = 'purchase' THEN 'mobile_money_transaction'
                    WHEN event_type = 'signup' THEN 'device_signal'
                    WHEN violation = 5 THEN 'refund'
                    WHEN violation = 11 THEN 'mobile_money_transaction'
                    WHEN violation = 12 THEN 'loan_application'
                    WHEN violation = 20 THEN 'loan_decision'
                    WHEN violation = 21 THEN 'repayment'
                    ELSE 'gsm_usage' END AS kind""",
            f"{_uuid(EVENT_TEXT.format('event'))} AS event_uuid",
            f"{_uuid('cast(user_id AS string)')} AS customer_uuid",
            f"{_uuid(EVENT_TEXT.format('application'))} AS application_uuid",
            f"{CURRENCY_BY_COUNTRY} AS currency",
            """explode(sequence(0, CASE WHEN event_type IN ('click', 'signup') AND k < 10 THEN 1
                    WHEN event_type = 'purchase' AND k < 5 THEN 2 WHEN violation = 20 THEN 1 ELSE 0 END)) AS copy""",
        )
    )

    def only(kinds: str, expression: str) -> str:
        listed = ", ".join(f"'{kind}'" for kind in kinds.split())
        return f"IF(kind IN ({listed}), {expression}, NULL)"

    payload = {
        "event_type": "IF(violation = 6, 'device_signal', kind)",
        "call_duration_seconds": only("gsm_usage", "k * 36"),
        # Renamed below: violation 13 has text where a number belongs.
        "sms_count_text": "IF(violation = 13, 'many', NULL)",
        "sms_count": only("gsm_usage", "CASE violation WHEN 13 THEN NULL WHEN 17 THEN 1001 ELSE k END"),
        "data_mb": only("gsm_usage", "value"),
        "unique_contacts": only("gsm_usage", "k"),
        "airtime_topup_amount": only("gsm_usage", "value"),
        "network_tenure_days": only("gsm_usage", "k * 10 + 1"),
        "surprise": "IF(violation = 14, 'x', NULL)",
        "transaction_type": only("mobile_money_transaction", TRANSACTION_TYPE),
        "amount": only("mobile_money_transaction repayment", "IF(violation = 11, 0.0D, value)"),
        "currency": only("mobile_money_transaction loan_application repayment", "currency"),
        "counterparty_hash": only("mobile_money_transaction", "md5(cast(k AS string))"),
        "channel": only("mobile_money_transaction", CHANNEL),
        "device_hash": only("device_signal", "md5(cast(user_id AS string))"),
        "sim_slot_count": only("device_signal", "k % 4 + 1"),
        "device_age_months": only("device_signal", "k"),
        "is_rooted": only("device_signal", "k % 2 = 0"),
        "location_cell_changes_24h": only("device_signal", "k * 7"),
        "application_id": only("loan_application loan_decision repayment", "application_uuid"),
        "requested_amount": only("loan_application", "-5.0D"),
        "term_days": only("loan_application", "30"),
        "product_code": only("loan_application", "'nano'"),
        "stated_purpose": only("loan_application", "'other'"),
        "decision": only("loan_decision", "'declined'"),
        "score": only("loan_decision", "300"),
        "approved_amount": only("loan_decision", "100.0D"),
        "interest_rate": only("loan_decision", "0.1D"),
        "reason_code": only("loan_decision", "'policy_limit'"),
        "loan_id": only("repayment", "application_uuid"),
        "days_past_due": only("repayment", "0"),
        "payment_status": only("repayment", "'late'"),
    }
    envelope = {
        "event_id": "IF(violation = 3, NULL, event_uuid)",
        "schema_version": "IF(violation = 4, '2.0', '1.0')",
        "event_type": "kind",
        "occurred_at": f"CASE violation WHEN 9 THEN NULL WHEN 16 THEN {_iso('occurred_at', '')} ELSE {_iso('occurred_at')} END",
        "ingested_at": _iso("ingested_at"),
        "source_system": """CASE kind WHEN 'mobile_money_transaction' THEN 'mobile_money' WHEN 'repayment' THEN 'loan_ledger'
            WHEN 'loan_application' THEN 'credit_engine' WHEN 'loan_decision' THEN 'credit_engine' ELSE 'gsm' END""",
        "country_code": "IF(violation = 8, NULL, country_code)",
        "customer_id": "IF(violation = 7, NULL, customer_uuid)",
        "correlation_id": "customer_uuid",
        "trace_id": "concat(IF(event_type = 'signup' AND copy > 0, 'again-', 'trace-'), cast(event_id AS string))",
        "surprise": "IF(violation = 15, 1, NULL)",
        "payload": _struct(payload),
    }
    return rows.selectExpr(
        "*", f"replace(to_json({_struct(envelope)}), 'sms_count_text', 'sms_count') AS body"
    ).selectExpr(
        "cast(customer_uuid AS binary) AS key",
        """cast(CASE violation WHEN 0 THEN concat('not json ', cast(event_id AS string)) WHEN 1 THEN ''
                WHEN 2 THEN '[1, 2]' WHEN 18 THEN concat(body, ' tail') ELSE body END AS binary) AS value""",
        "ingested_at AS timestamp",
        "cast(user_id % 6 AS int) AS partition",
        "event_id * 4 + copy AS offset",
    )


def all_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan messages and user events together, spread like the partitions of a topic."""
    return loan_messages(spark, sf_dir).unionByName(event_messages(spark, sf_dir))
