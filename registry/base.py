"""Shared pieces: query records, portable output types, domain views in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill.plans import marts as M
from lendmill.plans.staging import stage
from lendmill.sources import testviews as V


@dataclass(frozen=True)
class Query:
    """A Spark query over a folder of test tables and, where SQL can express it, the
    same query for DuckDB."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def portable(df: DataFrame) -> DataFrame:
    """Money as double and instants without zone, as DuckDB returns them."""
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(field.name))
    return df.select(*columns)


class Domain:
    """Staged domain tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, with_owner: bool = False):
        self.spark, self.sf_dir, self.with_owner = spark, sf_dir, with_owner

    def _staged(self, name: str, *args) -> DataFrame:
        return stage(name, getattr(V, name)(self.spark, self.sf_dir, *args))

    @property
    def customers(self) -> DataFrame:
        return self._staged("customers")

    @property
    def gsm(self) -> DataFrame:
        return self._staged("gsm_usage")

    @property
    def money(self) -> DataFrame:
        return self._staged("mobile_money_transactions")

    @property
    def applications(self) -> DataFrame:
        return self._staged("loan_applications")

    @property
    def decisions(self) -> DataFrame:
        return self._staged("loan_decisions", self.with_owner)

    @property
    def repayments(self) -> DataFrame:
        return self._staged("repayments", self.with_owner)

    @property
    def portfolio(self) -> DataFrame:
        return M.credit_portfolio(self.applications, self.decisions, self.repayments)

    @property
    def events(self) -> DataFrame:
        return V.event_fact(self.spark, self.sf_dir)


# --- domain views in DuckDB SQL --------------------------------------------------
_UUID = "regexp_replace(md5({0}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def uuid_sql(text: str) -> str:
    return _UUID.format(text)


def pct(part: str, whole: str, digits: int | None = None) -> str:
    ratio = f"100.0::DOUBLE * ({part}) / nullif({whole}, 0)"
    return ratio if digits is None else rounded(ratio, digits)


def rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


_CURRENCY = V.CURRENCY_BY_COUNTRY

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "customer_country": (
        (),
        f"""SELECT c.*, {V.COUNTRY_BY_REGION} AS country_code FROM customer c
            JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "customers": (
        ("customer_country",),
        """SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS event_id, c_custkey AS customer_id,
             CAST(DATE '1994-12-31' + CAST(c_custkey % 60 AS INTEGER) AS TIMESTAMP) AS registered_at, country_code,
             sha256(c_name) AS phone_hash,
             ['18-24', '25-34', '35-44', '45-54', '55+'][c_custkey % 5 + 1] AS age_band,
             CASE WHEN c_acctbal < 0 THEN 'low' WHEN c_acctbal < 3000 THEN 'lower_middle'
                  WHEN c_acctbal < 6000 THEN 'upper_middle' ELSE 'high' END AS income_band,
             CASE c_mktsegment WHEN 'FURNITURE' THEN 'farmer' WHEN 'BUILDING' THEN 'merchant'
                  WHEN 'AUTOMOBILE' THEN 'salaried' WHEN 'MACHINERY' THEN 'gig_worker' ELSE 'other' END AS occupation,
             'v2.1' AS consent_version FROM customer_country""",
    ),
    "applications": (
        ("customer_country",),
        f"""SELECT o_orderkey AS application_id, 'A' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS event_id,
             o_custkey AS customer_id, o_orderdate AS applied_at, country_code,
             CAST(o_totalprice AS DECIMAL(20,4)) AS requested_amount, {_CURRENCY} AS currency,
             CASE left(o_orderpriority, 1) WHEN '1' THEN 7 WHEN '2' THEN 14 WHEN '3' THEN 30 WHEN '4' THEN 60 ELSE 90 END AS term_days,
             CASE o_orderstatus WHEN 'F' THEN 'nano' WHEN 'O' THEN 'working_capital' ELSE 'personal' END AS product_code,
             CASE left(o_orderpriority, 1) WHEN '1' THEN 'emergency' WHEN '2' THEN 'inventory' WHEN '3' THEN 'education'
                  WHEN '4' THEN 'agriculture' ELSE 'other' END AS stated_purpose
           FROM orders JOIN customer_country ON o_custkey = c_custkey""",
    ),
    "decisions": (
        ("applications",),
        """SELECT lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 9, '0')
               || '-' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS event_id,
             l_orderkey AS application_id, customer_id, l_shipdate AS decided_at, country_code,
             CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'R' THEN 'declined' ELSE 'manual_review' END AS decision,
             CAST(l_quantity * 20 AS INTEGER) AS score,
             CASE l_returnflag WHEN 'A' THEN CAST(l_extendedprice AS DECIMAL(20,4)) ELSE 0 END AS approved_amount,
             CAST(l_discount AS DECIMAL(8,6)) AS interest_rate,
             CASE l_returnflag WHEN 'A' THEN 'affordability_pass' WHEN 'R' THEN 'affordability_fail' ELSE 'thin_file' END AS reason_code,
             'm' || CAST(l_linenumber % 3 AS VARCHAR) AS model_version
           FROM lineitem LEFT JOIN applications ON l_orderkey = application_id WHERE l_linestatus = 'O'""",
    ),
    "repayments": (
        ("applications",),
        """SELECT lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || '-' || lpad(CAST(l_partkey AS VARCHAR), 9, '0')
               || '-' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS event_id,
             'L' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS loan_id, l_orderkey AS application_id,
             customer_id, l_shipdate AS paid_at, country_code, CAST(l_extendedprice AS DECIMAL(20,4)) AS amount, currency,
             CAST(round(l_tax * 1000) AS INTEGER) AS days_past_due,
             CASE WHEN CAST(round(l_tax * 1000) AS INTEGER) = 0 AND l_returnflag = 'A' THEN 'settled'
                  WHEN CAST(round(l_tax * 1000) AS INTEGER) = 0 THEN 'on_time'
                  WHEN l_returnflag = 'A' THEN 'partial' ELSE 'late' END AS payment_status
           FROM lineitem LEFT JOIN applications ON l_orderkey = application_id WHERE l_linestatus = 'F'""",
    ),
    "user_events": (
        (),
        f"""SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k, {V.COUNTRY_BY_USER} AS country_code FROM events""",
    ),
    "gsm": (
        ("user_events",),
        """SELECT 'G' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, user_id AS customer_id, ts AS occurred_at,
             country_code, k * 36 AS call_duration_seconds, k AS sms_count, value AS data_mb, k AS unique_contacts,
             CAST(value AS DECIMAL(20,4)) AS airtime_topup_amount, k * 10 + 1 AS network_tenure_days
           FROM user_events WHERE event_type IN ('click', 'view')""",
    ),
    "money": (
        ("user_events",),
        f"""SELECT 'M' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id, user_id AS customer_id, ts AS occurred_at,
             country_code, ['cash_in', 'cash_out', 'p2p', 'merchant_pay', 'bill_pay'][k % 5 + 1] AS transaction_type,
             CAST(value AS DECIMAL(20,4)) AS amount, {_CURRENCY} AS currency,
             ['ussd', 'app', 'agent'][k % 3 + 1] AS channel
           FROM user_events WHERE event_type = 'purchase'""",
    ),
    "event_fact": (
        ("user_events",),
        """SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS event_id,
             CASE event_type WHEN 'purchase' THEN 'mobile_money_transaction' WHEN 'signup' THEN 'device_signal'
                  WHEN 'error' THEN 'repayment' ELSE 'gsm_usage' END AS event_type,
             ts AS occurred_at, ts + to_seconds(k) AS ingested_at,
             CASE event_type WHEN 'purchase' THEN 'mobile_money' WHEN 'error' THEN 'loan_ledger' ELSE 'gsm' END AS source_system,
             country_code, md5(CAST(user_id AS VARCHAR)) AS customer_id, 'trace-' || CAST(event_id AS VARCHAR) AS trace_id,
             CAST(ts AS DATE) AS processing_date, k AS lag_s
           FROM user_events""",
    ),
    "latest": (
        ("decisions",),
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY application_id
             ORDER BY decided_at DESC, event_id DESC) AS rn FROM decisions) WHERE rn = 1""",
    ),
    "performance": (
        ("repayments",),
        """SELECT application_id, max(loan_id) AS loan_id, sum(amount) AS total_repaid, count(*) AS repayment_count,
             max(days_past_due) AS max_days_past_due, bool_or(days_past_due > 7) AS ever_par7,
             bool_or(days_past_due > 30) AS ever_par30, bool_or(payment_status = 'settled') AS is_settled,
             max(paid_at) AS last_paid_at FROM repayments GROUP BY application_id""",
    ),
    "portfolio": (
        ("applications", "latest", "performance"),
        """SELECT a.application_id, a.customer_id, a.applied_at, a.country_code, a.requested_amount, a.currency,
             a.term_days, a.product_code, a.stated_purpose, d.decided_at, d.decision, d.score, d.approved_amount,
             d.interest_rate, d.reason_code, d.model_version, r.loan_id,
             coalesce(r.total_repaid, 0) AS total_repaid, coalesce(r.repayment_count, 0) AS repayment_count,
             coalesce(r.max_days_past_due, 0) AS max_days_past_due, coalesce(r.ever_par7, false) AS ever_par7,
             coalesce(r.ever_par30, false) AS ever_par30, coalesce(r.is_settled, false) AS is_settled, r.last_paid_at
           FROM applications a LEFT JOIN latest d USING (application_id) LEFT JOIN performance r USING (application_id)""",
    ),
}


def sql(body: str, *views: str) -> str:
    """``body`` with the views it needs (and theirs) as common table expressions."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in VIEWS[name][0]:
                visit(needed)
            ordered.append(name)

    for view in views:
        visit(view)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body
