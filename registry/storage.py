"""Layers, writers and runs: each query fills a new lake from the whole test tables and
returns what a reader of that lake sees."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendmill import contract as C
from lendmill.operators import gate as G
from lendmill.plans import backfill as B
from lendmill.plans import batch as P
from lendmill.plans import publish as U
from lendmill.plans import serving as V2
from lendmill.session import work_dir
from lendmill.sinks import layers as S
from lendmill.sources import lake as L
from lendmill.sources import testviews as V
from lendmill.sources.messages import LINE_ORDER, decode, raw_lines

from registry.base import Domain, Query, pct, portable, sql
from registry.marts import QUERIES as MARTS
from registry.gating import _CUSTOMER_ID, _EVENT_ID

RUN = "run-1"


def _lake(spark, label: str, **options) -> L.Lake:
    return L.Lake(work_dir(spark, label), **options)


# Few rows a day: these lakes keep whole days together.
BY_DAY = ("processing_date",)


def _bronze(spark, sf, label: str) -> L.Lake:
    lake = _lake(spark, label, silver_partitions=BY_DAY)
    S.append(S.bronze_rows(decode(V.event_messages(spark, sf))), lake.bronze, S.BRONZE_PARTITIONS)
    return lake


def _bronze_counts(rows):
    return rows.groupBy("ingestion_date", "kafka_partition").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("kafka_offset").alias("offsets"),
        F.count("raw_value").alias("texts"),
    )


_INGESTED = """CASE WHEN event_type = 'view' AND k >= 95 THEN ts + INTERVAL 2 DAY WHEN violation = 10 THEN ts - INTERVAL 1 MINUTE
  ELSE ts + to_seconds(k) END"""
_BRONZE_SQL = f"""SELECT CAST({_INGESTED} AS DATE) AS ingestion_date, CAST(user_id % 6 AS INTEGER) AS kafka_partition, count(*) AS messages,
  count(DISTINCT event_id * 4 + c) AS offsets, count(*) AS texts FROM judged, unnest(range(sent)) AS t(c)"""


def _silver(spark, sf):
    """Accepted events inserted twice; the second time must add nothing."""
    lake = _lake(spark, "silver")
    gated = P.settle(G.gate(decode(V.event_messages(spark, sf)), V.AS_OF), lake.path("work", "gated"))
    accepted = G.accepted(gated)
    rows = accepted.count()
    for keep in (False, True):
        S.load_event_fact(spark, lake, accepted, rows, ids_keep_their_date=keep)
    return _silver_counts(L.event_fact(spark, lake))


def _silver_counts(rows):
    return rows.groupBy("processing_date", "country_code", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids"), F.max("ingested_at").cast("timestamp_ntz").alias("newest")
    )


_SILVER_SQL = sql(
    """SELECT CAST(ts AS DATE) AS processing_date, country_code, kind AS event_type, count(*) AS events, count(*) AS ids,
         max(CASE WHEN late THEN ts + INTERVAL 2 DAY ELSE ts + to_seconds(k) END) AS newest
       FROM records WHERE outcome = 'accepted' GROUP BY 1, 2, 3""",
    "records",
)


def _quarantine(spark, sf):
    lake = _lake(spark, "quarantine")
    gated = P.settle(G.gate(decode(V.event_messages(spark, sf)), V.AS_OF), lake.path("work", "gated"))
    for _ in range(2):
        S.load_quarantine(spark, lake, gated, gated.count())
    return L.quarantine(spark, lake).select("quality_reason", "event_id", "kafka_key", "kafka_partition", "kafka_offset")


def _quarantine_lines(spark, sf):
    """Plain lines in, JSON lines out."""
    lake = _lake(spark, "lines")
    V.event_messages(spark, sf).select(F.col("value").cast("string")).write.text(lake.path("input"))
    gated = G.gate(raw_lines(spark, lake.path("input")), V.AS_OF, LINE_ORDER)
    S.quarantine_lines(gated).write.json(lake.path("quarantine"))
    written = spark.read.schema("raw string, reason string, error string, errors array<string>").json(lake.path("quarantine"))
    return written.groupBy("reason", F.coalesce("error", F.array_join("errors", "; ")).alias("detail")).agg(F.count(F.lit(1)).alias("lines"))


def _insert_if_absent(spark, sf):
    """Applications of one status first, then all of them twice."""
    lake = _lake(spark, "insert")
    applications = V.loan_applications(spark, sf).withColumn("application_id", F.col("application_id").cast("string")).withColumn(
        "customer_id", F.col("customer_id").cast("string")
    )
    schema, path = C.table_schema("loan_applications"), lake.table("loan_applications")
    rows = applications.count()
    for batch in (applications.filter("product_code = 'nano'"), applications, applications):
        S.insert_if_absent(spark, batch, path, schema, C.TYPED_TABLES["loan_applications"].unique_keys, ["occurred_at", "event_id"], rows)
    return portable(L.warehouse_table(spark, lake, "loan_applications"))


def _first_registration(spark, sf):
    """One row per customer although every order registers its customer again."""
    lake = _lake(spark, "customers")
    profile = V.customers(spark, sf).drop("event_id", "occurred_at")
    again = V.table(spark, sf, "orders").select(
        F.format_string("A%012d", "o_orderkey").alias("event_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp").alias("occurred_at"),
    )
    batch = again.join(profile, "customer_id").withColumn("customer_id", F.col("customer_id").cast("string"))
    S.insert_if_absent(
        spark, batch, lake.table("customers"), C.table_schema("customers"), C.TYPED_TABLES["customers"].unique_keys,
        ["occurred_at", "event_id"], batch.count(),
    )
    return portable(L.warehouse_table(spark, lake, "customers").select("customer_id", "event_id", "occurred_at", "country_code"))


def _whole_run(spark, sf, label):
    """All messages through a batch run. The loans span years with few rows a day, so
    this lake leaves the date out of its silver partitions."""
    lake = _lake(spark, label, silver_partitions=("country_code", "event_type"))
    P.run_batch(spark, lake, decode(V.all_messages(spark, sf)), V.AS_OF, RUN)
    return lake


def _batch_summary(spark, sf):
    lake = _whole_run(spark, sf, "run")
    summary = spark.read.json(lake.path("reports", RUN, "business_summary"))
    run = V2.latest_run(L.read_table(spark, lake.runs, L.RUN_SCHEMA)).withColumn("run_id", F.lit(RUN))
    issues = L.read_table(spark, lake.issues, L.ISSUE_SCHEMA).agg(F.count(F.lit(1)).alias("issues")).withColumn("run_id", F.lit(RUN))
    return (
        summary.join(run.select("run_id", "status", "input_rows", "output_rows", "quarantined_rows"), "run_id").join(issues, "run_id").drop("run_id")
    )


def _published(spark, sf, mart):
    d = Domain(spark, sf, True)
    lake = _lake(spark, "publish")
    tables = {
        "customers": d.customers, "gsm_usage": d.gsm, "mobile_money_transactions": d.money,
        "loan_applications": d.applications, "loan_decisions": d.decisions, "repayments": d.repayments,
    }
    U.publish(spark, lake, d.events, tables, V.AS_OF, RUN)
    return lake, U.published(spark, lake, mart)


def _two_publications(spark, sf):
    """Two publications for one time of data: the first of all applications, the one completed last
    of nano loans. Returns what readers see, with the two runs as audited."""
    d = Domain(spark, sf, True)
    lake = _lake(spark, "twice")
    tables = {
        "customers": d.customers, "gsm_usage": d.gsm, "mobile_money_transactions": d.money,
        "loan_applications": d.applications, "loan_decisions": d.decisions, "repayments": d.repayments,
    }
    U.publish(spark, lake, d.events, tables, V.AS_OF, "run_9", clock=iter(["2024-02-01 10:00:00", "2024-02-01 10:05:00"]).__next__)
    nano = {**tables, "loan_applications": d.applications.filter("product_code = 'nano'")}
    U.publish(spark, lake, d.events, nano, V.AS_OF, "run_10", clock=iter(["2024-02-01 10:10:00", "2024-02-01 10:20:00"]).__next__)
    seen = U.published(spark, lake, "fct_credit_portfolio").count()
    runs = L.read_table(spark, lake.runs, L.RUN_SCHEMA).select("run_id", "status", "started_at", "completed_at")
    return portable(runs.withColumn("visible", F.lit(seen).cast("bigint")))


def _quality_status(spark, sf):
    lake, _ = _published(spark, sf, "fct_credit_portfolio")
    checks = V2.recent_checks(L.read_table(spark, lake.checks, L.CHECK_SCHEMA))
    run = V2.latest_run(L.read_table(spark, lake.runs, L.RUN_SCHEMA))
    return checks.groupBy("dataset_name", "status").agg(F.count(F.lit(1)).alias("checks")).unionByName(
        run.select(F.col("pipeline_name").alias("dataset_name"), "status", F.lit(1).cast("bigint").alias("checks"))
    )


def _backfill(spark, sf):
    """Silver is filled, then the dates of a week of ingestion are rebuilt from bronze."""
    lake = _bronze(spark, sf, "backfill")
    messages = L.bronze(spark, lake).drop("ingestion_date")
    gated = P.settle(G.gate(messages, V.AS_OF, columns=S.fact_columns()), lake.path("work", "first"))
    S.load_event_fact(spark, lake, G.accepted(gated), gated.count())
    B.backfill(spark, lake, "2024-01-10", "2024-01-16", V.AS_OF, RUN)
    return _silver_counts(L.event_fact(spark, lake))


def _replay(spark, sf):
    """Every message was quarantined by an outdated consumer; the gate now judges again."""
    lake = _lake(spark, "replay", silver_partitions=BY_DAY)
    stuck = decode(V.event_messages(spark, sf)).withColumn("quality_reason", F.lit("unsupported_schema_version")).withColumn("event_id", F.lit(None).cast("string"))
    S.append(stuck.select(*L.QUARANTINE_SCHEMA.names), lake.quarantine, S.QUARANTINE_PARTITIONS)
    B.replay_quarantine(spark, lake, ["unsupported_schema_version"], V.AS_OF, RUN)
    return _silver_counts(L.event_fact(spark, lake))


def _statistics(spark, sf):
    path = f"{sf}/lineitem.parquet"
    name = "lineitem_" + "".join(ch if ch.isalnum() else "_" for ch in sf)
    return U.analyze(spark, name, path).select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("row_count"))


QUERIES: dict[str, Query] = {
    "bronze_messages": Query(
        lambda spark, sf: _bronze_counts(L.bronze(spark, _bronze(spark, sf, "bronze"))), sql(f"{_BRONZE_SQL} GROUP BY 1, 2", "judged")
    ),
    "bronze_date_range": Query(
        lambda spark, sf: _bronze_counts(L.bronze(spark, _bronze(spark, sf, "bronze"), "2024-01-10", "2024-01-16")),
        sql(f"{_BRONZE_SQL} WHERE CAST({_INGESTED} AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16' GROUP BY 1, 2", "judged"),
    ),
    "silver_events": Query(_silver, _SILVER_SQL),
    "quarantine_table": Query(
        _quarantine,
        sql(
            f"""SELECT reason AS quality_reason, CASE WHEN NOT fails_contract THEN {_EVENT_ID} END AS event_id, {_CUSTOMER_ID} AS kafka_key,
                 CAST(user_id % 6 AS INTEGER) AS kafka_partition, event_id * 4 + copy AS kafka_offset FROM records WHERE outcome = 'quarantined'""",
            "records",
        ),
    ),
    "quarantine_lines": Query(
        _quarantine_lines,
        sql(
            """SELECT CASE WHEN fails_contract THEN 'schema_contract' ELSE 'business_rule' END AS reason,
                 CASE WHEN violation = 10 THEN 'ingested_at precedes occurred_at' WHEN violation = 19 THEN 'occurred_at is in the future; ingested_at precedes occurred_at'
                   WHEN violation = 20 THEN 'non-approved decision has an approved amount' WHEN violation IN (0, 1, 2, 18) THEN 'json' WHEN violation = 3 THEN 'event_id:missing'
                   WHEN violation = 4 THEN 'schema_version:choice' WHEN violation = 5 THEN 'event_type:choice' WHEN violation = 6 THEN 'payload:tag'
                   WHEN violation = 7 THEN 'customer_id:missing' WHEN violation = 8 THEN 'country_code:missing' WHEN violation = 9 THEN 'occurred_at:missing'
                   WHEN violation = 12 THEN 'payload.requested_amount:range' WHEN violation = 13 THEN 'value:type' WHEN violation = 14 THEN 'payload:unknown_field'
                   WHEN violation = 15 THEN 'unknown_field' WHEN violation = 16 THEN 'occurred_at:zone' WHEN violation = 17 THEN 'payload.sms_count:range'
                   WHEN fails_contract THEN 'payload.amount:range' ELSE 'late/partial payment must have positive days past due' END AS detail, count(*) AS lines
               FROM records WHERE outcome = 'quarantined' GROUP BY 1, 2""",
            "records",
        ),
    ),
    "insert_if_absent": Query(
        _insert_if_absent,
        sql(
            """SELECT event_id, CAST(customer_id AS VARCHAR) AS customer_id, applied_at AS occurred_at, country_code, CAST(application_id AS VARCHAR) AS application_id,
                 CAST(requested_amount AS DOUBLE) AS requested_amount, currency, term_days, product_code, stated_purpose FROM applications""",
            "applications",
        ),
    ),
    "first_registration_of_customer": Query(
        _first_registration,
        sql(
            """SELECT CAST(customer_id AS VARCHAR) AS customer_id, event_id, applied_at AS occurred_at, country_code FROM (SELECT *,
                 row_number() OVER (PARTITION BY customer_id ORDER BY applied_at, event_id) AS rn FROM applications) WHERE rn = 1""",
            "applications",
        ),
    ),
    "batch_run_summary": Query(
        _batch_summary,
        sql(
            f"""SELECT (SELECT count(*) FROM customers) AS customers, count(DISTINCT customer_id) AS applicants, count(*) AS applications, count(decision) AS decisions,
                 count(*) FILTER (WHERE decision = 'approved') AS approvals, count(*) FILTER (WHERE total_repaid > 0) AS loans_with_repayment,
                 {pct("count(*) FILTER (WHERE decision = 'approved')", 'count(decision)', 2)} AS approval_rate_pct,
                 (SELECT count(*) FROM records WHERE outcome = 'accepted' AND kind = 'mobile_money_transaction') AS transactions,
                 (SELECT count(*) FROM repayments) AS repayments,
                 {pct('count(*) FILTER (WHERE total_repaid > 0 AND ever_par30)', 'count(*) FILTER (WHERE total_repaid > 0)', 2)} AS par30_pct,
                 'success' AS status, any_value(n.received) AS input_rows, any_value(n.accepted) AS output_rows, any_value(n.quarantined) AS quarantined_rows,
                 any_value(n.issues) AS issues
               FROM portfolio_uuid, (SELECT CAST(sum(copies) AS BIGINT) + any_value(l.loans) AS received, count(*) FILTER (WHERE outcome = 'accepted') + any_value(l.loans) AS accepted,
                   count(*) FILTER (WHERE outcome = 'quarantined') AS quarantined, count(*) FILTER (WHERE outcome = 'quarantined' OR late) + count(*) FILTER (WHERE violation = 19) AS issues
                 FROM records, (SELECT (SELECT count(*) FROM customers) + (SELECT count(*) FROM applications) + (SELECT count(*) FROM decisions) + (SELECT count(*) FROM repayments) AS loans) l) n""",
            "portfolio", "customers", "records", "repayments",
        )
        # In the run decisions carry hashed ids, so ties of one day are broken by those.
        .replace(
            "\nSELECT (SELECT count(*) FROM customers) AS customers, count(DISTINCT",
            """,\nportfolio_uuid AS (SELECT a.application_id, a.customer_id, d.decision, coalesce(r.total_repaid, 0) AS total_repaid, coalesce(r.ever_par30, false) AS ever_par30
               FROM applications a LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY decided_at DESC,
                 md5('D' || CAST(application_id AS VARCHAR) || strftime(decided_at, '%Y-%m-%d %H:%M:%S') || event_id) DESC) AS rn FROM decisions) WHERE rn = 1) d USING (application_id)
               LEFT JOIN performance r USING (application_id))\nSELECT (SELECT count(*) FROM customers) AS customers, count(DISTINCT""",
        ),
    ),
    "published_portfolio": Query(
        lambda spark, sf: portable(_published(spark, sf, "fct_credit_portfolio")[1]),
        MARTS["credit_portfolio"].sql,
    ),
    "published_country_performance": Query(
        lambda spark, sf: portable(_published(spark, sf, "mart_country_performance")[1]),
        MARTS["country_performance"].sql,
    ),
    "latest_of_two_publications": Query(
        _two_publications,
        sql(
            """SELECT r.*, (SELECT count(*) FROM applications WHERE product_code = 'nano') AS visible FROM (VALUES
                 ('run_9', 'success', TIMESTAMP '2024-02-01 10:00:00', TIMESTAMP '2024-02-01 10:05:00'),
                 ('run_10', 'success', TIMESTAMP '2024-02-01 10:10:00', TIMESTAMP '2024-02-01 10:20:00')) AS r(run_id, status, started_at, completed_at)""",
            "applications",
        ),
    ),
    "quality_status": Query(
        _quality_status,
        """SELECT * FROM (VALUES ('event_fact', 'pass', CAST(2 AS BIGINT)), ('fct_credit_portfolio', 'pass', 7), ('dim_customer_features', 'pass', 3),
             ('mart_country_performance', 'pass', 2), ('daily_portfolio', 'success', 1)) AS t(dataset_name, status, checks)""",
    ),
    "backfilled_silver": Query(_backfill, _SILVER_SQL),
    "replayed_quarantine": Query(_replay, _SILVER_SQL),
    "table_statistics": Query(_statistics, "SELECT count(*) AS row_count FROM lineitem"),
}
