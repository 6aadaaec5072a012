"""Data tests, gates and grades over the whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lendmill.operators import checks as K
from lendmill.operators import report as R
from lendmill.plans import marts as M
from lendmill.plans import serving as S
from lendmill.sources import testviews as V

from registry.base import Domain, Query, portable, sql
from registry.gating import _VALID_LOAN_MESSAGES, _gated

NOW = f"TIMESTAMP '{V.AS_OF}'"


def _results(*rows: tuple[str, str, str, float]) -> str:
    """Result rows in SQL: dataset, rule, observed expression, threshold."""
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset_name, '{rule}' AS rule_name, CASE WHEN v <= {limit} THEN 'pass' ELSE 'fail' END AS status, "
        f"CAST(v AS DOUBLE) AS observed_value, {limit}::DOUBLE AS threshold_value FROM (SELECT ({observed}) AS v)"
        for dataset, rule, observed, limit in rows
    )


def _duplicated(view: str, key: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {view} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"


def _count(view: str, condition: str) -> str:
    return f"SELECT count(*) FROM {view} WHERE {condition}"


def _coherence(spark, sf):
    d = Domain(spark, sf, True)
    activity = K.stack(
        [
            d.gsm.select("customer_id", "occurred_at"),
            d.money.select("customer_id", "occurred_at"),
            d.applications.select("customer_id", F.col("applied_at").alias("occurred_at")),
            d.decisions.select("customer_id", F.col("decided_at").alias("occurred_at")),
            d.repayments.select("customer_id", F.col("paid_at").alias("occurred_at")),
        ]
    )
    return K.coherence(d.customers, activity, d.applications, d.decisions, d.repayments)


def _slo(spark, sf):
    """Service measures of the whole history, graded."""
    events = Domain(spark, sf).events
    age = S.ingestion_summary(events, V.AS_OF).select(F.col("latest_event_age_seconds").alias("event_age_seconds"))
    lag = S.event_throughput(events).agg(F.max("p95_lag_seconds").alias("p95_lag_seconds"))
    counts = R.gate_counts(_gated(spark, sf, *R.COUNTED)).select(
        (F.col("acceptance_rate") * 100).alias("acceptance_pct"),
        (F.col("quarantined") / F.col("received")).alias("quarantine_rate"),
    )
    return K.grade_slo(M.side_by_side(age, lag, counts))


_EVENTS_GRADE = f"""SELECT 'event_fact' AS dataset_name, 'freshness_occurred_at' AS rule_name,
  CASE WHEN age IS NULL OR age > 60 THEN 'fail' WHEN age > 15 THEN 'warn' ELSE 'pass' END AS status, age AS observed_value,
  60.0::DOUBLE AS threshold_value FROM (SELECT epoch_us({NOW} - max(occurred_at)) / 1e6 / 60.0::DOUBLE AS age FROM event_fact)"""

QUERIES: dict[str, Query] = {
    "portfolio_data_tests": Query(
        lambda spark, sf: K.portfolio_tests((d := Domain(spark, sf)).portfolio, d.customers),
        sql(
            _results(
                ("fct_credit_portfolio", "unique_application_id", _duplicated("portfolio", "application_id"), 0),
                ("fct_credit_portfolio", "not_null_application_id", _count("portfolio", "application_id IS NULL"), 0),
                ("fct_credit_portfolio", "not_null_customer_id", _count("portfolio", "customer_id IS NULL"), 0),
                ("fct_credit_portfolio", "accepted_values_decision", _count("portfolio", "decision NOT IN ('approved', 'declined', 'manual_review')"), 0),
                ("fct_credit_portfolio", "accepted_range_score", _count("portfolio", "score < 0 OR score > 1000"), 0),
                ("fct_credit_portfolio", "relationships_customer_id", _count("portfolio", "customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers)"), 0),
                ("fct_credit_portfolio", "one_currency_per_country", "SELECT count(*) FROM (SELECT country_code FROM portfolio GROUP BY 1 HAVING count(DISTINCT currency) > 1)", 0),
            ),
            "portfolio", "customers",
        ),
    ),
    "features_data_tests": Query(
        lambda spark, sf: K.features_tests(M.customer_features((d := Domain(spark, sf)).customers, d.gsm, d.money, d.portfolio, V.AS_OF)),
        sql(
            _results(
                ("dim_customer_features", "unique_customer_id", _duplicated("customers", "customer_id"), 0),
                ("dim_customer_features", "not_null_customer_id", _count("customers", "customer_id IS NULL"), 0),
                ("dim_customer_features", "accepted_values_country_code", _count("customers", "country_code NOT IN ('KEN', 'UGA', 'GHA', 'TZA', 'ZMB')"), 0),
            ),
            "customers",
        ),
    ),
    "country_data_tests": Query(
        lambda spark, sf: K.country_tests(M.country_performance(Domain(spark, sf).portfolio)),
        sql(
            _results(
                ("mart_country_performance", "unique_country_code", "SELECT 0", 0),
                ("mart_country_performance", "not_null_country_code", "SELECT count(*) FROM (SELECT DISTINCT country_code FROM portfolio) WHERE country_code IS NULL", 0),
            ),
            "portfolio",
        ),
    ),
    "failing_data_tests": Query(
        # Tests that the raw tables do break: repeated keys, values outside a list or range.
        lambda spark, sf: K.stack(
            [
                K.unique("lineitem", V.table(spark, sf, "lineitem"), "l_orderkey"),
                K.row_checks(
                    "lineitem", V.table(spark, sf, "lineitem"),
                    [
                        K.accepted_values("l_returnflag", ["A", "N"], F.col("l_linestatus") == "F"),
                        K.accepted_range("l_quantity", 5, 45),
                        K.not_null("l_orderkey"),
                    ],
                ),
                K.relationships("orders", V.table(spark, sf, "orders"), "o_custkey", V.table(spark, sf, "events"), "user_id"),
                K.one_currency_per_country(
                    "orders", V.table(spark, sf, "orders").selectExpr("o_orderstatus AS country_code", "o_orderpriority AS currency")
                ),
            ]
        ),
        _results(
            ("lineitem", "unique_l_orderkey", _duplicated("lineitem", "l_orderkey"), 0),
            ("lineitem", "accepted_values_l_returnflag", _count("lineitem", "l_linestatus = 'F' AND l_returnflag NOT IN ('A', 'N')"), 0),
            ("lineitem", "accepted_range_l_quantity", _count("lineitem", "l_quantity < 5 OR l_quantity > 45"), 0),
            ("lineitem", "not_null_l_orderkey", _count("lineitem", "l_orderkey IS NULL"), 0),
            ("orders", "relationships_o_custkey", _count("orders", "o_custkey NOT IN (SELECT user_id FROM events)"), 0),
            ("orders", "one_currency_per_country", "SELECT count(*) FROM (SELECT o_orderstatus FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1)", 0),
        ),
    ),
    "customers_without_events": Query(
        lambda spark, sf: K.orphans(V.table(spark, sf, "orders"), "o_custkey", V.table(spark, sf, "events"), "user_id"),
        "SELECT o_custkey, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events) GROUP BY 1",
    ),
    "source_freshness": Query(
        lambda spark, sf: K.source_freshness("event_fact", Domain(spark, sf).events, V.AS_OF),
        sql(_EVENTS_GRADE, "event_fact"),
    ),
    "publication_gates": Query(
        lambda spark, sf: K.stack([K.freshness_gate((e := Domain(spark, sf).events), V.AS_OF), K.volume_gate(e, V.AS_OF)]),
        sql(
            f"""SELECT 'event_fact' AS dataset_name, 'streaming_freshness' AS rule_name,
                  CASE WHEN coalesce(max(ingested_at) > {NOW} - INTERVAL 60 MINUTE, false) THEN 'pass' ELSE 'fail' END AS status,
                  epoch_us({NOW} - max(ingested_at)) / 1e6 / 60.0::DOUBLE AS observed_value, 60.0::DOUBLE AS threshold_value FROM event_fact
                UNION ALL SELECT 'event_fact', 'source_volume', CASE WHEN count(*) >= 10 THEN 'pass' ELSE 'fail' END, count(*)::DOUBLE, 10.0::DOUBLE
                FROM event_fact WHERE processing_date >= CAST({NOW} AS DATE) - 1""",
            "event_fact",
        ),
    ),
    "slo_grades": Query(
        _slo,
        sql(
            f"""SELECT measure, observed_value, CASE measure
                  WHEN 'acceptance_pct' THEN CASE WHEN observed_value < 98 THEN 'critical' WHEN observed_value < 99 THEN 'warn' ELSE 'ok' END
                  WHEN 'quarantine_rate' THEN CASE WHEN observed_value >= 0.02 THEN 'critical' WHEN observed_value >= 0.005 THEN 'warn' ELSE 'ok' END
                  WHEN 'event_age_seconds' THEN CASE WHEN observed_value > 300 THEN 'critical' WHEN observed_value >= 60 THEN 'warn' ELSE 'ok' END
                  ELSE CASE WHEN observed_value > 120 THEN 'critical' WHEN observed_value >= 30 THEN 'warn' ELSE 'ok' END END AS grade
                FROM (SELECT 'event_age_seconds' AS measure, greatest(0.0::DOUBLE, epoch_us({NOW} - max(ingested_at)) / 1e6) AS observed_value FROM event_fact
                  UNION ALL SELECT 'p95_lag_seconds', max(p) FROM (SELECT CAST(round(CAST(percentile_cont(0.95) WITHIN GROUP (ORDER BY lag_s) AS DECIMAL(38,10)), 3) AS DOUBLE) AS p
                      FROM event_fact GROUP BY date_trunc('minute', ingested_at), event_type, country_code)
                  UNION ALL SELECT 'acceptance_pct', CAST(round(CAST(a::DOUBLE / (r - d) AS DECIMAL(38,10)), 6) AS DOUBLE) * 100 FROM counted
                  UNION ALL SELECT 'quarantine_rate', q::DOUBLE / r FROM counted)""",
            "event_fact", "records", "customers", "applications", "decisions", "repayments",
        ).replace(
            "\nSELECT measure",
            f""",\ncounted AS (SELECT sum(copies) + {_VALID_LOAN_MESSAGES} AS r, count(*) FILTER (WHERE outcome = 'accepted') + {_VALID_LOAN_MESSAGES} AS a,
                 sum(copies - 1) AS d, count(*) FILTER (WHERE outcome = 'quarantined') AS q FROM records)\nSELECT measure""",
        ),
    ),
    "row_reconciliation": Query(
        lambda spark, sf: K.reconcile(R.gate_counts(_gated(spark, sf, *R.COUNTED))),
        _results(("event_fact", "row_reconciliation", "SELECT 0", 0)),
    ),
    "domain_coherence": Query(
        _coherence,
        sql(
            _results(
                ("customers", "activity_needs_registration", "SELECT count(*) FROM first_activity WHERE customer_id NOT IN (SELECT customer_id FROM customers)", 0),
                ("customers", "activity_after_registration", "SELECT count(*) FROM first_activity JOIN customers USING (customer_id) WHERE t < registered_at", 0),
                ("loan_applications", "decision_needs_application", "SELECT count(DISTINCT application_id) FROM decisions WHERE application_id NOT IN (SELECT application_id FROM applications)", 0),
                ("loan_applications", "decision_after_application", "SELECT count(DISTINCT d.application_id) FROM decisions d JOIN applications USING (application_id) WHERE decided_at < applied_at", 0),
                ("loan_applications", "repayment_needs_approval", "SELECT count(DISTINCT application_id) FROM repayments WHERE application_id NOT IN (SELECT application_id FROM decisions WHERE decision = 'approved')", 0),
                ("loan_applications", "repayment_after_approval", "SELECT count(*) FROM (SELECT application_id, min(paid_at) AS p FROM repayments GROUP BY 1) JOIN (SELECT application_id, min(decided_at) AS a FROM decisions WHERE decision = 'approved' GROUP BY 1) USING (application_id) WHERE p < a", 0),
            ),
            "customers", "gsm", "money", "applications", "decisions", "repayments",
        ).replace(
            "\nSELECT 'customers' AS dataset_name",
            """,\nfirst_activity AS (SELECT customer_id, min(t) AS t FROM (SELECT customer_id, occurred_at AS t FROM gsm UNION ALL SELECT customer_id, occurred_at FROM money
               UNION ALL SELECT customer_id, applied_at FROM applications UNION ALL SELECT customer_id, decided_at FROM decisions
               UNION ALL SELECT customer_id, paid_at FROM repayments) WHERE customer_id IS NOT NULL GROUP BY 1)\nSELECT 'customers' AS dataset_name""",
            1,
        ),
    ),
}
