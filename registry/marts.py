"""Marts and staged views over the whole test tables."""

from __future__ import annotations

from lendmill.plans import marts as M
from lendmill.sources import testviews as V

from registry.base import Domain, Query, pct, portable, rounded, sql

D = "CAST({0} AS DOUBLE) AS {0}".format


def _staged(name: str, view: str, columns: str) -> Query:
    money = {"requested_amount", "approved_amount", "interest_rate", "amount", "airtime_topup_amount"}
    listed = ", ".join(D(c) if c in money else c for c in columns.split())
    attribute = {
        "loan_applications": "applications",
        "loan_decisions": "decisions",
        "gsm_usage": "gsm",
        "mobile_money_transactions": "money",
    }.get(name, name)
    return Query(
        lambda spark, sf: portable(getattr(Domain(spark, sf, True), attribute)),
        sql(f"SELECT {listed} FROM {view}", view),
    )


_PORTFOLIO_SQL = """application_id, customer_id, applied_at, country_code,
  CAST(requested_amount AS DOUBLE) AS requested_amount, currency, term_days, product_code, stated_purpose,
  decided_at, decision, score, CAST(approved_amount AS DOUBLE) AS approved_amount,
  CAST(interest_rate AS DOUBLE) AS interest_rate, reason_code, model_version, loan_id,
  CAST(total_repaid AS DOUBLE) AS total_repaid, repayment_count, max_days_past_due, ever_par7, ever_par30,
  is_settled, last_paid_at"""

_GSM = """gsm_f AS (SELECT customer_id, count(*) AS n, avg(call_duration_seconds) AS calls, avg(unique_contacts) AS contacts,
  sum(airtime_topup_amount) AS topup, max(network_tenure_days) AS tenure FROM gsm GROUP BY 1)"""
_MONEY = """money_f AS (SELECT customer_id, count(*) AS n, sum(amount) AS total,
  count(DISTINCT CAST(occurred_at AS DATE)) AS days, count(DISTINCT channel) AS channels FROM money GROUP BY 1)"""
_CREDIT = """credit_f AS (SELECT customer_id, count(*) AS n, avg(score) AS score, max(max_days_past_due) AS dpd,
  bool_or(ever_par30) AS par30 FROM portfolio GROUP BY 1)"""
_FEATURES = sql(f"{{select}} FROM customers c LEFT JOIN gsm_f g USING (customer_id) LEFT JOIN money_f m USING (customer_id) LEFT JOIN credit_f cr USING (customer_id)", "customers", "gsm", "money", "portfolio").replace(
    "\n{select}", f",\n{_GSM},\n{_MONEY},\n{_CREDIT}\n{{select}}"
)

_APPROVED = "count(*) FILTER (WHERE decision = 'approved')"
_PAR30 = "count(*) FILTER (WHERE ever_par30)"

_LATEST_COLUMNS = "event_id application_id customer_id decided_at country_code decision score approved_amount interest_rate reason_code model_version"

QUERIES: dict[str, Query] = {
    "staged_customers": _staged("customers", "customers", "customer_id country_code registered_at age_band income_band occupation consent_version"),
    "staged_gsm_usage": _staged("gsm_usage", "gsm", "event_id customer_id occurred_at country_code call_duration_seconds sms_count data_mb unique_contacts airtime_topup_amount network_tenure_days"),
    "staged_mobile_money": _staged("mobile_money_transactions", "money", "event_id customer_id occurred_at country_code transaction_type amount currency channel"),
    "staged_loan_applications": _staged("loan_applications", "applications", "application_id event_id customer_id applied_at country_code requested_amount currency term_days product_code stated_purpose"),
    "staged_loan_decisions": _staged("loan_decisions", "decisions", _LATEST_COLUMNS),
    "staged_repayments": _staged("repayments", "repayments", "event_id loan_id application_id customer_id paid_at country_code amount currency days_past_due payment_status"),
    "latest_decision": Query(
        lambda spark, sf: portable(M.latest_decision(Domain(spark, sf, True).decisions)),
        sql(
            "SELECT event_id, application_id, customer_id, decided_at, country_code, decision, score, "
            f"{D('approved_amount')}, {D('interest_rate')}, reason_code, model_version FROM latest",
            "latest",
        ),
    ),
    "latest_decision_brief": Query(
        lambda spark, sf: portable(
            M.latest_decision(Domain(spark, sf).decisions).select(
                "application_id", "decision", "score", "approved_amount", "model_version"
            )
        ),
        sql(
            f"SELECT DISTINCT ON (application_id) application_id, decision, score, {D('approved_amount')}, model_version "
            "FROM decisions ORDER BY application_id, decided_at DESC, event_id DESC",
            "decisions",
        ),
    ),
    "repayment_performance": Query(
        lambda spark, sf: portable(M.repayment_performance(Domain(spark, sf).repayments)),
        sql(f"SELECT * REPLACE (CAST(total_repaid AS DOUBLE) AS total_repaid) FROM performance", "performance"),
    ),
    "credit_portfolio": Query(
        lambda spark, sf: portable(Domain(spark, sf).portfolio),
        sql(f"SELECT {_PORTFOLIO_SQL} FROM portfolio", "portfolio"),
    ),
    "application_portfolio": Query(
        lambda spark, sf: portable(M.application_portfolio(Domain(spark, sf).portfolio)),
        sql(
            """SELECT application_id, customer_id, applied_at, country_code, CAST(requested_amount AS DOUBLE) AS requested_amount,
                 currency, term_days, product_code, stated_purpose, decision, score, CAST(approved_amount AS DOUBLE) AS approved_amount,
                 CAST(interest_rate AS DOUBLE) AS interest_rate, reason_code, model_version,
                 CAST(coalesce(r.paid, 0) AS DOUBLE) AS total_repaid, coalesce(r.dpd, 0) AS max_days_past_due,
                 coalesce(r.par30, 0) AS ever_par30, coalesce(r.settled, 0) AS is_settled
               FROM applications LEFT JOIN (SELECT * EXCLUDE (event_id, customer_id, country_code) FROM latest) USING (application_id)
               LEFT JOIN (SELECT application_id, sum(amount) AS paid, max(days_past_due) AS dpd,
                   max(CASE WHEN days_past_due > 30 THEN 1 ELSE 0 END) AS par30,
                   max(CASE WHEN payment_status = 'settled' THEN 1 ELSE 0 END) AS settled
                 FROM repayments GROUP BY application_id) r USING (application_id)""",
            "applications", "latest", "repayments",
        ),
    ),
    "customer_features": Query(
        lambda spark, sf: portable(
            M.customer_features(
                (d := Domain(spark, sf)).customers, d.gsm, d.money, d.portfolio, V.AS_OF
            )
        ),
        _FEATURES.replace(
            "{select}",
            f"""SELECT c.customer_id, c.country_code, registered_at, age_band, income_band, occupation,
              coalesce(g.n, 0) AS gsm_observation_count, coalesce(g.calls, 0) AS avg_call_duration_seconds,
              coalesce(g.contacts, 0) AS avg_unique_contacts, CAST(coalesce(g.topup, 0) AS DOUBLE) AS airtime_topup_value,
              coalesce(g.tenure, 0) AS network_tenure_days, coalesce(m.n, 0) AS transaction_count,
              CAST(coalesce(m.total, 0) AS DOUBLE) AS transaction_value_local, coalesce(m.days, 0) AS active_transaction_days,
              coalesce(m.channels, 0) AS channel_diversity, coalesce(cr.n, 0) AS application_count, cr.score AS average_score,
              coalesce(cr.dpd, 0) AS max_days_past_due, coalesce(cr.par30, false) AS ever_par30,
              TIMESTAMP '{V.AS_OF}' AS feature_computed_at""",
        ),
    ),
    "customer_features_portable": Query(
        lambda spark, sf: portable(
            M.customer_features_portable((d := Domain(spark, sf)).customers, d.gsm, d.money, d.portfolio)
        ),
        _FEATURES.replace(
            "{select}",
            f"""SELECT c.customer_id, c.country_code, income_band, occupation, coalesce(g.n, 0) AS gsm_observations,
              {rounded('coalesce(g.contacts, 0)', 2)} AS avg_unique_contacts, {rounded('coalesce(g.topup, 0)', 2)} AS total_airtime_topup,
              coalesce(m.n, 0) AS transaction_count, {rounded('coalesce(m.total, 0)', 2)} AS transaction_value,
              coalesce(cr.n, 0) AS application_count, {rounded('cr.score', 1)} AS avg_credit_score,
              coalesce(cr.dpd, 0) AS max_days_past_due""",
        ),
    ),
    "country_performance": Query(
        lambda spark, sf: portable(M.country_performance(Domain(spark, sf).portfolio)),
        sql(
            f"""SELECT country_code, count(*) AS applications, count(DISTINCT customer_id) AS applicants, {_APPROVED} AS approvals,
              {pct(_APPROVED, 'count(decision)', 2)} AS approval_rate_pct, CAST(sum(approved_amount) AS DOUBLE) AS approved_value_local,
              avg(score) AS average_score, {pct(_PAR30, 'count(loan_id)', 2)} AS par30_pct,
              count(*) FILTER (WHERE is_settled) AS settled_loans FROM portfolio GROUP BY country_code""",
            "portfolio",
        ),
    ),
    "country_performance_live": Query(
        lambda spark, sf: portable(M.country_performance_live(Domain(spark, sf).portfolio)),
        sql(
            f"""SELECT a.country_code, count(DISTINCT a.customer_id) AS applicants, count(*) AS applications, {_APPROVED} AS approvals,
              {pct(_APPROVED, 'count(d.application_id)', 2)} AS approval_rate_pct,
              CAST(coalesce(sum(approved_amount), 0) AS DOUBLE) AS approved_value_local, {rounded('avg(score)', 1)} AS average_credit_score,
              {pct('count(*) FILTER (WHERE r.dpd > 30)', 'count(r.application_id)', 2)} AS par30_pct
            FROM applications a LEFT JOIN latest d USING (application_id)
            LEFT JOIN (SELECT application_id, max(days_past_due) AS dpd FROM repayments GROUP BY 1) r USING (application_id)
            GROUP BY a.country_code""",
            "applications", "latest", "repayments",
        ),
    ),
    "country_performance_portable": Query(
        lambda spark, sf: portable(M.country_performance_portable(Domain(spark, sf).portfolio)),
        sql(
            f"""SELECT country_code, count(DISTINCT customer_id) AS applicants, count(*) AS applications,
              CAST(sum(CASE WHEN decision = 'approved' THEN 1 ELSE 0 END) AS BIGINT) AS approvals,
              {pct("sum(CASE WHEN decision = 'approved' THEN 1 ELSE 0 END)", 'sum(CASE WHEN decision IS NOT NULL THEN 1 ELSE 0 END)', 2)} AS approval_rate_pct,
              {rounded('coalesce(sum(approved_amount), 0)', 2)} AS approved_value_local, {rounded('avg(score)', 1)} AS average_credit_score,
              {rounded('100.0::DOUBLE * avg(CASE WHEN total_repaid > 0 THEN CAST(ever_par30 AS INTEGER) END)', 2)} AS par30_pct
            FROM portfolio GROUP BY country_code""",
            "portfolio",
        ),
    ),
    "growth_risk_frontier": Query(
        lambda spark, sf: portable(M.growth_risk_frontier(Domain(spark, sf).portfolio)),
        sql(
            f"""SELECT country_code, CASE country_code WHEN 'KEN' THEN 'Kenya' WHEN 'UGA' THEN 'Uganda' WHEN 'GHA' THEN 'Ghana'
                WHEN 'TZA' THEN 'Tanzania' WHEN 'ZMB' THEN 'Zambia' END AS market,
              count(*) AS applications, count(DISTINCT customer_id) AS applicants, {_APPROVED} AS approvals,
              {pct(_APPROVED, 'count(decision)', 2)} AS approval_rate_pct, {rounded('avg(score)', 1)} AS average_credit_score,
              {pct(_PAR30, 'count(loan_id)', 2)} AS par30_pct FROM portfolio GROUP BY country_code""",
            "portfolio",
        ),
    ),
    "realtime_kpis": Query(
        lambda spark, sf: portable(M.realtime_kpis(Domain(spark, sf).portfolio)),
        sql(
            f"""SELECT count(DISTINCT customer_id) AS applicants, count(*) AS applications, count(decided_at) AS decisions,
              {_APPROVED} AS approvals, count(*) FILTER (WHERE loan_id IS NOT NULL) AS loans_with_repayment,
              {pct(_APPROVED, 'count(decided_at)', 2)} AS approval_rate_pct,
              CAST(coalesce(sum(approved_amount), 0) AS DOUBLE) AS approved_value_local, {rounded('avg(score)', 1)} AS average_score,
              {pct(_PAR30, 'count(loan_id)', 2)} AS par30_pct, max(applied_at) AS latest_application_at FROM portfolio""",
            "portfolio",
        ),
    ),
    "credit_funnel": Query(
        lambda spark, sf: portable(M.credit_funnel((d := Domain(spark, sf)).portfolio, d.repayments)),
        sql(
            """SELECT (SELECT count(*) FROM applications) AS applications,
              (SELECT count(*) FROM portfolio WHERE decision IS NOT NULL) AS decisions,
              (SELECT count(*) FROM portfolio WHERE decision = 'approved') AS approvals,
              (SELECT count(DISTINCT application_id) FROM repayments) AS loans_with_repayment,
              (SELECT count(*) FROM repayments WHERE payment_status = 'settled') AS settled_payments""",
            "portfolio", "repayments",
        ),
    ),
    "model_monitoring_daily": Query(
        lambda spark, sf: portable(
            M.model_monitoring_daily(Domain(spark, sf).portfolio).withColumn(
                "score_stddev", M.round_half_up("score_stddev", 6)
            )
        ),
        sql(
            f"""SELECT CAST(decided_at AS DATE) AS decision_date, country_code, model_version, count(*) AS decisions,
              avg(score) AS average_score, {rounded('stddev_pop(score)', 6)} AS score_stddev,
              percentile_cont(0.5) WITHIN GROUP (ORDER BY score) AS median_score,
              {pct(_APPROVED, 'count(*)')} AS approval_rate_pct, {pct(_PAR30, 'count(loan_id)')} AS observed_par30_pct
            FROM portfolio WHERE decided_at IS NOT NULL GROUP BY 1, 2, 3""",
            "portfolio",
        ),
    ),
    "model_monitoring_hourly": Query(
        lambda spark, sf: portable(M.model_monitoring_hourly(Domain(spark, sf).decisions)),
        sql(
            f"""SELECT date_trunc('hour', decided_at) AS period, model_version, count(*) AS decisions,
              {rounded('avg(score)', 1)} AS average_score, {rounded('stddev_pop(score)', 2)} AS score_stddev,
              {pct(_APPROVED, 'count(*)', 2)} AS approval_rate_pct FROM decisions GROUP BY 1, 2""",
            "decisions",
        ),
    ),
    "risk_distribution": Query(
        lambda spark, sf: portable(M.risk_distribution(Domain(spark, sf).decisions)),
        sql(
            f"""SELECT CASE WHEN score < 450 THEN 'very_high' WHEN score < 550 THEN 'high' WHEN score < 650 THEN 'medium'
                WHEN score < 750 THEN 'low' ELSE 'very_low' END AS risk_band, count(*) AS decisions,
              {rounded('avg(score)', 1)} AS average_score, {pct(_APPROVED, 'count(*)', 2)} AS approval_rate_pct
            FROM decisions GROUP BY 1""",
            "decisions",
        ),
    ),
    "business_summary": Query(
        lambda spark, sf: portable(
            M.business_summary((d := Domain(spark, sf)).customers, d.portfolio, d.money, d.repayments)
        ),
        sql(
            f"""SELECT (SELECT count(*) FROM customers) AS customers, count(DISTINCT customer_id) AS applicants, count(*) AS applications,
              count(decision) AS decisions, {_APPROVED} AS approvals, count(*) FILTER (WHERE total_repaid > 0) AS loans_with_repayment,
              coalesce({pct(_APPROVED, 'count(decision)', 2)}, 0) AS approval_rate_pct, (SELECT count(*) FROM money) AS transactions,
              (SELECT count(*) FROM repayments) AS repayments,
              coalesce({rounded('100.0::DOUBLE * avg(CAST(ever_par30 AS INTEGER)) FILTER (WHERE total_repaid > 0)', 2)}, 0) AS par30_pct
            FROM portfolio""",
            "customers", "portfolio", "money", "repayments",
        ),
    ),
}
