"""Business marts. Every function maps staged tables to a DataFrame.

Joins run on keys that are unique on both sides, because each side is aggregated to one
row per key first; those aggregates combine on the map side, so a key with a large share
of the rows never gathers them in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendmill.functions import country_name, instant, percentage, risk_band, round_half_up

PAR7_DAYS = 7
PAR30_DAYS = 30


def latest_decision(decisions: DataFrame) -> DataFrame:
    """Latest decision of each application; the larger event id wins a tie.

    The rank filter is applied before the shuffle as well (window group limit)."""
    newest = W.partitionBy("application_id").orderBy(F.desc("decided_at"), F.desc("event_id"))
    ranked = decisions.withColumn("__rank", F.row_number().over(newest))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def repayment_performance(repayments: DataFrame) -> DataFrame:
    """Repayment history of each application."""
    return repayments.groupBy("application_id").agg(
        F.max("loan_id").alias("loan_id"),
        F.sum("amount").alias("total_repaid"),
        F.count(F.lit(1)).alias("repayment_count"),
        F.max("days_past_due").alias("max_days_past_due"),
        F.bool_or(F.col("days_past_due") > PAR7_DAYS).alias("ever_par7"),
        F.bool_or(F.col("days_past_due") > PAR30_DAYS).alias("ever_par30"),
        F.bool_or(F.col("payment_status") == "settled").alias("is_settled"),
        F.max("paid_at").alias("last_paid_at"),
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def _or_false(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False)).alias(name)


def credit_portfolio(applications: DataFrame, decisions: DataFrame, repayments: DataFrame) -> DataFrame:
    """One row per application with its latest decision and repayment performance."""
    decided = latest_decision(decisions).drop("event_id", "customer_id", "country_code")
    repaid = repayment_performance(repayments)
    joined = applications.join(decided, "application_id", "left").join(repaid, "application_id", "left")
    return joined.select(
        "application_id", "customer_id", "applied_at", "country_code", "requested_amount",
        "currency", "term_days", "product_code", "stated_purpose",
        "decided_at", "decision", "score", "approved_amount", "interest_rate", "reason_code", "model_version",
        "loan_id",
        _or_zero("total_repaid"), _or_zero("repayment_count"), _or_zero("max_days_past_due"),
        _or_false("ever_par7"), _or_false("ever_par30"), _or_false("is_settled"),
        "last_paid_at",
    )


def application_portfolio(portfolio: DataFrame) -> DataFrame:
    """Portable form of the portfolio fact: 19 columns, flags as 0 and 1."""
    return portfolio.select(
        "application_id", "customer_id", "applied_at", "country_code", "requested_amount",
        "currency", "term_days", "product_code", "stated_purpose",
        "decision", "score", "approved_amount", "interest_rate", "reason_code", "model_version",
        "total_repaid", "max_days_past_due",
        F.col("ever_par30").cast("int").alias("ever_par30"),
        F.col("is_settled").cast("int").alias("is_settled"),
    )


# --- customer features -------------------------------------------------------------


def _gsm_by_customer(gsm: DataFrame) -> DataFrame:
    return gsm.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("gsm_observation_count"),
        F.avg("call_duration_seconds").alias("avg_call_duration_seconds"),
        F.avg("unique_contacts").alias("avg_unique_contacts"),
        F.sum("airtime_topup_amount").alias("airtime_topup_value"),
        F.max("network_tenure_days").alias("network_tenure_days"),
    )


def _money_by_customer(money: DataFrame, distinct_counts: bool = True) -> DataFrame:
    measures = [
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("transaction_value_local"),
    ]
    if distinct_counts:
        measures += [
            F.count_distinct(F.to_date("occurred_at")).alias("active_transaction_days"),
            F.count_distinct("channel").alias("channel_diversity"),
        ]
    return money.groupBy("customer_id").agg(*measures)


def _credit_by_customer(portfolio: DataFrame) -> DataFrame:
    return portfolio.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("application_count"),
        F.avg("score").alias("average_score"),
        F.max("max_days_past_due").alias("max_days_past_due"),
        F.bool_or("ever_par30").alias("ever_par30"),
    )


def customer_features(customers: DataFrame, gsm: DataFrame, money: DataFrame, portfolio: DataFrame, as_of) -> DataFrame:
    """One row per registered customer: phone, money and credit behaviour."""
    joined = (
        customers.join(_gsm_by_customer(gsm), "customer_id", "left")
        .join(_money_by_customer(money), "customer_id", "left")
        .join(_credit_by_customer(portfolio), "customer_id", "left")
    )
    return joined.select(
        "customer_id", "country_code", "registered_at", "age_band", "income_band", "occupation",
        _or_zero("gsm_observation_count"), _or_zero("avg_call_duration_seconds"),
        _or_zero("avg_unique_contacts"), _or_zero("airtime_topup_value"), _or_zero("network_tenure_days"),
        _or_zero("transaction_count"), _or_zero("transaction_value_local"),
        _or_zero("active_transaction_days"), _or_zero("channel_diversity"),
        _or_zero("application_count"), "average_score", _or_zero("max_days_past_due"),
        _or_false("ever_par30"),
        instant(as_of).alias("feature_computed_at"),
    )


def customer_features_portable(customers: DataFrame, gsm: DataFrame, money: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Portable form: 12 columns, rounded."""
    joined = (
        customers.join(_gsm_by_customer(gsm), "customer_id", "left")
        .join(_money_by_customer(money, distinct_counts=False), "customer_id", "left")
        .join(_credit_by_customer(portfolio), "customer_id", "left")
    )
    return joined.select(
        "customer_id", "country_code", "income_band", "occupation",
        F.coalesce("gsm_observation_count", F.lit(0)).alias("gsm_observations"),
        round_half_up(F.coalesce("avg_unique_contacts", F.lit(0.0)), 2).alias("avg_unique_contacts"),
        round_half_up(F.coalesce("airtime_topup_value", F.lit(0)), 2).alias("total_airtime_topup"),
        _or_zero("transaction_count"),
        round_half_up(F.coalesce("transaction_value_local", F.lit(0)), 2).alias("transaction_value"),
        _or_zero("application_count"),
        round_half_up("average_score", 1).alias("avg_credit_score"),
        _or_zero("max_days_past_due"),
    )


# --- portfolio aggregates ----------------------------------------------------------


def _approvals() -> Column:
    return F.count_if(F.col("decision") == "approved")


def _approval_pct() -> Column:
    return percentage(_approvals(), F.count("decision"))


def _par30_pct() -> Column:
    return percentage(F.count_if("ever_par30"), F.count("loan_id"))


def country_performance(portfolio: DataFrame) -> DataFrame:
    """Published country mart."""
    return portfolio.groupBy("country_code").agg(
        F.count(F.lit(1)).alias("applications"),
        F.count_distinct("customer_id").alias("applicants"),
        _approvals().alias("approvals"),
        round_half_up(_approval_pct(), 2).alias("approval_rate_pct"),
        F.sum("approved_amount").alias("approved_value_local"),
        F.avg("score").alias("average_score"),
        round_half_up(_par30_pct(), 2).alias("par30_pct"),
        F.count_if("is_settled").alias("settled_loans"),
    )


def country_performance_live(portfolio: DataFrame) -> DataFrame:
    """Country view of the serving layer: value defaults to 0, score rounded."""
    return portfolio.groupBy("country_code").agg(
        F.count_distinct("customer_id").alias("applicants"),
        F.count(F.lit(1)).alias("applications"),
        _approvals().alias("approvals"),
        round_half_up(_approval_pct(), 2).alias("approval_rate_pct"),
        F.coalesce(F.sum("approved_amount"), F.lit(0)).alias("approved_value_local"),
        round_half_up(F.avg("score"), 1).alias("average_credit_score"),
        round_half_up(_par30_pct(), 2).alias("par30_pct"),
    )


def country_performance_portable(portfolio: DataFrame) -> DataFrame:
    """Portable country view: PAR30 as the mean flag over loans that repaid anything."""
    repaid = F.when(F.col("total_repaid") > 0, F.col("ever_par30").cast("int"))
    return portfolio.groupBy("country_code").agg(
        F.count_distinct("customer_id").alias("applicants"),
        F.count(F.lit(1)).alias("applications"),
        F.sum(F.when(F.col("decision") == "approved", 1).otherwise(0)).alias("approvals"),
        round_half_up(_approval_pct(), 2).alias("approval_rate_pct"),
        round_half_up(F.coalesce(F.sum("approved_amount"), F.lit(0)), 2).alias("approved_value_local"),
        round_half_up(F.avg("score"), 1).alias("average_credit_score"),
        round_half_up(F.avg(repaid) * 100.0, 2).alias("par30_pct"),
    )


def growth_risk_frontier(portfolio: DataFrame) -> DataFrame:
    """Country points: approval rate against PAR30, with volume and display name."""
    return country_performance_live(portfolio).select(
        "country_code",
        country_name("country_code").alias("market"),
        "applications", "applicants", "approvals", "approval_rate_pct", "average_credit_score", "par30_pct",
    )


def realtime_kpis(portfolio: DataFrame) -> DataFrame:
    """Ten portfolio measures in one row; also on empty input."""
    return portfolio.agg(
        F.count_distinct("customer_id").alias("applicants"),
        F.count(F.lit(1)).alias("applications"),
        F.count("decision").alias("decisions"),
        _approvals().alias("approvals"),
        F.count("loan_id").alias("loans_with_repayment"),
        round_half_up(_approval_pct(), 2).alias("approval_rate_pct"),
        F.coalesce(F.sum("approved_amount"), F.lit(0)).alias("approved_value_local"),
        round_half_up(F.avg("score"), 1).alias("average_score"),
        round_half_up(_par30_pct(), 2).alias("par30_pct"),
        F.max("applied_at").alias("latest_application_at"),
    )


def side_by_side(*single_rows: DataFrame) -> DataFrame:
    """Merge one-row frames into one row, without a cross join."""
    stacked = single_rows[0]
    for other in single_rows[1:]:
        stacked = stacked.unionByName(other, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def credit_funnel(portfolio: DataFrame, repayments: DataFrame) -> DataFrame:
    """Application to settlement. Counts on repayments include orphans of the portfolio;
    the last one counts payments, not loans."""
    paid = repayments.groupBy("application_id").agg(
        F.count_if(F.col("payment_status") == "settled").alias("settled")
    )
    return side_by_side(
        portfolio.agg(
            F.count(F.lit(1)).alias("applications"),
            F.count("decision").alias("decisions"),
            _approvals().alias("approvals"),
        ),
        paid.agg(
            F.count("application_id").alias("loans_with_repayment"),
            F.coalesce(F.sum("settled"), F.lit(0)).alias("settled_payments"),
        ),
    )


def model_monitoring_daily(portfolio: DataFrame) -> DataFrame:
    """Score distribution and outcome of latest decisions by day, country and model.

    Scores are integers in 0..1000, so the exact median keeps at most 1001 counts."""
    decided = portfolio.filter(F.col("decided_at").isNotNull())
    return decided.groupBy(
        F.to_date("decided_at").alias("decision_date"), "country_code", "model_version"
    ).agg(
        F.count(F.lit(1)).alias("decisions"),
        F.avg("score").alias("average_score"),
        F.stddev_pop("score").alias("score_stddev"),
        F.percentile("score", 0.5).alias("median_score"),
        percentage(_approvals(), F.count(F.lit(1))).alias("approval_rate_pct"),
        _par30_pct().alias("observed_par30_pct"),
    )


def model_monitoring_hourly(decisions: DataFrame) -> DataFrame:
    """All decisions by hour and model."""
    return (
        decisions.groupBy(F.date_trunc("hour", "decided_at").alias("period"), "model_version")
        .agg(
            F.count(F.lit(1)).alias("decisions"),
            round_half_up(F.avg("score"), 1).alias("average_score"),
            round_half_up(F.stddev_pop("score"), 2).alias("score_stddev"),
            round_half_up(percentage(_approvals(), F.count(F.lit(1))), 2).alias("approval_rate_pct"),
        )
        .orderBy("period", "model_version")
    )


def risk_distribution(decisions: DataFrame) -> DataFrame:
    """All decisions by risk band, riskiest first."""
    return (
        decisions.groupBy(risk_band("score").alias("risk_band"))
        .agg(
            F.count(F.lit(1)).alias("decisions"),
            round_half_up(F.avg("score"), 1).alias("average_score"),
            round_half_up(percentage(_approvals(), F.count(F.lit(1))), 2).alias("approval_rate_pct"),
            F.min("score").alias("__lowest"),
        )
        .orderBy("__lowest")
        .drop("__lowest")
    )


def business_summary(
    customers: DataFrame, portfolio: DataFrame, money: DataFrame, repayments: DataFrame
) -> DataFrame:
    """Business figures of one run, in one row."""
    repaid = F.col("total_repaid") > 0
    credit = portfolio.agg(
        F.count_distinct("customer_id").alias("applicants"),
        F.count(F.lit(1)).alias("applications"),
        F.count("decision").alias("decisions"),
        _approvals().alias("approvals"),
        F.count_if(repaid).alias("loans_with_repayment"),
        F.coalesce(round_half_up(_approval_pct(), 2), F.lit(0.0)).alias("approval_rate_pct"),
        F.coalesce(
            round_half_up(F.avg(F.when(repaid, F.col("ever_par30").cast("int"))) * 100.0, 2), F.lit(0.0)
        ).alias("par30_pct"),
    )
    return side_by_side(
        customers.agg(F.count(F.lit(1)).alias("customers")),
        credit,
        money.agg(F.count(F.lit(1)).alias("transactions")),
        repayments.agg(F.count(F.lit(1)).alias("repayments")),
    )
