"""Data tests, gates and grades. Each yields rows of one result shape:

dataset_name, rule_name, status (pass / warn / fail), observed_value, threshold_value.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill import contract as C
from lendmill.functions import instant, lag_seconds, minutes_before

# --- fixed values: thresholds ------------------------------------------------------
SOURCE_WARN_MINUTES, SOURCE_ERROR_MINUTES = 15, 60
FRESHNESS_GATE_MINUTES = 60
VOLUME_GATE_ROWS = 10
SLO_LIMITS = {  # warn above (below for acceptance), critical above (below)
    "event_age_seconds": (60.0, 300.0),
    "acceptance_pct": (99.0, 98.0),
    "p95_lag_seconds": (30.0, 120.0),
    "quarantine_rate": (0.005, 0.02),
}
# ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class RowCheck:
    """A predicate that marks failing rows."""

    rule: str
    failing: Column


def _limited(failing: Column, where: Column | None) -> Column:
    return failing if where is None else where & failing


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null_{column}", F.col(column).isNull())


def accepted_values(column: str, values: Sequence, where: Column | None = None) -> RowCheck:
    """Nulls pass."""
    return RowCheck(f"accepted_values_{column}", _limited(~F.col(column).isin(*values), where))


def accepted_range(column: str, low, high, where: Column | None = None) -> RowCheck:
    outside = (F.col(column) < low) | (F.col(column) > high)
    return RowCheck(f"accepted_range_{column}", _limited(outside, where))


def _as_results(counted: DataFrame, dataset: str, observed: dict[str, str], threshold: float = 0.0) -> DataFrame:
    """Turn one row of counts into one result row per rule."""
    pairs = ", ".join(f"'{rule}', cast(`{column}` AS double)" for rule, column in observed.items())
    rows = counted.select(F.expr(f"stack({len(observed)}, {pairs}) AS (rule_name, observed_value)"))
    return rows.select(
        F.lit(dataset).alias("dataset_name"),
        "rule_name",
        F.when(F.col("observed_value") <= threshold, "pass").otherwise("fail").alias("status"),
        "observed_value",
        F.lit(threshold).alias("threshold_value"),
    )


def row_checks(dataset: str, df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """All row predicates of a dataset in one pass; observed value is failing rows."""
    counted = df.agg(*[F.count_if(c.failing).alias(c.rule) for c in checks])
    return _as_results(counted, dataset, {c.rule: c.rule for c in checks})


def unique(dataset: str, df: DataFrame, key: str) -> DataFrame:
    """Observed value: keys that occur more than once (nulls are left to not_null)."""
    copies = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rule = f"unique_{key}"
    return _as_results(copies.agg(F.count_if(F.col("n") > 1).alias(rule)), dataset, {rule: rule})


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them. The child is reduced to
    its distinct keys first, so a frequent key joins as one row."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return keys.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def relationships(dataset: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Observed value: child rows whose key the parent lacks."""
    rule = f"relationships_{key}"
    missing = orphans(child, key, parent, parent_key).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias(rule))
    return _as_results(missing, dataset, {rule: rule})


def one_currency_per_country(dataset: str, df: DataFrame) -> DataFrame:
    """Country sums of money are only valid with one currency each."""
    per_country = df.groupBy("country_code").agg(F.count_distinct("currency").alias("n"))
    rule = "one_currency_per_country"
    return _as_results(per_country.agg(F.count_if(F.col("n") > 1).alias(rule)), dataset, {rule: rule})


def stack(results: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def portfolio_tests(portfolio: DataFrame, customers: DataFrame) -> DataFrame:
    name = "fct_credit_portfolio"
    return stack(
        [
            unique(name, portfolio, "application_id"),
            row_checks(
                name,
                portfolio,
                [
                    not_null("application_id"),
                    not_null("customer_id"),
                    accepted_values("decision", C.DECISIONS, F.col("decision").isNotNull()),
                    accepted_range("score", 0, 1000, F.col("score").isNotNull()),
                ],
            ),
            relationships(name, portfolio, "customer_id", customers, "customer_id"),
            one_currency_per_country(name, portfolio),
        ]
    )


def features_tests(features: DataFrame) -> DataFrame:
    name = "dim_customer_features"
    return stack(
        [
            unique(name, features, "customer_id"),
            row_checks(name, features, [not_null("customer_id"), accepted_values("country_code", C.COUNTRIES)]),
        ]
    )


def country_tests(countries: DataFrame) -> DataFrame:
    name = "mart_country_performance"
    return stack(
        [unique(name, countries, "country_code"), row_checks(name, countries, [not_null("country_code")])]
    )


# --- gates -------------------------------------------------------------------------


def source_freshness(dataset: str, df: DataFrame, as_of, time_column: str = "occurred_at") -> DataFrame:
    """Age of the newest row in minutes: warn beyond 15, fail beyond 60 or if empty."""
    age = lag_seconds(instant(as_of), F.max(time_column)) / 60.0
    return df.agg(age.alias("observed_value")).select(
        F.lit(dataset).alias("dataset_name"),
        F.lit(f"freshness_{time_column}").alias("rule_name"),
        F.when(F.col("observed_value").isNull() | (F.col("observed_value") > SOURCE_ERROR_MINUTES), "fail")
        .when(F.col("observed_value") > SOURCE_WARN_MINUTES, "warn")
        .otherwise("pass")
        .alias("status"),
        "observed_value",
        F.lit(float(SOURCE_ERROR_MINUTES)).alias("threshold_value"),
    )


def freshness_gate(events: DataFrame, as_of, minutes: int = FRESHNESS_GATE_MINUTES) -> DataFrame:
    """Passes if anything arrived within the last hour; fails on an empty table."""
    newest = F.max("ingested_at")
    fresh = F.coalesce(newest > minutes_before(instant(as_of), minutes), F.lit(False))
    return events.agg(fresh.alias("fresh"), (lag_seconds(instant(as_of), newest) / 60.0).alias("observed_value")).select(
        F.lit("event_fact").alias("dataset_name"),
        F.lit("streaming_freshness").alias("rule_name"),
        F.when(F.col("fresh"), "pass").otherwise("fail").alias("status"),
        "observed_value",
        F.lit(float(minutes)).alias("threshold_value"),
    )


def volume_gate(events: DataFrame, as_of, rows: int = VOLUME_GATE_ROWS) -> DataFrame:
    """Passes if enough events happened since yesterday (a filter on the partition date)."""
    yesterday = F.date_sub(F.to_date(instant(as_of)), 1)
    return events.filter(F.col("processing_date") >= yesterday).agg(
        F.count(F.lit(1)).cast("double").alias("observed_value")
    ).select(
        F.lit("event_fact").alias("dataset_name"),
        F.lit("source_volume").alias("rule_name"),
        F.when(F.col("observed_value") >= rows, "pass").otherwise("fail").alias("status"),
        "observed_value",
        F.lit(float(rows)).alias("threshold_value"),
    )


def grade_slo(measures: DataFrame) -> DataFrame:
    """Grade one row of service measures (columns of ``SLO_LIMITS``): ok, warn, critical."""
    observed = ", ".join(f"'{m}', cast({m} AS double)" for m in SLO_LIMITS)
    rows = measures.select(F.expr(f"stack({len(SLO_LIMITS)}, {observed}) AS (measure, observed_value)"))
    grade = None
    for measure, (warn, critical) in SLO_LIMITS.items():
        value = F.col("observed_value")
        if warn > critical:  # higher is better
            own = F.when(value < critical, "critical").when(value < warn, "warn")
        elif measure == "quarantine_rate":  # coloured from the limit on
            own = F.when(value >= critical, "critical").when(value >= warn, "warn")
        else:
            own = F.when(value > critical, "critical").when(value >= warn, "warn")
        own = F.when(value.isNull(), "unknown").otherwise(own.otherwise("ok"))
        is_measure = F.col("measure") == measure
        grade = F.when(is_measure, own) if grade is None else grade.when(is_measure, own)
    return rows.select("measure", "observed_value", grade.alias("grade"))


def reconcile(counts: DataFrame) -> DataFrame:
    """received = accepted + quarantined + duplicates, on one row of counts."""
    gap = F.col("received") - F.col("accepted") - F.col("quarantined") - F.col("duplicates")
    return _as_results(counts.select(F.abs(gap).alias("gap")), "event_fact", {"row_reconciliation": "gap"})


def coherence(customers: DataFrame, activity: DataFrame, applications: DataFrame, decisions: DataFrame, repayments: DataFrame) -> DataFrame:
    """Referential and temporal order of the domain; observed value is violating keys.

    ``activity`` has customer_id and occurred_at of everything but registrations. Each
    side contributes flags and first times per key, combined by one aggregate per key
    type, so no fact table is joined row by row.
    """
    per_customer = (
        customers.select("customer_id", F.col("registered_at").alias("registered"), F.lit(None).cast("timestamp").alias("active"))
        .unionByName(activity.select("customer_id", F.lit(None).cast("timestamp").alias("registered"), F.col("occurred_at").alias("active")))
        .groupBy("customer_id")
        .agg(F.min("registered").alias("registered"), F.min("active").alias("active"))
        .agg(
            F.count_if(F.col("active").isNotNull() & F.col("registered").isNull()).alias("unregistered"),
            F.count_if(F.col("active") < F.col("registered")).alias("early"),
        )
    )
    none = F.lit(None).cast("timestamp")

    def tagged(df: DataFrame, applied=none, decided=none, approved=none, repaid=none) -> DataFrame:
        return df.select("application_id", applied.alias("applied"), decided.alias("decided"), approved.alias("approved"), repaid.alias("repaid"))

    decided_at = F.col("decided_at")
    per_application = (
        stack(
            [
                tagged(applications, applied=F.col("applied_at")),
                tagged(decisions, decided=decided_at, approved=F.when(F.col("decision") == "approved", decided_at)),
                tagged(repayments, repaid=F.col("paid_at")),
            ]
        )
        .groupBy("application_id")
        .agg(*[F.min(c).alias(c) for c in ("applied", "decided", "approved", "repaid")])
        .agg(
            F.count_if(F.col("decided").isNotNull() & F.col("applied").isNull()).alias("no_application"),
            F.count_if(F.col("decided") < F.col("applied")).alias("early_decision"),
            F.count_if(F.col("repaid").isNotNull() & F.col("approved").isNull()).alias("no_approval"),
            F.count_if(F.col("repaid") < F.col("approved")).alias("early_repayment"),
        )
    )
    return _as_results(
        per_customer, "customers",
        {"activity_needs_registration": "unregistered", "activity_after_registration": "early"},
    ).unionByName(
        _as_results(
            per_application, "loan_applications",
            {
                "decision_needs_application": "no_application",
                "decision_after_application": "early_decision",
                "repayment_needs_approval": "no_approval",
                "repayment_after_approval": "early_repayment",
            },
        )
    )
