"""Quality report of a gated batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.functions import round_half_up
from lendmill.operators.gate import ACCEPTED, QUARANTINED, issue_log, issues

PASS_RATE = 0.99
LISTED_ISSUES = 100


#: What the counts and the issues per rule need of a judged row.
COUNTED = ("outcome", "late")
ISSUES = ("contract_codes", "business_codes")


def report_columns(order_by: Sequence[str]) -> list[Column | str]:
    """What the whole report needs of a judged row: id and place of arrival where it has issues."""
    flagged = (F.col("contract_codes") != "") | (F.col("business_codes") != "")
    return [*COUNTED, "contract_codes", "business_codes", *[F.when(flagged, F.col(c)).alias(c) for c in ("event_id", *order_by)]]


def gate_counts(gated: DataFrame) -> DataFrame:
    """One row: received, accepted, duplicates, quarantined, late_events, acceptance_rate, status."""
    none = F.lit(0).cast("bigint")
    counted = gated.agg(
        F.coalesce(F.sum("copies"), none).alias("received"),
        F.count_if(F.col("outcome") == ACCEPTED).alias("accepted"),
        F.coalesce(F.sum(F.col("copies") - 1), none).alias("duplicates"),
        F.count_if(F.col("outcome") == QUARANTINED).alias("quarantined"),
        F.count_if((F.col("outcome") == ACCEPTED) & F.col("late")).alias("late_events"),
    )
    eligible = F.col("received") - F.col("duplicates")
    rate = F.coalesce(F.try_divide(F.col("accepted").cast("double"), eligible.cast("double")), F.lit(1.0))
    return counted.select(
        "*",
        round_half_up(rate, 6).alias("acceptance_rate"),
        F.when(rate >= PASS_RATE, "pass").otherwise("warn").alias("status"),
    )


def issue_counts(gated: DataFrame) -> DataFrame:
    """Issues per rule."""
    return issues(gated).groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("issues"))


def first_issues(gated: DataFrame, order_by: list[str]) -> DataFrame:
    """The first issues in arrival order, as the report lists them."""
    columns = ["rule", "severity", "message", "event_id"]
    return issue_log(gated).orderBy(*order_by, "rule").limit(LISTED_ISSUES).select(*columns)


def quality_report(gated: DataFrame, order_by: list[str], generated_at) -> DataFrame:
    """One row ready to be written as JSON: counts, issues per rule, the first issues.

    The collected lists are small by definition: one entry per rule, 100 issues."""
    counts = gate_counts(gated).withColumn("part", F.lit(1))
    per_rule = issue_counts(gated).groupBy("rule").agg(F.sum("issues").alias("issues")).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("rule", "issues")))).alias("issue_counts")
    )
    listed = first_issues(gated, order_by).agg(
        F.collect_list(F.struct("rule", "severity", "message", "event_id")).alias("issues")
    )
    return (
        counts.join(per_rule.withColumn("part", F.lit(1)), "part")
        .join(listed.withColumn("part", F.lit(1)), "part")
        .drop("part")
        .withColumn("generated_at", F.lit(generated_at).cast("timestamp"))
    )
