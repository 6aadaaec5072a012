"""One batch run: raw records to layers, typed tables, issues, audit row and reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill import contract as C
from lendmill.functions import instant
from lendmill.operators import gate as G
from lendmill.operators import report as R
from lendmill.plans import marts as M
from lendmill.plans.staging import stage
from lendmill.session import dropping_shuffles
from lendmill.sinks import layers as S
from lendmill.sinks.commits import Folder
from lendmill.sinks.ledger import append_bronze, load_judged
from lendmill.sources import lake as L


def record_run(
    spark: SparkSession,
    lake: L.Lake,
    run_id: str,
    pipeline_name: str,
    started_at,
    completed_at,
    status: str,
    counts: DataFrame | None = None,
    metadata: dict | None = None,
) -> None:
    """Write the audit row of a run, in place of its earlier ones. ``counts`` is one row with
    received, accepted, quarantined. The new row is there before the others go; of two rows of
    one run that a crash leaves, ``latest_run`` and ``published_run`` take the finished one."""
    if counts is None:
        counts = spark.range(1).select(
            *[F.lit(None).cast("bigint").alias(c) for c in ("received", "accepted", "quarantined")]
        )
    row = counts.select(
        F.lit(run_id).alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        instant(started_at).alias("started_at"),
        instant(completed_at).alias("completed_at"),
        F.lit(status).alias("status"),
        F.col("received").alias("input_rows"),
        F.col("accepted").alias("output_rows"),
        F.col("quarantined").alias("quarantined_rows"),
        F.lit(json.dumps(metadata or {}, sort_keys=True)).alias("metadata"),
    )
    S.replace(row.coalesce(1), lake.runs, ["pipeline_name", "run_id", "status"])
    folder = Folder(spark, lake.runs)
    for pipeline in folder.names():
        for run in folder.names(pipeline) if unquote(pipeline) == f"pipeline_name={pipeline_name}" else ():
            for old in folder.names(f"{pipeline}/{run}") if unquote(run) == f"run_id={run_id}" else ():
                if old.startswith("status=") and unquote(old) != f"status={status}":
                    folder.delete(f"{pipeline}/{run}/{old}")


def wall_clock() -> str:
    return datetime.now(UTC).isoformat()


@dataclass
class Run:
    """What a run reports when it ends."""

    started_at: str
    counts: DataFrame | None = None
    metadata: dict = field(default_factory=dict)


@contextmanager
def audited(spark: SparkSession, lake: L.Lake, run_id: str, pipeline_name: str, clock: Callable[[], str] = wall_clock) -> Iterator[Run]:
    """A run with its audit row: ``running`` from the start, then ``success``, or ``failed`` with
    the error when its body raises. Times are those of the clock. A row that stays ``running``
    is of a driver that was lost."""
    run = Run(clock())
    record_run(spark, lake, run_id, pipeline_name, run.started_at, None, "running")
    try:
        yield run
    except Exception as error:
        metadata = {"error": type(error).__name__, "message": str(error)[:500], **run.metadata}
        record_run(spark, lake, run_id, pipeline_name, run.started_at, clock(), "failed", run.counts, metadata)
        raise
    record_run(spark, lake, run_id, pipeline_name, run.started_at, clock(), "success", run.counts, run.metadata)


def record_checks(results: DataFrame, lake: L.Lake, run_id: str, checked_at) -> None:
    """Write check results of a run, in place of its earlier ones on these data sets."""
    rows = results.select(
        F.lit(run_id).alias("run_id"),
        instant(checked_at).alias("checked_at"),
        "dataset_name", "rule_name", "status", "observed_value", "threshold_value",
        F.lit("{}").alias("details"),
    )
    S.replace(rows.coalesce(1), lake.checks, ["run_id", "dataset_name"])


def record_issues(gated: DataFrame, lake: L.Lake, run_id: str, recorded_at) -> None:
    """Write the issue log of a run, in place of its earlier one."""
    issues = G.issue_log(gated).withColumn("recorded_at", instant(recorded_at)).withColumn("run_id", F.lit(run_id))
    S.replace(issues.select(*L.ISSUE_SCHEMA.names), lake.issues, ["run_id"])


def staged_tables(spark: SparkSession, lake: L.Lake) -> dict[str, DataFrame]:
    return {name: stage(name, L.warehouse_table(spark, lake, name)) for name in C.TYPED_TABLES}


def portfolio_of(tables: dict[str, DataFrame]) -> DataFrame:
    return M.credit_portfolio(tables["loan_applications"], tables["loan_decisions"], tables["repayments"])


def settle(gated: DataFrame, path: str) -> DataFrame:
    """Write a gated batch and read it back. The records are parsed and judged once;
    every consumer then scans only the columns it needs, and nothing upstream has to be
    computed again when executors are lost."""
    gated.write.mode("overwrite").parquet(path)
    return gated.sparkSession.read.schema(gated.schema).parquet(path)


def run_batch(
    spark: SparkSession,
    lake: L.Lake,
    raw: DataFrame,
    as_of,
    run_id: str,
    order_by: Sequence[str] = S.ARRIVAL,
    clock: Callable[[], str] = wall_clock,
) -> DataFrame:
    """Process raw records into the lake; returns the one-row business summary.

    ``raw`` holds raw_value and the ``order_by`` columns. Broker messages go to the
    partitioned bronze and quarantine layers, plain lines to their text forms, in a folder of
    the run. A run that is repeated under its id appends nothing again. The audit row tells
    that a run goes on, ended or failed, with the times of ``clock``.
    """
    with dropping_shuffles(spark), audited(spark, lake, run_id, "batch", clock) as run:
        return _run_batch(spark, lake, raw, as_of, run_id, order_by, run)


def _run_batch(spark: SparkSession, lake: L.Lake, raw: DataFrame, as_of, run_id: str, order_by: Sequence[str], run: Run) -> DataFrame:
    messages = "kafka_offset" in raw.columns
    own = f"run={quote(run_id, safe='')}"
    if messages:
        append_bronze(spark, lake, raw, "batch", run_id)
    else:
        raw.select(F.rtrim("raw_value").alias("value")).write.mode("overwrite").text(f"{lake.bronze}/{own}")

    gated = settle(G.gate(raw, as_of, order_by, S.run_columns(raw)), lake.path("work", run_id, "gated"))
    run.counts = settle(R.gate_counts(gated), lake.path("work", run_id, "counts"))
    load_judged(spark, lake, gated, "batch", run_id, order_by)
    if not messages:
        S.quarantine_lines(gated).write.mode("overwrite").json(f"{lake.quarantine}/{own}")
    record_issues(gated, lake, run_id, as_of)

    R.quality_report(gated, list(order_by), as_of).coalesce(1).write.mode("overwrite").json(
        lake.path("reports", run_id, "quality_report")
    )
    tables = staged_tables(spark, lake)
    portfolio = portfolio_of(tables)
    summary = M.business_summary(
        tables["customers"], portfolio, tables["mobile_money_transactions"], tables["repayments"]
    )
    summary = summary.withColumn("run_id", F.lit(run_id))
    summary.coalesce(1).write.mode("overwrite").json(lake.path("reports", run_id, "business_summary"))
    M.country_performance_portable(portfolio).orderBy("country_code").coalesce(1).write.mode("overwrite").json(
        lake.path("reports", run_id, "country_performance")
    )
    return spark.read.json(lake.path("reports", run_id, "business_summary"))
