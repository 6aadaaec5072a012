"""Gated publication of the marts.

Gates, then build, then data tests, then audit. A run writes its marts to folders of
its own; the success row in the audit table is what makes them visible, and its time of
completion, by the clock, orders publications. A failure at any step leaves the previous
publication in place. The id of a run that was published is refused, so no folder that a
plan reads is ever overwritten; a run that failed may be repeated under its id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.operators import checks as K
from lendmill.plans import marts as M
from lendmill.plans.batch import Run, audited, portfolio_of, record_checks, wall_clock
from lendmill.sources import lake as L

PUBLICATION = "daily_portfolio"


class GateFailed(RuntimeError):
    """A gate or data test did not pass; nothing was published."""


class AlreadyPublished(RuntimeError):
    """The run id names a publication that readers may have open."""


def _mart_path(lake: L.Lake, name: str, run_id: str) -> str:
    return f"{lake.mart(name)}/run_id={run_id}"


def _require(spark: SparkSession, results: DataFrame, lake: L.Lake, run_id: str, as_of, run: Run) -> None:
    """Record results and stop the run unless all pass (a handful of rows)."""
    rows = results.collect()
    frame = spark.createDataFrame(rows, results.schema)
    record_checks(frame, lake, run_id, as_of)
    failed = [f"{r['dataset_name']}.{r['rule_name']}={r['observed_value']}" for r in rows if r["status"] == "fail"]
    if failed:
        run.metadata["failed"] = failed
        raise GateFailed("; ".join(failed))


def publish(
    spark: SparkSession,
    lake: L.Lake,
    events: DataFrame,
    tables: dict[str, DataFrame],
    as_of,
    run_id: str,
    statistics: bool = False,
    clock: Callable[[], str] = wall_clock,
) -> None:
    """Build, test and publish the marts from staged ``tables`` and the event fact."""
    if _publications(spark, lake).filter(F.col("run_id") == run_id).limit(1).count():
        raise AlreadyPublished(run_id)
    with audited(spark, lake, run_id, PUBLICATION, clock) as run:
        _publish(spark, lake, events, tables, as_of, run_id, run)
    if statistics:
        for name in ("fct_credit_portfolio", "dim_customer_features"):
            analyze(spark, f"{name}_{run_id.replace('-', '_')}", _mart_path(lake, name, run_id))


def _publish(spark: SparkSession, lake: L.Lake, events: DataFrame, tables: dict[str, DataFrame], as_of, run_id: str, run: Run) -> None:
    _require(spark, K.stack([K.freshness_gate(events, as_of), K.volume_gate(events, as_of)]), lake, run_id, as_of, run)

    def materialise(name: str, df: DataFrame) -> DataFrame:
        path = _mart_path(lake, name, run_id)
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    portfolio = materialise("fct_credit_portfolio", portfolio_of(tables))
    features = materialise(
        "dim_customer_features",
        M.customer_features(
            tables["customers"], tables["gsm_usage"], tables["mobile_money_transactions"], portfolio, as_of
        ),
    )
    countries = materialise("mart_country_performance", M.country_performance(portfolio))
    materialise("mart_model_monitoring", M.model_monitoring_daily(portfolio))

    tests = K.stack(
        [
            K.portfolio_tests(portfolio, tables["customers"]),
            K.features_tests(features),
            K.country_tests(countries),
        ]
    )
    _require(spark, tests, lake, run_id, as_of, run)
    run.metadata.update(checks=["streaming_freshness", "source_volume", "data_tests"], status="passed", as_of=str(as_of))


def _publications(spark: SparkSession, lake: L.Lake) -> DataFrame:
    runs = L.read_table(spark, lake.runs, L.RUN_SCHEMA)
    return runs.filter((F.col("pipeline_name") == PUBLICATION) & (F.col("status") == "success"))


def published_run(spark: SparkSession, lake: L.Lake) -> str | None:
    """Id of the publication that was completed last."""
    newest = _publications(spark, lake).orderBy(F.desc("completed_at"), F.desc("started_at"), F.desc("run_id")).select("run_id").first()
    return newest[0] if newest else None


def published(spark: SparkSession, lake: L.Lake, mart: str) -> DataFrame:
    """The mart as of the newest successful publication."""
    run_id = published_run(spark, lake)
    if run_id is None:
        raise GateFailed("nothing has been published yet")
    return spark.read.parquet(_mart_path(lake, mart, run_id))


def analyze(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Register a parquet folder as a table, compute its statistics, and return them."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.filter(F.col("col_name") == "Statistics").select("data_type")
