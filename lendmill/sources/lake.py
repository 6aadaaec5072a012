"""Lake layout and readers for its layers and tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill import contract as C

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("kafka_key", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("ingestion_date", T.DateType()),
    ]
)
QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("quality_reason", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("kafka_key", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
    ]
)
ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
    ]
)
RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("completed_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("output_rows", T.LongType()),
        T.StructField("quarantined_rows", T.LongType()),
        T.StructField("metadata", T.StringType()),
    ]
)
CHECK_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("checked_at", T.TimestampType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("observed_value", T.DoubleType()),
        T.StructField("threshold_value", T.DoubleType()),
        T.StructField("details", T.StringType()),
    ]
)
METRIC_SCHEMA = T.StructType(
    [
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("quality_reason", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("latest_event_at", T.TimestampType()),
    ]
)

LAG_SCHEMA = T.StructType(
    [
        T.StructField("minute", T.TimestampType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("country_code", T.StringType()),
        T.StructField("lag", T.LongType()),
        T.StructField("records", T.LongType()),
        T.StructField("day", T.DateType()),
        T.StructField("query_name", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Lake:
    """Folders of one lake.

    Silver is partitioned for large daily volumes. A small lake with a long history may
    leave ``processing_date`` out; date-scoped operations then do not apply to it.
    """

    root: str
    silver_partitions: tuple[str, ...] = ("processing_date", "country_code", "event_type")

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self.path("bronze", "events")

    @property
    def silver(self) -> str:
        return self.path("silver", "events")

    @property
    def quarantine(self) -> str:
        return self.path("quarantine", "events")

    @property
    def late(self) -> str:
        return self.path("late", "events")

    @property
    def missed(self) -> str:
        return self.path("late", "missed")

    @property
    def issues(self) -> str:
        return self.path("observability", "quality_issues")

    @property
    def runs(self) -> str:
        return self.path("observability", "pipeline_runs")

    @property
    def checks(self) -> str:
        return self.path("observability", "data_quality_results")

    @property
    def metrics(self) -> str:
        return self.path("observability", "batch_metrics")

    @property
    def lags(self) -> str:
        return self.path("observability", "lag_histogram")

    @property
    def lags_by_month(self) -> str:
        return self.path("observability", "lag_histogram_by_month")

    def table(self, name: str) -> str:
        return self.path("warehouse", name)

    def mart(self, name: str) -> str:
        return self.path("marts", name)

    def checkpoint(self, query: str) -> str:
        return self.path("checkpoints", query)


def read_or_none(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table with its declared schema (no inference), or None if nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Like ``read_or_none`` with an empty table in place of a missing one."""
    found = read_or_none(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def bronze(spark: SparkSession, lake: Lake, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bronze messages, optionally of an inclusive range of ingestion dates; the range
    is a filter on the partition column, so other days are not listed or read."""
    rows = read_table(spark, lake.bronze, BRONZE_SCHEMA)
    if start is not None:
        rows = rows.filter(F.col("ingestion_date") >= F.lit(start).cast("date"))
    if end is not None:
        rows = rows.filter(F.col("ingestion_date") <= F.lit(end).cast("date"))
    return rows


def event_fact(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_table(spark, lake.silver, C.event_fact_schema())


def event_fact_of_dates(spark: SparkSession, lake: Lake, dates: list[str]) -> DataFrame | None:
    """Silver rows of some processing dates. Only the folders of those dates are listed,
    so the cost does not grow with the history of the lake."""
    parts = []
    for day in dates:
        part = read_or_none(spark, f"{lake.silver}/processing_date={day}", C.event_fact_schema())
        if part is not None:
            parts.append(f"{lake.silver}/processing_date={day}")
    if not parts:
        return None
    return spark.read.schema(C.event_fact_schema()).option("basePath", lake.silver).parquet(*parts)


def warehouse_table(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """One of the seven warehouse tables; ``event_fact`` is the silver layer itself."""
    if name == "event_fact":
        return event_fact(spark, lake)
    return read_table(spark, lake.table(name), C.table_schema(name))


def lags(spark: SparkSession, lake: Lake, start: str | None = None) -> DataFrame:
    """Lag histograms of all batches, those of backlogs too, optionally from a date on; folders of
    earlier days and months are not read."""
    by_month = T.StructType([*LAG_SCHEMA, T.StructField("month", T.DateType())])
    days, months = read_table(spark, lake.lags, LAG_SCHEMA), read_table(spark, lake.lags_by_month, by_month)
    if start is not None:
        first = F.lit(start).cast("date")
        days, months = days.filter(F.col("day") >= first), months.filter((F.col("month") >= F.trunc(first, "month")) & (F.col("day") >= first))
    return days.select(*LAG_SCHEMA.names).unionByName(months.select(*LAG_SCHEMA.names))


def missed(spark: SparkSession, lake: Lake) -> DataFrame:
    """Messages that no verdict was entered for, as ``plans.audit.collect_missed`` found them."""
    return read_table(spark, lake.missed, BRONZE_SCHEMA).select(*BRONZE_SCHEMA.names)


def quarantine(spark: SparkSession, lake: Lake, reasons: list[str] | None = None) -> DataFrame:
    """Quarantined records, optionally of some reasons (the partition column)."""
    rows = read_table(spark, lake.quarantine, QUARANTINE_SCHEMA)
    return rows.filter(F.col("quality_reason").isin(reasons)) if reasons else rows
