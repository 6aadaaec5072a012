"""Rebuilding silver from bronze, and replaying quarantined records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill import contract as C
from lendmill.operators import gate as G
from lendmill.operators.dedup import existing_keys
from lendmill.plans.batch import settle
from lendmill.sinks import layers as S
from lendmill.sinks.ledger import load_judged, open_ledger
from lendmill.sources import lake as L


def _event_date(raw: DataFrame) -> DataFrame:
    """Bronze rows with the event date from a parse of that one field."""
    text = F.get_json_object("raw_value", "$.occurred_at")
    zoned = F.when(text.rlike(G.INSTANT_PATTERN + G.ZONE_PATTERN), text.try_cast("timestamp"))
    return raw.withColumn("event_date", F.to_date(zoned))


def backfill(spark: SparkSession, lake: L.Lake, start: str, end: str, as_of, run_id: str) -> list[str]:
    """Rebuild the silver dates that bronze messages of an ingestion range belong to.

    The range selects by ingestion date but silver is partitioned by event date. So the
    touched event dates are found first, every bronze row of those dates is read again
    whatever its ingestion date, and then exactly these dates are replaced. Rows that
    arrived outside the range are kept. Returns the dates (one entry per day).
    """
    if not start or not end:
        raise ValueError("a backfill needs both ends of its date range")
    if lake.silver_partitions[0] != "processing_date":
        raise ValueError("a backfill replaces dates, so silver must be partitioned by them")
    in_range = _event_date(L.bronze(spark, lake, start, end))
    touched = in_range.select("event_date").filter(F.col("event_date").isNotNull()).distinct()
    dates = [row[0].isoformat() for row in touched.collect()]
    if not dates:
        return []
    wanted = F.col("event_date").isin(*[F.lit(d).cast("date") for d in dates])
    raw = _event_date(L.bronze(spark, lake)).filter(wanted).drop("event_date", "ingestion_date")

    gated = settle(G.gate(raw, as_of, columns=S.fact_columns()), lake.path("work", run_id, "gated"))
    rows = S.event_fact_rows(G.accepted(gated)).select(*C.EVENT_FACT_COLUMNS)
    silver = L.read_or_none(spark, lake.silver, C.event_fact_schema())
    if silver is not None:
        # An id that silver holds under another date stays there.
        others = silver.filter(~F.col("processing_date").isin(*[F.lit(d).cast("date") for d in dates]))
        known = existing_keys(others, rows, ["event_id"], gated.count())
        rows = rows.join(known, ["event_id"], "left_anti").select(*C.EVENT_FACT_COLUMNS)
    # Settled before the overwrite: the plan above reads the table it replaces.
    rebuilt = settle(rows, lake.path("work", run_id, "silver"))
    (
        rebuilt.hint("rebalance", *lake.silver_partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*lake.silver_partitions)
        .parquet(lake.silver)
    )
    # Last, so that a run that dies before leaves rows too many and not too few.
    _drop_vanished(spark, lake, rebuilt, dates)
    ledger = open_ledger(spark, lake)
    ledger.enter(rebuilt.select(F.col("event_id").alias("key"), F.lit(G.ACCEPTED).alias("verdict")), "backfill", run_id, streamed=False)
    return sorted(dates)


def _drop_vanished(spark: SparkSession, lake: L.Lake, rebuilt: DataFrame, dates: list[str]) -> None:
    """Remove partitions of the touched dates that the rebuilt data no longer has; a
    dynamic overwrite would leave them. Works on partition values, not on rows."""
    old = L.event_fact_of_dates(spark, lake, dates)
    if old is None:
        return
    parts = list(lake.silver_partitions)
    gone = old.select(*parts).distinct().join(rebuilt.select(*parts).distinct(), parts, "left_anti")
    jvm = spark.sparkContext._jvm
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    for row in gone.collect():
        folder = "/".join(f"{name}={row[name]}" for name in parts)
        path = jvm.org.apache.hadoop.fs.Path(f"{lake.silver}/{folder}")
        path.getFileSystem(configuration).delete(path, True)


def replay_quarantine(spark: SparkSession, lake: L.Lake, reasons: list[str], as_of, run_id: str) -> DataFrame:
    """Judge quarantined records again, with their original ids, after a rule or a
    producer was corrected. Accepted ones are inserted if absent; the rest stay where
    they are. Returns outcome counts per reason."""
    raw = L.quarantine(spark, lake, reasons)
    old_reason = raw.select(*S.ARRIVAL, F.col("quality_reason").alias("old_reason"))
    # Failing records stay where they are, so their texts are not needed again.
    wanted = [*S.fact_columns(), "contract_codes", *S.ARRIVAL]
    gated = settle(G.gate(raw.drop("quality_reason", "event_id"), as_of, columns=wanted), lake.path("work", run_id, "gated"))
    # Held back by accepted events alone: these ids are known as failures.
    load_judged(spark, lake, gated, "replay", run_id, blocking=[G.ACCEPTED], keep_failed=False)
    return (
        gated.join(old_reason, list(S.ARRIVAL))
        .groupBy("old_reason", "outcome")
        .agg(F.count(F.lit(1)).alias("records"))
    )
