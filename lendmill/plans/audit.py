"""Whether a lake holds what it received: messages without a verdict, and a reconciliation of
the layers as they are read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.operators import gate as G
from lendmill.operators.dedup import first_by
from lendmill.plans.batch import settle
from lendmill.sinks import layers as S
from lendmill.sinks.ledger import keyed, load_judged, open_ledger
from lendmill.sources import lake as L


def collect_missed(spark: SparkSession, lake: L.Lake, run_id: str, start: str | None = None, end: str | None = None) -> None:
    """Write the bronze messages (of a range of ingestion dates) whose key has no entry in the
    ledger, one for each key: what a stateful stream dropped behind its watermark, or what no
    stream has read. A run that is repeated replaces its rows; ``judge_missed`` takes them in."""
    rows = keyed(G.check_contract(L.bronze(spark, lake, start, end)), S.ARRIVAL)
    known = open_ledger(spark, lake).entries().select("key")
    late = first_by(rows.select(*L.BRONZE_SCHEMA.names, "key"), ["key"], S.ARRIVAL).join(known, "key", "left_anti")
    S.replace(late.select(*L.BRONZE_SCHEMA.names, F.lit(run_id).alias("run_id")), lake.missed, ["run_id"])


def judge_missed(spark: SparkSession, lake: L.Lake, as_of, run_id: str) -> None:
    """Judge the missed messages and insert them as any other batch."""
    gated = settle(G.gate(L.missed(spark, lake).drop("ingestion_date"), as_of), lake.path("work", run_id, "missed"))
    load_judged(spark, lake, gated, "missed", run_id)


def _unjudged(spark: SparkSession, lake: L.Lake) -> DataFrame:
    rows = keyed(G.check_contract(L.missed(spark, lake)), S.ARRIVAL)
    return rows.select("key").distinct().join(open_ledger(spark, lake).entries().select("key"), "key", "left_anti")


def reconciliation(spark: SparkSession, lake: L.Lake) -> DataFrame:
    """One row: messages received, what became of them by the layers read back, and the
    difference, which is 0 where nothing is lost or doubled.

    ``repeats`` are counted from the messages themselves: a key that arrives again is one.
    ``missed`` are messages that were found without a verdict and have none yet.
    """
    rows = keyed(G.check_contract(L.bronze(spark, lake)), S.ARRIVAL)
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("received"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeats")
    )

    def size(table: DataFrame, name: str) -> DataFrame:
        return table.agg(F.count(F.lit(1)).alias(name))

    one = keys
    for table, name in ((L.event_fact(spark, lake), "accepted"), (L.quarantine(spark, lake), "quarantined"), (_unjudged(spark, lake), "missed")):
        one = one.join(F.broadcast(size(table, name)))  # one row each
    return one.withColumn("difference", F.col("received") - F.col("repeats") - F.col("accepted") - F.col("quarantined") - F.col("missed"))
