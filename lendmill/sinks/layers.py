"""Frames of the lake layers, and the writers that keep them free of repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendmill import contract as C
from lendmill.operators.dedup import absent_rows, existing_keys
from lendmill.operators.gate import ACCEPTED, BUSINESS_RULES, packed, quarantined, unpacked
from lendmill.sources import lake as L

BRONZE_PARTITIONS = ("ingestion_date", "kafka_partition")
QUARANTINE_PARTITIONS = ("quality_reason",)
ARRIVAL = ("kafka_partition", "kafka_offset")


def bronze_rows(decoded: DataFrame) -> DataFrame:
    """Every message as it came, before any judgement."""
    dated = decoded.withColumn("ingestion_date", F.to_date("kafka_timestamp"))
    return dated.select(*L.BRONZE_SCHEMA.names)


def fact_columns() -> list[Column | str]:
    """What ``event_fact_rows`` needs of a judged row: not its text, and the payload of accepted
    events alone."""
    derived = ("payload_json", "processing_date")
    payload = F.when(F.col("outcome") == ACCEPTED, F.col("payload")).alias("payload")
    return ["outcome", *[c for c in C.EVENT_FACT_COLUMNS if c not in derived], payload]


def run_columns(raw: DataFrame) -> list[Column | str]:
    """What a batch run needs of a judged row of ``raw``: text and key of failing records, the
    payload of accepted events."""
    passed = F.col("outcome") == ACCEPTED
    texts = [F.when(~passed, F.col(c)).alias(c) if c in ("raw_value", "kafka_key") else c for c in raw.columns]
    payload = F.when(passed, F.col("payload")).alias("payload")
    return [*texts, *[f.name for f in C.ENVELOPE], payload, "contract_codes", "business_codes", "reason", "late", "outcome"]


def event_fact_rows(accepted: DataFrame) -> DataFrame:
    """Silver event fact: envelope, payload as JSON (absent fields dropped), date."""
    return accepted.withColumn("payload_json", F.to_json("payload")).withColumn(
        "processing_date", F.to_date("occurred_at")
    )


def typed_rows(accepted: DataFrame, table: str) -> DataFrame:
    """Projection of one event type into its warehouse table, cast to stored types.

    Other columns of the input (arrival order) are kept for the writer. Ids may be packed, as
    ``typed_columns`` gives them.
    """
    fields = C.PAYLOADS[C.TYPED_TABLES[table].event_type]
    own = accepted.filter(F.col("event_type") == C.TYPED_TABLES[table].event_type)
    order = [c for c in own.columns if c.startswith("kafka_") or c.startswith("source_")]
    types = {**{f.name: f.dataType for f in own.schema}, **{f"payload.{f.name}": f.dataType for f in own.schema["payload"].dataType}}

    def plain(name: str) -> Column:
        return unpacked(F.col(name)) if isinstance(types[name], T.BinaryType) else F.col(name)

    return own.select(
        *[plain(c).alias(c) for c in C.TABLE_BASE],
        *[plain(f"payload.{f.name}").cast(f.stored).alias(f.name) for f in fields],
        *[c for c in order if c != "source_system"],
    )


def typed_columns(table: str) -> list[Column | str]:
    """What ``typed_rows`` needs of a judged row, empty in rows of other types; ids are packed."""
    kind = C.TYPED_TABLES[table].event_type
    own = (F.col("outcome") == ACCEPTED) & (F.col("event_type") == kind)
    ids = {f.name for f in C.ENVELOPE if f.kind == "uuid"} | {f"payload.{f.name}" for f in C.PAYLOADS[kind] if f.kind == "uuid"}

    def narrow(name: str) -> Column:
        return packed(name, own) if name in ids else F.col(name)

    payload = F.struct(*[narrow(f"payload.{f.name}").alias(f.name) for f in C.PAYLOADS[kind]])
    return ["outcome", *[F.when(own, narrow(c)).alias(c) for c in (*C.TABLE_BASE, "event_type")], F.when(own, payload).alias("payload")]


def quarantine_rows(gated: DataFrame) -> DataFrame:
    """Failing records with their reason. The event id is kept only where the contract
    held, that is for business-rule failures."""
    trusted = F.when(F.col("contract_codes") == "", F.col("event_id"))
    return (
        quarantined(gated)
        .withColumnRenamed("reason", "quality_reason")
        .withColumn("event_id", trusted)
        .select(*L.QUARANTINE_SCHEMA.names)
    )


def dead_letters(quarantine: DataFrame) -> DataFrame:
    """Quarantined records as messages: key, and a JSON value with reason and origin."""
    return quarantine.select(
        F.coalesce("kafka_key", F.lit("unknown")).alias("key"),
        F.to_json(
            F.struct("quality_reason", "raw_value", "kafka_timestamp", "kafka_partition", "kafka_offset")
        ).alias("value"),
    )


def send_dead_letters(quarantine: DataFrame, servers: str, topic: str) -> None:
    """Publish to the dead-letter topic. Needs Spark's Kafka connector."""
    (
        dead_letters(quarantine)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def quarantine_lines(gated: DataFrame) -> DataFrame:
    """Portable form of a quarantined record: raw text, reason class, error list."""
    failed = quarantined(gated)
    by_contract = F.col("contract_codes") != ""
    errors = F.array(*[F.lit(r) for r, (severity, _) in BUSINESS_RULES.items() if severity == "error"])
    messages = F.create_map(*[F.lit(x) for r, (_, m) in BUSINESS_RULES.items() for x in (r, m)])
    broken = F.array_intersect(F.split("business_codes", ","), errors)
    return failed.select(
        F.col("raw_value").alias("raw"),
        F.when(by_contract, "schema_contract").otherwise("business_rule").alias("reason"),
        F.when(by_contract, F.col("contract_codes")).alias("error"),
        F.when(~by_contract, F.transform(broken, lambda r: F.try_element_at(messages, r))).alias("errors"),
    )


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append parquet. For partitioned tables rows are first gathered by partition with
    a rebalancing shuffle: adaptive execution merges small partitions into few files
    and splits a partition value that holds a large share of the rows."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Write parquet so that the folders of the key values in ``df`` hold these rows only.

    Each writer has key values of its own. A write that is repeated gives the same folder,
    and writers that run at one time do not meet: a dynamic overwrite stages its files in
    a folder of its own, where appends to one path share theirs.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def insert_if_absent(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    unique_keys: Sequence[str],
    order_by: Sequence[str],
    batch_rows: int,
    partition_by: Sequence[str] = (),
    target: DataFrame | None = None,
    distinct_in_batch: Sequence[str] = (),
) -> None:
    """Append the rows whose unique keys the table does not hold yet.

    Running the same batch again adds nothing. ``target`` may narrow the rows compared
    against; by default it is the whole table (its key columns only).
    """
    if target is None:
        target = L.read_or_none(spark, path, schema)
    fresh = absent_rows(batch, target, unique_keys, order_by, batch_rows, distinct_in_batch)
    append(fresh.select(*schema.names), path, partition_by)


def load_event_fact(
    spark: SparkSession,
    lake: L.Lake,
    accepted: DataFrame,
    batch_rows: int,
    order_by: Sequence[str] = ARRIVAL,
    ids_keep_their_date: bool = False,
) -> None:
    """Insert accepted events (distinct by id, as the gate gives them) into silver.

    By default an id is looked up in the whole table. Where producers guarantee that a
    repeated id repeats its ``occurred_at`` (as for redelivered copies), only the dates
    in the batch are compared, which keeps the cost of a micro-batch constant.
    """
    rows = event_fact_rows(accepted)
    target = None
    if ids_keep_their_date:
        dates = [r[0].isoformat() for r in rows.select("processing_date").distinct().collect()]
        target = L.event_fact_of_dates(spark, lake, dates)
        if target is None:
            target = spark.createDataFrame([], C.event_fact_schema())
    insert_if_absent(
        spark, rows, lake.silver, C.event_fact_schema(), ["event_id"], order_by, batch_rows,
        lake.silver_partitions, target, ["event_id"],
    )


def load_typed_tables(
    spark: SparkSession,
    lake: L.Lake,
    accepted: DataFrame,
    batch_rows: int,
    order_by: Sequence[str] = ARRIVAL,
    tables: Sequence[str] = tuple(C.TYPED_TABLES),
) -> None:
    """Insert accepted events into their typed tables, each on its own: a batch that
    stopped half-way is completed when it is run again."""
    for name in tables:
        insert_if_absent(
            spark,
            typed_rows(accepted, name),
            lake.table(name),
            C.table_schema(name),
            C.TYPED_TABLES[name].unique_keys,
            order_by,
            batch_rows,
            distinct_in_batch=["event_id"],
        )


def load_quarantine(spark: SparkSession, lake: L.Lake, gated: DataFrame, batch_rows: int) -> None:
    """Insert failing records into quarantine, once per message. ``batch_rows`` is a bound
    for the failing records of the batch."""
    rows = quarantine_rows(gated)
    target = L.read_or_none(spark, lake.quarantine, L.QUARANTINE_SCHEMA)
    keys = list(ARRIVAL)
    if target is not None:
        known = existing_keys(target, rows, keys, batch_rows)
        rows = rows.join(known, keys, "left_anti")
        # Contract failures have no id: kept out of the join, where they would be one hot key.
        without, named = rows.filter("event_id is null"), rows.filter("event_id is not null")
        ids = existing_keys(target, named, ["event_id"], batch_rows)
        rows = without.unionByName(named.join(ids, ["event_id"], "left_anti"))
    append(rows.select(*L.QUARANTINE_SCHEMA.names), lake.quarantine, QUARANTINE_PARTITIONS)
