"""Layers, batch runs, publication, backfill, replay and streaming on small lakes."""

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from events import AS_OF, UUID, event, messages, raw
from pyspark.sql import functions as F

from lendmill.operators import gate as G
from lendmill.plans import backfill as B
from lendmill.plans import batch as P
from lendmill.plans import publish as U
from lendmill.sinks import layers as S
from lendmill.sources import lake as L
from lendmill.sources.messages import LINE_ORDER, decode, message_files, raw_lines
from lendmill.streaming import jobs as J


@pytest.fixture()
def lake(tmp_path):
    return L.Lake(str(tmp_path))


def ids(df, column="event_id"):
    return sorted(r[0] for r in df.select(column).collect())


def a_day(start=1, day=1, n=4, **more):
    stamp = f"2026-01-{day:02d}T10:00:00Z"
    kinds = ["customer_registered", "loan_application", "loan_decision", "repayment", "gsm_usage", "mobile_money_transaction", "device_signal"]
    return [event(start + i, kinds[(start + i) % 7], occurred_at=stamp, ingested_at=stamp, **more) for i in range(n)]


def load(spark, lake, texts, start=0):
    gated = G.gate(raw(spark, texts, start), AS_OF)
    accepted = G.accepted(gated)
    n = accepted.count()
    S.load_event_fact(spark, lake, accepted, n)
    S.load_typed_tables(spark, lake, accepted, n)
    S.load_quarantine(spark, lake, gated, gated.count())


def test_loading_twice_adds_nothing(spark, lake):
    texts = a_day(n=14) + ["junk", event(99, "repayment", {"payment_status": "late"})]
    for _ in range(2):
        load(spark, lake, texts)
    assert len(ids(L.event_fact(spark, lake))) == 14
    assert L.quarantine(spark, lake).count() == 2
    # One registration and one application keep their first row; the others are many.
    assert L.warehouse_table(spark, lake, "customers").count() == 1
    assert L.warehouse_table(spark, lake, "loan_applications").count() == 1
    assert L.warehouse_table(spark, lake, "loan_decisions").count() == 2


def test_half_done_batch_is_completed_by_its_retry(spark, lake):
    accepted = G.accepted(G.gate(raw(spark, a_day(n=7)), AS_OF))
    S.load_event_fact(spark, lake, accepted, 7)  # stopped before the typed tables
    load(spark, lake, a_day(n=7))
    assert len(ids(L.event_fact(spark, lake))) == 7
    assert L.warehouse_table(spark, lake, "repayments").count() == 1


def test_silver_layout_and_pruning(spark, lake):
    load(spark, lake, a_day(day=1) + a_day(start=20, day=2))
    rows = L.event_fact(spark, lake)
    assert {r[0].isoformat() for r in rows.select("processing_date").distinct().collect()} == {"2026-01-01", "2026-01-02"}
    plan = rows.filter("processing_date = date'2026-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(processing_date" in plan
    assert L.event_fact_of_dates(spark, lake, ["2026-01-02", "2027-01-01"]).count() == 4
    assert L.event_fact_of_dates(spark, lake, ["2027-01-01"]) is None


def test_typed_rows_use_stored_types(spark, lake):
    load(spark, lake, [event(1, "loan_decision", {"interest_rate": 0.125, "approved_amount": 90.12345})])
    row = L.warehouse_table(spark, lake, "loan_decisions").first()
    assert str(row["interest_rate"]) == "0.125000" and str(row["approved_amount"]) == "90.1235"


def test_dead_letters(spark):
    gated = G.gate(raw(spark, ["junk"]), AS_OF)
    row = S.dead_letters(S.quarantine_rows(gated)).first()
    assert row["key"] == "unknown"
    assert json.loads(row["value"])["quality_reason"] == "invalid_json" and json.loads(row["value"])["raw_value"] == "junk"


def test_batch_run_from_lines(spark, lake, tmp_path):
    texts = a_day(n=14) + a_day(n=3) + ['{"schema_version":"0.0","malformed":true}', '{"event_id":"not-a-uuid","event_type":"repayment"}']
    (tmp_path / "in.jsonl").write_text("\n".join(texts) + "\n")
    summary = P.run_batch(spark, lake, raw_lines(spark, str(tmp_path / "in.jsonl")), AS_OF, "r1", LINE_ORDER).first()
    assert (summary["customers"], summary["applications"], summary["repayments"]) == (1, 1, 2)
    run = L.read_table(spark, lake.runs, L.RUN_SCHEMA).first()
    assert (run["input_rows"], run["output_rows"], run["quarantined_rows"], run["status"]) == (19, 14, 2, "success")
    assert spark.read.text(lake.bronze).count() == 19
    assert spark.read.json(lake.quarantine).filter("reason = 'schema_contract'").count() == 2
    report = spark.read.json(lake.path("reports", "r1", "quality_report")).first()
    assert report["duplicates"] == 3 and report["issue_counts"]["schema_contract"] == 2
    assert L.read_table(spark, lake.issues, L.ISSUE_SCHEMA).count() == 2
    countries = spark.read.json(lake.path("reports", "r1", "country_performance"))
    assert countries.agg(F.sum("applications")).first()[0] == summary["applications"]


def _bronze(spark, lake, texts, day, start):
    rows = raw(spark, texts, start).withColumn("kafka_timestamp", F.lit(datetime(2026, 1, day, 12)))
    S.append(S.bronze_rows(rows), lake.bronze, S.BRONZE_PARTITIONS)


def test_backfill_keeps_rows_that_arrived_outside_its_range(spark, lake):
    _bronze(spark, lake, a_day(1, day=1), 1, 0)
    _bronze(spark, lake, a_day(10, day=1, n=2) + a_day(20, day=2), 2, 10)  # two events of day 1 arrive on day 2
    load(spark, lake, a_day(1, day=1))
    before = a_day(30, day=5)
    _bronze(spark, lake, before, 5, 40)
    load(spark, lake, before, 40)
    dates = B.backfill(spark, lake, "2026-01-02", "2026-01-02", AS_OF, "b1")
    assert dates == ["2026-01-01", "2026-01-02"]
    expected = [UUID.format(i) for i in (1, 2, 3, 4, 10, 11, 20, 21, 22, 23, 30, 31, 32, 33)]
    assert ids(L.event_fact(spark, lake)) == sorted(expected)
    B.backfill(spark, lake, "2026-01-02", "2026-01-02", AS_OF, "b2")
    assert ids(L.event_fact(spark, lake)) == sorted(expected)


def test_backfill_removes_rows_that_no_longer_pass(spark, lake):
    load(spark, lake, a_day(1, day=1, country_code="UGA"))  # written earlier; bronze has none of it
    _bronze(spark, lake, a_day(10, day=1), 1, 10)
    B.backfill(spark, lake, "2026-01-01", "2026-01-01", AS_OF, "b1")
    assert ids(L.event_fact(spark, lake)) == [UUID.format(i) for i in range(10, 14)]


def test_backfill_needs_a_range_and_may_find_nothing(spark, lake):
    with pytest.raises(ValueError):
        B.backfill(spark, lake, "2026-01-01", "", AS_OF, "b")
    assert B.backfill(spark, lake, "2026-01-01", "2026-01-02", AS_OF, "b") == []


def test_replayed_quarantine(spark, lake):
    stuck = raw(spark, a_day(1) + ["junk"]).withColumn("quality_reason", F.lit("outdated")).withColumn("event_id", F.lit(None).cast("string"))
    S.append(stuck.select(*L.QUARANTINE_SCHEMA.names), lake.quarantine, S.QUARANTINE_PARTITIONS)
    for run in ("p1", "p2"):
        outcome = {r["outcome"]: r["records"] for r in B.replay_quarantine(spark, lake, ["outdated"], AS_OF, run).collect()}
        assert outcome == {"accepted": 4, "quarantined": 1}
        assert len(ids(L.event_fact(spark, lake))) == 4


# --- publication -------------------------------------------------------------------


def _tables(spark, lake):
    return P.staged_tables(spark, lake)


def test_publication_is_gated_and_keeps_the_last_good_run(spark, lake):
    load(spark, lake, a_day(1, day=1, n=14))
    events, now = L.event_fact(spark, lake), "2026-01-01 10:30:00"
    U.publish(spark, lake, events, _tables(spark, lake), now, "run_1")
    first = U.published(spark, lake, "fct_credit_portfolio")
    assert first.count() == 1 and U.published_run(spark, lake) == "run_1"

    with pytest.raises(U.GateFailed, match="streaming_freshness"):
        U.publish(spark, lake, events, _tables(spark, lake), "2026-01-01 12:00:00", "run_2")

    broken = _tables(spark, lake)
    broken["customers"] = broken["customers"].limit(0)  # the application loses its customer
    with pytest.raises(U.GateFailed, match="relationships_customer_id"):
        U.publish(spark, lake, events, broken, now, "run_3")

    assert U.published_run(spark, lake) == "run_1"
    runs = {r["run_id"]: r["status"] for r in L.read_table(spark, lake.runs, L.RUN_SCHEMA).collect()}
    assert runs == {"run_1": "success", "run_2": "failed", "run_3": "failed"}
    checks = L.read_table(spark, lake.checks, L.CHECK_SCHEMA)
    assert checks.filter("run_id = 'run_1' AND status = 'pass'").count() == 14
    assert checks.filter("run_id = 'run_3' AND status = 'fail'").count() == 1

    # A failed run may come again under its id, a published one may not.
    U.publish(spark, lake, events, _tables(spark, lake), now, "run_2")
    assert U.published_run(spark, lake) == "run_2"
    with pytest.raises(U.AlreadyPublished):
        U.publish(spark, lake, events, _tables(spark, lake), now, "run_1")


def test_runs_are_audited_from_start_to_end(spark, lake):
    clock = iter(f"2026-01-01 11:00:0{i}" for i in range(9)).__next__

    def runs():
        rows = L.read_table(spark, lake.runs, L.RUN_SCHEMA).collect()
        return {r["run_id"]: (r["status"], r["started_at"].second, r["completed_at"] and r["completed_at"].second) for r in rows}

    with P.audited(spark, lake, "a/1", "batch", clock):
        assert runs() == {"a/1": ("running", 0, None)}
    with pytest.raises(ZeroDivisionError), P.audited(spark, lake, "b", "batch", clock):
        1 / 0  # noqa: B018
    assert runs() == {"a/1": ("success", 0, 1), "b": ("failed", 2, 3)}
    with P.audited(spark, lake, "b", "batch", clock):
        pass
    assert runs()["b"] == ("success", 4, 5) and len(runs()) == 2
    with pytest.raises(Exception, match="column"):
        P.run_batch(spark, lake, raw(spark, a_day(1)).drop("raw_value"), AS_OF, "dies", clock=clock)
    assert runs()["dies"] == ("failed", 6, 7)


def test_nothing_published(spark, lake):
    with pytest.raises(U.GateFailed):
        U.published(spark, lake, "fct_credit_portfolio")


# --- streaming ---------------------------------------------------------------------


def _topic(spark, lake, *batches):
    start = 0
    for texts in batches:
        messages(spark, texts, start).coalesce(1).write.mode("append").parquet(lake.path("topic"))
        start += len(texts)
    return message_files(spark, lake.path("topic"), max_files_per_trigger=1)


def _finish(*queries):
    for query in queries:
        query.awaitTermination()
        assert query.exception() is None


def test_writers_at_one_time_lose_no_metrics(spark, lake):
    with ThreadPoolExecutor(4) as pool:
        jobs = [
            pool.submit(J._record_metrics, spark, lake, name, batch, "reason", {"x": (batch, None), "y": (1, None)})
            for batch in range(12) for name in ("accepted", "quarantine")
        ]
        for job in jobs:
            job.result()
    J._record_metrics(spark, lake, "quarantine", 5, "reason", {"x": (5, None), "y": (1, None)})
    assert L.read_table(spark, lake.metrics, L.METRIC_SCHEMA).count() == 2 * len(jobs)


def test_one_verdict_fills_both_sides(spark, lake):
    first, second = a_day(1, day=1, n=7) + ["junk"], a_day(5, day=1, n=6) + ["junk again"]
    _finish(J.start_gated(_topic(spark, lake, first, second), lake, AS_OF, available_now=True))
    assert L.event_fact(spark, lake).count() == 10
    assert ids(L.quarantine(spark, lake), "raw_value") == ["junk", "junk again"]
    metrics = L.read_table(spark, lake.metrics, L.METRIC_SCHEMA)
    assert {r[0]: r[1] for r in metrics.groupBy("query_name").agg(F.sum("records")).collect()} == {"accepted": 13, "quarantine": 2}


def test_a_batch_of_failures_alone(spark, lake):
    """No accepted row; failures without an id are kept, each once."""
    for run in ("one", "two"):
        P.run_batch(spark, lake, raw(spark, ["junk"] * 5), AS_OF, run)
    assert L.quarantine(spark, lake).count() == 5
    assert L.read_table(spark, lake.runs, L.RUN_SCHEMA).count() == 2
    P.run_batch(spark, lake, raw(spark, ["junk"] * 5), AS_OF, "two")
    assert L.read_table(spark, lake.runs, L.RUN_SCHEMA).count() == 2


def test_stream_equals_batch(spark, lake, tmp_path):
    first, second = a_day(1, day=1, n=7) + ["junk"], a_day(5, day=1, n=6) + a_day(30, day=2) + ["junk again"]
    stream = _topic(spark, lake, first, second)
    _finish(
        J.start_bronze(stream, lake, available_now=True),
        J.start_accepted(stream, lake, AS_OF, available_now=True),
        J.start_quarantine(stream, lake, AS_OF, available_now=True),
    )
    other = L.Lake(str(tmp_path / "batch"))
    load(spark, other, first + second)
    assert ids(L.event_fact(spark, lake)) == ids(L.event_fact(spark, other))
    for name in ("customers", "gsm_usage", "loan_applications", "loan_decisions", "repayments"):
        assert ids(L.warehouse_table(spark, lake, name)) == ids(L.warehouse_table(spark, other, name)), name
    assert ids(L.quarantine(spark, lake), "raw_value") == ids(L.quarantine(spark, other), "raw_value")
    assert L.bronze(spark, lake).count() == len(first) + len(second)
    metrics = L.read_table(spark, lake.metrics, L.METRIC_SCHEMA)
    assert metrics.filter("query_name = 'quarantine'").agg(F.sum("records")).first()[0] == 2


def test_bronze_range_is_inclusive(spark, lake):
    for day in (1, 2, 3):
        _bronze(spark, lake, [event(day)], day, day)
    assert ids(L.bronze(spark, lake, "2026-01-02", "2026-01-03"), "kafka_offset") == [2, 3]


def test_micro_batch_retry_is_idempotent(spark, lake):
    gated = G.gate(raw(spark, a_day(1, n=7)), AS_OF)
    for _ in range(2):
        J.load_batch(spark, lake, gated, "accepted", 0)
    assert len(ids(L.event_fact(spark, lake))) == 7
    assert L.read_table(spark, lake.metrics, L.METRIC_SCHEMA).agg(F.sum("records")).first()[0] == 7


def test_stateful_form_drops_late_rows_and_the_late_output_keeps_them(spark, lake):
    def at(number, day, hour=10):
        stamp = (datetime(2026, 1, day, hour)).strftime("%Y-%m-%dT%H:%M:%SZ")
        return event(number, occurred_at=stamp, ingested_at=stamp)

    batches = [[at(1, 10), at(1, 10)], [at(2, 12)], [at(3, 9), at(1, 10), at(4, 12)]]
    start = 0
    for day, texts in zip((10, 12, 12), batches):
        messages(spark, texts, start, day=day).coalesce(1).write.mode("append").parquet(lake.path("topic"))
        start += len(texts)
    stream = message_files(spark, lake.path("topic"), max_files_per_trigger=1)
    query = J.start_accepted_with_state(stream, lake, AS_OF, available_now=True)
    _finish(query, J.start_late(stream, lake, available_now=True))
    # Event 3 is behind the watermark; the repeat of event 1 is, too.
    assert ids(L.event_fact(spark, lake)) == [UUID.format(i) for i in (1, 2, 4)]
    # The progress of the query tells that rows were dropped.
    assert sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]) >= 1
    assert spark.read.parquet(lake.late).count() == 2


def test_closed_minutes_are_written(spark, lake):
    def at(number, day):
        stamp = (datetime(2026, 1, day, 10) - timedelta(seconds=number)).strftime("%Y-%m-%dT%H:%M:%SZ")
        return event(number, occurred_at=stamp, ingested_at=f"2026-01-{day:02d}T10:00:00Z")

    stream = _topic(spark, lake, [at(1, 1), at(3, 1)], [at(5, 20)])
    _finish(J.start_throughput(stream, lake, available_now=True))
    row = spark.read.parquet(lake.path("observability", "throughput")).collect()
    assert [(r["event_count"], r["avg_lag_seconds"], r["max_lag_seconds"]) for r in row] == [(2, 2.0, 3.0)]


def test_stream_filter_does_not_repeat_the_parse(spark, lake):
    frame = J.valid_events(spark.range(1).selectExpr("cast(NULL AS binary) AS key", "cast(cast(id AS string) AS binary) AS value", "current_timestamp() AS timestamp", "0 AS partition", "id AS offset"), "m")
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2
