"""What is shuffled: rows before their text is built, and of a judged row what is wanted."""

from datetime import datetime

import pytest
from events import AS_OF, event, raw

from lendmill import contract as C
from lendmill.operators import gate as G
from lendmill.operators import report as R
from lendmill.sinks import layers as S
from lendmill.sources import testviews as V
from lendmill.streaming import jobs as J
from registry import streams


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tables(spark, tmp_path):
    rows = [
        (i, datetime(2024, 1, 1 + i % 28, 10), 100 + i % 9, ["click", "view", "purchase", "signup", "error"][i % 5], float(i), f'{{"k": {i * 7 % 100}}}')
        for i in range(300)
    ]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def a_batch(spark):
    late = event(1, ingested_at="2026-01-04T10:00:00Z")
    return raw(spark, [late, late, event(2, "repayment", {"payment_status": "late"}), event(2, "repayment"), "junk", event(3, "loan_decision"), event(4, drop=["event_id"]), event(3, "repayment")])


def test_wanted_columns_are_those_of_the_whole_gate(spark):
    whole = G.gate(a_batch(spark), AS_OF)
    for names in (["outcome", "reason"], list(R.COUNTED), list(R.ISSUES)):
        narrow = G.gate(a_batch(spark), AS_OF, columns=names)
        assert sorted(map(repr, narrow.collect())) == sorted(map(repr, whole.select(*names, "copies").collect()))
    for table in ("loan_decisions", "repayments", "gsm_usage"):
        narrow = G.gate(a_batch(spark), AS_OF, columns=S.typed_columns(table))
        wanted = S.typed_rows(G.accepted(whole), table)
        got = S.typed_rows(G.accepted(narrow), table)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.select(*got.columns).collect()))


def test_a_batch_run_carries_texts_of_failing_records_alone(spark):
    whole = G.gate(a_batch(spark), AS_OF)
    narrow = G.gate(a_batch(spark), AS_OF, columns=S.run_columns(a_batch(spark))).persist()
    assert sorted(narrow.columns) == sorted(whole.columns)
    for of in (S.quarantine_rows, S.quarantine_lines, lambda g: G.issue_log(g).drop("kafka_key"), R.gate_counts, lambda g: S.event_fact_rows(G.accepted(g)).select(*C.event_fact_schema().names)):
        assert sorted(map(repr, of(narrow).collect())) == sorted(map(repr, of(whole).collect()))
    assert G.accepted(narrow).count() and not G.accepted(narrow).filter("raw_value is not null").count()
    assert not G.quarantined(narrow).filter("raw_value is null or payload is not null").count()


def test_texts_stay_where_they_are_judged(spark):
    def shuffled(df):
        return [line for line in plan(df).splitlines() if "min_by(struct" in line]

    assert all("raw_value" in line for line in shuffled(G.gate(a_batch(spark), AS_OF)))
    narrow = shuffled(G.gate(a_batch(spark), AS_OF, columns=["outcome", "reason"]))
    assert narrow and not any("raw_value" in line or "payload" in line for line in narrow)


def test_messages_are_built_after_the_rows_are_spread(spark, tables):
    for found, spread in ((V.event_messages(spark, tables), "hashpartitioning(event_id"), (V.event_messages(spark, tables, 5), "rangepartitioning(event_id")):
        exchanges = [line for line in plan(found).splitlines() if "Exchange" in line]
        assert len(exchanges) == 1 and spread in exchanges[0]


def test_ranges_hold_all_messages_in_order(spark, tables):
    ranged = V.event_messages(spark, tables, 5)
    assert sorted(map(repr, ranged.collect())) == sorted(map(repr, V.event_messages(spark, tables).collect()))
    parts = [[r["offset"] for r in part] for part in ranged.rdd.glom().collect()]
    ends = [(min(p), max(p)) for p in parts if p]
    assert len(ends) == 5 and all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_a_small_micro_batch_comes_in_few_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    assert J._by_rows(spark.range(100, numPartitions=64), 100).rdd.getNumPartitions() == cores
    assert J._by_rows(spark.range(100, numPartitions=64), 20 * J.ROWS_PER_TASK).rdd.getNumPartitions() == 20


def test_a_micro_batch_has_several_files(spark, tables, monkeypatch):
    assert streams._files(spark, tables, "events") == 1
    monkeypatch.setattr(streams, "FEW_ROWS", 20)
    assert streams._files(spark, tables, "events") == 5
