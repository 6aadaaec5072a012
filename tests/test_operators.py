"""Deduplication, insert-if-absent, percentile, checks, functions."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lendmill import functions as fn
from lendmill.operators import checks as K
from lendmill.operators import dedup as D
from lendmill.operators.quantile import grouped_percentile
from lendmill.plans import marts as M
from lendmill.plans import serving as S


def test_first_by_keeps_first_row_and_counts(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    rows = {r["k"]: r for r in D.first_by(df, ["k"], ["o"], copies="n").collect()}
    assert rows["a"]["v"] == "y" and rows["a"]["n"] == 2 and rows["b"]["n"] == 1


def test_first_by_combines_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("IF(id % 3 = 0, 'hot', cast(id AS string)) AS k", "id AS o")
    plan = D.first_by(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_absent_rows_applies_every_unique_key(spark):
    schema = "event_id string, customer_id string, o int"
    target = spark.createDataFrame([("e1", "c1", 0)], schema)
    batch = spark.createDataFrame(
        [("e1", "c9", 1), ("e2", "c1", 2), ("e3", "c3", 4), ("e4", "c3", 3), ("e5", "c5", 5)], schema
    )
    rows = D.absent_rows(batch, target, ["event_id", "customer_id"], ["o"], batch.count())
    assert sorted(r["event_id"] for r in rows.collect()) == ["e4", "e5"]


@pytest.mark.parametrize("limit", [0, D.MAX_BROADCAST_KEYS])
def test_existing_keys_by_broadcast_or_shuffle(spark, monkeypatch, limit):
    monkeypatch.setattr(D, "MAX_BROADCAST_KEYS", limit)
    target = spark.range(100).selectExpr("id AS k")
    batch = spark.range(95, 105).selectExpr("id AS k")
    assert D.existing_keys(target, batch, ["k"], 10).count() == 5


def test_percentile_scans_its_input_once(spark, tmp_path):
    spark.range(100).selectExpr("id % 3 AS g", "id AS v").write.parquet(str(tmp_path / "t"))
    plan = grouped_percentile(spark.read.parquet(str(tmp_path / "t")), ["g"], F.col("v"), 0.95, "total", "n", "q")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan


def test_grouped_percentile_equals_sorting(spark):
    rng = random.Random(7)
    rows = [("hot", rng.choice([rng.randrange(10), rng.randrange(1 << 22), rng.randrange(1 << 45)])) for _ in range(3000)]
    rows += [("one", 5)] + [("two", v) for v in (1, 1 << 41)] + [("same", 9)] * 50
    df = spark.createDataFrame(rows, "g string, v bigint")
    for p in (0.0, 0.5, 0.95, 1.0):
        got = {r["g"]: r for r in grouped_percentile(df, ["g"], F.col("v"), p, "total", "n", "q").collect()}
        for group in {g for g, _ in rows}:
            values = sorted(v for g, v in rows if g == group)
            at = p * (len(values) - 1)
            low = int(at)
            want = values[low] + (at - low) * (values[min(low + 1, len(values) - 1)] - values[low])
            assert got[group]["q"] == pytest.approx(want, rel=1e-12), (group, p)
            assert got[group]["n"] == len(values) and int(got[group]["total"]) == sum(values)


def test_row_checks_and_relationships(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, 50), (2, "z", None)], "id int, v string, n int")
    rows = K.row_checks("t", df, [K.not_null("v"), K.accepted_values("v", ["a"]), K.accepted_range("n", 0, 10)]).collect()
    assert {r["rule_name"]: r["observed_value"] for r in rows} == {"not_null_v": 1, "accepted_values_v": 1, "accepted_range_n": 1}
    assert K.unique("t", df, "id").first()["observed_value"] == 1
    parent = spark.createDataFrame([(1,)], "id int")
    assert K.relationships("t", df, "id", parent, "id").first()["observed_value"] == 1


def _events(spark, ages):
    now = datetime(2026, 1, 2, 12)
    rows = [(now - timedelta(minutes=a), now - timedelta(minutes=a), (now - timedelta(minutes=a)).date()) for a in ages]
    return spark.createDataFrame(rows, "occurred_at timestamp, ingested_at timestamp, processing_date date"), "2026-01-02 12:00:00"


@pytest.mark.parametrize("age, status", [(5, "pass"), (20, "warn"), (61, "fail")])
def test_source_freshness(spark, age, status):
    events, now = _events(spark, [age, 500])
    assert K.source_freshness("event_fact", events, now).first()["status"] == status


def test_gates_fail_on_empty_tables(spark):
    events, now = _events(spark, [1])
    assert K.freshness_gate(events.limit(0), now).first()["status"] == "fail"
    assert K.volume_gate(events, now).first()["status"] == "fail"
    assert K.source_freshness("e", events.limit(0), now).first()["status"] == "fail"
    many, now = _events(spark, [1] * 10)
    assert K.volume_gate(many, now).first()["status"] == "pass"


def test_slo_grades(spark):
    measures = spark.createDataFrame([(30.0, 98.5, 121.0, 0.005)], "event_age_seconds double, acceptance_pct double, p95_lag_seconds double, quarantine_rate double")
    grades = {r["measure"]: r["grade"] for r in K.grade_slo(measures).collect()}
    assert grades == {"event_age_seconds": "ok", "acceptance_pct": "warn", "p95_lag_seconds": "critical", "quarantine_rate": "warn"}


def test_scalar_functions(spark):
    row = spark.range(1).select(
        fn.pseudonym(F.lit("+254"), "s").alias("p"), fn.pseudonym(F.lit("+254"), "t").alias("q"),
        fn.id_token(F.lit("123456789")).alias("token"), fn.risk_band(F.lit(450)).alias("band"),
        fn.country_name(F.lit("KEN")).alias("country"), fn.percentage(F.lit(1), F.lit(0)).alias("none"),
        fn.round_half_up(F.lit(1.005), 2).alias("rounded"),
    ).first()
    assert len(row["p"]) == 64 and row["p"] != row["q"] and "254" not in row["p"][:4]
    assert (row["token"], row["band"], row["country"], row["none"], row["rounded"]) == ("12345678…", "high", "Kenya", None, 1.01)


def test_latest_decision_prefers_larger_id_on_ties_and_limits_before_the_shuffle(spark):
    at = datetime(2026, 1, 1)
    df = spark.createDataFrame([("a", at, "1", "declined"), ("a", at, "2", "approved")], "application_id string, decided_at timestamp, event_id string, decision string")
    latest = M.latest_decision(df)
    assert latest.first()["decision"] == "approved"
    assert latest._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_kpis_of_an_empty_portfolio(spark):
    schema = "customer_id string, decision string, loan_id string, approved_amount decimal(20,4), score int, ever_par30 boolean, applied_at timestamp"
    row = M.realtime_kpis(spark.createDataFrame([], schema)).first()
    assert row["applications"] == 0 and row["approval_rate_pct"] is None and row["approved_value_local"] == 0


@pytest.mark.parametrize("call", [lambda e: S.throughput_series(e, "2026-01-01", 4), lambda e: S.recent_events(e, 201), lambda e: S.recent_events(e, 0)])
def test_serving_parameters_are_bounded(spark, call):
    with pytest.raises(ValueError):
        call(spark.range(1))
