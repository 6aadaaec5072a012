"""The quality report: counts, issues per rule, the first issues."""

import json

import pytest
from events import AS_OF, event, raw
from tables import same_as_duckdb, write_tables

from lendmill.operators import gate as G
from lendmill.operators import report as R


def test_the_query_gives_the_whole_report(spark, tmp_path):
    pytest.importorskip("duckdb")
    [report] = same_as_duckdb(spark, write_tables(spark, tmp_path, events=900), "quality_report")
    counts, issues = json.loads(report["issue_counts"]), json.loads(report["issues"])
    assert counts["schema_contract"] > 100 and len(counts) == 4 and list(counts) == sorted(counts)
    assert len(issues) == 100 and all(("event_id" in i) == (i["rule"] != "schema_contract") for i in issues)
    assert {i["rule"] for i in issues} <= counts.keys() and {"json", "event_id:missing"} <= {i["message"] for i in issues}
    assert report["generated_at"].isoformat() == "2024-01-31T00:00:00"


def test_a_report_without_issues(spark, tmp_path):
    pytest.importorskip("duckdb")
    path = write_tables(spark, tmp_path, events=1, orders=3)  # one click
    [report] = same_as_duckdb(spark, path, "quality_report")
    assert (report["issue_counts"], report["issues"], report["status"]) == ("{}", "[]", "pass")


def test_issues_are_counted_without_ids(spark):
    rows = raw(spark, ["junk", event(1, ingested_at="2026-01-04T10:00:00Z"), event(2, "repayment", {"payment_status": "late"}), event(3), event(4, drop=["event_id"])])
    assert "event_id" not in R.ISSUES
    narrow = R.issue_counts(G.gate(rows, AS_OF, columns=list(R.ISSUES)))
    assert sorted(map(repr, narrow.collect())) == sorted(map(repr, R.issue_counts(G.gate(rows, AS_OF)).collect()))
    assert {(r["rule"], r["issues"]) for r in narrow.collect()} == {("schema_contract", 2), ("freshness_24h", 1), ("repayment_status_consistency", 1)}
