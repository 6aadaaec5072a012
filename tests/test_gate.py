"""The contract and business rules, one literal case each."""

import json

import pytest
from events import AS_OF, PAYLOADS, UUID, event, raw

from lendmill import contract as C
from lendmill.operators import gate as G
from lendmill.operators import report as R

CASES = {
    # name: (text, reason, contract codes that must be listed)
    **{f"valid {kind}": (event(i + 1, kind), None, "") for i, kind in enumerate(PAYLOADS)},
    "tag mismatch": (event(20, payload={"event_type": "repayment"}), "payload_type_mismatch", "payload:tag"),
    "no zone": (event(21, occurred_at="2026-01-01T10:00:00"), "schema_contract", "occurred_at:zone"),
    "bad instant": (event(22, occurred_at="yesterday"), "schema_contract", "occurred_at:format"),
    "impossible instant": (event(23, occurred_at="2026-02-31T10:00:00Z"), "schema_contract", "occurred_at:format"),
    "number as instant": (event(24, occurred_at=1767261600), "schema_contract", "occurred_at:format"),
    "negative measure": (event(25, payload={"data_mb": -1.0}), "schema_contract", "payload.data_mb:range"),
    "too large": (event(26, payload={"sms_count": 1001}), "schema_contract", "payload.sms_count:range"),
    "text for int": (event(27, payload={"sms_count": "2"}), "type_mismatch", "value:type"),
    "fraction for int": (event(28, payload={"sms_count": 1.5}), "type_mismatch", "value:type"),
    "int out of range": (event(29, payload={"sms_count": 5_000_000_000}), "type_mismatch", "value:type"),
    "number for text": (event(30, trace_id=5), "type_mismatch", "value:type"),
    "number for version": (event(31, schema_version=1.0), "type_mismatch", "value:type"),
    "number for hash": (event(32, "device_signal", {"device_hash": 1234567890123456}), "type_mismatch", "value:type"),
    "number for payload": (event(33, whole=5), "type_mismatch", "value:type"),
    "payload as text": (event(34, whole=json.dumps({"event_type": "gsm_usage", **PAYLOADS["gsm_usage"]})), "type_mismatch", "value:type"),
    "unknown envelope field": (event(35, extra=1), "schema_contract", "unknown_field"),
    "unknown payload field": (event(36, payload={"extra": None}), "schema_contract", "payload:unknown_field"),
    "field of another type": (event(37, payload={"score": 3}), "schema_contract", "payload:unknown_field"),
    "bad enum": (event(38, source_system="fax"), "schema_contract", "source_system:choice"),
    "bad uuid": (event(39, customer_id="abc"), "schema_contract", "customer_id:format"),
    "short hash": (event(40, "device_signal", {"device_hash": "abc"}), "schema_contract", "payload.device_hash:length"),
    "absent id": (event(41, drop=["event_id"]), "missing_event_id", "event_id:missing"),
    "null version": (event(42, schema_version=None), "unsupported_schema_version", "schema_version:missing"),
    "null type": (event(43, event_type=None), "unknown_event_type", "event_type:missing"),
    "other type": (event(44, "refund"), "unknown_event_type", "event_type:choice"),
    "null payload": (event(45, whole=None), "payload_type_mismatch", "payload:tag"),
    "no customer": (event(46, customer_id=None), "missing_customer_id", "customer_id:missing"),
    "no country": (event(47, drop=["country_code"]), "missing_country", "country_code:missing"),
    "no occurrence": (event(48, drop=["occurred_at"]), "missing_occurred_at", "occurred_at:missing"),
    "null ingestion": (event(49, ingested_at=None), "schema_contract", "ingested_at:missing"),
    "zero amount": (event(50, "mobile_money_transaction", {"amount": 0}), "invalid_transaction_amount", "payload.amount:range"),
    "null amount": (event(51, "mobile_money_transaction", {"amount": None}), "invalid_transaction_amount", "payload.amount:missing"),
    "negative request": (event(52, "loan_application", {"requested_amount": -1}), "invalid_requested_amount", "payload.requested_amount:range"),
    "other term": (event(53, "loan_application", {"term_days": 31}), "schema_contract", "payload.term_days:choice"),
    "before ingestion": (event(54, ingested_at="2026-01-01T09:59:59Z"), "invalid_event_time", ""),
    "before ingestion, zero amount": (event(90, "mobile_money_transaction", {"amount": 0}, ingested_at="2026-01-01T09:59:59Z"), "invalid_event_time", "payload.amount:range"),
    "inconsistent status": (event(55, "repayment", {"payment_status": "late"}), "business_rule", ""),
    "declined with amount": (event(56, "loan_decision", {"decision": "declined"}), "business_rule", ""),
    "future": (event(57, occurred_at="2026-02-01T00:06:00Z", ingested_at="2026-02-01T00:00:00Z"), "invalid_event_time", ""),
    "text": ("junk", "invalid_json", "json"),
    "empty": ("", "invalid_json", "json"),
    "null": (None, "invalid_json", "json"),
    "array": ("[1]", "invalid_json", "json"),
    "trailing text": (event(58) + " x", "invalid_json", "json"),
    "not a number": (event(59).replace("1.5", "NaN"), "invalid_json", "json"),
    "malformed example": ('{"schema_version":"0.0","malformed":true}', "missing_event_id", "unknown_field"),
    "bad id example": ('{"event_id":"not-a-uuid","event_type":"repayment"}', "unsupported_schema_version", "event_id:format"),
    "default consent": (event(60, "customer_registered").replace(', "consent_version": "v2.1"', ""), None, ""),
    "null consent": (event(61, "customer_registered", {"consent_version": None}), "schema_contract", "payload.consent_version:missing"),
    "other zone": (event(62, occurred_at="2026-01-01T13:00:00+03:00"), None, ""),
    "large topup": (event(63, payload={"airtime_topup_amount": 1e17}), "schema_contract", "payload.airtime_topup_amount:range"),
}


@pytest.fixture(scope="module")
def judged(spark):
    names = list(CASES)
    gated = G.gate(raw(spark, [CASES[n][0] for n in names]), AS_OF)
    return {names[row["kafka_offset"]]: row for row in gated.collect()}


@pytest.mark.parametrize("name", CASES)
def test_case(judged, name):
    _, reason, code = CASES[name]
    row = judged[name]
    assert row["reason"] == reason, row["contract_codes"]
    assert row["outcome"] == ("accepted" if reason is None else "quarantined")
    if code:
        assert code in row["contract_codes"].split(",")
    else:
        assert row["contract_codes"] == ""


def test_ids_are_lower_cased_and_instants_are_utc(spark):
    text = event(1, event_id=UUID.format(7).replace("8000", "ABCD"), occurred_at="2026-01-01T13:00:00+03:00")
    row = G.gate(raw(spark, [text]), AS_OF).selectExpr("event_id", "cast(occurred_at AS string) AS o", "payload.data_mb AS mb").first()
    assert row == (UUID.format(7).replace("8000", "abcd"), "2026-01-01 10:00:00", 1.5)


def test_defaults_fill_absent_fields_only(spark):
    text = event(1, "loan_decision").replace(', "model_version": "m1"', "")
    row = G.gate(raw(spark, [text]), AS_OF).selectExpr("payload.model_version AS m").first()
    assert row["m"] == C.DEFAULT_MODEL_VERSION


def test_first_arrival_wins_and_copies_are_counted(spark):
    texts = [event(1), event(1, trace_id="second"), event(2, ingested_at="2026-01-01T09:00:00Z"), event(2), "junk", "junk"]
    gated = G.gate(raw(spark, texts), AS_OF)
    rows = {r["kafka_offset"]: r for r in gated.collect()}
    assert set(rows) == {0, 2, 4, 5}
    assert rows[0]["trace_id"] == "trace" and rows[0]["copies"] == 2
    # The repeat of a business-rule failure is a duplicate, not a second decision.
    assert rows[2]["reason"] == "invalid_event_time" and rows[2]["copies"] == 2
    counts = R.gate_counts(gated).first()
    assert (counts["received"], counts["accepted"], counts["duplicates"], counts["quarantined"]) == (6, 1, 2, 3)
    assert counts["received"] == counts["accepted"] + counts["duplicates"] + counts["quarantined"]


def test_late_event_is_a_warning(spark):
    gated = G.gate(raw(spark, [event(1, ingested_at="2026-01-03T10:00:00Z")]), AS_OF)
    row = gated.first()
    assert row["outcome"] == "accepted" and row["late"]
    issue = G.issue_log(gated).first()
    assert (issue["rule"], issue["severity"], issue["event_id"]) == ("freshness_24h", "warning", UUID.format(1))


def test_report_of_clean_and_empty_batches(spark):
    clean = R.quality_report(G.gate(raw(spark, [event(i) for i in range(5)]), AS_OF), ["kafka_offset"], AS_OF).first()
    assert clean["status"] == "pass" and clean["acceptance_rate"] == 1.0 and clean["issue_counts"] == {}
    empty = R.gate_counts(G.gate(raw(spark, [event(1)]).limit(0), AS_OF)).first()
    assert empty["received"] == 0 and empty["acceptance_rate"] == 1.0


def test_report_lists_issues(spark):
    texts = [event(1), "junk", event(2, "repayment", {"payment_status": "late"})]
    report = R.quality_report(G.gate(raw(spark, texts), AS_OF), ["kafka_offset"], AS_OF).first()
    assert report["status"] == "warn"
    assert report["issue_counts"] == {"schema_contract": 1, "repayment_status_consistency": 1}
    assert [i["rule"] for i in report["issues"]] == ["schema_contract", "repayment_status_consistency"]


def test_one_parse_one_shuffle(spark):
    plan = G.gate(raw(spark, [event(1)]), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("from_json") == 2  # envelope and payload


def test_published_schema_has_36_payload_fields_and_the_tag():
    # the tag, and every field of the seven payloads once
    assert len(C.payload_schema()) == 1 + len({f.name for fields in C.PAYLOADS.values() for f in fields})
    assert C.event_schema()["payload"].dataType == C.payload_schema()
