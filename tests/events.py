"""Builders of raw messages for tests."""

import json
from datetime import datetime

from lendmill.sources.messages import MESSAGE_SCHEMA

UUID = "00000000-0000-4000-8000-{:012d}"
AS_OF = "2026-02-01 00:00:00"
HASH = "ab" * 32

PAYLOADS = {
    "customer_registered": {"phone_hash": HASH, "age_band": "25-34", "income_band": "low", "occupation": "farmer", "consent_version": "v2.1"},
    "gsm_usage": {"call_duration_seconds": 10, "sms_count": 2, "data_mb": 1.5, "unique_contacts": 3, "airtime_topup_amount": 20.0, "network_tenure_days": 90},
    "mobile_money_transaction": {"transaction_type": "p2p", "amount": 12.5, "currency": "KES", "counterparty_hash": "c" * 16, "channel": "app"},
    "device_signal": {"device_hash": "d" * 16, "sim_slot_count": 2, "device_age_months": 10, "is_rooted": False, "location_cell_changes_24h": 4},
    "loan_application": {"application_id": UUID.format(900), "requested_amount": 100.0, "currency": "KES", "term_days": 30, "product_code": "nano", "stated_purpose": "other"},
    "loan_decision": {"application_id": UUID.format(900), "decision": "approved", "score": 700, "approved_amount": 90.0, "interest_rate": 0.1, "reason_code": "affordability_pass", "model_version": "m1"},
    "repayment": {"loan_id": UUID.format(901), "application_id": UUID.format(900), "amount": 30.0, "currency": "KES", "days_past_due": 0, "payment_status": "on_time"},
}


def event(number=1, kind="gsm_usage", payload=None, drop=(), whole=..., **envelope):
    """A valid event; keyword arguments override envelope fields, ``payload`` payload
    fields, ``whole`` the payload itself."""
    body = {
        "event_id": UUID.format(number), "schema_version": "1.0", "event_type": kind,
        "occurred_at": "2026-01-01T10:00:00Z", "ingested_at": "2026-01-01T10:00:05+00:00",
        "source_system": "gsm", "country_code": "KEN", "customer_id": UUID.format(500),
        "correlation_id": UUID.format(501), "trace_id": "trace",
        "payload": {"event_type": kind, **PAYLOADS.get(kind, {}), **(payload or {})},
    }
    body.update(envelope)
    if whole is not ...:
        body["payload"] = whole
    return json.dumps({k: v for k, v in body.items() if k not in drop})


def raw(spark, texts, start=0):
    rows = [(None, text, datetime(2026, 1, 1, 12), 0, start + i) for i, text in enumerate(texts)]
    return spark.createDataFrame(
        rows, "kafka_key string, raw_value string, kafka_timestamp timestamp, kafka_partition int, kafka_offset bigint"
    )


def messages(spark, texts, start=0, day=1, key=b"k"):
    rows = [(key, t.encode(), datetime(2026, 1, day, 12), 0, start + i) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)
