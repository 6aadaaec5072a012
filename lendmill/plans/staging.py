"""Staged views of the typed tables: column subsets with business names for times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of each staged view; a pair renames.
STAGED = {
    "customers": ("customer_id", "country_code", ("occurred_at", "registered_at"), "age_band", "income_band", "occupation", "consent_version"),
    "gsm_usage": ("event_id", "customer_id", "occurred_at", "country_code", "call_duration_seconds", "sms_count", "data_mb", "unique_contacts", "airtime_topup_amount", "network_tenure_days"),
    "mobile_money_transactions": ("event_id", "customer_id", "occurred_at", "country_code", "transaction_type", "amount", "currency", "channel"),
    "loan_applications": ("application_id", "event_id", "customer_id", ("occurred_at", "applied_at"), "country_code", "requested_amount", "currency", "term_days", "product_code", "stated_purpose"),
    "loan_decisions": ("event_id", "application_id", "customer_id", ("occurred_at", "decided_at"), "country_code", "decision", "score", "approved_amount", "interest_rate", "reason_code", "model_version"),
    "repayments": ("event_id", "loan_id", "application_id", "customer_id", ("occurred_at", "paid_at"), "country_code", "amount", "currency", "days_past_due", "payment_status"),
}


def stage(name: str, table: DataFrame) -> DataFrame:
    """Staged view of a typed table."""
    columns = [(c, c) if isinstance(c, str) else c for c in STAGED[name]]
    return table.select(*[F.col(source).alias(target) for source, target in columns])
