"""The event contract, declared once.

One table of fields per event type drives everything else: the published
``StructType``, the parse schemas, the row rules of the gate and the projections
into typed tables. Nothing here touches data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values of the contract ------------------------------------------------
SCHEMA_VERSION = "1.0"
COUNTRIES = ("KEN", "UGA", "GHA", "TZA", "ZMB")
COUNTRY_NAMES = {
    "KEN": "Kenya",
    "UGA": "Uganda",
    "GHA": "Ghana",
    "TZA": "Tanzania",
    "ZMB": "Zambia",
}
CURRENCIES = ("KES", "UGX", "GHS", "TZS", "ZMW")
SOURCE_SYSTEMS = ("gsm", "mobile_money", "credit_engine", "loan_ledger", "identity")
AGE_BANDS = ("18-24", "25-34", "35-44", "45-54", "55+")
INCOME_BANDS = ("low", "lower_middle", "upper_middle", "high")
OCCUPATIONS = ("farmer", "merchant", "salaried", "gig_worker", "other")
TRANSACTION_TYPES = ("cash_in", "cash_out", "p2p", "merchant_pay", "bill_pay")
CHANNELS = ("ussd", "app", "agent")
TERM_DAYS = (7, 14, 30, 60, 90)
PRODUCTS = ("nano", "working_capital", "personal")
PURPOSES = ("inventory", "emergency", "education", "agriculture", "other")
DECISIONS = ("approved", "declined", "manual_review")
REASON_CODES = (
    "affordability_pass",
    "thin_file",
    "velocity_risk",
    "affordability_fail",
    "policy_limit",
)
PAYMENT_STATUSES = ("on_time", "late", "partial", "settled")
DEFAULT_CONSENT_VERSION = "v2.1"
DEFAULT_MODEL_VERSION = "credit-risk-2026.08"
AMOUNT_LIMIT = 1_000_000
# ---------------------------------------------------------------------------------

MONEY = T.DecimalType(20, 4)
RATE = T.DecimalType(8, 6)
# Largest double that still fits MONEY; measures without an upper limit use it.
STORABLE_MONEY = 1e16 - 2

# How each kind of field is read from JSON and how it is stored.
_PARSED = {
    "string": T.StringType(),
    "uuid": T.StringType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "money": T.DoubleType(),
    "rate": T.DoubleType(),
    "bool": T.BooleanType(),
    "instant": T.TimestampType(),
}
_STORED = {**_PARSED, "money": MONEY, "rate": RATE}


@dataclass(frozen=True)
class Field:
    """One contract field: its kind and what values it may take."""

    name: str
    kind: str = "string"
    choices: tuple = ()
    low: float | None = None
    high: float | None = None
    above: float | None = None  # exclusive lower limit
    length: tuple[int, int] | None = None
    default: str | None = None

    @property
    def parsed(self) -> T.DataType:
        return _PARSED[self.kind]

    @property
    def stored(self) -> T.DataType:
        return _STORED[self.kind]


ENVELOPE: tuple[Field, ...] = (
    Field("event_id", "uuid"),
    Field("schema_version", choices=(SCHEMA_VERSION,)),
    Field("event_type"),
    Field("occurred_at", "instant"),
    Field("ingested_at", "instant"),
    Field("source_system", choices=SOURCE_SYSTEMS),
    Field("country_code", choices=COUNTRIES),
    Field("customer_id", "uuid"),
    Field("correlation_id", "uuid"),
    Field("trace_id"),
)

_AMOUNT = Field("amount", "money", above=0, high=AMOUNT_LIMIT)
_CURRENCY = Field("currency", choices=CURRENCIES)
_APPLICATION_ID = Field("application_id", "uuid")

PAYLOADS: dict[str, tuple[Field, ...]] = {
    "customer_registered": (
        Field("phone_hash", length=(64, 64)),
        Field("age_band", choices=AGE_BANDS),
        Field("income_band", choices=INCOME_BANDS),
        Field("occupation", choices=OCCUPATIONS),
        Field("consent_version", default=DEFAULT_CONSENT_VERSION),
    ),
    "gsm_usage": (
        Field("call_duration_seconds", "int", low=0, high=14_400),
        Field("sms_count", "int", low=0, high=1_000),
        Field("data_mb", "double", low=0, high=100_000),
        Field("unique_contacts", "int", low=0, high=5_000),
        Field("airtime_topup_amount", "money", low=0, high=STORABLE_MONEY),
        Field("network_tenure_days", "int", low=0),
    ),
    "mobile_money_transaction": (
        Field("transaction_type", choices=TRANSACTION_TYPES),
        _AMOUNT,
        _CURRENCY,
        Field("counterparty_hash", length=(16, 64)),
        Field("channel", choices=CHANNELS),
    ),
    "device_signal": (
        Field("device_hash", length=(16, 64)),
        Field("sim_slot_count", "int", low=1, high=4),
        Field("device_age_months", "int", low=0, high=240),
        Field("is_rooted", "bool"),
        Field("location_cell_changes_24h", "int", low=0, high=10_000),
    ),
    "loan_application": (
        _APPLICATION_ID,
        Field("requested_amount", "money", above=0, high=AMOUNT_LIMIT),
        _CURRENCY,
        Field("term_days", "int", choices=TERM_DAYS),
        Field("product_code", choices=PRODUCTS),
        Field("stated_purpose", choices=PURPOSES),
    ),
    "loan_decision": (
        _APPLICATION_ID,
        Field("decision", choices=DECISIONS),
        Field("score", "int", low=0, high=1_000),
        Field("approved_amount", "money", low=0, high=AMOUNT_LIMIT),
        Field("interest_rate", "rate", low=0, high=1),
        Field("reason_code", choices=REASON_CODES),
        Field("model_version", default=DEFAULT_MODEL_VERSION),
    ),
    "repayment": (
        Field("loan_id", "uuid"),
        _APPLICATION_ID,
        _AMOUNT,
        _CURRENCY,
        Field("days_past_due", "int", low=0, high=3_650),
        Field("payment_status", choices=PAYMENT_STATUSES),
    ),
}
EVENT_TYPES: tuple[str, ...] = tuple(PAYLOADS)


@dataclass(frozen=True)
class TypedTable:
    """A warehouse table fed by one event type."""

    event_type: str
    unique_keys: tuple[str, ...] = ("event_id",)


# device_signal has no table of its own: it stays in the event fact only.
TYPED_TABLES: dict[str, TypedTable] = {
    "customers": TypedTable("customer_registered", ("event_id", "customer_id")),
    "gsm_usage": TypedTable("gsm_usage"),
    "mobile_money_transactions": TypedTable("mobile_money_transaction"),
    "loan_applications": TypedTable("loan_application", ("event_id", "application_id")),
    "loan_decisions": TypedTable("loan_decision"),
    "repayments": TypedTable("repayment"),
}
TABLE_BASE = ("event_id", "customer_id", "occurred_at", "country_code")
EVENT_FACT_COLUMNS = (
    "event_id",
    "schema_version",
    "event_type",
    "occurred_at",
    "ingested_at",
    "source_system",
    "country_code",
    "customer_id",
    "correlation_id",
    "trace_id",
    "payload_json",
    "processing_date",
)


def payload_fields() -> list[Field]:
    """Every payload field once, in first-seen order (shared names share a type)."""
    seen: dict[str, Field] = {}
    for fields in PAYLOADS.values():
        for field in fields:
            seen.setdefault(field.name, field)
    return list(seen.values())


def payload_schema() -> T.StructType:
    """The wide payload: the tag plus the union of all payload fields."""
    return T.StructType(
        [T.StructField("event_type", T.StringType())]
        + [T.StructField(f.name, f.parsed) for f in payload_fields()]
    )


def event_schema() -> T.StructType:
    """The published event type."""
    return T.StructType(
        [T.StructField(f.name, f.parsed) for f in ENVELOPE]
        + [T.StructField("payload", payload_schema())]
    )


def envelope_text_schema(corrupt: str) -> T.StructType:
    """Envelope with every value kept as text, so that the rules can tell an absent
    value from a malformed one and can see whether an instant carries a zone."""
    names = [f.name for f in ENVELOPE] + ["payload", corrupt]
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def table_schema(table: str) -> T.StructType:
    """Stored schema of a typed table."""
    envelope = {f.name: f for f in ENVELOPE}
    fields = PAYLOADS[TYPED_TABLES[table].event_type]
    return T.StructType(
        [T.StructField(n, envelope[n].stored) for n in TABLE_BASE]
        + [T.StructField(f.name, f.stored) for f in fields]
    )


def event_fact_schema() -> T.StructType:
    envelope = {f.name: f.stored for f in ENVELOPE}
    extra = {"payload_json": T.StringType(), "processing_date": T.DateType()}
    return T.StructType(
        [T.StructField(n, {**envelope, **extra}[n]) for n in EVENT_FACT_COLUMNS]
    )
