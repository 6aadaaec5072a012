"""The validation gate: raw JSON text in, one judged row per distinct event out.

The gate is one pass with one shuffle. Rules are plain SQL expressions generated from
the contract; rule hits are kept as a comma-separated code list, which stays
inside generated code and is only exploded for the few rows that have one.

Order of judgement: contract (incl. reason code) -> first arrival of an event id wins
-> business rules. Records that fail the contract never take part in deduplication.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill import contract as C
from lendmill.functions import instant
from lendmill.operators.dedup import first_by

# --- fixed values: patterns, limits, rule names, severities and messages ----------
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
INSTANT_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
ZONE_PATTERN = r"(Z|z|[+-]\d{2}:?\d{2})$"
# A JSON key can be told from a string value by the colon after it: quotes inside
# strings are escaped. These find text fields that hold another token, and a payload
# that is text instead of an object.
TEXT_TOKEN_PATTERN = r'"(?:(?:{names})"\s*:\s*[^"n\s]|payload"\s*:\s*")'
# Text that could as well be the text of a number, a truth value, an object or an array.
LOOKALIKE_PATTERN = r"(^| )(-?[0-9][0-9.eE+-]*|true|false)( |$)|[{\[]"
FUTURE_TOLERANCE_MINUTES = 5
LATE_AFTER_HOURS = 24
BUSINESS_RULES = {
    "event_not_in_future": ("error", "occurred_at is in the future"),
    "ingestion_after_occurrence": ("error", "ingested_at precedes occurred_at"),
    "freshness_24h": ("warning", "event arrived more than 24h late"),
    "declined_amount_zero": ("error", "non-approved decision has an approved amount"),
    "repayment_status_consistency": (
        "error",
        "late/partial payment must have positive days past due",
    ),
}
CONTRACT_RULE = "schema_contract"
# ---------------------------------------------------------------------------------

ACCEPTED = "accepted"
QUARANTINED = "quarantined"
_CORRUPT = "__corrupt"
# Marks of keys and ids that are no packed UUID: longer than its 16 bytes.
_RECORD, _UNPACKED = "failing record at ", "text not packed: "


def _text(value: str) -> str:
    """SQL literal of a plain text or pattern (raw, so backslashes stay)."""
    return f"r'{value}'"


def _one_of(column: str, values: Sequence) -> str:
    listed = ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)
    return f"{column} IN ({listed})"


def _code_list(rules: Sequence[tuple[str, str]]) -> str:
    """Comma-separated list of the codes whose condition holds; empty text if none.

    Rules are SQL text: the whole list is handed to Spark as one expression."""
    return "concat_ws(',', " + ", ".join(f"IF({condition}, '{code}', NULL)" for code, condition in rules) + ")"


def parse(raw: DataFrame, text: str = "raw_value") -> DataFrame:
    """Parse JSON text into envelope fields and the wide payload.

    Adds the envelope columns (instants parsed, ids lower-cased), ``payload``, and
    helper columns starting with ``__`` that the contract rules need.
    """
    options = f"map('columnNameOfCorruptRecord', '{_CORRUPT}', 'allowSingleQuotes', 'false')"
    envelope_type = _ddl(C.envelope_text_schema(_CORRUPT))
    payload_type = _ddl(C.payload_schema().add(_CORRUPT, "string"))
    staged = raw.selectExpr(
        "*",
        f"from_json({text}, '{envelope_type}', {options}) AS __envelope",
        f"json_object_keys({text}) AS __keys",
    ).selectExpr(
        "*",
        f"from_json(__envelope.payload, '{payload_type}', {options}) AS __payload",
        "json_object_keys(__envelope.payload) AS __payload_keys",
    )

    def envelope_field(f: C.Field) -> str:
        value = f"__envelope.{f.name}"
        if f.kind == "uuid":
            value = f"lower({value})"
        if f.kind == "instant":
            value = f"IF({value} RLIKE {_text(INSTANT_PATTERN + ZONE_PATTERN)}, try_cast({value} AS timestamp), NULL)"
        return f"{value} AS {f.name}"

    owner = {f.name: kind for kind, fields in C.PAYLOADS.items() for f in fields if f.default}

    def payload_field(f: C.Field) -> str:
        value = f"__payload.{f.name}"
        if f.kind == "uuid":
            value = f"lower({value})"
        if f.default:  # filled in where the field is absent, not where it is null
            absent = f"__envelope.event_type = '{owner[f.name]}' AND NOT coalesce(array_contains(__payload_keys, '{f.name}'), false)"
            value = f"IF({absent}, '{f.default}', {value})"
        return f"'{f.name}', {value}"

    payload = ", ".join(["'event_type', __payload.event_type", *[payload_field(f) for f in C.payload_fields()]])
    instants = [f.name for f in C.ENVELOPE if f.kind == "instant"]
    return staged.selectExpr(
        *raw.columns,
        *[envelope_field(f) for f in C.ENVELOPE],
        f"IF(__payload IS NULL, NULL, named_struct({payload})) AS payload",
        f"__keys IS NULL OR __envelope.{_CORRUPT} IS NOT NULL"
        f" OR NOT (startswith(trim({text}), '{{') AND endswith(trim({text}), '}}')) AS __invalid_json",
        f"__payload.{_CORRUPT} IS NOT NULL OR {_other_token(text)} AS __wrong_type",
        *[f"__envelope.{name} AS __text_{name}" for name in instants],
        "__keys",
        "__payload_keys",
    )


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


def _other_token(text: str) -> str:
    """True if a text field holds a JSON number, truth value, object or array.

    Only free text needs this; the other text fields have a vocabulary or a form that
    no such token satisfies. The whole record is only searched where a value could come
    from another token, judged by its look or by an unusual spelling of the key."""
    free = [f.name for f in C.payload_fields() if f.kind == "string" and not f.choices]
    names = "|".join(["schema_version", "trace_id", *free])
    version = " OR ".join(f"""contains({text}, '"schema_version":{space}"')""" for space in ("", " "))
    payload = " OR ".join(f"""contains({text}, '"payload":{space}{{')""" for space in ("", " "))
    values = ", ".join(["__envelope.trace_id", *[f"__payload.{n}" for n in free]])
    lookalike = f"concat_ws(' ', {values}) RLIKE {_text(LOOKALIKE_PATTERN)}"
    search = f"{text} RLIKE {_text(TEXT_TOKEN_PATTERN.format(names=names))}"
    return f"IF(({version}) AND ({payload}) AND NOT ({lookalike}), false, {search})"


def _unknown_keys(keys: str, scope: str, known: Sequence[str]) -> str:
    """True if the object has a key that is not known. When as many known fields have a
    value as there are keys there can be no other key; the set difference is only
    computed for the rest."""
    present = " + ".join(f"int({scope}{k} IS NOT NULL)" for k in known)
    listed = ", ".join(f"'{k}'" for k in known)
    return f"IF(size({keys}) = {present}, false, size(array_except({keys}, array({listed}))) > 0)"


def _value_rules(field: C.Field, scope: str) -> list[tuple[str, str]]:
    """Rules of one field: absent, wrong form, outside its vocabulary or its limits."""
    column = code = f"{scope}{field.name}"
    rules = [(f"{code}:missing", f"{column} IS NULL")]
    if field.kind == "uuid":
        rules.append((f"{code}:format", f"NOT {column} RLIKE {_text(UUID_PATTERN)}"))
    if field.choices:
        rules.append((f"{code}:choice", f"NOT {_one_of(column, field.choices)}"))
    if field.length:
        low, high = field.length
        rules.append((f"{code}:length", f"char_length({column}) NOT BETWEEN {low} AND {high}"))
    limits = [
        f"{column} {sign} {limit!r}{'' if isinstance(limit, int) else 'D'}"
        for sign, limit in (("<", field.low), ("<=", field.above), (">", field.high))
        if limit is not None
    ]
    if limits:
        rules.append((f"{code}:range", " OR ".join(limits)))
    return rules


def contract_codes_sql() -> str:
    """All contract rules at once, as one code list."""
    names = [f.name for f in C.ENVELOPE]
    rules = [("unknown_field", _unknown_keys("__keys", "", [*names, "payload"]))]
    for f in C.ENVELOPE:
        if f.kind == "instant":
            text = f"__text_{f.name}"
            no_zone = f"coalesce({text} RLIKE {_text(INSTANT_PATTERN + '$')}, false)"
            rules += [
                (f"{f.name}:missing", f"{text} IS NULL"),
                (f"{f.name}:zone", no_zone),
                (f"{f.name}:format", f"{text} IS NOT NULL AND {f.name} IS NULL AND NOT {no_zone}"),
            ]
        else:
            rules += _value_rules(f, "")
    rules.append(("event_type:choice", f"NOT {_one_of('event_type', C.EVENT_TYPES)}"))

    by_type = ""
    for kind, fields in C.PAYLOADS.items():
        own = [("payload:unknown_field", _unknown_keys("__payload_keys", "payload.", ["event_type", *[f.name for f in fields]]))]
        for f in fields:
            own += _value_rules(f, "payload.")
        by_type += f" WHEN event_type = '{kind}' THEN {_code_list(own)}"
    payload = f"""CASE WHEN __wrong_type THEN 'value:type'
        WHEN NOT payload.event_type <=> event_type THEN 'payload:tag'{by_type} END"""
    envelope = _code_list(rules)
    return f"IF(__invalid_json, 'json', concat_ws(',', nullif({envelope}, ''), nullif({payload}, '')))"


def reason_sql() -> str:
    """First matching reason of a record that fails the contract; null if it passes.

    A null never slips through a comparison: absent values count as violations.
    """
    reasons = [
        ("invalid_json", "__invalid_json"),
        ("type_mismatch", "__wrong_type"),
        ("missing_event_id", "event_id IS NULL"),
        ("unsupported_schema_version", f"NOT schema_version <=> '{C.SCHEMA_VERSION}'"),
        ("unknown_event_type", f"event_type IS NULL OR NOT {_one_of('event_type', C.EVENT_TYPES)}"),
        ("payload_type_mismatch", "NOT payload.event_type <=> event_type"),
        ("missing_customer_id", "customer_id IS NULL"),
        ("missing_country", "country_code IS NULL"),
        ("missing_occurred_at", "__text_occurred_at IS NULL"),
        # Alone this is a business failure, which is named after the first arrival is chosen.
        ("invalid_event_time", "contract_codes <> '' AND ingested_at < occurred_at"),
        ("invalid_transaction_amount", "event_type = 'mobile_money_transaction' AND coalesce(payload.amount, 0) <= 0"),
        ("invalid_requested_amount", "event_type = 'loan_application' AND coalesce(payload.requested_amount, 0) <= 0"),
        (CONTRACT_RULE, "contract_codes <> ''"),
    ]
    return "CASE " + " ".join(f"WHEN {condition} THEN '{reason}'" for reason, condition in reasons) + " END"


def business_codes_sql() -> str:
    """Rules beyond structure, errors and warnings, as one code list. ``__as_of`` is the
    clock."""
    tolerance = f"INTERVAL '{FUTURE_TOLERANCE_MINUTES}' MINUTE"
    conditions = {
        "event_not_in_future": f"occurred_at > greatest(__as_of, ingested_at) + {tolerance}",
        "ingestion_after_occurrence": "ingested_at < occurred_at",
        "freshness_24h": f"ingested_at > occurred_at + INTERVAL '{LATE_AFTER_HOURS}' HOUR",
        "declined_amount_zero": "event_type = 'loan_decision' AND payload.decision <> 'approved' AND payload.approved_amount <> 0",
        "repayment_status_consistency": "event_type = 'repayment' AND payload.days_past_due = 0"
        " AND payload.payment_status IN ('late', 'partial')",
    }
    return _code_list([(rule, conditions[rule]) for rule in BUSINESS_RULES])


def check_contract(raw: DataFrame) -> DataFrame:
    """Row-local half of the gate: parsed events with ``contract_codes`` and ``reason``.

    Works on batch and streaming frames alike; no shuffle.
    """
    parsed = parse(raw).selectExpr("*", f"{contract_codes_sql()} AS contract_codes")
    public = [c for c in parsed.columns if not c.startswith("__")]
    return parsed.selectExpr(*public, f"{reason_sql()} AS reason")


def apply_business_rules(checked: DataFrame, as_of) -> DataFrame:
    """Row-local second half: adds ``business_codes``, the final ``reason``, ``outcome``
    and the ``late`` flag."""
    errors = ", ".join(f"'{r}'" for r, (severity, _) in BUSINESS_RULES.items() if severity == "error")
    others = [c for c in checked.columns if c != "reason"]
    codes = "split(business_codes, ',')"
    return (
        checked.withColumn("__as_of", instant(as_of))
        .selectExpr(*checked.columns, f"IF(reason IS NULL, {business_codes_sql()}, '') AS business_codes")
        .selectExpr(
            *others,
            "business_codes",
            f"""CASE WHEN reason IS NOT NULL THEN reason
                     WHEN array_contains({codes}, 'ingestion_after_occurrence') THEN 'invalid_event_time'
                     WHEN arrays_overlap({codes}, array({errors})) THEN 'business_rule' END AS reason""",
            f"array_contains({codes}, 'freshness_24h') AS late",
        )
        .selectExpr("*", f"IF(reason IS NULL, '{ACCEPTED}', '{QUARANTINED}') AS outcome")
    )


def gate(
    raw: DataFrame, as_of, order_by: Sequence[str] = ("kafka_partition", "kafka_offset"), columns: Sequence[str | Column] | None = None
) -> DataFrame:
    """Judge raw records.

    ``raw`` holds ``raw_value`` and the columns of ``order_by``, which define arrival
    order and identify a record. The result has one row per distinct valid event (its
    first arrival, ``copies`` counts all of them) and one per failing record.

    ``columns`` names what is wanted of a judged row besides ``copies``, or derives it from one.
    Only that is shuffled then, where otherwise each record is with its text and its payload.
    """
    checked = check_contract(raw)
    # Failing records get a key of their own, so that they neither meet in one group
    # nor compete with valid events.
    holds = F.col("reason").isNull()
    record = F.concat_ws("/", F.lit("record"), *[F.col(c).cast("string") for c in order_by])
    if columns is not None:
        # The business rules look at one record alone, so they may come before the choice. Ids are
        # packed meanwhile.
        key = F.when(holds, packed("event_id", holds)).otherwise(F.concat(F.lit(_RECORD), record).cast("binary"))
        judged = apply_business_rules(checked.withColumns({"__group": key, "__holds": holds}), as_of)
        ids = [f.name for f in C.ENVELOPE if f.kind == "uuid" and any(isinstance(c, str) and c == f.name for c in columns)]
        place = [f"__place_{c}" for c in order_by]
        narrow = judged.select(
            "__group",
            *[F.col(c).alias(p) for c, p in zip(order_by, place, strict=True)],
            *[packed(c, F.col("__holds")).alias(c) if isinstance(c, str) and c in ids else c for c in columns],
        )
        first = first_by(narrow, ["__group"], place, copies="copies", columns=[c for c in narrow.columns if not c.startswith("__")])
        return first.withColumns({c: unpacked(F.col(c)) for c in ids}) if ids else first
    keyed = checked.withColumn("__group", F.when(holds, F.col("event_id")).otherwise(record))
    distinct = first_by(keyed, ["__group"], order_by, copies="copies").drop("__group")
    return apply_business_rules(distinct, as_of)


def packed(uuid: str, holds: Column) -> Column:
    """A UUID text as its 16 bytes, which a shuffle carries in place of 36. Where it is not known
    to hold its form, the text itself with a mark, which is longer."""
    text = F.col(uuid)
    bytes_ = F.unhex(F.replace(text, F.lit("-"), F.lit("")))
    return F.when(holds & (F.length(text) == 36), bytes_).otherwise(F.concat(F.lit(_UNPACKED), text).cast("binary"))


def unpacked(column: Column) -> Column:
    """The text of ``packed``."""
    text = F.lower(F.hex(column))
    for place in (9, 14, 19, 24):
        text = F.overlay(text, F.lit("-"), F.lit(place), F.lit(0))
    return F.when(F.octet_length(column) == 16, text).otherwise(F.substring(column.cast("string"), len(_UNPACKED) + 1, 1 << 30))


def accepted(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("outcome") == ACCEPTED)


def quarantined(gated: DataFrame) -> DataFrame:
    return gated.filter(F.col("outcome") == QUARANTINED)


def issues(gated: DataFrame) -> DataFrame:
    """Judged rows with issues, once for each, with its rule and severity."""
    severity = F.create_map(*[F.lit(x) for r, (s, _) in BUSINESS_RULES.items() for x in (r, s)])
    failed_contract = F.col("contract_codes") != ""
    flagged = gated.filter(failed_contract | (F.col("business_codes") != ""))
    rules = F.when(failed_contract, F.array(F.lit(CONTRACT_RULE))).otherwise(F.split("business_codes", ","))
    exploded = flagged.withColumn("rule", F.explode(rules))
    return exploded.withColumn("severity", F.when(F.col("rule") == CONTRACT_RULE, "error").otherwise(F.try_element_at(severity, F.col("rule"))))


def issue_log(gated: DataFrame) -> DataFrame:
    """One row per issue, warnings included: event id, rule, severity, message.

    A record that fails the contract has one ``schema_contract`` issue whose message
    lists the codes; it carries no event id, since its id cannot be trusted.
    """
    message = F.create_map(*[F.lit(x) for r, (_, m) in BUSINESS_RULES.items() for x in (r, m)])
    is_contract = F.col("rule") == CONTRACT_RULE
    keep = [c for c in gated.columns if c.startswith("kafka_")]
    return issues(gated).select(
        *keep,
        F.when(~is_contract, F.col("event_id")).alias("event_id"),
        "rule",
        "severity",
        F.when(is_contract, F.col("contract_codes")).otherwise(F.try_element_at(message, F.col("rule"))).alias("message"),
    )
