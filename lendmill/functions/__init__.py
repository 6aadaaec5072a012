"""Scalar column functions shared by gate, marts and serving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendmill.contract import COUNTRY_NAMES


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: Column | str, digits: int) -> Column:
    """Decimal rounding of a double, free of binary tie effects."""
    return F.round(_col(value).cast("decimal(38,10)"), digits).cast("double")


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` as a double; null when there is no denominator."""
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def lag_micros(later: Column | str, earlier: Column | str) -> Column:
    """Difference of two instants in whole microseconds."""
    return F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))


def lag_seconds(later: Column | str, earlier: Column | str) -> Column:
    """Difference of two instants in seconds."""
    return lag_micros(later, earlier) / F.lit(1e6)


def id_token(identifier: Column | str) -> Column:
    """Displayable stub of an identifier: its first eight characters."""
    return F.concat(F.left(_col(identifier).cast("string"), F.lit(8)), F.lit("…"))


def risk_band(score: Column | str) -> Column:
    """Band of a credit score; the thresholds are fixed values."""
    s = _col(score)
    return (
        F.when(s < 450, "very_high")
        .when(s < 550, "high")
        .when(s < 650, "medium")
        .when(s < 750, "low")
        .otherwise("very_low")
    )


def pseudonym(value: Column | str, salt: str) -> Column:
    """Keyed SHA-256 of an identifier, hex encoded. The salt is the caller's secret."""
    return F.sha2(F.concat(F.lit(f"{salt}:"), _col(value).cast("string")), 256)


def country_name(code: Column | str) -> Column:
    """Display name of a country code."""
    pairs = [F.lit(x) for item in COUNTRY_NAMES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), _col(code))


def minutes_before(as_of: Column, minutes: int) -> Column:
    return as_of - F.make_dt_interval(mins=F.lit(minutes))


def instant(as_of) -> Column:
    """A clock argument (datetime, ISO text or Column) as a timestamp column."""
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
