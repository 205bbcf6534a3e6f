"""Typed values from legacy text: dates, money, codes.  Nothing here raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, trim_u

# Fixed values of the target model.
NO_DATE = "0000-00-00"
GENDERS = {"M": "male", "F": "female"}
MARITAL = ("single", "married", "divorced", "widowed", "separated", "cohabiting", "other")
STATUS = {"0": "pending", "1": "confirmed", "2": "completed", "3": "cancelled"}
SCHEDULE_STATES = ("0", "1", "2")
NEAR_ZERO = 1e-4


def sentinel_to_null(text: Column) -> Column:
    """Null for a blank or the no-date sentinel; anything else unchanged."""
    return F.when((trim_u(text) != "") & (trim_u(text) != NO_DATE), text)


def lenient_date(text: Column) -> Column:
    return F.try_to_date(sentinel_to_null(text).cast("string"), "yyyy-MM-dd")


def strict_date(text: Column) -> Column:
    """A date of the shape yyyy-mm-dd that the calendar has; else null."""
    x = trim_u(text)
    return F.when(x.rlike(r"^\d{4}-\d{2}-\d{2}$") & (x != NO_DATE), F.try_to_date(x, "yyyy-MM-dd"))


def invalid_date(text: Column) -> Column:
    """True for what has a date's shape or any other content, but is no date."""
    return sentinel_to_null(text).isNotNull() & strict_date(text).isNull()


def _mapped(x: Column, names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(v) for pair in names.items() for v in pair]), x)


def gender(code: Column) -> Column:
    return _mapped(F.upper(trim_u(code)), GENDERS)


def marital_status(text: Column, codes: dict[str, str] | None = None) -> Column:
    """A known word, in any case; with ``codes`` also one-letter codes; else null."""
    x = F.lower(trim_u(text))
    word = F.when(x.isin(*MARITAL), x)
    return F.coalesce(word, _mapped(F.upper(trim_u(text)), codes)) if codes else word


def appointment_status(code: Column) -> Column:
    return F.coalesce(_mapped(trim_u(code.cast("string")), STATUS), F.lit("pending"))


def unknown_status(code: Column) -> Column:
    return F.coalesce(code.isNotNull() & ~trim_u(code.cast("string")).isin(*STATUS), F.lit(False))


def phone(private: Column, work: Column | None = None) -> Column:
    """The private number unless blank or 0, then the one at work."""
    first = F.nullif(blank_to_null(private), F.lit("0"))
    return first if work is None else F.coalesce(first, F.nullif(blank_to_null(work), F.lit("0")))


def integer_prefix(text: Column) -> Column:
    """Leading integer as parse functions of scripting languages read it; null without one."""
    return F.nullif(F.regexp_extract(text, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("bigint")


def number_prefix(text: Column) -> Column:
    """Leading decimal number as double; null without one."""
    return F.nullif(F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1), F.lit("")).try_cast("double")


def decimal_comma(text: Column) -> Column:
    """A number with a comma for its point, as double; blank or no number is 0.  Only the first comma counts."""
    return F.coalesce(number_prefix(F.regexp_replace(text, "^([^,]*),", "$1.")), F.lit(0.0))


def money(value: Column) -> Column:
    return F.round(value, 2).try_cast("decimal(10,2)")


def visit_fee(text: Column) -> Column:
    return money(number_prefix(text))


def is_zero(value: Column) -> Column:
    return F.abs(value) < NEAR_ZERO


def doctor_code(text: Column) -> Column:
    """The code of a doctor; blank and 0 mean none."""
    return F.nullif(integer_prefix(F.nullif(blank_to_null(text), F.lit("0"))), F.lit(0).cast("bigint"))


def cash_route(day: Column, income: Column, expense: Column) -> Column:
    """Where a cash entry goes: excluded_date, omitted, excluded_both, income or expense."""
    return (
        F.when(trim_u(day.cast("string")) == NO_DATE, "excluded_date")
        .when(is_zero(income) & is_zero(expense), "omitted")
        .when(~is_zero(income) & ~is_zero(expense), "excluded_both")
        .when(~is_zero(income), "income")
        .otherwise("expense")
    )


def payload_hash(*columns: str) -> Column:
    """SHA-256 of the row as JSON with sorted names; nulls count."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)
