"""Timestamps of known shapes, ages, categories, delimited fields, unit formulas and null rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

YEAR_SECONDS = 31_536_000
BAD_DATE = -2_209_008_070
#: Formats tried in order on texts without a declared format.
LADDER = (
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}[+-][0-9]{2}:[0-9]{2}$", "yyyy-MM-dd'T'HH:mm:ssXXX"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy-MM-dd'T'HH:mm:ss"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd"),
)
#: The format of a text by its length.
BY_LENGTH = {29: "yyyy-MM-dd HH:mm:ss.SSSSSS a", 26: "yyyy-MM-dd HH:mm:ss.SSSSSS", 19: "yyyy-MM-dd HH:mm:ss", 10: "yyyy-MM-dd"}


def seconds(ts: Column) -> Column:
    """Epoch seconds of a timestamp without zone, taken as UTC whatever the session's zone."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts) / F.lit(1_000_000)).cast("bigint")


def _parsed(text: Column, fmt: str) -> Column:
    """Epoch seconds. A format with an offset gives the instant; one without is read as UTC, whatever the session's zone."""
    if fmt.endswith("X"):
        return F.floor(F.unix_micros(F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ltz")) / F.lit(1_000_000)).cast("bigint")
    return seconds(F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz"))


def parse_ladder(text: Column, fmt: str | None = None, relative_to: Column | None = None) -> Column:
    """Epoch seconds of a text: relative seconds to an epoch, a fixed format, or the LADDER; null if nothing fits."""
    if relative_to is not None:
        return text.try_cast("bigint") + relative_to
    if fmt:
        return _parsed(text, fmt)
    out = F.lit(None).cast("bigint")
    for pattern, each in reversed(LADDER):
        out = F.when(text.rlike(pattern), _parsed(text, each)).otherwise(out)
    return out


def parse_by_length(text: Column, formats: dict[int, str] = BY_LENGTH, default: int | None = BAD_DATE, offset: Column | None = None) -> Column:
    """Epoch seconds of a text: a whole number counts from ``offset`` (else from 1970), whatever its length; else by the format of its length, or as a bare date; else the default."""
    number = text.try_cast("bigint") + (F.coalesce(offset, F.lit(0)) if offset is not None else F.lit(0))
    out = _parsed(text, "yyyy-MM-dd")
    for length, fmt in formats.items():
        out = F.when(F.length(text) == length, _parsed(text, fmt)).otherwise(out)
    return F.coalesce(number, out, F.lit(default).cast("bigint"))


def age_years(event: Column, birth: Column) -> Column:
    """Whole years of 365 days, towards zero."""
    return ((event - birth) / YEAR_SECONDS).cast("bigint")


def event_time(primary: Column, others: Sequence[Column]) -> Column:
    """When an event happened: its own time, else the least of all its times."""
    return F.coalesce(primary, F.array_min(F.array(primary, *others)))


def birth_from_age(day: Column, age: Column) -> Column:
    """The day ``age`` years earlier; '89+' counts as 90."""
    years = F.when(age == "89+", 90).otherwise(age.try_cast("int"))
    return F.add_months(day, years * -12)


def ladder(text: Column, rules: Sequence[tuple[str, str, str]], default: str) -> Column:
    """The first label whose rule ('is', 'starts', 'has') holds for the lower-case text."""
    low, out = F.lower(text), F.lit(default)
    tests = {"is": lambda v: low == v, "starts": lambda v: low.startswith(v), "has": lambda v: low.contains(v)}
    for how, value, label in reversed(rules):
        out = F.when(tests[how](value), label).otherwise(out)
    return out


def sorted_tokens(text: Column, separator: str, joiner: str) -> Column:
    """The tokens in order; a '|' in them becomes '-'."""
    return F.array_join(F.array_sort(F.split(F.replace(text, F.lit("|"), F.lit("-")), separator)), joiner)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def apply_formula(value: Column, formula: Column) -> Column:
    """'_value * n' and '_value / n' with any spaces; every other formula leaves the value."""
    pattern = r"^\s*_value\s*([*/])\s*([0-9.]+)\s*$"
    op, number = F.regexp_extract(formula, pattern, 1), F.regexp_extract(formula, pattern, 2).try_cast("double")
    return F.when(op == "*", value * number).when((op == "/") & (number != 0), value / number).otherwise(value)
