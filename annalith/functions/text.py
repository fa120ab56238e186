"""Column expressions on text shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def clean(c: Column) -> Column:
    """Trimmed of white space; blank becomes null."""
    t = F.btrim(c, F.lit(" \t\n\x0b\f\r"))
    return F.when(t != "", t)


def folded(c: Column) -> Column:
    """Trimmed, lower case; blank becomes null."""
    return F.lower(clean(c))


def version_milli(c: Column) -> Column:
    """A version such as '4.001', ' 4.0010' or '4' as an integer of thousandths; null if it is no number."""
    return (clean(c).try_cast("decimal(20,6)") * 1000).cast("bigint")


def version_text(milli: Column) -> Column:
    """Thousandths back to 'major.mmm'; 0 is '0.0'."""
    return F.when(milli == 0, F.lit("0.0")).otherwise(F.format_string("%d.%03d", F.floor(milli / 1000), F.pmod(milli, F.lit(1000))))


def present(*cols: Column) -> Column:
    """A 64-bit hash of values that tells nulls apart by position."""
    parts = []
    for c in cols:
        parts += [F.isnull(c), c]
    return F.xxhash64(*parts)


def fenced(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that later filters and projections use as values, never by repeating their expressions."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items())))))
