"""Lookup, null-safe, nearest and interval joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import scanned, small
from .blocks import blocked, running


def lookup_left(df: DataFrame, lookup: DataFrame, on: str | list[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join with a lookup (broadcast if its size allows); missing values take their defaults."""
    joined = df.join(small(lookup), on, "left")
    return joined.fillna(defaults) if defaults else joined


def tidy_null(df: DataFrame, column: str) -> Column:
    """Null for blanks and NaN."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, T.StringType):
        return F.when(c != "", c)
    return F.when(~F.isnan(c), c) if isinstance(kind, (T.FloatType, T.DoubleType)) else c


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where null meets null; blanks and NaN are nulls. The right side's keys are dropped."""
    a = left.withColumns({c: tidy_null(left, c) for c in on})
    b = right.select(*(tidy_null(right, c).alias(f"__{c}") for c in on), *(c for c in right.columns if c not in on))
    condition = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on))
    return a.join(b, condition, how).drop(*(f"__{c}" for c in on))


def no_fanout(lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """The lookup, after a check that no key occurs twice."""
    if not lookup.groupBy(*on).count().filter("count > 1").isEmpty():
        raise ValueError(f"the lookup has repeated keys on {list(on)}")
    return lookup


def guarded_left(df: DataFrame, lookup: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join that can't multiply rows: the lookup's keys are checked before, and the number of rows after."""
    out = df.join(small(no_fanout(lookup, on)), list(on), "left")
    before, after = df.count(), out.count()
    if before != after:
        raise ValueError(f"the join on {list(on)} made {after} rows of {before}")
    return out


def rule_join(facts: DataFrame, rules: DataFrame, key: Sequence[str], attributes: Sequence[str], token: str | None = None) -> DataFrame:
    """Facts with their rules: equal on ``key``, null-safe on ``attributes``, all trimmed and without case; with ``token`` also the same token.

    Every matching rule gives a row. The rules' own key columns are dropped.
    """
    on = [*key, *attributes, *([token] if token else [])]
    tidy = lambda c: F.nullif(F.lower(F.trim(F.col(c).cast("string"))), F.lit(""))
    a = facts.withColumns({f"__f_{c}": tidy(c) for c in on})
    b = rules.select(*(tidy(c).alias(f"__r_{c}") for c in on), *(c for c in rules.columns if c not in on))
    equal = [F.col(f"__f_{c}") == F.col(f"__r_{c}") for c in on if c not in attributes]
    null_safe = [F.col(f"__f_{c}").eqNullSafe(F.col(f"__r_{c}")) for c in attributes]
    return a.join(small(b), reduce(Column.__and__, [*equal, *null_safe])).drop(*(f"__f_{c}" for c in on), *(f"__r_{c}" for c in on))


def nearest(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, carry: Sequence[str], hot_rows: int | None = None) -> DataFrame:
    """For every left row the right row of the same entity nearest in time: carries ``carry`` and distance; of equal distances the earlier.

    Both sides fold to one row per entity and time. The last right row at or before and the first at or after
    come from two running values over these, in blocks for a hot entity, so no entity forms a product or one
    task. Left rows without any partner keep nulls. Of right rows at one time the one with the least carried values counts.
    """
    payload = F.struct(F.col(right_time).cast("bigint").alias("t"), *(F.col(c) for c in carry))
    kind = right.select(payload.alias("p")).schema["p"].dataType
    asked = left.select(F.col(by).alias("__e"), F.col(left_time).cast("bigint").alias("__t")).distinct().select("*", F.lit(None).cast(kind).alias("__r"), F.lit(1).alias("__side"))
    others = right.filter(F.col(right_time).isNotNull()).groupBy(F.col(by).alias("__e"), F.col(right_time).cast("bigint").alias("__t")).agg(F.min(payload).alias("__r")).withColumn("__side", F.lit(0))
    union = blocked(asked.unionByName(others), ["__e"], "__t", hot_rows)
    past = running(union, ["__e"], ["__t", "__side"], {"__p": ("last", F.col("__r"))})
    both = running(past.withColumn("__side", -F.col("__side")), ["__e"], ["__t", "__side"], {"__n": ("last", F.col("__r"))}, reverse=True).filter("__side = -1")
    nearer = F.col("__p.t").isNotNull() & (F.col("__n.t").isNull() | (F.col("__t") - F.col("__p.t") <= F.col("__n.t") - F.col("__t")))
    found = both.select("__e", "__t", F.when(F.col("__t").isNotNull(), F.when(nearer, F.col("__p")).otherwise(F.col("__n"))).alias("__m"))
    joined = left.join(found, F.col(by).eqNullSafe(F.col("__e")) & F.col(left_time).cast("bigint").eqNullSafe(F.col("__t")), "left")
    return joined.select(*left.columns, *(F.col(f"__m.{c}").alias(c) for c in carry), F.abs(F.col("__t") - F.col("__m.t")).alias("distance"))


def within(points: DataFrame, spans: DataFrame, by: str, at: str, start: str, end: str) -> DataFrame:
    """Points joined with the spans of their entity that they lie strictly inside of; only spans with start < end count.

    Spans fall into levels by length, and on each level into cells of a quarter to the whole of that length. A
    point meets only the cells it lies in, one per level that there is, so an entity costs the pairs it
    yields and not the product of its rows.
    """
    length = (F.col(end) - F.col(start)).cast("double")
    leveled = scanned(spans.filter(F.col(start) < F.col(end)).withColumn("__level", F.floor(F.log2(length) / 2).cast("int")))
    width = F.expr("shiftleft(1L, 2 * __level)")
    cell = lambda c: F.floor(c / width).cast("bigint")
    placed = leveled.withColumn("__cell", F.explode(F.sequence(cell(F.col(start)), cell(F.col(end)))))
    levels = [r[0] for r in leveled.select("__level").distinct().collect()]  # at most 32, one per power of four
    asked = points.filter(F.col(at).isNotNull()).withColumn("__level", F.explode(F.lit(levels or [0]))).withColumn("__cell", cell(F.col(at)))
    return asked.join(placed, [by, "__level", "__cell"]).filter((F.col(start) < F.col(at)) & (F.col(at) < F.col(end))).drop("__level", "__cell")
