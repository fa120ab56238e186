"""Counters, thresholds, uniqueness and reconciliation; profiles of values, days and years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Bounds of count buckets: 1, 5, then ten steps in every power of ten up to a hundred million.
BOUNDS = sorted({1, 5} | {step * 10**e for e in range(1, 8) for step in range(1, 11)})


def counters(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: all rows, and how many meet each condition."""
    return df.agg(F.count("*").alias("n"), *(F.count_if(c).alias(name) for name, c in conditions.items()))


def breaches(counted: DataFrame, limit_percent: float, names: Sequence[str]) -> DataFrame:
    """(name, share): the counters whose share of all rows is above the limit."""
    pairs = F.array(*(F.struct(F.lit(c).alias("name"), F.round(F.when(F.col("n") > 0, F.col(c) * 100.0 / F.col("n")), 4).alias("share")) for c in names))
    return counted.select(F.inline(pairs)).filter(F.col("share") > limit_percent)


def require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


def repeated(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def reconcile(a: DataFrame, b: DataFrame, bucket: str) -> DataFrame:
    """(bucket, a_rows, b_rows, equal) of two tables."""
    left, right = (t.groupBy(bucket).agg(F.count("*").alias(n)) for t, n in ((a, "a_rows"), (b, "b_rows")))
    joined = left.join(right, bucket, "full").select(bucket, F.coalesce("a_rows", F.lit(0)).alias("a_rows"), F.coalesce("b_rows", F.lit(0)).alias("b_rows"))
    return joined.withColumn("equal", F.col("a_rows") == F.col("b_rows"))


def row_ids_complete(df: DataFrame, bucket: str, row_id: str) -> DataFrame:
    """(bucket, n, max_row_id, equal): whether the greatest row id of a bucket is its number of rows."""
    return df.groupBy(bucket).agg(F.count("*").alias("n"), F.max(row_id).cast("bigint").alias("max_row_id")).withColumn("equal", F.col("n") == F.col("max_row_id"))


def columns_by_line(df: DataFrame, text: str, separator: str = "|") -> DataFrame:
    """(n_columns, n_lines): how many lines of all texts have so many columns; lines fold to counts before the shuffle."""
    lines = df.select(F.explode(F.split(text, "\n")).alias("line"))
    n = F.length("line") - F.length(F.replace("line", F.lit(separator), F.lit(""))) + 1
    return lines.groupBy(n.cast("bigint").alias("n_columns")).agg(F.count("*").alias("n_lines"))


def value_counts(df: DataFrame, column: str, entity: str) -> DataFrame:
    """Rows and distinct entities per value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.countDistinct(entity).alias("n_entities"), F.count("*").alias("n_rows"))


def count_bucket(n: Column) -> Column:
    """The greatest of BOUNDS that is not above n, found by its power of ten; null below 1. Counts above the last bound fall into it."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(n + F.lit(0.5)))).cast("bigint")
    step = F.when(n < 5, 1).when(n < 10, 5).otherwise(F.floor(n / power) * power)
    return F.when(n >= 1, F.least(step, F.lit(BOUNDS[-1]))).cast("bigint")


def log_histogram(df: DataFrame, entity: str) -> DataFrame:
    """Entities per bucket of their number of rows."""
    counted = df.groupBy(entity).agg(F.count("*").alias("__n"))
    return counted.groupBy(count_bucket(F.col("__n")).alias("bucket")).agg(F.count("*").alias("n_entities"))


def day_strings(df: DataFrame, entity: str, day: Column) -> DataFrame:
    """(entity, days 'd:c,d:c' in order, total); days are counted before they are listed."""
    daily = df.groupBy(entity, day.alias("d")).agg(F.count("*").alias("c"))
    item = F.struct("d", F.concat_ws(":", F.col("d").cast("string"), F.col("c").cast("string")).alias("s"))
    return daily.groupBy(entity).agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"]), ",").alias("days"), F.sum("c").alias("total"))


def nested_days(df: DataFrame, outer: str, inner: str, day: Column) -> DataFrame:
    """(outer, JSON of inner -> day -> count), keys in order. A row holds one entry per inner key and day, whatever the number of rows."""
    daily = df.groupBy(outer, inner, day.cast("string").alias("d")).agg(F.count("*").alias("c"))
    per = daily.groupBy(outer, inner).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("d", "c")))).alias("m"))
    by_key = lambda a, b: F.when(a[inner] < b[inner], -1).when(a[inner] > b[inner], 1).otherwise(0)
    return per.groupBy(outer).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(inner), "m")), by_key))).alias("raw"))


def year_cohorts(df: DataFrame, entity: str, year: Column) -> DataFrame:
    """(year, n_rows, n_entities, n_first): entities by year, and by the year they first appear; year 0 has the totals."""
    each = df.select(F.col(entity).alias("e"), year.cast("bigint").alias("year")).filter("year is not null")
    yearly = each.groupBy("year").agg(F.count("*").alias("n_rows"), F.countDistinct("e").alias("n_entities"))
    first = each.groupBy("e").agg(F.min("year").alias("year")).groupBy("year").agg(F.count("*").alias("n_first"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = yearly.join(first, "year", "left").select("year", "n_rows", "n_entities", zero("n_first").alias("n_first"))
    whole = each.agg(F.count("*").alias("n_rows"), F.countDistinct("e").alias("n_entities")).select(F.lit(0).cast("bigint").alias("year"), "n_rows", "n_entities", F.col("n_entities").alias("n_first"))
    return rows.unionByName(whole)


def observed_range(tables: dict[str, DataFrame], entity: str, at: str) -> DataFrame:
    """(entity, source, first_ts, last_ts) per table, and over all of them as ALL_TABLES."""
    each = [t.groupBy(F.col(entity).alias("entity")).agg(F.min(at).alias("first_ts"), F.max(at).alias("last_ts")).withColumn("source", F.lit(n)) for n, t in tables.items()]
    union = each[0]
    for t in each[1:]:
        union = union.unionByName(t)
    whole = union.groupBy("entity").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")).withColumn("source", F.lit("ALL_TABLES"))
    return union.unionByName(whole).select("entity", "source", "first_ts", "last_ts")
