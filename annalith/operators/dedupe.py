"""Duplicates of raw deliveries: newest first, drop indicators, false updates and reprocessing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .blocks import numbered

#: Classes of raw rows, and those that are not kept.
CLASSES = ("VALIDATION", "RAW_DUPLICATE", "RE_PROCESSED_DUPLICATE", "FACT_ONLY_PATIENT", "RE_PROCESSED_RECORDS", "RAW_RECORDS")
DROPPED = CLASSES[:4]


def mark_duplicates(df: DataFrame, key: Sequence[str], newest: Sequence[str], out: str = "is_duplicate") -> DataFrame:
    """Marks all rows of a key but the newest (descending, nulls last); a key with very many copies is sorted by many tasks."""
    ranked = numbered(df, key, [F.col(c).desc_nulls_last() for c in newest], "__n")
    return ranked.withColumn(out, F.col("__n") > 1).drop("__n")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return numbered(df, key, order, "__n").filter("__n = 1").drop("__n")


def newest_rows(df: DataFrame, key: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per key by an aggregate with map-side combine: the greatest by ``newest``, then by the rest; nulls are least."""
    rest = [c for c in df.columns if c not in key and c not in newest]
    return df.groupBy(*key).agg(F.max(F.struct(*newest, *rest)).alias("__r")).select(*key, *(f"__r.{c}" for c in [*newest, *rest])).select(*df.columns)


def drop_indicator(duplicate: Column, row_id: Column, entity: Column, marker: Column, prefix: str) -> Column:
    """The class of a raw row, first match wins."""
    return (
        F.when(marker.startswith(prefix), CLASSES[0]).when(duplicate & (row_id == 0), CLASSES[1]).when(duplicate & (row_id != 0), CLASSES[2])
        .when(entity == 0, CLASSES[3]).when(row_id != 0, CLASSES[4]).otherwise(CLASSES[5])
    )


def indicator_stats(df: DataFrame, column: str = "indicator") -> DataFrame:
    """Counts per class with the totals of raw and reprocessed rows."""
    count = lambda *names: F.count_if(F.col(column).isin(*names))
    return df.agg(*(count(c).alias(c.lower()) for c in CLASSES), count("RAW_RECORDS", "RAW_DUPLICATE").alias("raw_total"), count("RE_PROCESSED_RECORDS", "RE_PROCESSED_DUPLICATE").alias("re_processed_total"))


def false_updates(new: DataFrame, old: DataFrame, key: str, row_hash: str) -> DataFrame:
    """New rows but those whose key is known with the same row hash; rows without history stay."""
    known = old.select(key, row_hash).distinct()
    return new.join(known, [key, row_hash], "left_anti")


def with_history(new: DataFrame, past: DataFrame, changed: DataFrame, entity: str, batch: str) -> DataFrame:
    """New rows and the past rows of entities whose identity changed, the latter as batch 0."""
    return new.unionByName(past.join(changed.select(entity).distinct(), entity, "left_semi").withColumn(batch, F.lit(0)), allowMissingColumns=True)
