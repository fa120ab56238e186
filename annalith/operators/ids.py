"""Stable dense ids: append-only dictionaries, global or per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut, small
from .blocks import numbered


def number_globally(df: DataFrame, order: str, out: str = "n") -> DataFrame:
    """Dense numbers from 1 over distinct values of a column, without a one-task window.

    The values are split into ranges; each range is numbered by itself and shifted by the sizes of the
    ranges before it, of which there are as many as partitions.
    """
    values = df.select(order).distinct()
    # written once: numbering and sizes must see the same ranges
    parted = cut(values.repartitionByRange(order).withColumn("__part", F.spark_partition_id()))
    ranked = parted.withColumn("__n", F.row_number().over(W.partitionBy("__part").orderBy(order)))
    sizes = parted.groupBy("__part").agg(F.count("*").alias("__size"))
    shifts = sizes.withColumn("__shift", F.coalesce(F.sum("__size").over(W.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__part", "__shift")
    return ranked.join(small(shifts), "__part").select(order, (F.col("__n") + F.col("__shift")).cast("bigint").alias(out))


def extend_dictionary(known: DataFrame, values: DataFrame, value: str, id_col: str) -> DataFrame:
    """The dictionary (id_col, value) with ids for new non-null values: the greatest id of the whole dictionary plus their rank."""
    fresh = values.select(value).filter(F.col(value).isNotNull()).distinct().join(known.select(value), value, "left_anti")
    top = known.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("__top"))
    new = number_globally(fresh, value, "__n").join(F.broadcast(top)).select((F.col("__n") + F.col("__top")).alias(id_col), value)
    return known.select(F.col(id_col).cast("bigint").alias(id_col), value).unionByName(new)


def extend_per_entity(known: DataFrame, values: DataFrame, entity: str, value: str, id_col: str) -> DataFrame:
    """The same within every entity."""
    fresh = values.select(entity, value).filter(F.col(value).isNotNull()).distinct().join(known.select(entity, value), [entity, value], "left_anti")
    top = known.groupBy(entity).agg(F.max(id_col).cast("bigint").alias("__top"))
    new = numbered(fresh, [entity], [F.col(value)], "__n", bound=values).join(top, entity, "left").select(entity, (F.col("__n") + F.coalesce("__top", F.lit(0))).cast("bigint").alias(id_col), value)
    return known.select(entity, F.col(id_col).cast("bigint").alias(id_col), value).unionByName(new)


def one_to_one(mapping: DataFrame, a: str, b: str) -> DataFrame:
    """Values of either side that meet more than one of the other: (side, value, n)."""
    side = lambda x, y: mapping.groupBy(F.col(x).cast("string").alias("value")).agg(F.countDistinct(y).alias("n")).filter("n > 1").select(F.lit(x).alias("side"), "value", "n")
    return side(a, b).unionByName(side(b, a))


def compact_hashes(rows: DataFrame, entity: str, row: str, fields: Sequence[str], known: DataFrame, id_col: str = "hash_id") -> tuple[DataFrame, DataFrame]:
    """(rows with every hash replaced by its per-entity id, extended dictionary (entity, id, value))."""
    long = rows.select(entity, row, *fields).unpivot([entity, row], list(fields), "field", "value").filter("value is not null")
    dictionary = extend_per_entity(known, long, entity, "value", id_col)
    wide = long.join(dictionary, [entity, "value"]).groupBy(entity, row).pivot("field", list(fields)).agg(F.max(id_col))
    return wide, dictionary
