"""Bucket ids, key and row hashes, surrogate ids and packed 64-bit guids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

IDS_PER_FILE = 10_000
SPLITS = 5
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def bucket_id(entity: Column, buckets: int) -> Column:
    """The bucket of an entity: one file of ids per residue."""
    return (F.pmod(entity, F.lit(buckets)) * IDS_PER_FILE + 1).cast("int")


def split_bucket_id(entity: Column, buckets: int) -> Column:
    """The bucket of an entity in a large table, where every bucket is split in SPLITS."""
    part = F.pmod(F.floor(entity / buckets), F.lit(SPLITS))
    return (bucket_id(entity, buckets) + part * (IDS_PER_FILE // SPLITS)).cast("int")


def base_bucket(bucket: Column) -> Column:
    return (F.floor(bucket / IDS_PER_FILE) * IDS_PER_FILE + 1).cast("int")


def with_bucket(df: DataFrame, entity: str, buckets: int, out: str = "bucket_id", split: bool = False) -> DataFrame:
    """Adds the bucket unless the frame has one already."""
    return df if out in df.columns else df.withColumn(out, (split_bucket_id if split else bucket_id)(F.col(entity), buckets))


def key_order(columns: Sequence[str]) -> list[str]:
    """The order in which key columns are joined: by upper-case name with the ending _NA, a.b being a__b. So CODE_DK goes before CODE."""
    return sorted(columns, key=lambda c: f"{c.replace('.', '__').upper()}_NA")


def key_text(df: DataFrame, columns: Sequence[str], zero_numbers: bool = True) -> Column:
    """Values of the columns in ``key_order``, joined by '|'; null is '0' for numbers (if zero_numbers) and '' otherwise."""
    parts = []
    for name in key_order(columns):
        numeric = zero_numbers and isinstance(df.select(name).schema.fields[0].dataType, NUMERIC)
        parts.append(F.coalesce(F.col(name).cast("string"), F.lit("0" if numeric else "")))
    return F.concat_ws("|", *parts)


def key_hash(df: DataFrame, columns: Sequence[str], zero_numbers: bool = True) -> Column:
    """SHA-256 of the business key."""
    return F.sha2(key_text(df, columns, zero_numbers), 256)


NULL_MARK = "\x01"


def row_md5(columns: Sequence[str]) -> Column:
    """MD5 of the row's values joined by '|'. A null has a mark of its own, so a value that moves to another column changes the hash."""
    return F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in columns)))


def surrogate_id(df: DataFrame, columns: Sequence[str], absolute: bool = False) -> Column:
    """A 64-bit id of the columns' values, taken and filled as in ``key_text``; of one column, its own hash, null where it is null."""
    one = len(columns) == 1
    hashed = F.xxhash64(F.col(columns[0]) if one else key_text(df, columns))
    hashed = F.abs(hashed) if absolute else hashed
    return F.when(F.col(columns[0]).isNotNull(), hashed) if one else hashed


def pack_guid(table_id: Column, key_id: Column, fact_key_id: Column) -> Column:
    """8 bits of table, 28 of key, 28 of the fact's number within the key."""
    return F.shiftleft(table_id.cast("bigint"), 56).bitwiseOR(F.shiftleft(key_id.cast("bigint"), 28)).bitwiseOR(fact_key_id.cast("bigint"))


def unpack_guid(guid: Column) -> tuple[Column, Column, Column]:
    mask = F.lit((1 << 28) - 1)
    return F.shiftrightunsigned(guid, 56).cast("bigint"), F.shiftrightunsigned(guid, 28).bitwiseAND(mask), guid.bitwiseAND(mask)


def pack_pair(high: Column, low: Column) -> Column:
    """Two 32-bit ids in one."""
    return F.shiftleft(high.cast("bigint"), 32).bitwiseOR(low.cast("bigint"))
