"""Parquet and delimited sinks with counts taken in the same job."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..operators.blocks import numbered


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = (), columns: Sequence[str] | None = None) -> int:
    """Overwrites a Parquet folder and returns how many rows went in, counted while writing."""
    seen = Observation("written")
    out = (df.select(*columns) if columns else df).observe(seen, F.count(F.lit(1)).alias("n"))
    writer = out.write.mode("overwrite").option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return int(seen.get["n"])


def blocks(df: DataFrame, bucket: str, order: Sequence[Column], out: str = "row_id") -> DataFrame:
    """One layout per bucket: rows numbered and sorted within it."""
    return numbered(df, [bucket], order, out).repartition(bucket).sortWithinPartitions(bucket, out)


def write_delimited(df: DataFrame, path: str, sep: str = "|", single: bool = False, header: bool = False) -> None:
    """Delimited text; ``single`` for small tables only: it is one task."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, sep=sep, header=header, emptyValue="")


def header_text(df: DataFrame, sep: str = "|") -> str:
    """The two-line side-car of names and type names."""
    from .readers import type_name

    return "\n".join(sep.join(x) for x in ([f.name for f in df.schema.fields], [type_name(f.dataType) for f in df.schema.fields])) + "\n"


def write_header(df: DataFrame, path: str, sep: str = "|") -> None:
    Path(path).write_text(header_text(df, sep))


def bucket_files(df: DataFrame, path: str, bucket: str, sep: str = "|") -> list[str]:
    """One headerless file per bucket, named by it (part_<bucket>.final); returns their paths. A bucket with more than one file is an error."""
    from .readers import listing

    spark = df.sparkSession
    df.repartition(bucket).write.mode("overwrite").option("emptyValue", "").partitionBy(bucket).csv(path + ".parts", sep=sep)
    out, fs_path = [], spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(path))
    for folder in listing(spark, path + ".parts"):
        if not folder.startswith(f"{bucket}="):
            continue
        files = [f for f in listing(spark, f"{path}.parts/{folder}") if f.startswith("part-")]
        if len(files) != 1:
            raise ValueError(f"{folder} has {len(files)} files")
        out.append(f"{path}/part_{folder.split('=', 1)[1]}.final")
        fs.rename(fs_path(f"{path}.parts/{folder}/{files[0]}"), fs_path(out[-1]))
    fs.delete(fs_path(path + ".parts"), True)
    return out


def write_stats(stats: dict, path: str) -> None:
    Path(path).write_text(json.dumps(stats, indent=1, sort_keys=True))


def unresolved(df: DataFrame, key: str, entity: str) -> DataFrame:
    """Distinct keys that have no identity."""
    return df.filter(F.col(entity) == 0).select(key).distinct()
