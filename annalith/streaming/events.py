"""The batch operators' nearest relatives on streams: windows, sessions and versioned upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def tumbling(df: DataFrame, at: str, width: str, keys: list[str], late: str | None = None, **aggregates: Column) -> DataFrame:
    """Aggregates per window and keys; on a stream ``late`` is the watermark."""
    if late and df.isStreaming:
        df = df.withWatermark(at, late)
    return df.groupBy(F.window(at, width).alias("w"), *keys).agg(*(a.alias(n) for n, a in aggregates.items())).select(F.col("w.start").alias("window_start"), *keys, *aggregates)


def sessions(df: DataFrame, at: str, gap: str, keys: list[str], late: str | None = None, **aggregates: Column) -> DataFrame:
    """Aggregates per session of events closer than ``gap``."""
    if late and df.isStreaming:
        df = df.withWatermark(at, late)
    return df.groupBy(F.session_window(at, gap).alias("w"), *keys).agg(*(a.alias(n) for n, a in aggregates.items())).select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, *aggregates)


def upsert_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True):
    """Runs a batch operator (such as a merge with history) on every micro-batch."""
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
