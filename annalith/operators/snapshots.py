"""What changed between full snapshots (problem 4).

The index of a snapshot is (key, hash of the compared values), stored in buckets by key and sorted in each.
A new snapshot is folded, hashed and written as the next index in the same buckets: that shuffles the new
rows alone, and only key and hash. Then the two indexes are probed against each other bucket by bucket,
without a shuffle or a sort, and swapped: the next one is in force and the last one goes. Old and new values
are fetched for changed keys alone.

Rows of one key and snapshot collapse map-side to the latest loaded one, so a hot key costs a bucket at
most one row per snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import folded, present, version_milli, version_text
from ..session import checkpoint_dir, cut, forget_at_end, small

COMPARED = ("map_fact_id", "fact_guid", "updated_milli")


def latest_rows(snapshots: DataFrame) -> DataFrame:
    """(key, snapshot, map_fact_id, fact_guid, updated_milli): of several rows of a key in a snapshot the latest loaded.

    Rows without key or version are ignored; a null loaded_dtm is the oldest; ties go to the greatest values.
    map_updated_by counts as a number, null or no number as 0.
    """
    rows = snapshots.select(
        folded(F.col("key_hash")).alias("key"),
        version_milli(F.col("version")).alias("snapshot"),
        F.struct(
            F.coalesce(F.unix_micros(F.col("loaded_dtm").cast("timestamp")), F.lit(-(1 << 62))).alias("at"),
            F.col("map_fact_id"),
            F.col("fact_guid"),
            F.coalesce(version_milli(F.col("map_updated_by")), F.lit(0)).alias("updated_milli"),
        ).alias("row"),
    ).filter("key is not null and snapshot is not null")
    return rows.groupBy("key", "snapshot").agg(F.max("row").alias("row")).select("key", "snapshot", *(f"row.{c}" for c in COMPARED))


class SnapshotIndex:
    """The stored key-to-hash index of the last snapshot, and the step to the next one."""

    def __init__(self, spark: SparkSession, buckets: int | None = None, folder: str | None = None):
        self.spark, self.version = spark, None
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"annalith_index_{uuid.uuid4().hex}"
        self.folder = folder or f"{checkpoint_dir(spark)}/{self.name}"
        self.current, self.generation = None, 0
        forget_at_end(spark, self.folder)

    def _write(self, rows: DataFrame) -> str:
        """The next index: one file per bucket, sorted by key."""
        table = f"{self.name}_{self.generation}"
        hashed = rows.select("key", present(*(F.col(c) for c in COMPARED)).alias("hash"))
        placed = hashed.repartition(self.buckets, "key")
        placed.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{self.generation}").saveAsTable(table)
        self.generation += 1
        return table

    def advance(self, rows: DataFrame, version: int) -> DataFrame | None:
        """Probes the index with the rows (key and compared values) of the snapshot ``version`` and puts theirs in its place.

        Returns the written changes (key, version, change_kind); None for the first snapshot, which has nothing before it.
        """
        after, before = self._write(rows), self.current
        changes = None
        if before is not None:
            old, new = (self.spark.table(t) for t in (before, after))
            kind: Column = F.when(F.col("o.hash").isNull(), "added").when(F.col("n.hash").isNull(), "removed").when(F.col("o.hash") != F.col("n.hash"), "changed")
            met = old.alias("o").join(new.alias("n"), F.col("o.key") == F.col("n.key"), "full")
            found = met.select(F.coalesce("o.key", "n.key").alias("key"), F.lit(version).cast("bigint").alias("version"), kind.alias("change_kind"))
            changes = cut(found.filter("change_kind is not null"))
            self.spark.sql(f"DROP TABLE {before}")
        self.current, self.version = after, version
        return changes

    def close(self) -> None:
        if self.current:
            self.spark.sql(f"DROP TABLE {self.current}")


def deliveries(rows: DataFrame) -> Iterator[tuple[int, DataFrame]]:
    """(version, rows) of each snapshot in order, from one table parted by snapshot; there are as many versions as deliveries."""
    parted = cut(rows, ("snapshot",))
    for (version,) in parted.select("snapshot").distinct().orderBy("snapshot").collect():
        yield version, parted.filter(F.col("snapshot") == version)


CHANGES = "key string, version bigint, change_kind string"


def changes(rows: DataFrame) -> DataFrame:
    """(key, version, change_kind) of all snapshots, each delivered to the index in turn."""
    spark, index, found = rows.sparkSession, SnapshotIndex(rows.sparkSession), []
    for version, delivered in deliveries(rows):
        step = index.advance(delivered, version)
        found += [step] if step is not None else []
    index.close()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], CHANGES)


def changed_values(rows: DataFrame) -> DataFrame:
    """(key, snapshot, old_snapshot, old and new values): changes with what they were and are, fetched for changed keys only."""
    values = lambda df, p: df.select("key", *(F.col(c).alias(f"{p}_{c}") for c in COMPARED))
    index, found, last = SnapshotIndex(rows.sparkSession), [], None
    for version, delivered in deliveries(rows):
        step = index.advance(delivered, version)
        if step is not None:
            keys = small(step.filter("change_kind = 'changed'").select("key"))
            old, new = (values(df, p).join(keys, "key", "left_semi") for df, p in ((last[1], "old"), (delivered, "new")))
            found.append(old.join(new, "key").select("key", F.lit(version).cast("bigint").alias("snapshot"), F.lit(last[0]).cast("bigint").alias("old_snapshot"), *(f"{p}_{c}" for p in ("old", "new") for c in COMPARED)))
        last = version, delivered
    index.close()
    if found:
        return reduce(DataFrame.unionByName, found)
    none = rows.limit(0).withColumnsRenamed({c: f"old_{c}" for c in COMPARED})
    return none.select("key", "snapshot", F.col("snapshot").alias("old_snapshot"), *(f"old_{c}" for c in COMPARED), *(F.col(f"old_{c}").alias(f"new_{c}") for c in COMPARED))


def p4_found(snapshots: DataFrame) -> DataFrame:
    return changes(latest_rows(snapshots)).select(version_text(F.col("version")).alias("version"), F.col("key").alias("key_hash"), "change_kind")
