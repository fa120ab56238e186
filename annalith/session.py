"""Sessions, table access, size-checked broadcasts and durable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 8 << 20
"""Size up to which ``small`` broadcasts a side: of its files if it is a plain scan, else as Catalyst bounds it or as it was written."""
BIG_TABLE_FACTOR = 5
"""Shuffle partitions of a big table against those of others: its buckets are split in so many."""


def build_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings the session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.checkpoint.dir", "file://" + os.path.join(tempfile.gettempdir(), "annalith-checkpoints"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def tune(spark: SparkSession, buckets: int, big: bool = False, override: int | None = None) -> int:
    """Sets the shuffle partitions for a class of tables: one per bucket, BIG_TABLE_FACTOR per bucket of a big one, or as given. AQE joins small ones and splits skewed ones."""
    n = override or buckets * (BIG_TABLE_FACTOR if big else 1)
    for key, value in {"spark.sql.shuffle.partitions": n, "spark.sql.adaptive.enabled": True, "spark.sql.adaptive.skewJoin.enabled": True, "spark.sql.adaptive.coalescePartitions.enabled": True}.items():
        spark.conf.set(key, str(value).lower())
    return n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_of(df: DataFrame) -> int:
    """Catalyst's bound for the size of a frame: for a scan the size of its files; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


SHRINKING = {"LogicalRelation", "LocalRelation", "OneRowRelation", "Project", "Filter", "Aggregate", "Distinct", "Window", "Sort", "GlobalLimit", "LocalLimit", "Union", "SubqueryAlias", "ResolvedHint"}
"""Plan nodes whose result Catalyst's bound covers; joins, generators and Python stages may give more."""


def _only(plan, names: set[str]) -> bool:
    inner = plan.children()
    return plan.nodeName() in names and all(_only(inner.apply(i), names) for i in range(inner.size()))


def is_table(df: DataFrame) -> bool:
    """Whether a frame is a stored table, or columns of it."""
    plan = df._jdf.queryExecution().analyzed()
    return _only(plan, {"LogicalRelation", "Project", "SubqueryAlias"})


def scanned(df: DataFrame) -> DataFrame:
    """The frame, if it is computed row by row from a stored table; else written once, for those who look at it more than once."""
    return df if _only(df._jdf.queryExecution().analyzed(), {"LogicalRelation", "LocalRelation", "Project", "Filter", "SubqueryAlias", "Union"}) else cut(df)


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A broadcast hint if the side has at most ``limit`` bytes, else the plain side, to be joined by shuffle.

    Where Catalyst's bound doesn't show it, the side is written once, measured, and read from there, so nothing is computed twice.
    """
    if bytes_of(df) > limit or not _only(df._jdf.queryExecution().optimizedPlan(), SHRINKING):
        df = cut(df)
    return F.broadcast(df) if bytes_of(df) <= limit else df


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names in spark.checkpoint.dir. Only a local session may go without: then it is a temporary folder."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir names no folder; on a cluster it must be one that all executors share")
        where = "file://" + os.path.join(tempfile.gettempdir(), "annalith-checkpoints")
    return where


def forget_at_end(spark: SparkSession, path: str) -> None:
    """The folder goes when the application ends."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


def cut(df: DataFrame, parted_by: Sequence[str] = ()) -> DataFrame:
    """The frame from a table written to the shared folder, so a lost executor doesn't replay the lineage.

    It is columnar, so later readers take only the columns they need, and its size is known. It goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/annalith-{uuid.uuid4().hex}"
    (df.write.partitionBy(*parted_by) if parted_by else df.write).parquet(path)
    forget_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application, so that Python stages run wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_annalith_shipped", False):
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="annalith-")) / "annalith.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._annalith_shipped = True


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
