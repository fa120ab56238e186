"""Order within groups of any size: hot groups are cut into blocks, and what a block needs to know of those before it is carried over.

A group is hot above HOT_ROWS rows. Its blocks are ranges of the order column between approximate quantiles, so
all rows of one value share a block. Windows run over (group, block). Sums, extremes and last values of whole
blocks, a few numbers each, go from block to block in a window over these alone, and come back by a join of
proven size. Groups that aren't hot have one block and take no part in that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut, is_table, scanned, small

HOT_ROWS = 1 << 16
QUANTILES = 1000
"""Blocks that a group can have at most."""
BLOCK = "__block"


def met(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on keys where null meets null; the other side's keys are dropped."""
    renamed = other.withColumnsRenamed({c: f"__k_{c}" for c in on})
    return df.join(renamed, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in on)), how).drop(*(f"__k_{c}" for c in on))


def hot_groups(df: DataFrame, by: Sequence[str], hot_rows: int | None = None) -> DataFrame | None:
    """(by..., __n) of the groups above ``hot_rows`` rows, null keys included; None if there are none, as where the whole table has no more rows."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    if is_table(df) and df.count() <= limit:  # footers tell
        return None
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > limit)
    return None if counted.isEmpty() else cut(counted)


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "n", hot_rows: int | None = None, bound: DataFrame | None = None) -> DataFrame:
    """Row numbers from 1 within every group, in an order of any kind; rows that tie are numbered one after the other.

    Hot groups are sorted over all tasks by ranges of (group, order); each range is numbered by itself and
    shifted by the rows of its group in the ranges before. ``bound`` is a stored frame whose groups are known to have
    no fewer rows, if there is one to look for hot groups in.
    """
    plain = lambda d: d.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("bigint"))
    df = scanned(df) if bound is None else df
    hot = hot_groups(df if bound is None else bound, by, hot_rows)
    if hot is None:
        return plain(df)
    hot, df = small(hot.select(*by)), scanned(df)
    own, tie = df.columns, F.monotonically_increasing_id().alias("__tie")
    mine = met(df, hot, by, "left_semi").select("*", tie)
    parted = cut(mine.repartitionByRange(*by, *order, "__tie").withColumn("__part", F.spark_partition_id()))
    within = parted.withColumn("__k", F.row_number().over(W.partitionBy(*by, "__part").orderBy(*order, "__tie")))
    sizes = parted.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("__size"))
    before = W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    shifts = small(sizes.select(*by, "__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift")))
    joined = met(within, shifts, [*by, "__part"]).select(*own, (F.col("__k") + F.col("__shift")).cast("bigint").alias(out))
    return plain(met(df, hot, by, "left_anti")).unionByName(joined)


def blocked(df: DataFrame, by: Sequence[str], at: str, hot_rows: int | None = None) -> DataFrame:
    """Adds the block: 0 in groups that aren't hot, else 1 and more along ``at``, which is a number. A null ``at`` is in the first block."""
    limit = HOT_ROWS if hot_rows is None else hot_rows
    df = scanned(df)
    hot = hot_groups(df, by, hot_rows)
    if hot is None:
        return df.withColumn(BLOCK, F.lit(0))
    hot = small(hot)
    inner = met(df.select(*by, at), hot, by)
    cuts = inner.groupBy(*by).agg(F.max("__n").alias("__n"), F.percentile_approx(at, [k / QUANTILES for k in range(1, QUANTILES)], 4 * QUANTILES).alias("__q"))
    every = F.greatest(F.lit(1), F.floor(QUANTILES * F.lit(limit) / F.col("__n"))).cast("int")
    cuts = small(cuts.select(*by, F.array_sort(F.array_distinct(F.filter("__q", lambda x, i: (i + 1) % every == 0))).alias("__cuts")))
    joined = met(df, cuts, by, "left")
    passed = F.size(F.filter("__cuts", lambda x: x < F.coalesce(F.col(at), F.lit(-(1 << 62)))))
    return joined.withColumn(BLOCK, F.when(F.col("__cuts").isNull(), 0).otherwise(passed + 1)).drop("__cuts")


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], outs: dict[str, tuple[str, Column]], reverse: bool = False, inclusive: bool = True) -> DataFrame:
    """Adds running values of a blocked frame along ``order`` (backwards if ``reverse``), of the rows up to this one or, if not ``inclusive``, before it.

    outs: name -> (what, value), what being sum, max, min or last (non-null). The first of ``order`` must be
    the column of the blocks.
    """
    turn = (lambda c: F.col(c).desc_nulls_last()) if reverse else (lambda c: F.col(c).asc_nulls_first())
    along = W.partitionBy(*by, BLOCK).orderBy(*(turn(c) for c in order)).rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    fold = {"sum": F.sum, "max": F.max, "min": F.min, "last": lambda c: F.last(c, ignorenulls=True)}
    own = df.columns
    if not _split(df):
        return df.select("*", *(fold[what](value).over(along).alias(name) for name, (what, value) in outs.items()))
    valued = df.select("*", *(value.alias(f"__v_{name}") for name, (_, value) in outs.items()))
    place = F.struct(*order)
    last = F.min if reverse else F.max

    def whole(name: str, what: str) -> Column:
        v = F.col(f"__v_{name}")
        return last(F.when(v.isNotNull(), F.struct(place.alias("p"), v.alias("v"))))["v"] if what == "last" else fold[what](v)

    edges = valued.filter(F.col(BLOCK) > 0).groupBy(*by, BLOCK).agg(*(whole(n, w).alias(f"__e_{n}") for n, (w, _) in outs.items()))
    before = W.partitionBy(*by).orderBy(turn(BLOCK)).rowsBetween(W.unboundedPreceding, -1)
    carried = small(edges.select(*by, BLOCK, *(fold[w](F.col(f"__e_{n}")).over(before).alias(f"__c_{n}") for n, (w, _) in outs.items())))
    inner = valued.select(*own, *(fold[what](F.col(f"__v_{name}")).over(along).alias(f"__r_{name}") for name, (what, _) in outs.items()))
    joined = met(inner, carried, [*by, BLOCK], "left")
    both = {"sum": lambda r, c: F.when(r.isNull() & c.isNull(), None).otherwise(F.coalesce(r, F.lit(0)) + F.coalesce(c, F.lit(0))), "max": F.greatest, "min": F.least, "last": F.coalesce}
    return joined.select(*own, *(both[what](F.col(f"__r_{name}"), F.col(f"__c_{name}")).alias(name) for name, (what, _) in outs.items()))


def stored(df: DataFrame) -> DataFrame:
    """A blocked frame written to the shared folder; a constant block stays known as one."""
    return cut(df) if _split(df) else cut(df.drop(BLOCK)).withColumn(BLOCK, F.lit(0))


def _split(df: DataFrame) -> bool:
    """Whether any group has blocks: a constant block column is foldable, and the optimizer shows it so."""
    plan = df.select(BLOCK)._jdf.queryExecution().optimizedPlan().toString()
    return f"0 AS {BLOCK}" not in plan
