"""Order within an entity: gaps, episodes, doses, running lists, changes and first values."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import ship
from .blocks import BLOCK, blocked, running, stored

DAY = 86_400


def gap_cycles(df: DataFrame, entity: str, at: str, gap: int = DAY, hot_rows: int | None = None) -> DataFrame:
    """Runs of events no more than ``gap`` seconds apart: (entity, cycle, days, start_ts, end_ts)."""
    timed = running(blocked(df.select(entity, at), [entity], at, hot_rows), [entity], [at], {"__before": ("last", F.col(at))}, inclusive=False)
    goes_on = F.when(F.col(at) - F.col("__before") <= gap, 1).otherwise(0)  # of events at one time the first opens the run
    cycles = running(timed.withColumn("__on", goes_on), [entity], [at, "__on"], {"cycle": ("sum", 1 - F.col("__on"))})
    return cycles.groupBy(entity, "cycle").agg((F.floor((F.max(at) - F.min(at)) / DAY) + 1).cast("bigint").alias("days"), F.min(at).alias("start_ts"), F.max(at).alias("end_ts"))


def spaced_starts(times: np.ndarray, after: int | None, restart: int) -> tuple[np.ndarray, int | None]:
    """Of ascending times those that start anew: the first, then each first one more than ``restart`` days after the last; and that last one."""
    taken = []
    k = 0 if after is None else int(np.searchsorted(times, after + (restart + 1) * DAY))
    while k < len(times):
        after = int(times[k])
        taken.append(k)
        k = int(np.searchsorted(times, after + (restart + 1) * DAY))
    return np.array(taken, np.int64), after


def episodes(df: DataFrame, entity: str, at: str, tag: str, source: str, primary: str, reach: int = 2 * DAY, restart: int = 30, hot_rows: int | None = None) -> DataFrame:
    """(entity, cycle, days, start_ts, end_ts): episodes from tagged events (1 starts, 0 goes on, -1 ends), each in the order of time, source, tag.

    A start stands until an end of its own source, or until the next start if its source isn't ``primary`` or
    more than ``restart`` days have passed. Its end makes an episode of it, widened back over starts and stays
    and on over ends and stays that follow within ``reach``; episodes that touch are one. Rows without entity
    or time are left out; an event that is there twice counts once.

    A start can be told to stand by its neighbours alone if no start lies within the restart time before it,
    or an end of the primary source lies between: so starts fall into stretches. In a stretch only a standing
    start of the primary source keeps others away, and these are the ones spaced by more than the restart time;
    they are taken in one pass over the distinct times of primary starts. All else is running values.
    """
    by = ["entity"]
    place = ["at", "source", "tag"]
    rows = df.select(F.col(entity).alias("entity"), F.col(at).cast("bigint").alias("at"), F.col(tag).cast("int").alias("tag"), F.col(source).alias("source")).filter("entity is not null and at is not null").distinct()
    start, main = F.col("tag") == 1, F.coalesce(F.col("source") == primary, F.lit(False))
    seen = running(
        blocked(rows, by, "at", hot_rows), by, place,
        {"start_before": ("last", F.when(start, F.col("at"))), "kind_before": ("last", F.when(start, "start").when((F.col("tag") == -1) & main, "end")), "at_before": ("last", F.col("at")), "tag_before": ("last", F.coalesce("tag", F.lit(9)))},
        inclusive=False,
    )
    seen = running(seen, by, place, {"at_after": ("last", F.col("at")), "tag_after": ("last", F.coalesce("tag", F.lit(9)))}, reverse=True, inclusive=False)
    far = F.floor((F.col("at") - F.col("start_before")) / DAY) > restart
    opens = F.when(start & (F.col("start_before").isNull() | far | (F.col("kind_before") == "end")), 1).otherwise(0)
    apart = (F.col("at") - F.col("at_before") > reach) | ~F.col("tag_before").isin(0, 1) | F.col("at_before").isNull()
    ends = (F.col("at_after") - F.col("at") > reach) | ~F.col("tag_after").isin(0, -1) | F.col("at_after").isNull()
    marked = running(seen.withColumn("opens", opens), by, place, {"stretch": ("sum", F.col("opens")), "reaches_back": ("last", F.when(apart, F.col("at")))})
    marked = running(marked, by, place, {"reaches_on": ("last", F.when(ends, F.col("at")))}, reverse=True)
    marked = stored(marked.select("entity", BLOCK, *place, "stretch", "reaches_back", "reaches_on"))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, last = None, None  # the stretch a batch ends in goes on in the next
        for batch in batches:
            for k, g in batch.groupby(["entity", "stretch"], sort=False):
                chosen, last = spaced_starts(g["at"].to_numpy(), last if k == key else None, restart)
                key = k
                yield g.iloc[chosen]

    ship(df.sparkSession)
    main_starts = marked.filter(start & main).select("entity", "stretch", "at").distinct()
    standing = main_starts.repartition("entity", "stretch").sortWithinPartitions("entity", "stretch", "at").mapInPandas(pick, "entity bigint, stretch bigint, at bigint")
    standing = standing.select("entity", "stretch", "at", F.lit(primary).alias("source"), F.lit(1).alias("tag"), F.lit(True).alias("stands"))
    flagged = marked.join(standing, ["entity", "stretch", "at", "source", "tag"], "left")
    held = running(flagged, by, place, {"hold": ("last", F.when(F.col("stands"), F.struct("stretch", "at")))})
    free = F.col("hold").isNull() | (F.col("hold.stretch") != F.col("stretch")) | (F.floor((F.col("at") - F.col("hold.at")) / DAY) > restart)
    actual = F.when(start & (F.col("stands") | (~main & free)), F.struct("at", "source", "reaches_back"))
    current = running(held.withColumn("actual", actual), by, place, {"from": ("last", F.col("actual")), "number": ("sum", F.when(F.col("actual").isNotNull(), 1).otherwise(0))})
    closing = current.filter((F.col("tag") == -1) & F.col("from").isNotNull() & F.col("source").eqNullSafe(F.col("from.source")))
    each = closing.groupBy("entity", "number").agg(F.min("from.reaches_back").alias("start_ts"), F.min("reaches_on").alias("end_ts"))
    ordered = blocked(each, by, "start_ts", hot_rows)
    with_last = running(ordered, by, ["start_ts", "number"], {"end_before": ("max", F.col("end_ts"))}, inclusive=False)
    fresh = F.when(F.col("start_ts") <= F.col("end_before"), 0).otherwise(1)
    merged = running(with_last.withColumn("fresh", fresh), by, ["start_ts", "number"], {"cycle": ("sum", F.col("fresh"))})
    whole = merged.groupBy("entity", "cycle").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"))
    days = (F.floor((F.col("end_ts") - F.col("start_ts")) / DAY) + 1).cast("bigint")
    return whole.select(F.col("entity").alias(entity), "cycle", days.alias("days"), "start_ts", "end_ts")


def doses(df: DataFrame, entity: str, at: str, code: str, name: str, needed: str, wait: int = 14 * DAY, hot_rows: int | None = None) -> DataFrame:
    """Doses in order: nth, seconds since the one before (0 at first), the names so far, and when the series is complete.

    Of doses at one time with one code one counts, that of the least name and number. A dose that is the last
    needed gives a second row, ``wait`` later. The list of names grows with every dose, as it is the result.
    """
    once = df.groupBy(entity, at, code).agg(F.min(F.struct(name, needed)).alias("__d")).select(entity, at, code, f"__d.{name}", f"__d.{needed}")
    timed = blocked(once, [entity], at, hot_rows)
    seq = running(timed, [entity], [at, code], {"nth": ("sum", F.lit(1).cast("bigint"))})
    seq = running(seq, [entity], [at, code], {"__before": ("last", F.col(at))}, inclusive=False)
    seq = seq.withColumn("since", F.coalesce(F.col(at) - F.col("__before"), F.lit(0)).cast("bigint"))
    w = W.partitionBy(entity).orderBy(at, code).rowsBetween(W.unboundedPreceding, 0)
    seq = seq.withColumn("names", F.array_join(F.collect_list(name).over(w), "_"))
    given = seq.select(entity, F.col(at).alias("at"), "nth", "since", F.col(name).alias("name"), "names", F.lit("NO").alias("completes"))
    done = seq.filter(F.col("nth") == F.col(needed)).select(entity, (F.col(at) + wait).alias("at"), "nth", F.lit(None).cast("bigint").alias("since"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("names"), F.lit("YES").alias("completes"))
    return given.unionByName(done)


def changes_only(df: DataFrame, by: Sequence[str], at: str, value: str, order: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Drops a row that repeats the value before it on the same day (of seconds ``at``); first rows stay."""
    timed = running(blocked(df, by, at, hot_rows), by, [at, *order], {"__last": ("last", F.struct(F.col(at).alias("at"), F.col(value).alias("value")))}, inclusive=False)
    same = F.col("__last.value").eqNullSafe(F.col(value)) & (F.floor(F.col("__last.at") / DAY) == F.floor(F.col(at) / DAY))
    return timed.filter(F.col("__last").isNull() | ~F.coalesce(same, F.lit(False))).select(*df.columns)


def first_values(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per group: of each column the first non-null value in order."""
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct(*order, c)))[c]
    return df.groupBy(*by).agg(*(first(c).alias(c) for c in columns))
