"""Bitemporal ledger of changing entity attributes (problem 1).

Every assertion says: from version ``valid`` on, the entity has ``state``; it became known at
``recorded``. The ledger holds one row per rectangle of valid and recorded time. A later assertion
never overwrites a row: it closes the rectangles it touches on the recorded axis and opens new ones,
so a late update for an old version splits the interval of its predecessor.

The rectangles come from a sweep along the valid axis. Seen from an assertion at ``v``, the valid end
at recorded time ``t`` is the nearest later version whose first assertion is known by ``t``; going
outwards from ``v`` only versions whose first record is earlier than that of all nearer ones ever
become the end. Where an entity's versions became known in their own order, that is the next version
alone, and neighbours say all. Entities with late updates are swept once from the last version to the
first with the stack of such ends; each rectangle costs one step.

Copies collapse by map-side aggregation into one assertion per entity, version and recorded point, so
an entity with a third of all rows costs a task no more than (versions x loads) rows. New loads are
appended to a stored ledger: only entities that they name are swept again, and of these only what is
in force.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import clean, folded, version_milli, version_text
from ..session import ship

ATTRIBUTES = ("patient_clinic_number", "patient_merged_flag", "zipcode", "race_code", "deceased_flag")
FOREVER = (1 << 62)


def state_text(attributes: Sequence[str], withdrawn: Column) -> Column:
    """One comparable text per state: trimmed, caseless, blank as null; withdrawals are all alike."""
    parts = [F.coalesce(F.concat(F.lit("="), folded(F.col(a))), F.lit("~")) for a in attributes]
    return F.when(withdrawn, F.lit("D")).otherwise(F.concat(F.lit("A"), F.concat_ws("\x1f", *parts)))


def assertions(feed: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """(entity, valid, recorded, state): one per entity, version and load; rows without entity or version are left out.

    A null incr_counter is older than any other; of rows with one counter the latest received, then the
    highest feed_row_id stands.
    """
    rows = feed.select(
        clean(F.col("patient_dk")).alias("entity"),
        version_milli(F.col("version")).alias("valid"),
        F.coalesce(F.col("incr_counter"), F.lit(-1)).cast("bigint").alias("recorded"),
        state_text(attributes, F.coalesce(folded(F.col("record_state")) == "d", F.lit(False))).alias("state"),
        F.struct(F.coalesce(F.unix_micros(F.col("received_dtm").cast("timestamp")), F.lit(-FOREVER)).alias("at"), F.col("feed_row_id").alias("id")).alias("last"),
    ).filter("entity is not null and valid is not null")
    return rows.groupBy("entity", "valid", "recorded").agg(F.max_by("state", "last").alias("state"))


RECTANGLE = "entity string, state string, valid_from bigint, valid_to bigint, recorded_from bigint, recorded_to bigint"


def swept(rows: list[tuple[int, int, int, str]]) -> list[tuple[str, int, int, int, int]]:
    """Rectangles (state, valid_from, valid_to, recorded_from, recorded_to) of one entity's assertions (valid, recorded, until, state), in order of version and record."""
    out, stack, k = [], [(FOREVER, -FOREVER)], len(rows)
    while k:
        at = rows[k - 1][0]
        first = k - 1
        while first and rows[first - 1][0] == at:
            first -= 1
        for valid, recorded, until, state in rows[first:k]:
            # the ends from the nearest on, each in force from when it was known until a nearer one was
            for end, known in reversed(stack):
                since = max(recorded, known)
                if since < until:
                    out.append((state, valid, end, since, until))
                until = min(until, known)
                if until <= recorded:
                    break
        known = rows[first][1]
        while len(stack) > 1 and stack[-1][1] >= known:
            stack.pop()
        stack.append((at, known))
        k = first
    return out


def ledger(asserted: DataFrame) -> DataFrame:
    """(entity, state, valid_from, valid_to, recorded_from, recorded_to); open ends are ``FOREVER``."""
    same = W.partitionBy("entity", "valid").orderBy("recorded")
    along = W.partitionBy("entity").orderBy("valid", "recorded")
    seen = asserted.repartition("entity").withColumns({"until": F.lead("recorded", 1, FOREVER).over(same), "first": F.min("recorded").over(W.partitionBy("entity", "valid"))})
    # the next version's first record stands on its first row, which follows the last row of this version
    after = F.lead(F.struct("valid", "first")).over(along)
    seen = seen.withColumn("after", after).withColumn("next", F.last("after").over(W.partitionBy("entity", "valid").orderBy("recorded").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    late = F.max((F.col("next.first") < F.col("first")).cast("int")).over(W.partitionBy("entity"))
    seen = seen.select("entity", "state", "valid", "recorded", "until", "next", F.coalesce(late, F.lit(0)).alias("late"))
    known = F.coalesce("next.first", F.lit(FOREVER))
    before = F.struct(F.lit(FOREVER).alias("valid_to"), F.col("recorded").alias("recorded_from"), F.least("until", known).alias("recorded_to"))
    since = F.struct(F.coalesce("next.valid", F.lit(FOREVER)).alias("valid_to"), F.greatest("recorded", known).alias("recorded_from"), F.col("until").alias("recorded_to"))
    timely = seen.filter("late = 0").select("entity", "state", F.col("valid").alias("valid_from"), F.inline(F.array(before, since))).filter("recorded_from < recorded_to")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the last entity of a batch may go on in the next
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if len(batch):
                whole = batch["entity"] != batch["entity"].iat[-1]
                rest = batch[~whole]
                yield from entities(batch[whole])
        if rest is not None:
            yield from entities(rest)

    def entities(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        out = [(e, *r) for e, g in batch.groupby("entity", sort=False) for r in swept(list(zip(g["valid"], g["recorded"], g["until"], g["state"])))]
        yield pd.DataFrame(out, columns=["entity", "state", "valid_from", "valid_to", "recorded_from", "recorded_to"])

    ship(asserted.sparkSession)
    ordered = seen.filter("late = 1").select("entity", "valid", "recorded", "until", "state").repartition("entity").sortWithinPartitions("entity", "valid", "recorded")
    return timely.unionByName(ordered.mapInPandas(run, RECTANGLE))


def append(book: DataFrame, asserted: DataFrame) -> DataFrame:
    """The ledger after a new load; it equals the ledger of all assertions. What was recorded must be later than all that the book has of the entity.

    Rows that are closed, or of entities that the load doesn't name, pass through.
    """
    named = asserted.groupBy("entity").agg(F.min("recorded").alias("since"))
    open_rows = book.filter(F.col("recorded_to") == FOREVER)
    touched = open_rows.join(named, "entity").withColumn("recorded_from", F.when(F.col("recorded_from") >= F.col("since"), F.raise_error(F.lit("the load is older than the ledger"))).otherwise(F.col("recorded_from"))).drop("since")
    anew = ledger(touched.select("entity", F.col("valid_from").alias("valid"), F.lit(-FOREVER).alias("recorded"), "state").unionByName(asserted.select("entity", "valid", "recorded", "state")))
    began = touched.select("entity", "valid_from", F.col("recorded_from").alias("began"))
    kept = anew.join(began, ["entity", "valid_from"], "left").withColumn("recorded_from", F.when(F.col("recorded_from") == -FOREVER, F.col("began")).otherwise(F.col("recorded_from"))).drop("began")
    return book.filter(F.col("recorded_to") != FOREVER).unionByName(open_rows.join(named.select("entity"), "entity", "left_anti")).unionByName(kept)


def as_recorded(book: DataFrame, recorded: int | None = None) -> DataFrame:
    """The rows of the ledger in force at a recorded time; None is now."""
    at = FOREVER - 1 if recorded is None else recorded
    return book.filter((F.col("recorded_from") <= at) & (F.col("recorded_to") > at))


def validity_periods(book: DataFrame, recorded: int | None = None) -> DataFrame:
    """(entity, state, valid_from, valid_to): equal neighbours joined, withdrawals ending a period but opening none."""
    along = W.partitionBy("entity").orderBy("valid_from")
    now = as_recorded(book, recorded)
    turns = now.withColumn("before", F.lag("state").over(along)).filter(~F.col("state").eqNullSafe(F.col("before")))
    return turns.withColumn("valid_to", F.lead("valid_from", 1, 0).over(along)).filter(F.col("state") != "D").select("entity", "state", "valid_from", "valid_to")


def p1_found(feed: DataFrame) -> DataFrame:
    periods = validity_periods(ledger(assertions(feed)))
    return periods.select(F.col("entity").alias("patient_dk"), version_text(F.col("valid_from")).alias("version"), version_text(F.col("valid_to")).alias("updated_by"))
