"""Implausible spikes in measurements (problem 6), per source and relative to its own readings.

A series is decomposed by Haar wavelets over its sequence numbers: the approximation of level j is the mean
over a cell of 2^j numbers, the detail of level j the step from one approximation to the next finer one. The
details of a reading and its block's coarsest approximation sum up to the reading, so a reading further from
the series' level than SPIKE_SCALE robust deviations has a detail, or a coarsest approximation, above its
share of that. Such coefficients, against the series' median and median deviation, give the candidates for
spikes, and miss none; the distance itself decides on these. Runs of zero finest details are stuck values,
bounds give the impossible ones.

A series may hold a third of all rows. It is worked on in blocks of BLOCK sequence numbers; runs are stitched
over the first and last run of each block alone. Medians are exact: a sketch brackets them, and only the
values inside the bracket are counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import cut, map_arrow, small

STUCK_RUN = 8
SPIKE_SCALE = 10.0
BLOCK = 4096
"""Sequence numbers per block, a power of two."""
SERIES = ("device_id", "flowsheet_row_name_dk")
BRACKETS = (0.001, 0.02, 0.5)
"""Half-widths, in ranks, of the bracket around a median; a wider one is tried only should the sketch have missed."""


def bounded(rows: DataFrame, variables: DataFrame) -> DataFrame:
    """Readings with ``inside`` (within range_min and range_max; a null or NaN bound is none). NaN and null values are no readings."""
    number = lambda c: F.when(~F.isnan(c), F.col(c))
    limits = variables.filter("flowsheet_row_name_dk is not null").groupBy("flowsheet_row_name_dk").agg(F.max(number("range_min")).alias("range_min"), F.min(number("range_max")).alias("range_max"))
    readings = rows.select("row_id", *SERIES, "seq_nbr", F.col("derived_value").cast("double").alias("x")).filter("x is not null and not isnan(x)")
    joined = readings.join(small(limits), "flowsheet_row_name_dk", "left")
    inside = F.coalesce(F.col("x") >= F.col("range_min"), F.lit(True)) & F.coalesce(F.col("x") <= F.col("range_max"), F.lit(True))
    return joined.withColumn("inside", inside).drop("range_min", "range_max")


def steps(readings: DataFrame) -> DataFrame:
    """One row per series and seq_nbr: of repeats the row with the lowest row_id. Rows without device, variable or seq_nbr are in no series."""
    whole = readings.dropna(subset=[*SERIES, "seq_nbr"])
    return whole.groupBy(*SERIES, "seq_nbr").agg(F.min(F.struct("row_id", "x", "inside")).alias("r")).select(*SERIES, F.col("seq_nbr").cast("bigint").alias("seq"), "r.x", "r.inside")


def medians(values: DataFrame, out: str) -> DataFrame:
    """(series, out): the exact median of x per series, the mean of the two middle values where there are two."""
    for half in BRACKETS:
        sketch = values.groupBy(*SERIES).agg(F.count("*").alias("n"), F.percentile_approx("x", [0.5 - half, 0.5 + half], 10_000).alias("q"))
        bracket = small(cut(sketch.select(*SERIES, "n", F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high"))))
        near = F.when(F.col("x").between(F.col("low"), F.col("high")), F.col("x"))
        counts = values.join(bracket, list(SERIES)).groupBy(*SERIES, "n", near.alias("v")).agg(F.count("*").alias("c"), F.count_if(F.col("x") < F.col("low")).alias("below"))
        along = W.partitionBy(*SERIES).orderBy(F.col("v").asc_nulls_first())
        ranked = counts.withColumn("rank", F.sum(F.when(F.col("v").isNull(), F.col("below")).otherwise(F.col("c"))).over(along)).withColumn("before", F.coalesce(F.lag("rank").over(along), F.lit(0)))
        at = lambda k: F.max(F.when((F.col("before") < k) & (F.col("rank") >= k), F.col("v")))
        found = cut(ranked.groupBy(*SERIES).agg((at(F.floor((F.col("n") + 1) / 2)) * 0.5 + at(F.floor(F.col("n") / 2) + 1) * 0.5).alias(out)))
        if found.filter(F.col(out).isNull()).isEmpty():
            break
    return found


def robust_levels(series: DataFrame) -> DataFrame:
    """(series, level, scale): median of the in-range readings and the median of their distances from it."""
    good = series.filter("inside").select(*SERIES, "x")
    level = small(medians(good, "level"))
    scale = medians(good.join(level, list(SERIES)).select(*SERIES, F.abs(F.col("x") - F.col("level")).alias("x")), "scale")
    return level.join(scale, list(SERIES))


def haar_details(group: np.ndarray, seq: np.ndarray, x: np.ndarray, weight: np.ndarray, block: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """(details of each level, finest first, coarsest approximation) of readings in order of group and sequence number; ``weight`` 0 leaves a reading out of all means."""
    details, finer = [], x
    for j in range(1, (block or BLOCK).bit_length()):
        cell = seq >> j
        starts = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (cell[1:] != cell[:-1]))))
        sizes = np.diff(np.append(starts, len(x)))
        n = np.add.reduceat(weight, starts)
        mean = np.repeat(np.add.reduceat(np.where(weight > 0, x, 0.0), starts) / np.maximum(n, 1), sizes)
        details.append(finer - mean)
        finer = mean
    return details, finer


FOUND = "device_id string, variable bigint, block bigint, run int, what string, x double, n bigint, seqs array<bigint>"


def analysed(group: np.ndarray, seq: np.ndarray, x: np.ndarray, inside: np.ndarray, level: np.ndarray, scale: np.ndarray, block: int = 0) -> list[tuple[int, int, str, float | None, int, list[int] | None]]:
    """(position, run, what, x, n, seqs) of whole blocks in order: spikes, stuck runs, and each block's first and last run as edges to be stitched.

    ``group`` numbers the blocks. Runs long enough are told whole; the others at an edge bring their sequence numbers.
    """
    if not len(x):
        return []
    with np.errstate(invalid="ignore", over="ignore"):
        details, coarse = haar_details(group, seq, x, inside.astype(float), block)
        bound = SPIKE_SCALE * scale
        share = bound / (len(details) + 1) * (1 - 1e-9)
        large = ~(np.abs(coarse - level) <= share)
        for d in details:
            large |= ~(np.abs(d) <= share)
        at = np.flatnonzero(large & inside)
        at = at[np.abs(x[at] - level[at]) > bound[at]]
    out = [(int(p), 0, "spike", None, 1, [int(seq[p])]) for p in at]
    turned = np.concatenate(([True], group[1:] != group[:-1]))
    starts = np.flatnonzero(turned | np.concatenate(([True], x[1:] != x[:-1])))
    sizes = np.diff(np.append(starts, len(x)))
    first = turned[starts]
    last = np.append(first[1:], True)
    for k in np.flatnonzero(first | last | (sizes >= STUCK_RUN)):
        p, n = int(starts[k]), int(sizes[k])
        seqs = seq[p : p + n].tolist()
        if n >= STUCK_RUN:
            out.append((p, 0, "stuck", None, n, seqs))
        if first[k] or last[k]:
            out.append((p, 0 if first[k] else 1, "edge", float(x[p]), n, seqs if n < STUCK_RUN else None))
    return out


def decomposed(series: DataFrame, levels: DataFrame) -> DataFrame:
    """What ``analysed`` finds in all blocks of all series."""
    block = BLOCK
    known = series.join(small(levels), list(SERIES), "left").select(F.col(SERIES[0]).alias("device_id"), F.col(SERIES[1]).cast("bigint").alias("variable"), F.floor(F.col("seq") / block).alias("block"), "seq", "x", "inside", "level", "scale")
    placed = known.repartition("device_id", "variable", "block").sortWithinPartitions("device_id", "variable", "block", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last block of a batch may go on in the next
        for b in batches:
            table = pa.Table.from_batches([b] if rest is None else [*rest.to_batches(), b]).combine_chunks()
            if table.num_rows:
                group = blocks_of(table)
                end = int(np.searchsorted(group, group[-1]))
                yield from found(table.slice(0, end), group[:end])
                rest = table.slice(end)
        if rest is not None:
            yield from found(rest, blocks_of(rest))

    def blocks_of(t: pa.Table) -> np.ndarray:
        keys = [t["device_id"].combine_chunks().dictionary_encode().indices.to_numpy(), t["variable"].to_numpy(), t["block"].to_numpy()]
        return np.cumsum(np.concatenate(([False], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))

    def found(t: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        number = lambda c: t[c].to_numpy()
        rows = analysed(group, number("seq"), number("x"), t["inside"].to_numpy().astype(bool), number("level").astype(float), number("scale").astype(float), block)
        at = pa.array([r[0] for r in rows], pa.int64())
        keys = [t.column(c).combine_chunks().take(at) for c in ("device_id", "variable", "block")]
        kinds = (pa.int32(), pa.string(), pa.float64(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*keys, *(pa.array([r[k + 1] for r in rows], kind) for k, kind in enumerate(kinds))], names=[c.split()[0] for c in FOUND.split(", ")])

    return map_arrow(placed, run, FOUND)


def faults(rows: DataFrame, variables: DataFrame) -> DataFrame:
    """(row_id, fault): 'impossible', 'spike', 'stuck'; a reading may have two, one row each. All rows of a repeated seq_nbr share what was found for it.

    A series with no in-range reading has no spikes; one whose scale is 0 has a spike wherever it leaves its level.
    """
    readings = bounded(rows, variables)
    series = cut(steps(readings))  # it is read for the medians and for the decomposition
    found = cut(decomposed(series, robust_levels(series)))
    series_key = ["device_id", "variable"]
    over = W.partitionBy(*series_key).orderBy("block", "run")
    joined = (F.lag("x").over(over) == F.col("x")) & (F.lag("block").over(over) != F.col("block"))
    chains = found.filter("what = 'edge'").withColumn("chain", F.sum(F.when(F.coalesce(joined, F.lit(False)), 0).otherwise(1)).over(over))
    whole = chains.withColumn("total", F.sum("n").over(W.partitionBy(*series_key, "chain"))).filter((F.col("total") >= STUCK_RUN) & (F.col("n") < STUCK_RUN))
    stitched = whole.select(*series_key, F.lit("stuck").alias("what"), "seqs")
    marked = found.filter("what <> 'edge'").select(*series_key, "what", "seqs").unionByName(stitched)
    marked = marked.select(F.col("device_id").alias(SERIES[0]), F.col("variable").alias(SERIES[1]), F.col("what").alias("fault"), F.explode("seqs").alias("seq_nbr"))
    listed = readings.join(small(marked), [*SERIES, "seq_nbr"]).select("row_id", "fault")
    return readings.filter("not inside").select("row_id", F.lit("impossible").alias("fault")).unionByName(listed)


def p6_found(rows: DataFrame, variables: DataFrame) -> DataFrame:
    return faults(rows, variables)
