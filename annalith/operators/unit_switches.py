"""Quantities recorded in different units: a hidden Markov model per device and variable decodes the unit (problem 7).

The unit is the hidden state. What is seen is the bare number, whose logarithm in unit u lies around the
source's level at that time, shifted by the logarithm of u's factor; or, where text or unit column tell the
unit, the unit itself, which leaves that state alone. Units tend to stay, and change rarely. Viterbi decoding
finds the likeliest units of the whole chain in time order. The level follows the source's values whose unit
is told, in common units: medians of blocks, smoothed over neighbouring blocks and drawn to the source's
level, and that to the variable's, where few are told. Charted rows name no device, so their source is the site.

A source may hold a third of all rows, so no task holds a chain, only a block of BLOCK_DAYS days of one, and of
a chain with very many rows a part of such a block.
The first pass reduces every block to a max-plus matrix: the best score of a path through it by the state
before it and its last state. These are scanned over the blocks of a chain, which fixes the states at all
boundaries, and the second pass decodes every block between its own. That is exact. Between two told units a
path doesn't depend on the rest, so only stretches of untold ones are walked through.

TESTDATA gives a row to quantities whose unit is told: these decoded states are p7_found; the others are p7_inferred.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import cut, ship, small
from .blocks import BLOCK, blocked
from .units import amounts, conversions

STAY = 0.98
"""Chance that the unit of the next reading is the same."""
BLOCK_DAYS = 30
PARTS = 1 << 10
"""Parts that a block of a hot chain may have; they go on counting along the chain."""
UNTIMED_ROWS = 1 << 16
"""Readings without a time come before the others, in blocks of so many row ids."""
LEVEL_REACH, LEVEL_PRIOR = 2.0, 5.0
"""Blocks over which the weight of a block's level falls to 1/e, and the readings that the wider level counts as."""
LEAST_SPREAD = 0.05


def arrivals(best: np.ndarray, stay: float) -> np.ndarray:
    """The best scores of being in every state one step after ``best`` (states last), before what is seen there."""
    k = best.shape[-1]
    if k == 1:
        return best
    return np.maximum(best + np.log(stay), best.max(axis=-1, keepdims=True) + np.log((1 - stay) / (k - 1)))


def entered(state: int, k: int, stay: float) -> np.ndarray:
    return arrivals(np.where(np.arange(k) == state, 0.0, -np.inf), stay)


def viterbi(logs: np.ndarray, stay: float = STAY, before: int | None = None, last: int | None = None) -> np.ndarray:
    """Likeliest states for log-likelihoods of shape (times, states), given the state before and the last one where they are known."""
    n, k = logs.shape
    if k == 1:
        return np.zeros(n, int)
    move, hold = np.log((1 - stay) / (k - 1)), np.log(stay)
    best, back = logs[0] + (0.0 if before is None else entered(before, k, stay)), np.zeros((n, k), int)
    for t in range(1, n):
        top = int(best.argmax())
        other = best[top] + move
        kept = best + hold
        back[t] = np.where(kept >= other, np.arange(k), top)
        best = np.maximum(kept, other) + logs[t]
    path = np.empty(n, int)
    path[-1] = int(best.argmax()) if last is None else last
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def decoded_path(logs: np.ndarray, told: np.ndarray, stay: float = STAY, before: int | None = None, last: int | None = None) -> np.ndarray:
    """As ``viterbi``; ``told`` has the states that are certain, -1 where none is."""
    path, n = told.copy(), len(told)
    open_at = np.flatnonzero(told < 0)
    for run in np.split(open_at, np.flatnonzero(np.diff(open_at) > 1) + 1) if len(open_at) else []:
        a, b = int(run[0]), int(run[-1]) + 1
        end = min(b + 1, n)  # the told state after the stretch is its last
        part = np.array(logs[a:end])
        if end > b:
            part[-1] = np.where(np.arange(part.shape[1]) == told[b], 0.0, -np.inf)
        path[a:b] = viterbi(part, stay, int(told[a - 1]) if a else before, int(told[b]) if end > b else last)[: b - a]
    return path


def transfer(logs: np.ndarray, told: np.ndarray, stay: float = STAY) -> np.ndarray:
    """Best scores of paths through a block, by last state: in row 0 of those that start with it, in row 1 + i of those that come from state i.

    What all paths share, between the first and the last told state, is left out.
    """
    k, known = logs.shape[1], np.flatnonzero(told >= 0)
    best = np.vstack([np.zeros(k), *(entered(i, k, stay) for i in range(k))])

    def step(best: np.ndarray, t: int, moved: bool) -> np.ndarray:
        seen = logs[t] if told[t] < 0 else np.where(np.arange(k) == told[t], 0.0, -np.inf)
        return (arrivals(best, stay) if moved else best) + seen

    for t in range(int(known[0]) + 1 if len(known) else len(logs)):
        best = step(best, t, t > 0)
    if len(known):
        best = np.where(np.arange(k) == told[known[-1]], best[:, [told[known[0]]]], -np.inf)
        for t in range(int(known[-1]) + 1, len(logs)):
            best = step(best, t, True)
    return best


def boundaries(blocks: Sequence[np.ndarray]) -> list[tuple[int | None, int]]:
    """(state before, last state) of every block on the best path through a chain's blocks, from their ``transfer``."""
    best, back = blocks[0][0], []
    for block in blocks[1:]:
        scores = best[:, None] + block[1:]
        back.append(scores.argmax(axis=0))
        best = scores.max(axis=0)
    ends = [int(best.argmax())]
    for came in reversed(back):
        ends.append(int(came[ends[-1]]))
    ends.reverse()
    return list(zip([None, *ends], ends))


def smoothed(blocks: Sequence[int], medians: Sequence[float], counts: Sequence[float], usual: float) -> np.ndarray:
    """A source's level in each of its blocks in order, from the medians and numbers of told readings there (0 where none) and the variable's usual level."""
    at, n = np.asarray(blocks, float), np.asarray(counts, float)
    x = np.where(n > 0, np.nan_to_num(np.asarray(medians, float)), 0.0)
    source = (n @ x + LEVEL_PRIOR * usual) / (n.sum() + LEVEL_PRIOR)
    fade = np.exp(-np.diff(at) / LEVEL_REACH)
    weight, total = n.copy(), n * x
    back_weight, back_total = n.copy(), n * x
    for i in range(1, len(at)):
        weight[i] += weight[i - 1] * fade[i - 1]
        total[i] += total[i - 1] * fade[i - 1]
    for i in range(len(at) - 2, -1, -1):
        back_weight[i] += back_weight[i + 1] * fade[i]
        back_total[i] += back_total[i + 1] * fade[i]
    w, s = weight + back_weight - n, total + back_total - n * x
    return (s + LEVEL_PRIOR * source) / (w + LEVEL_PRIOR)


Unit = tuple[str, float, float]


def emissions(values: np.ndarray, units: Sequence[Unit], level: np.ndarray | float, spread: float) -> np.ndarray:
    """Log-likelihoods (values, units) of bare numbers. units: (code, pre_add, factor)."""
    x = np.asarray(values, float)
    logs = np.empty((len(x), len(units)))
    for j, (_, pre, factor) in enumerate(units):
        common = (x + pre) * factor
        z = (np.log(np.where(common > 0, common, np.nan)) - level) / max(spread, LEAST_SPREAD)
        logs[:, j] = np.where(np.isfinite(z), -0.5 * np.minimum(z * z, 400), -300.0)
    return logs


def told_states(told: Sequence[str | None], units: Sequence[Unit]) -> np.ndarray:
    place = {u[0]: j for j, u in enumerate(units)}
    return np.array([place.get(t, -1) for t in told], int)


def decode(values: Sequence[float], told: Sequence[str | None], units: Sequence[Unit], level: float, spread: float, before: int | None = None, last: int | None = None) -> list[str]:
    """The unit of every value; a told unit is certain. units: (code, pre_add, factor)."""
    path = decoded_path(emissions(values, units, level, spread), told_states(told, units), STAY, before, last)
    return [units[j][0] for j in path]


def starts_of(batch: pd.DataFrame, key: list[str]) -> np.ndarray:
    """Where the groups of a frame that is sorted by ``key`` begin, and its end."""
    turns = np.logical_or.reduce([batch[c].to_numpy()[1:] != batch[c].to_numpy()[:-1] for c in key])
    return np.concatenate(([0], np.flatnonzero(turns) + 1, [len(batch)]))


def grouped(key: list[str], many: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[Iterable[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """``many`` over frames of whole groups, from batches that are sorted by ``key``; a group that goes over batches is put together once."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            if rest and tuple(rest[0][key].iloc[0]) != tuple(batch[key].iloc[0]):
                yield many(pd.concat(rest, ignore_index=True))
                rest = []
            starts, begin = starts_of(batch, key), 0
            if len(starts) > 2 and rest:
                begin = int(starts[1])
                yield many(pd.concat([*rest, batch.iloc[:begin]], ignore_index=True))
                rest = []
            last = int(starts[-2])
            if begin < last:
                yield many(batch.iloc[begin:last])
            rest.append(batch.iloc[last:])
        if rest:
            yield many(pd.concat(rest, ignore_index=True))

    return run


def decoded_units(rows: DataFrame, variables: DataFrame, factors: DataFrame, sites: DataFrame) -> DataFrame:
    """(row_id, told, unit, common_milli) of rows with null derived_value and a single amount, decoded along the chain of their source and variable.

    ``told`` says whether text or unit column name the unit. Amounts in a unit that isn't known for their variable
    have no row, nor have those of variables without known units. The rules (units by variable) come to the driver.
    """
    chain = ["site", "device", "variable"]
    key = [*chain, "block"]
    marks = sites.filter("site_code is not null").groupBy("site_code").agg(F.min("decimal_mark").alias("decimal_mark"))
    known = conversions(variables, factors).withColumnRenamed("flowsheet_row_name_dk", "variable")
    options: dict[object, list[Unit]] = {}
    for r in known.select("variable", "unit", "pre_add", "factor").orderBy("variable", "unit").collect():
        options.setdefault(r[0], []).append((r[1], r[2], r[3]))
    device = F.col("device_id") if "device_id" in rows.columns else F.lit(None)
    kept = rows.filter("derived_value is null and flowsheet_result_txt is not null").select("row_id", "site_code", F.coalesce(device, F.lit("")).alias("device"), F.col("flowsheet_row_name_dk").alias("variable"), "received_dtm", "flowsheet_result_txt", "flowsheet_unit_of_measure_txt")
    kept = kept.join(small(known.select("variable").distinct()), "variable", "left_semi")
    block = F.floor(F.unix_micros(F.col("received_dtm").cast("timestamp")) / (BLOCK_DAYS * 86_400_000_000))
    untimed = F.lit(-(1 << 50)) + F.floor(F.col("row_id") / UNTIMED_ROWS)
    read = amounts(kept.join(small(marks), "site_code", "left")).select("row_id", F.coalesce("site_code", F.lit("")).alias("site"), "device", "variable", F.coalesce(block, untimed).alias("block"), "received_dtm", "amount", "unit")
    read = read.join(small(known), ["variable", "unit"], "left").filter("unit is null or factor is not null")
    read = cut(read.withColumn("at", F.unix_micros(F.col("received_dtm").cast("timestamp"))))  # it is read for the levels, the blocks' matrices and their decoding
    read = blocked(read, chain, "at").withColumn("block", F.col("block") * PARTS + F.col(BLOCK)).drop(BLOCK, "at")
    told = read.select(*key, F.log((F.col("amount") + F.col("pre_add")) * F.col("factor")).alias("x")).filter("x is not null and not isnan(x)")
    usual = told.groupBy("variable").agg(F.expr("percentile_approx(x, 0.5)").alias("usual"))
    medians = told.groupBy(*key).agg(F.expr("percentile_approx(x, 0.5)").alias("median"), F.count("*").alias("n"))

    def level_of(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        return pdf[key].assign(level=smoothed(pdf["block"] // PARTS, pdf["median"], pdf["n"], pdf["usual"].iloc[0]))

    ship(rows.sparkSession)
    fields = f"site string, device string, variable {dict(read.dtypes)['variable']}, block bigint"
    spans = read.select(*key).distinct().join(medians, key, "left").join(small(usual), "variable", "left").fillna(0, ["n"]).fillna(0.0, ["usual"])
    level = cut(spans.groupBy(*chain).applyInPandas(level_of, f"{fields}, level double"))
    spread = told.join(small(level), key).groupBy("variable").agg((F.expr("percentile_approx(x - level, 0.84) - percentile_approx(x - level, 0.16)") / 2).alias("spread"))
    work = read.drop("pre_add", "factor").join(small(level), key).join(small(spread), "variable", "left").fillna(LEAST_SPREAD, ["spread"])

    def seen(pdf: pd.DataFrame) -> Iterator[tuple[int, int, list[Unit], np.ndarray, np.ndarray]]:
        """(begin, end, units, log-likelihoods, told states) of every block; what a variable's blocks have in common is computed at once."""
        blocks, runs = starts_of(pdf, key), starts_of(pdf, ["variable"])
        for a, b in zip(runs, runs[1:]):
            part = pdf.iloc[a:b]
            units = options[part["variable"].iat[0]]
            logs = emissions(part["amount"].to_numpy(), units, part["level"].to_numpy(), float(part["spread"].iat[0]))
            told = part["unit"].map({u[0]: j for j, u in enumerate(units)}).fillna(-1).to_numpy().astype(int)
            inner = blocks[(blocks >= a) & (blocks <= b)]
            for c, d in zip(inner, inner[1:]):
                yield c, d, units, logs[c - a : d - a], told[c - a : d - a]

    def matrix(pdf: pd.DataFrame) -> pd.DataFrame:
        scores = [transfer(logs, told).ravel() for _, _, _, logs, told in seen(pdf)]
        return pdf[key].iloc[starts_of(pdf, key)[:-1]].assign(scores=scores)

    def bounds(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        k = int(len(pdf["scores"].iloc[0]) ** 0.5)  # k * (k + 1) scores
        found = boundaries([np.asarray(s).reshape(k + 1, k) for s in pdf["scores"]])
        return pdf[key].assign(before=[-1 if b is None else b for b, _ in found], last=[x for _, x in found])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        path, pre, factor, sure = np.empty(len(pdf), int), np.empty(len(pdf)), np.empty(len(pdf)), np.empty(len(pdf), bool)
        name = np.empty(len(pdf), object)
        before, last = pdf["before"].to_numpy(), pdf["last"].to_numpy()
        for a, b, units, logs, told in seen(pdf):
            path[a:b] = decoded_path(logs, told, STAY, None if before[a] < 0 else int(before[a]), int(last[a]))
            sure[a:b] = told >= 0
            name[a:b], pre[a:b], factor[a:b] = (np.array([u[k] for u in units])[path[a:b]] for k in range(3))
        milli = np.rint((pdf["amount"].to_numpy() + pre) * factor * 1000).astype(np.int64)
        return pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "told": sure, "unit": name, "common_milli": milli})

    in_order = lambda df: df.repartition(*key).sortWithinPartitions(*key, "received_dtm", "row_id")
    matrices = in_order(work).mapInPandas(grouped(key, matrix), f"{fields}, scores array<double>")
    ends = cut(matrices.groupBy(*chain).applyInPandas(bounds, f"{fields}, before int, last int"))
    return in_order(work.join(small(ends), key)).mapInPandas(grouped(key, one), "row_id bigint, told boolean, unit string, common_milli bigint")


def inferred_units(rows: DataFrame, variables: DataFrame, factors: DataFrame, sites: DataFrame) -> DataFrame:
    """(row_id, unit, common_milli) of the amounts that tell no unit."""
    return decoded_units(rows, variables, factors, sites).filter("not told").drop("told")


def p7_found(rows: DataFrame, variables: DataFrame, factors: DataFrame, sites: DataFrame) -> DataFrame:
    """(row_id, common_milli) of the amounts whose unit is told."""
    return decoded_units(rows, variables, factors, sites).filter("told").select("row_id", "common_milli")
