"""Best representative of each duplicate group (problem 5): Bayesian fusion with copy detection.

Every key and field is an item on which sources vote for values. How trustworthy a source is, and whether two
sources copy from each other, depends only on which sources agree on an item and which don't, not on the
values. So all items fold map-side into vote patterns with counts: the item's voter sets and the true number of
values of each. As these numbers are as many as the data makes them, the patterns stay in Spark. Every round of
the estimation folds them into sums per source and per pair of sources that vote together, and only these reach
the driver. The posterior of each pattern's groups goes back to the items by a join on the pattern.

A prior may be put before the votes. ``survivors`` takes the order of trust that TESTDATA fixes (trust_rank,
counter, time, row) as one so strong that no vote outweighs a step of it: values are compared by the best row
that claims them first and by their posterior second. ``fuse`` has no such prior; the votes decide.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean, folded
from ..session import BROADCAST_BYTES, bytes_of, cut, ship, small

FIELDS = ("result_txt", "unit_of_measure_txt", "normal_range_txt", "specimen_txt")
#: Stand-ins for "no value", lower case.
STAND_INS = ("n/a", "na", "null", "none", "nil", "unk", "unknown", "?", "??", "-", "--", "---", ".", "nan", "not available", "not applicable", "missing", "(null)", "<null>", "#n/a", "tbd")
LAST = (1 << 31) - 1
START = 0.9
"""Accuracy that every source starts with."""
FALSE_VALUES, COPY_RATE, PRIOR = 20, 0.8, 0.1
"""False values that an item can have, the share of values that a copier copies, and the chance that two sources are dependent."""
SETTLED = 1e-6
"""Change of accuracies and dependences below which the estimation is done."""
Voters = tuple[int, ...]
Pattern = tuple[tuple[Voters, int], ...]


def value(c: Column) -> Column:
    """The trimmed value; null for blanks and stand-ins."""
    t = clean(c)
    return F.when(~F.lower(t).isin(*STAND_INS), t)


def ranked(rows: DataFrame, sites: DataFrame, *more: str) -> DataFrame:
    """(key, fields..., best, more...): ``best`` orders rows, the greatest first: lowest trust_rank (no site last), highest incr_counter, latest received, highest row_id."""
    trust = sites.filter("site_code is not null").groupBy("site_code").agg(F.min("trust_rank").alias("trust_rank"))
    joined = rows.select("row_id", "key_hash", *FIELDS, "site_code", "incr_counter", "received_dtm", *more).join(small(trust), "site_code", "left")
    best = F.struct(
        (-F.coalesce("trust_rank", F.lit(LAST)).cast("bigint")).alias("trust"),
        F.coalesce("incr_counter", F.lit(-LAST)).alias("incr"),
        F.coalesce(F.unix_micros(F.col("received_dtm").cast("timestamp")), F.lit(-(1 << 62))).alias("received"),
        F.col("row_id"),
    )
    return joined.select(folded(F.col("key_hash")).alias("key"), *(value(F.col(f)).alias(f) for f in FIELDS), best.alias("best"), *more).filter("key is not null")


def site_codes(sites: DataFrame) -> list[str]:
    return [r[0] for r in sites.select("site_code").filter("site_code is not null").distinct().orderBy("site_code").collect()]


def claims(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(key, field, value, voters, best): per item and value the ids of the sources that claim it, in order, and the first of its rows by trust.

    Values are compared trimmed and without case; ``field`` is the place in FIELDS. Sources are numbered by name
    from 1; rows of unknown sources vote as source 0.
    """
    ids = rows.sparkSession.createDataFrame([(s, k + 1) for k, s in enumerate(site_codes(sites))], "site_code string, voter int")
    stacked = ranked(rows.join(small(ids), "site_code", "left"), sites, "voter").select("key", F.coalesce("voter", F.lit(0)).alias("voter"), "best", F.posexplode(F.array(*(F.lower(F.col(f)) for f in FIELDS))).alias("field", "value"))
    return stacked.filter("value is not null").groupBy("key", F.col("field").cast("tinyint").alias("field"), "value").agg(F.array_sort(F.collect_set("voter")).alias("voters"), F.max("best").alias("best"))


def items_of(claimed: DataFrame) -> DataFrame:
    """(key, field, groups, pattern): the item's distinct voter sets in order, as (voters, n, best, value): how many values have them, the first row by trust and the least value; the pattern is (voters, n) alone.

    Values are counted per voter set first, so an item of any number of values has at most one entry per
    set of sources.
    """
    sets = claimed.groupBy("key", "field", "voters").agg(F.count("*").alias("n"), F.max("best").alias("best"), F.min("value").alias("value"))
    items = sets.groupBy("key", "field").agg(F.sort_array(F.collect_list(F.struct("voters", "n", "best", "value"))).alias("groups"))
    return items.withColumn("pattern", F.transform("groups", lambda g: F.struct(g["voters"].alias("voters"), g["n"].alias("n"))))


def _chance(log_odds: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, log_odds))))


class Model:
    """Accuracies of the sources and dependences of pairs, and what follows from them for the values of a pattern."""

    def __init__(self, accuracy: list[float], copies: dict[tuple[int, int], float]):
        self.accuracy, self.copies, self.scores = accuracy, copies, {}

    def score(self, voters: Voters) -> float:
        """A voter's weight is discounted by the chance that it copied from one counted before it."""
        if voters not in self.scores:
            total, counted = 0.0, []
            for s in sorted(voters, key=lambda s: -self.accuracy[s]):
                alone = math.prod(1 - COPY_RATE * self.copies.get((min(s, t), max(s, t)), 0.0) for t in counted)
                total += alone * math.log(FALSE_VALUES * self.accuracy[s] / (1 - self.accuracy[s]))
                counted.append(s)
            self.scores[voters] = total
        return self.scores[voters]

    def posterior(self, pattern: Pattern) -> list[float]:
        """Of one value of each voter set."""
        scores = [self.score(g) for g, _ in pattern]
        top = max(scores)
        unseen = max(0, FALSE_VALUES + 1 - sum(k for _, k in pattern)) * math.exp(-top)
        whole = sum(k * math.exp(x - top) for x, (_, k) in zip(scores, pattern)) + unseen
        return [math.exp(x - top) / whole for x in scores]


Sums = dict[tuple[int, int], list[float]]


def tally(patterns: Iterable[tuple[Pattern, int]], model: Model | None) -> Sums:
    """Sums over items by pair of sources a <= b that vote on one: values that both claim, those expected to be true, and items on which both vote.

    For a = b these are the votes of the source. Without a model there are no expectations.
    """
    sums: Sums = {}
    for p, n in patterns:
        posterior = model.posterior(p) if model else [0.0] * len(p)
        for (g, k), q in zip(p, posterior):
            for pair in itertools.combinations_with_replacement(g, 2):
                own = sums.setdefault(pair, [0.0, 0.0, 0.0])
                own[0] += n * k
                own[1] += n * k * q
        for pair in itertools.combinations(sorted({s for g, _ in p for s in g}), 2):
            sums.setdefault(pair, [0.0, 0.0, 0.0])[2] += n
    return sums


def estimate(tallied: Callable[[Model | None], Sums], n_sources: int, rounds: int = 8) -> tuple[list[float], dict[tuple[int, int], float], Model]:
    """(accuracy by source, probability of dependence by pair, model of the last round), by ``tally`` over all patterns.

    Two sources that share more false values than independent ones would are taken to copy.
    """
    accuracy, copies = [START] * n_sources, {}
    # before any value counts as true, sources that agree far more often than independent ones would are taken to copy
    apart = START**2 + (1 - START) ** 2 / FALSE_VALUES
    for (a, b), (shared, _, n) in tallied(None).items():
        if n:
            same = min(shared, n)
            copies[a, b] = _chance(same * math.log((COPY_RATE + (1 - COPY_RATE) * apart) / apart) + (n - same) * math.log(1 - COPY_RATE) + math.log(PRIOR / (1 - PRIOR)))
    model = Model(accuracy, copies)
    for _ in range(rounds):
        model = Model(accuracy, copies)
        sums = tallied(model)
        last = accuracy, copies
        votes = [sums.get((s, s), (0.0, 0.0, 0.0)) for s in range(n_sources)]
        accuracy, copies = [float(min(0.99, max(0.05, (1 + v[1]) / (1.25 + v[0])))) for v in votes], {}
        for (a, b), (shared, true, n) in sums.items():
            if not n:
                continue
            false = shared - true
            other = max(0.0, n - shared)
            x, y = accuracy[a], accuracy[b]
            same_true, same_false = x * y, (1 - x) * (1 - y) / FALSE_VALUES
            apart = max(1e-9, 1 - same_true - same_false)
            c, z = COPY_RATE, (x + y) / 2
            log_odds = true * math.log((c * z + (1 - c) * same_true) / same_true) + false * math.log((c * (1 - z) + (1 - c) * same_false) / same_false) + other * math.log(max(1e-9, (1 - c) * apart) / apart)
            log_odds += math.log(PRIOR / (1 - PRIOR))
            copies[a, b] = _chance(log_odds)
        if max((abs(x - y) for x, y in zip(accuracy, last[0])), default=0.0) < SETTLED and max((abs(q - last[1].get(k, 0.0)) for k, q in copies.items()), default=0.0) < SETTLED:
            break
    return accuracy, copies, model


def read_patterns(batches: Iterable[pd.DataFrame]) -> Iterator[tuple[Pattern, int]]:
    for batch in batches:
        for pattern, n in zip(batch["pattern"], batch["n_items"]):
            yield tuple((tuple(int(v) for v in e["voters"]), int(e["n"])) for e in pattern), int(n)


def estimated(items: DataFrame, n_sources: int) -> tuple[list[float], dict[tuple[int, int], float], DataFrame]:
    """(accuracy, copies, (pattern, posteriors) of every pattern, one for each of its voter sets)."""
    ship(items.sparkSession)
    patterns = cut(items.groupBy("pattern").agg(F.count("*").alias("n_items")))
    few = bytes_of(patterns) <= BROADCAST_BYTES
    if few:  # patterns are far fewer than items: mostly one task is enough, and nothing is to be merged
        patterns = patterns.coalesce(1)

    def tallied(model: Model | None) -> Sums:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            yield pd.DataFrame([(*pair, *s) for pair, s in tally(read_patterns(batches), model).items()], columns=["a", "b", "shared", "true", "both"])

        found = patterns.mapInPandas(run, "a int, b int, shared double, true double, both double")
        found = found if few else found.groupBy("a", "b").agg(*(F.sum(c) for c in ("shared", "true", "both")))
        return {(r[0], r[1]): [r[2], r[3], r[4]] for r in found.collect()}  # a row per pair of sources

    accuracy, copies, model = estimate(tallied, n_sources)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [([{"voters": g, "n": k} for g, k in p], model.posterior(p)) for p, _ in read_patterns([batch])]
            yield pd.DataFrame(made, columns=["pattern", "posteriors"])

    return accuracy, copies, patterns.mapInPandas(run, "pattern array<struct<voters:array<int>,n:bigint>>, posteriors array<double>")


def judged(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(key, field_name, n_values, groups) of every item, a group being (best, posterior, value) of the values of one voter set."""
    items = cut(items_of(claims(rows, sites)))  # it is read for the patterns and for the posteriors
    _, _, scored = estimated(items, len(site_codes(sites)) + 1)
    names = F.array(*(F.lit(f) for f in FIELDS))
    joined = items.join(small(scored), "pattern")
    groups = F.zip_with("groups", "posteriors", lambda g, p: F.struct(g["best"].alias("best"), p.alias("posterior"), g["value"].alias("value")))
    return joined.select("key", F.get(names, F.col("field")).alias("field_name"), F.aggregate("pattern", F.lit(0).cast("bigint"), lambda n, g: n + g["n"]).alias("n_values"), groups.alias("groups"))


def fuse(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(key_hash, field_name, value, posterior, n_values): the value of greatest posterior for every key and field; ties go to the lesser value.

    Items without any value have no row.
    """
    top = F.array_min(F.transform("groups", lambda g: F.struct((-g["posterior"]).alias("p"), g["value"].alias("value"))))
    return judged(rows, sites).withColumn("b", top).select(F.col("key").alias("key_hash"), "field_name", F.col("b.value").alias("value"), (-F.col("b.p")).alias("posterior"), "n_values")


def survivors(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(key_hash, field_name, row_id, posterior, n_values): the same under the order of trust as prior, for keys with two or more rows.

    row_id is the row that supplies the value. A field that no row has is left out.
    """
    chosen = judged(rows, sites).withColumn("b", F.array_max(F.transform("groups", lambda g: F.struct(g["best"].alias("best"), g["posterior"].alias("posterior")))))
    repeated = rows.select(folded(F.col("key_hash")).alias("key")).filter("key is not null").groupBy("key").agg(F.count("*").alias("n")).filter("n >= 2").select("key")
    return chosen.join(repeated, "key", "left_semi").select(F.col("key").alias("key_hash"), "field_name", F.col("b.best.row_id").alias("row_id"), F.col("b.posterior").alias("posterior"), "n_values")


def p5_found(rows: DataFrame, sites: DataFrame) -> DataFrame:
    return survivors(rows, sites).select("key_hash", "field_name", "row_id")


def source_accuracy(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(source, accuracy, copies_with, dependence): estimated accuracy, and the source it most likely shares copies with."""
    codes = site_codes(sites)
    accuracy, copies, _ = estimated(items_of(claims(rows, sites)), len(codes) + 1)
    names, out = ["(none)", *codes], []
    for k, name in enumerate(names):
        near = max(((q, b if a == k else a) for (a, b), q in copies.items() if k in (a, b)), default=(0.0, None))
        out.append((name, accuracy[k], names[near[1]] if near[1] is not None else None, near[0]))
    return rows.sparkSession.createDataFrame(out, "source string, accuracy double, copies_with string, dependence double")
