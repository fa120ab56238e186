"""Mixing sources to target weights (problem 9).

Sizes are tokens. Per source the records fall into blocks by a hash of their id; only the blocks' sizes
(sources x blocks rows, whatever the number of records) reach the driver, where the plan is made. A source's
quota is met by whole passes over all its records and one last partial pass over blocks in random order. The
last of these blocks is cut by its records' running sum of tokens, so a source misses its quota by less than a
record. A splitting tree then parts the blocks of every pass among the output shards: at each node the number
of blocks of each source that go left is multivariate hypergeometric, so each shard is a uniform draw without
replacement. There are BLOCKS_PER_SHARD blocks of a source to a shard and more, so every shard can get of every
source. Records are shuffled locally within their shard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import folded
from ..session import cut, small
from .tokens import VOCABULARY, with_tokens

LEAST_BLOCKS, BLOCKS_PER_SHARD = 256, 16
SEED = 20_240_601


def source_key(c: Column) -> Column:
    """Trimmed, without case, - as _."""
    return F.replace(folded(c), F.lit("-"), F.lit("_"))


@dataclass
class SourcePlan:
    source: str
    share: float
    max_repeats: int
    tokens: int
    quota: float
    passes: int = 0
    partial: dict[int, int] = field(default_factory=dict)
    """Of the last pass: block -> tokens to take of it (all, but for the block that is cut)."""


def blocks_for(shards: int) -> int:
    return max(LEAST_BLOCKS, BLOCKS_PER_SHARD * shards)


def sized(documents: DataFrame, vocabulary: str = VOCABULARY, blocks: int = LEAST_BLOCKS) -> DataFrame:
    """(doc_id, source, n_tokens, block, place) of every record, also those of sources without a target; ``place`` orders a block at random."""
    rows = with_tokens(documents.select("doc_id", source_key(F.col("source")).alias("source"), "text"), vocabulary=vocabulary)
    mixed = F.xxhash64(F.col("doc_id"), F.lit(SEED))
    return rows.withColumns({"block": F.pmod(mixed, F.lit(blocks)).cast("int"), "place": F.xxhash64(mixed, F.lit(SEED))})


def targets_of(targets: DataFrame) -> list[tuple[str, float, int]]:
    """The targets in order of source; sources named twice add their shares and keep the larger cap."""
    rows = targets.select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats").filter("source is not null")
    return [tuple(r) for r in rows.groupBy("source").agg(F.sum("target_share"), F.max("max_repeats")).orderBy("source").collect()]


def plan(block_tokens: dict[tuple[str, int], int], total: int, targets: list[tuple[str, float, int]], seed: int = SEED) -> list[SourcePlan]:
    """Per source how often its records are used for an output of ``total`` tokens."""
    rng, plans = np.random.default_rng(seed), []
    by_source: dict[str, dict[int, int]] = {}
    for (s, b), n in block_tokens.items():
        by_source.setdefault(s, {})[b] = n
    for source, share, cap in targets:
        blocks = by_source.get(source, {})
        have, quota = sum(blocks.values()), (share or 0.0) * total
        p = SourcePlan(source, share or 0.0, cap or 0, have, quota)
        if have * p.max_repeats < quota:
            p.passes = p.max_repeats
        elif have:
            p.passes = int(quota // have)
            left = round(quota - p.passes * have)
            for b in rng.permutation(sorted(blocks)):
                if left <= 0:
                    break
                p.partial[int(b)] = min(left, blocks[b])
                left -= blocks[b]
        plans.append(p)
    return plans


def split_tree(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """(shards, sources): how many blocks of each source every shard gets; column sums are ``counts``."""
    if shards == 1:
        return counts[None, :]
    left = shards // 2
    total = int(counts.sum())
    take = rng.multivariate_hypergeometric(counts, total * left // shards, method="marginals") if total else counts * 0
    return np.vstack([split_tree(take, left, rng), split_tree(counts - take, shards - left, rng)])


def draws(plans: list[SourcePlan], block_tokens: dict[tuple[str, int], int], shards: int, seed: int = SEED) -> list[tuple[str, int, int, int, int]]:
    """(source, block, copy, tokens to take, shard), every block of every pass once."""
    rng, rows, own = np.random.default_rng(seed + 1), [], {}
    for (s, b), n in block_tokens.items():
        own.setdefault(s, {})[b] = n
    for copy in range(max([p.passes + bool(p.partial) for p in plans], default=0)):
        use = [own.get(p.source, {}) if copy < p.passes else p.partial if copy == p.passes else {} for p in plans]
        table = split_tree(np.array([len(u) for u in use], np.int64), shards, rng)
        for k, p in enumerate(plans):
            order, at = rng.permutation(sorted(use[k])), 0
            for shard in range(shards):
                for b in order[at : at + table[shard, k]]:
                    rows.append((p.source, int(b), copy, int(use[k][int(b)]), shard))
                at += table[shard, k]
    return rows


@dataclass
class Mix:
    """A mix as it was drawn: (shard, place, doc_id, source, copy, n_tokens) of its records, and the plans it follows."""

    records: DataFrame
    plans: list[SourcePlan]


def drawn(documents: DataFrame, targets: DataFrame, shards: int = 16, vocabulary: str = VOCABULARY) -> Mix:
    """Plans and draws a mix as large in tokens as all documents. The sizes are written once to the shared folder, as plan and draw both read them."""
    spark = documents.sparkSession
    sizes = cut(sized(documents, vocabulary, blocks_for(shards)))
    wanted = targets_of(targets)
    named = F.when(F.col("source").isin([s for s, _, _ in wanted]), F.col("source"))
    sums = {(r[0], r[1]): r[2] for r in sizes.groupBy(named.alias("source"), "block").agg(F.sum("n_tokens")).collect()}
    own = {k: v for k, v in sums.items() if k[0] is not None}
    plans = plan(own, sum(sums.values()), wanted)
    rows = [(*r, r[3] < own[r[0], r[1]]) for r in draws(plans, own, shards)]
    schema = "source string, block int, copy int, take bigint, shard int, part boolean"
    uses = spark.createDataFrame(rows, schema)
    met = sizes.join(small(uses), ["source", "block"])
    # only the one block of a source that is cut needs the running sum of its records
    before = F.sum("n_tokens").over(Window.partitionBy("source", "block", "copy").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    part = met.filter("part").withColumn("before", F.coalesce(before, F.lit(0))).filter("before < take").drop("before")
    columns = ["shard", F.xxhash64("place", "copy", F.lit(SEED)).alias("place"), "doc_id", "source", "copy", "n_tokens"]
    return Mix(met.filter("not part").select(*columns).unionByName(part.select(*columns)), plans)


def mix(documents: DataFrame, targets: DataFrame, shards: int = 16, vocabulary: str = VOCABULARY) -> DataFrame:
    """(shard, position, doc_id, source, copy, n_tokens): the mix, each shard in one partition and there in random order."""
    found = drawn(documents, targets, shards, vocabulary).records.withColumnRenamed("place", "position")
    return found.repartition("shard").sortWithinPartitions("shard", "position")


def write_mix(documents: DataFrame, targets: DataFrame, path: str, shards: int = 16, vocabulary: str = VOCABULARY) -> None:
    """The mix with its texts, one folder per shard, records in their shuffled order."""
    chosen = drawn(documents, targets, shards, vocabulary).records.withColumnRenamed("place", "position")
    whole = chosen.join(documents.select("doc_id", "text"), "doc_id")
    whole.repartition("shard").sortWithinPartitions("shard", "position").write.partitionBy("shard").parquet(path)


def shares(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(source, target_share, actual_share, n_tokens, n_records, most_uses, reachable) of the mix that was really drawn.

    A source is reachable if its draw falls short of its quota by less than its largest record.
    """
    made = drawn(documents, targets, 1, vocabulary)
    spark = documents.sparkSession
    got = made.records.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_records"), (F.max("copy") + 1).alias("most_uses"), F.max("n_tokens").alias("largest"))
    wanted = spark.createDataFrame([(p.source, p.share, p.quota) for p in made.plans], "source string, target_share double, quota double")
    zero = lambda c: F.coalesce(c, F.lit(0))
    whole = F.sum(zero("n_tokens")).over(Window.partitionBy(F.lit(0)))  # one row per source
    joined = wanted.join(got, "source", "left")
    reachable = F.col("quota") - zero("n_tokens") <= zero("largest")
    return joined.select("source", "target_share", (zero("n_tokens") / whole).alias("actual_share"), zero("n_tokens").alias("n_tokens"), zero("n_records").alias("n_records"), zero("most_uses").alias("most_uses"), reachable.alias("reachable"))


def p9_found(documents: DataFrame, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Sources, spelled as in the targets, whose draw falls short of their quota though it uses every record as often as it may."""
    short = shares(documents, targets, vocabulary).filter("not reachable").select(F.col("source").alias("key"))
    return targets.join(small(short), source_key(F.col("source")) == F.col("key"), "left_semi").select("source").distinct()
