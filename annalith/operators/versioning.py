"""Rows with the version that brought them in and the one that superseded them (0 while active)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut, small
from .blocks import numbered
from .keys import key_hash, pack_guid, row_md5

FROM, BY = "valid_from", "superseded_by"


def is_refresh(version_milli: int, base_milli: int) -> bool:
    """Even versions other than the base refresh enrichments only."""
    return version_milli != base_milli and version_milli % 2 == 0


def as_of(df: DataFrame, version: int, latest_only: bool = False) -> DataFrame:
    """The table as it stood at a version: later rows gone, later supersessions undone."""
    seen = df.filter(F.col(FROM) <= version).withColumn(BY, F.when(F.col(BY) > version, 0).otherwise(F.col(BY)).cast("bigint"))
    return seen.filter(F.col(BY) == 0) if latest_only else seen


def stamped(df: DataFrame, version: int) -> DataFrame:
    return df.withColumns({FROM: F.lit(version).cast("bigint"), BY: F.lit(0).cast("bigint")})


def merge_dim(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str], version: int) -> DataFrame:
    """A lookup with history: unchanged and missing rows stay active, changed ones are superseded and follow anew, new ones are added.

    Superseded rows of ``old`` pass through. One full join, then every pair unfolds into one or two rows.
    """
    active, past = old.filter(f"{BY} = 0"), old.filter(f"{BY} <> 0")
    rest = [c for c in columns if c not in key]
    pack = lambda df, extra: df.select(*key, F.struct(*rest, *extra).alias("__r"), row_md5(list(columns)).alias("__h"))
    a, b = pack(active, [FROM]), pack(new, [])
    joined = a.withColumnsRenamed({"__r": "__o", "__h": "__oh"}).join(b.withColumnsRenamed({"__r": "__n", "__h": "__nh"}), list(key), "full")
    row = lambda src, since, until: F.struct(*(F.col(f"{src}.{c}").alias(c) for c in rest), since.cast("bigint").alias(FROM), F.lit(until).cast("bigint").alias(BY))
    now = F.lit(version)
    kept, fresh = row("__o", F.col(f"__o.{FROM}"), 0), row("__n", now, 0)
    rows = (
        F.when(F.col("__oh").isNull(), F.array(fresh)).when(F.col("__nh").isNull() | (F.col("__oh") == F.col("__nh")), F.array(kept))
        .otherwise(F.array(row("__o", F.col(f"__o.{FROM}"), version), fresh))
    )
    merged = joined.select(*key, F.inline(rows))
    return past.select(*merged.columns).unionByName(merged)


def dim_changes(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Counts of unchanged, added, changed and missing rows of two states of a lookup."""
    a = old.select(*key, row_md5(list(columns)).alias("__oh"))
    joined = a.join(new.select(*key, row_md5(list(columns)).alias("__nh")), list(key), "full")
    o, n = F.col("__oh"), F.col("__nh")
    return joined.agg(F.count_if(o == n).alias("unchanged"), F.count_if(o.isNull()).alias("added"), F.count_if(o != n).alias("changed"), F.count_if(n.isNull()).alias("missing"))


def merge_derived(old: DataFrame, new: DataFrame, key: Sequence[str], values: Sequence[str], version: int) -> DataFrame:
    """A derived table with history: changed and missing rows are superseded, changed and new ones appended, equal ones left.

    One full join of the active rows with the new ones; superseded rows pass through. A key that ``new`` has twice is an error.
    """
    columns = [*key, *values, FROM, BY]
    hashes = lambda df, p: df.select(key_hash(df, key, zero_numbers=False).alias("__k"), F.struct(*key, *values, *([FROM] if p == "o" else [])).alias(p), key_hash(df, values, zero_numbers=False).alias(f"{p}h"))
    n = hashes(new, "n")
    once = n.groupBy("__k").agg(F.max(F.struct("n", "nh")).alias("r"), F.count(F.lit(1)).alias("c"))
    once = once.select("__k", "r.n", F.when(F.col("c") > 1, F.raise_error(F.concat(F.lit("repeated key of the new table: "), F.to_json("r.n")))).otherwise(F.col("r.nh")).alias("nh"))
    joined = hashes(old.filter(f"{BY} = 0"), "o").join(once, "__k", "full")
    row = lambda p, since, by: F.struct(*(F.col(f"{p}.{c}").alias(c) for c in (*key, *values)), since.cast("bigint").alias(FROM), F.lit(by).cast("bigint").alias(BY))
    fresh, now = row("n", F.lit(version), 0), F.col(f"o.{FROM}")
    rows = F.when(F.col("oh").isNull(), F.array(fresh)).when(F.col("nh").isNull(), F.array(row("o", now, version))).when(F.col("oh") == F.col("nh"), F.array(row("o", now, 0))).otherwise(F.array(row("o", now, version), fresh))
    return old.filter(f"{BY} <> 0").select(*columns).unionByName(joined.select(F.inline(rows)).select(*columns))


def stamp_facts(data: DataFrame, known: DataFrame, obsolete_keys: DataFrame, version: int, table_id: int, full: bool = False) -> DataFrame:
    """The map of facts after a version: old rows, expired where re-delivered or of an obsolete key id, and new rows with their ids.

    data: key_hash, entity_id, key_id. known: key_hash, entity_id, key_id, fact_id, fact_key_id, valid_from,
    superseded_by. obsolete_keys: key_id. A fact keeps its number within the entity while the entity is the
    same, and within the key id always; new facts are numbered on in order of their key hash. A key hash
    delivered twice for one entity (or key id) gets one number. ``full`` takes the old rows as they are, all
    superseded by this version.

    The active map meets the data in one full join on the key hash. Numbers are given to distinct key hashes
    only, and those of a hot entity (rows of nobody are entity 0) by ranges.
    """
    columns = ["key_hash", "entity_id", "key_id", "fact_id", "fact_key_id", FROM, BY]
    active = known.filter(f"{BY} = 0").select("key_hash", F.struct("entity_id", "key_id", "fact_id", "fact_key_id", FROM).alias("o"))
    dead = small(obsolete_keys.select(F.col("key_id").alias("__dead")).filter("__dead is not null").distinct())
    met = cut(data.select("key_hash", F.struct("entity_id", "key_id").alias("d")).join(active, "key_hash", "full"))
    came = met.filter("d is not null").select("key_hash", "d.*", F.when(F.col("o.entity_id") == F.col("d.entity_id"), F.col("o.fact_id")).alias("fact_id"), F.when(F.col("o.key_id") == F.col("d.key_id"), F.col("o.fact_key_id")).alias("fact_key_id"))

    def given(group: str, number: str) -> DataFrame:
        top = known.groupBy(group).agg(F.max(number).alias("__top"))
        fresh = numbered(came.filter(F.col(number).isNull()).select(group, "key_hash").distinct(), [group], [F.col("key_hash")], "__n", bound=came)
        return fresh.join(top, group, "left").select(group, "key_hash", (F.coalesce("__top", F.lit(0)) + F.col("__n")).cast("bigint").alias(f"new_{number}"))

    new = came.join(given("entity_id", "fact_id"), ["entity_id", "key_hash"], "left").join(given("key_id", "fact_key_id"), ["key_id", "key_hash"], "left")
    new = new.withColumns({n: F.coalesce(n, f"new_{n}").cast("bigint") for n in ("fact_id", "fact_key_id")})
    old = met.filter("o is not null").select("key_hash", "o.*", F.col("d").isNotNull().alias("again")).distinct()
    ended = old.join(dead, F.col("key_id") == F.col("__dead"), "left")
    ended = ended.withColumn(BY, F.when(F.lit(full) | F.col("again") | F.col("__dead").isNotNull(), version).otherwise(0).cast("bigint"))
    whole = known.filter(f"{BY} <> 0").select(*columns).unionByName(ended.select(*columns)).unionByName(stamped(new, version).select(*columns))
    return whole.withColumn("guid", pack_guid(F.lit(table_id), F.col("key_id"), F.col("fact_key_id")))


def replay(published: DataFrame, drops: DataFrame, changes: DataFrame, key: str, latest_only: bool = False) -> DataFrame:
    """A published table, the drops of later versions, and the rows these superseded: changes has key and superseded_by."""
    ended = changes.groupBy(key).agg(F.min(BY).alias("__by"))
    old = published.join(ended, key, "left").withColumn(BY, F.when(F.col(BY) == 0, F.coalesce("__by", F.lit(0))).otherwise(F.col(BY)).cast("bigint")).drop("__by")
    whole = old.unionByName(drops)
    return whole.filter(f"{BY} = 0") if latest_only else whole


def identity_changes(old: DataFrame, new: DataFrame, source_key: str, natural_id: str, entity_id: str) -> DataFrame:
    """Source keys whose natural id changed, with both identities."""
    rename = lambda df, p: df.select(source_key, F.col(natural_id).alias(f"{p}_{natural_id}"), F.col(entity_id).alias(f"{p}_{entity_id}"))
    return rename(old, "old").join(rename(new, "new"), source_key).filter(F.col(f"old_{natural_id}") != F.col(f"new_{natural_id}"))


def continue_row_ids(new: DataFrame, last: DataFrame, bucket: str, order: Sequence[Column], out: str = "row_id") -> DataFrame:
    """Row numbers within each bucket, from its greatest one so far (last: bucket, max_row_id)."""
    ranked = numbered(new, [bucket], order, out)
    return ranked.join(small(last), bucket, "left").withColumn(out, (F.col(out) + F.coalesce("max_row_id", F.lit(0))).cast("bigint")).drop("max_row_id")


def changed_share(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose columns differ from ``old``'s row of the same key."""
    h = lambda df: key_hash(df, columns, zero_numbers=False)
    before = old.select(key, h(old).alias("__o"))
    return new.withColumn("__n", h(new)).join(before, key).filter("__o <> __n").drop("__o", "__n")


def patch(df: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Columns replaced by the non-null values of an override row with the same key."""
    columns = [c for c in overrides.columns if c != key]
    other = overrides.select(key, *(F.col(c).alias(f"__{c}") for c in columns))
    return df.join(small(other), key, "left").withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop(*(f"__{c}" for c in columns))
