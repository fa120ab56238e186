"""The composed jobs: identities, raw rows to preprocessed ones, preprocessed rows to facts, and repairs of versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import small

from .blocks import numbered
from .dedupe import DROPPED, drop_indicator, indicator_stats, mark_duplicates, newest_rows, with_history
from .ids import extend_dictionary, one_to_one
from .joins import lookup_left
from .keys import key_hash, with_bucket
from .normalize import age_years, event_time
from .quality import counters
from .versioning import BY, FROM, continue_row_ids, merge_derived, stamped


def identities(profiles: DataFrame, known_people: DataFrame, known_keys: DataFrame, source_key: str, natural_id: str, newest: Sequence[str], buckets: int, version: int) -> DataFrame:
    """(source_key, natural_id, entity_id, key_id, bucket_id, row_id, versions): one row per source key, its newest profile; ids are stable.

    known_people: entity_id, natural id. known_keys: key_id, source key.
    """
    one = newest_rows(profiles.select(source_key, natural_id, *newest), [source_key], newest).filter(F.col(natural_id).isNotNull())
    people = extend_dictionary(known_people, one, natural_id, "entity_id")
    keyed = extend_dictionary(known_keys, one, source_key, "key_id")
    out = one.select(source_key, natural_id).join(people, natural_id).join(keyed, source_key)
    out = with_bucket(out, "entity_id", buckets)
    return stamped(numbered(out, ["bucket_id"], [F.col("entity_id"), F.col("key_id")], "row_id"), version).select(source_key, natural_id, "entity_id", "key_id", "bucket_id", "row_id", FROM, BY)


def identity_counters(old: DataFrame, new: DataFrame, source_key: str, natural_id: str) -> DataFrame:
    """One row: source keys in all, new ones, those whose natural id changed, and keys or entities that aren't one to one."""
    seen = old.select(source_key, F.col(natural_id).alias("__was")).distinct()
    joined = new.select(source_key, natural_id, "entity_id", "key_id").join(seen, source_key, "left")
    counted = joined.agg(F.count("*").alias("n"), F.count_if(F.col("__was").isNull()).alias("added"), F.count_if(F.col("__was") != F.col(natural_id)).alias("changed"))
    faults = one_to_one(new, source_key, "key_id").unionByName(one_to_one(new, natural_id, "entity_id")).agg(F.count("*").alias("collisions"))
    return counted.join(faults)  # one row each


def expire_seen(old: DataFrame, new: DataFrame, key: str, version: int) -> DataFrame:
    """A versioned map in which every key that comes again supersedes its active row."""
    again = new.select(key).distinct().withColumn("__again", F.lit(True))
    ended = old.join(again, key, "left").withColumn(BY, F.when((F.col(BY) == 0) & F.col("__again").isNotNull(), version).otherwise(F.col(BY)).cast("bigint")).drop("__again")
    return ended.unionByName(new)


def preprocess(raw: DataFrame, identity: DataFrame, source_key: str, business_key: Sequence[str], newest: Sequence[str], buckets: int, marker: Column | None = None, prefix: str = "CHECK", history: DataFrame | None = None, merged: DataFrame | None = None, known_only: bool = False) -> DataFrame:
    """Raw rows with entity, bucket, key hash and class; unknown source keys are entity 0.

    ``history`` has preprocessed rows of earlier versions (with their row_id): those of source keys in ``merged``
    are processed again, as batch 0. ``known_only`` keeps rows of known entities, for trial runs on a sample.
    """
    if history is not None and merged is not None:
        raw = with_history(raw.withColumn("row_id", F.lit(0).cast("bigint")), history, merged, source_key, "batch")
    resolved = lookup_left(raw, identity.select(source_key, "entity_id"), source_key, {"entity_id": 0})
    if known_only:
        resolved = resolved.filter("entity_id <> 0")
    keyed = with_bucket(resolved, "entity_id", buckets)
    keyed = keyed.withColumn("key_hash", key_hash(keyed, business_key))
    repeated = mark_duplicates(keyed, ["bucket_id", "key_hash"], newest, "__dup")
    row = F.coalesce("row_id", F.lit(0)) if "row_id" in raw.columns else F.lit(0)
    return repeated.withColumn("indicator", drop_indicator(F.col("__dup"), row, F.col("entity_id"), marker if marker is not None else F.lit(""), prefix)).drop("__dup")


def preprocess_stats(preprocessed: DataFrame) -> dict[str, dict[str, int]]:
    """INPUT and OUTPUT counts of a preprocessed table, as its stats file has them."""
    s = indicator_stats(preprocessed).first().asDict()
    raw, again = s["raw_records"], s["re_processed_records"]
    dropped = {c: s[c.lower()] for c in DROPPED}
    return {"INPUT": {"RAW_TOTAL": s["raw_total"], "RE_PROCESSED_TOTAL": s["re_processed_total"], **dropped}, "OUTPUT": {"TOTAL": raw + again, "RAW_RECORDS": raw, "RE_PROCESSED_RECORDS": again}}


def check_preprocessed(stats: dict[str, dict[str, int]], limit_percent: float) -> None:
    """Raises if more than the limit of raw rows are duplicates, or of rows belong to nobody."""
    given, out = stats["INPUT"], stats["OUTPUT"]
    shares = {"duplicates": given["RAW_DUPLICATE"] * 100 // max(given["RAW_TOTAL"], 1), "rows of nobody": given["FACT_ONLY_PATIENT"] * 100 // max(out["TOTAL"] + given["FACT_ONLY_PATIENT"], 1)}
    bad = {k: v for k, v in shares.items() if v > limit_percent}
    if bad:
        raise ValueError(f"above {limit_percent} %: {bad}")


def kept(preprocessed: DataFrame) -> DataFrame:
    return preprocessed.filter(~F.col("indicator").isin(*DROPPED))


def facts(preprocessed: DataFrame, last_rows: DataFrame, version: int) -> DataFrame:
    """Kept rows with row ids that go on in each bucket (last_rows: bucket_id, max_row_id) and their version."""
    return stamped(continue_row_ids(kept(preprocessed).drop("indicator", "row_id"), last_rows, "bucket_id", [F.col("key_hash")]), version)


def aged(df: DataFrame, births: DataFrame, primary: str, times: Sequence[str]) -> DataFrame:
    """Adds event_ts (the primary time, else the least of all) and age_years; births: entity_id, birth_ts."""
    timed = lookup_left(df, births.select("entity_id", "birth_ts"), "entity_id").withColumn("event_ts", event_time(F.col(primary), [F.col(t) for t in times]))
    return timed.withColumn("age", age_years(F.col("event_ts"), F.col("birth_ts"))).drop("birth_ts")


def fact_counters(df: DataFrame, enrichments: Sequence[str], now: int) -> DataFrame:
    """One row: all facts, and those without time, in the future, of nobody, of negative, no or great age, and with no enrichment at all."""
    none = reduce(Column.__and__, (F.col(c).isNull() for c in enrichments)) if enrichments else F.lit(False)
    return counters(df, null_time=F.col("event_ts").isNull(), future=F.col("event_ts") > now, nobody=F.col("entity_id") == 0, negative_age=F.col("age") < 0, empty_age=F.col("age").isNull(), over_90=F.col("age") > 90, not_enriched=none)


def replace_hashes(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], value: str, id_col: str, keep_unknown: bool = True) -> DataFrame:
    """Columns of hashes replaced by the ids a dictionary (id, value) has for them. Unknown hashes become null, or with ``keep_unknown`` off drop the row, as lookups want it."""
    names = df.columns
    for c in columns:
        ids = dictionary.select(F.col(value).alias(c), F.col(id_col).alias("__id"))
        df = df.join(small(ids), c, "left" if keep_unknown else "inner").withColumn(c, F.col("__id")).drop("__id")
    return df.select(*names)


def map_faults(facts: DataFrame, obsolete: DataFrame, counts: tuple[int, int] | None = None) -> DataFrame:
    """(check, n) of a fact map, one row per check, n being what breaks it.

    empty_ids: rows without key hash, fact id or guid. key_across, guid_across: key hashes of a key id with several
    guids over all versions, and guids with several hashes. key_active: key hashes that are active more than once.
    fact_id_active: fact ids active more than once in their entity. obsolete_active: active rows of an entity that
    was merged away. rows: how far the map is from old rows plus new ones, if ``counts`` tells them.
    """
    active = facts.filter(f"{BY} = 0")
    several = lambda df, key, other: df.groupBy(*key).agg(F.countDistinct(other).alias("n")).filter("n > 1")
    again = lambda df, key: df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    gone = active.join(small(obsolete.select("entity_id").distinct()), "entity_id", "left_semi")
    checks = {
        "empty_ids": facts.filter("key_hash is null or fact_id is null or guid is null"),
        "key_across": several(facts, ["key_id", "key_hash"], "guid"), "guid_across": several(facts, ["key_id", "guid"], "key_hash"),
        "key_active": again(active, ["key_id", "key_hash"]), "fact_id_active": again(active, ["entity_id", "fact_id"]), "obsolete_active": gone,
    }
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n") for name, df in checks.items()]
    if counts:
        counted.append(facts.agg((F.count("*") - F.lit(sum(counts))).alias("n")).select(F.lit("rows").alias("check"), F.abs("n").alias("n")))
    return reduce(DataFrame.unionByName, counted)


def guid_activity(facts: DataFrame, guid: str = "guid") -> DataFrame:
    """One row: distinct guids that are active, all distinct guids, and whether they are as many."""
    latest = facts.groupBy(guid).agg(F.max((F.col(BY) == 0).cast("int")).alias("on"))
    return latest.agg(F.coalesce(F.sum("on"), F.lit(0)).alias("active"), F.count(guid).alias("n")).withColumn("equal", F.col("active") == F.col("n"))


def derived_table(old: DataFrame | None, new: DataFrame, key: Sequence[str], values: Sequence[str], version: int, entity: str | None = None, buckets: int = 1) -> DataFrame:
    """A derived table with history, ready to publish: nobody's rows dropped, keys checked, merged with the last version, row ids per bucket."""
    if entity:
        new = new.filter(F.col(entity) != 0)
    dup = new.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    if not dup.isEmpty():
        raise ValueError(f"the key {list(key)} is repeated")
    merged = stamped(new.select(*key, *values), version) if old is None else merge_derived(old, new, key, values, version)
    if not entity:
        return merged
    order = [F.col(c) for c in (*key, FROM)]
    return numbered(with_bucket(merged, entity, buckets), ["bucket_id"], order, "row_id")


def derived_stats(df: DataFrame, version: int, entity: str | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row: rows in all, active, inserted and superseded by the version, entities active and dropped by it, and counters of one's own."""
    on, new, gone = F.col(BY) == 0, F.col(FROM) == version, F.col(BY) == version
    counted = counters(df, active=on, inserted=new, updated=gone, **(extra or {}))
    if not entity:
        return counted
    per = df.groupBy(entity).agg(F.max(on.cast("int")).alias("now"), F.max(((F.col(FROM) < version) & (on | gone)).cast("int")).alias("before"))
    return counted.join(per.agg(F.coalesce(F.sum("now"), F.lit(0)).alias("entities_active"), F.count_if((F.col("now") == 0) & (F.col("before") == 1)).alias("entities_dropped")))  # one row each


def repair_versions(data: DataFrame, version_map: DataFrame, key: Sequence[str]) -> DataFrame:
    """Versions as the map has them; rows that the map lacks keep their own."""
    other = version_map.select(*key, F.col(FROM).alias("__f"), F.col(BY).alias("__b"))
    return data.join(other, list(key), "left").withColumns({FROM: F.coalesce("__f", FROM), BY: F.coalesce("__b", BY)}).drop("__f", "__b")


def reactivate(known: DataFrame, key: str) -> DataFrame:
    """Where a key has no active row, the row that was superseded last is active again."""
    has = known.filter(f"{BY} = 0").select(key).distinct().withColumn("__on", F.lit(True))
    top = known.groupBy(key).agg(F.max(F.struct(BY, FROM)).alias("__t"))
    j = known.join(has, key, "left").join(top, key)
    back = F.col("__on").isNull() & (F.col(BY) == F.col("__t")[BY]) & (F.col(FROM) == F.col("__t")[FROM])
    return j.withColumn(BY, F.when(back, 0).otherwise(F.col(BY)).cast("bigint")).drop("__on", "__t")


def version_counts(df: DataFrame) -> DataFrame:
    """Rows and active rows per version."""
    return df.groupBy(FROM).agg(F.count("*").alias("n"), F.count_if(F.col(BY) == 0).alias("n_active"))


def prefix_flags(df: DataFrame, entity: str, text: str, prefixes: dict[str, str]) -> DataFrame:
    """(entity, one 0/1 flag and one count per named prefix)."""
    starts = {n: F.col(text).startswith(p) for n, p in prefixes.items()}
    return df.groupBy(entity).agg(*(F.max(c.cast("int")).cast("bigint").alias(f"has_{n}") for n, c in starts.items()), *(F.count_if(c).alias(f"n_{n}") for n, c in starts.items()))


def override_time(df: DataFrame, encounters: DataFrame, on: str, at: str) -> DataFrame:
    """Event times replaced by their encounter's, where it has one."""
    return df.join(encounters.select(on, F.col(at).alias("__at")), on, "left").withColumn(at, F.coalesce("__at", at)).drop("__at")
