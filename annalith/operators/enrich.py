"""Enrichments: columns from elsewhere joined to facts, their refresh, backfill and tables of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .blocks import numbered
from .dedupe import keep_first
from .joins import null_safe_join
from .normalize import sorted_tokens
from .versioning import BY, FROM, continue_row_ids


def canonical(df: DataFrame, separator: str = "##", joiner: str = ",") -> DataFrame:
    """All text columns with their tokens in order; a '|' in them becomes '-'."""
    return df.withColumns({f.name: sorted_tokens(F.col(f.name), separator, joiner) for f in df.schema.fields if isinstance(f.dataType, T.StringType)})


def enrichment_hash(df: DataFrame, columns: Sequence[str], separator: str = ",") -> Column:
    """SHA-256 of the columns in order of their names, texts by their sorted tokens; null is ''."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    part = lambda c: sorted_tokens(F.col(c), separator, separator) if isinstance(kinds[c], T.StringType) else F.col(c).cast("string")
    return F.sha2(F.concat_ws("|", *(F.coalesce(part(c), F.lit("")) for c in sorted(columns))), 256)


def enriched(facts: DataFrame, extra: DataFrame, on: Sequence[str], columns: Sequence[str], separator: str = "##", joiner: str = ",") -> DataFrame:
    """Facts with the columns of an enrichment, null-safe on its join fields; facts keep their number.

    The enrichment's keys take the facts' types; of several rows of a key the first in order of all columns counts.
    Columns that the facts have already are replaced.
    """
    kinds = {f.name: f.dataType for f in facts.schema.fields}
    typed = extra.select(*(F.col(c).try_cast(kinds[c]).alias(c) for c in on), *columns)
    once = keep_first(typed, on, [F.col(c).asc_nulls_last() for c in columns])
    told = canonical(once.select(*columns, *(F.col(c).alias(f"__on_{c}") for c in on)), separator, joiner) if separator else once
    keyed = told.select(*(F.col(f"__on_{c}").alias(c) for c in on), *columns) if separator else once
    return null_safe_join(facts.drop(*columns), keyed, on, "left")


def refreshed(active: DataFrame, extra: DataFrame, on: Sequence[str], columns: Sequence[str], last_rows: DataFrame, bucket: str, version: int) -> tuple[DataFrame, DataFrame]:
    """(rows whose enrichment changed, with new row ids and the version; (n, changed, percent) of all active rows).

    Only columns that the active rows have already are compared; new ones are left to ``backfilled``.
    """
    known = [c for c in columns if c in active.columns]
    before = active.withColumn("__before", enrichment_hash(active, known))
    after = enriched(before, extra, on, known)
    marked = after.withColumn("__changed", F.col("__before") != enrichment_hash(after, known))
    changed = marked.filter("__changed").drop("__before", "__changed", "row_id")
    anew = continue_row_ids(changed, last_rows, bucket, [F.col(c) for c in sorted(changed.columns) if c != bucket])
    stats = marked.agg(F.count("*").alias("n"), F.count_if("__changed").alias("changed")).withColumn("percent", F.round(F.when(F.col("n") > 0, F.col("changed") * 100.0 / F.col("n")).otherwise(F.lit(0.0)), 4))
    return anew.withColumns({FROM: F.lit(version).cast("bigint"), BY: F.lit(0).cast("bigint")}), stats


def within_expected(stats: DataFrame, expected_percent: float) -> None:
    """Raises if more than the expected share of rows changed."""
    n, changed, percent = stats.first()
    if percent > expected_percent:
        raise ValueError(f"{changed} of {n} rows changed, {percent} %; {expected_percent} % were expected")


def backfilled(versions: dict[int, DataFrame], extra: DataFrame, on: Sequence[str], columns: Sequence[str]) -> dict[int, DataFrame]:
    """The drops of all versions with the enrichment's columns, new ones after those they had."""
    out = {}
    for v, df in versions.items():
        wide = enriched(df, extra, on, columns)
        out[v] = wide.select(*df.columns, *(c for c in columns if c not in df.columns))
    return out


def refreshed_concepts(known: DataFrame, rows: DataFrame, columns: Sequence[str], id_col: str) -> DataFrame:
    """A concept dimension with the new combinations appended, their ids going on after the greatest."""
    fresh = rows.select(*columns).distinct().join(known.select(*columns), [*columns], "left_anti")
    top = known.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint").alias("__top"))
    given = numbered(fresh.withColumn("__all", F.lit(0)), ["__all"], [F.col(c) for c in columns], "__n").drop("__all")
    new = given.join(F.broadcast(top)).select((F.col("__n") + F.col("__top")).alias(id_col), *columns)  # one row
    return known.select(F.col(id_col).cast("bigint").alias(id_col), *columns).unionByName(new)
