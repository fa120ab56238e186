"""Declared tables: columns, types, keys and enrichments, read from JSON, and the settings of a run."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F, types as T

from .readers import flat_names, schema_of, spark_type

VERSIONED = ("valid_from", "superseded_by")


@dataclass(frozen=True)
class TableConfig:
    """One table: ``raw`` and ``final`` columns (nested ones as dictionaries), their types, keys, times and enrichments."""

    name: str
    raw: tuple = ()
    final: tuple[str, ...] = ()
    types: dict[str, str] = field(default_factory=dict)
    unique: tuple[str, ...] = ()
    newest: tuple[str, ...] = ()
    times: tuple[str, ...] = ()
    add_ons: tuple[str, ...] = ()
    hashed: tuple[str, ...] = ()
    big: bool = False

    def raw_columns(self) -> list[str]:
        return [n.upper() for c in self.raw for n in (flat_names(c) if isinstance(c, dict) else [c])]

    def raw_schema(self) -> T.StructType:
        """The raw columns with their types; hashed ones are texts."""
        names = self.raw_columns()
        known = {k.upper(): v for k, v in self.types.items()}
        return schema_of(names, [known.get(n, "STRING") for n in names], [h.upper() for h in self.hashed])

    def final_columns(self) -> list[str]:
        """The columns of a published table: declared or raw ones, enrichments, versions; each once."""
        return list(dict.fromkeys([*(c.upper() for c in self.final or self.raw_columns()), *(c.upper() for c in self.add_ons), *VERSIONED]))

    def map_columns(self) -> list[str]:
        """The columns of its version map."""
        return ["KEY_HASH", "ENTITY_ID", "ROW_ID", "FACT_ID", "GUID", *VERSIONED]


def read_tables(text: str) -> dict[str, TableConfig]:
    """Tables by upper-case name from a JSON text {name: {raw, final, types, unique, newest, times, add_ons, hashed, big}}; unknown settings are an error."""
    out = {}
    for name, given in json.loads(text).items():
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items()}
        out[name.upper()] = TableConfig(name.upper(), **known)
    return out


@dataclass(frozen=True)
class Run:
    """The settings of a run. In sample mode only the entities named, or so many rows of a table, are worked on."""

    version: int
    base: int
    buckets: int = 1000
    limit_percent: float = 80.0
    sample_entities: tuple[int, ...] = ()
    sample_rows: int = 0

    @property
    def sample(self) -> bool:
        return bool(self.sample_entities or self.sample_rows)

    def restricted(self, df: DataFrame, entity: str) -> DataFrame:
        if self.sample_entities:
            df = df.filter(F.col(entity).isin(*self.sample_entities))
        return df.limit(self.sample_rows) if self.sample_rows else df


def bootstrap(text: str, sample: str | None = None) -> Run:
    """A run from a JSON text; the settings of a second one, if given, make it a sample run."""
    return Run(**{k: tuple(v) if isinstance(v, list) else v for k, v in (json.loads(text) | (json.loads(sample) if sample else {})).items()})


def hash_fields(tables: dict[str, TableConfig]) -> dict[str, dict[str, object]]:
    """Ids for hashed columns: of each table that has any its place among all tables, and each column's place by name."""
    return {name: {"source_id": k, "field_ids": {f: i for i, f in enumerate(sorted(t.hashed))}} for k, (name, t) in enumerate(tables.items()) if t.hashed}


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns cast to the declared types, those that exist; what doesn't fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(spark_type(k)) for c, k in kinds.items() if c in df.columns})


def dim_rows(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """A lookup as declared: its columns, and of several rows of a key the least in order of the columns."""
    rows = df.select(*columns)
    if not key:
        return rows
    rest = [c for c in columns if c not in key]
    return rows.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__r")).select(*(c if c in key else F.col(f"__r.{c}").alias(c) for c in columns)) if rest else rows.distinct()
