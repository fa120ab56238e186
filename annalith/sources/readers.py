"""Delimited, JSON and Parquet drops with declared schemas, batches and file-derived columns."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from fnmatch import fnmatch
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Type names of configurations.
TYPES = {"INTEGER": T.IntegerType(), "LONG": T.LongType(), "DOUBLE": T.DoubleType(), "STRING": T.StringType(), "TEXT": T.StringType(), "TIMESTAMP": T.StringType(), "JSON": T.StringType(), "DATE": T.DateType(), "BOOLEAN": T.BooleanType(), "ARRAY[STRING]": T.ArrayType(T.StringType()), "ARRAY[DICT[STRING:STRING]]": T.ArrayType(T.MapType(T.StringType(), T.StringType()))}


def spark_type(name: str) -> T.DataType:
    return TYPES.get(name.upper(), T.StringType())


def type_name(kind: T.DataType) -> str:
    return next((n for n, t in TYPES.items() if t == kind and n != "TEXT"), "STRING")


def schema_of(names: Sequence[str], types: Sequence[str], hashed: Iterable[str] = ()) -> T.StructType:
    """Names and type names side by side; hashed columns are strings whatever their type."""
    text = set(hashed)
    return T.StructType([T.StructField(n, T.StringType() if n in text else spark_type(t)) for n, t in zip(names, types)])


def overlay_schema(header: Sequence[str], declared: dict[str, str], overrides: dict[str, str] | None = None) -> T.StructType:
    """A schema in the order of a file's header: overrides, then declared types, then STRING."""
    known = {k.upper(): v for k, v in declared.items()} | {k.upper(): v for k, v in (overrides or {}).items()}
    return T.StructType([T.StructField(n, spark_type(known.get(n.upper(), "STRING"))) for n in header])


def nested_schema(config: dict | list | str) -> T.DataType:
    """Dictionaries are structs, lists arrays of their first entry, names types."""
    if isinstance(config, dict):
        return T.StructType([T.StructField(k, nested_schema(v)) for k, v in config.items()])
    return T.ArrayType(nested_schema(config[0])) if isinstance(config, list) else spark_type(config)


def flat_names(config: dict, prefix: str = "") -> list[str]:
    return [x for k, v in config.items() for x in (flat_names(v, f"{prefix}{k}__") if isinstance(v, dict) else [f"{prefix}{k}"])]


def upper_names(kind: T.DataType) -> T.DataType:
    """The type with all field names in upper case, at any depth."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name.upper(), upper_names(f.dataType), f.nullable) for f in kind.fields])
    return T.ArrayType(upper_names(kind.elementType), kind.containsNull) if isinstance(kind, T.ArrayType) else kind


def upper_all(df: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`{f.name}`").cast(upper_names(f.dataType)).alias(f.name.upper()) for f in df.schema.fields))


def read_delimited(spark: SparkSession, path: str | list[str], schema: T.StructType, sep: str = "|", header: bool = False, mode: str = "FAILFAST", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text without quoting; the separator may have several characters."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, mode=mode, quote="", encoding=encoding)


def parse_header(said: str, sep: str = "|") -> tuple[list[str], list[str]]:
    """Names and type names of a two-line side-car, or the keys of a first JSON record (all STRING)."""
    lines = said.splitlines()
    if lines[0].lstrip().startswith("{"):
        names = list(json.loads(lines[0]))
        return names, ["STRING"] * len(names)
    return lines[0].split(sep), lines[1].split(sep) if len(lines) > 1 else ["STRING"] * len(lines[0].split(sep))


def read_header(path: str, sep: str = "|") -> tuple[list[str], list[str]]:
    return parse_header(Path(path).read_text(), sep)


def names_in(spark: SparkSession, path: str, sep: str = "|") -> list[str]:
    """The column names in the first line of a delimited file."""
    return spark.read.text(path).first()[0].split(sep)


def read_sidecar(spark: SparkSession, path: str, header: str, sep: str = "|") -> DataFrame:
    names, types = read_header(header, sep)
    return read_delimited(spark, path, schema_of(names, types), sep)


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType, strict: bool = False, casts: dict[str, str] | None = None) -> DataFrame:
    """JSON lines; ``casts`` are made after reading, and a text that doesn't fit becomes null."""
    df = spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "PERMISSIVE")
    return df.withColumns({c: F.col(c).try_cast(kind) for c, kind in (casts or {}).items()})


def repaired_json(text: Column, schema: T.StructType, repairs: Sequence[tuple[str, str]] = ((r",\s*([}\]])", "$1"), (r"([{,]\s*)'([^']*)'\s*:", '$1"$2":'))) -> Column:
    """A JSON text after repairs by pattern; null fields where it still doesn't parse."""
    for pattern, replacement in repairs:
        text = F.regexp_replace(text, pattern, replacement)
    return F.from_json(text, schema)


def read_parquet(spark: SparkSession, path: str) -> DataFrame | None:
    """None if there is nothing at the path."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(fs_path) else None


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def safe_select(df: DataFrame, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """The columns that exist, in the order asked; missing required ones are an error."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*(c for c in columns if c in df.columns))


def file_number(name: Column) -> Column:
    """The number before the extension of a file name: part_12.csv is 12."""
    return F.regexp_extract(name, r"_(\d+)\.[^/]*$", 1).try_cast("int")


def path_part(path: Column, back: int) -> Column:
    """The folder so many levels up from the file."""
    return F.element_at(F.split(path, "/"), -1 - back)


def manifest(lines: Iterable[str], pattern: str) -> list[tuple[int, list[str]]]:
    """Files of a manifest (path|batch) that match a pattern, by batch in order."""
    batches: dict[int, list[str]] = {}
    for line in lines:
        path, _, batch = line.strip().rpartition("|")
        if path and fnmatch(path.rsplit("/", 1)[-1], pattern):
            batches.setdefault(int(batch), []).append(path)
    return [(b, sorted(files)) for b, files in sorted(batches.items())]


def manifest_of(spark: SparkSession, path: str, batch: str) -> list[tuple[int, list[str]]]:
    """The batches of a folder that has one folder ``batch=n`` each, from the file system's own list."""
    return sorted((int(name.split("=", 1)[1]), [f"{path}/{name}"]) for name in listing(spark, path) if name.startswith(f"{batch}="))


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, in order; none if there is no such folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def union_batches(batches: Sequence[tuple[int, DataFrame]], out: str = "incr_counter") -> DataFrame:
    """All batches with their number; columns that a batch lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(out, F.lit(n)) for n, df in batches))


def newest_version(versions: Iterable[str], at_most: str) -> str | None:
    """The greatest 'major.mmm' not above a version."""
    key = lambda v: tuple(int(x) for x in v.split("."))
    return max((v for v in versions if key(v) <= key(at_most)), key=key, default=None)


def filtered(df: DataFrame, columns: Sequence[str] | None = None, filters: dict[str, list] | None = None) -> DataFrame:
    """IN filters by column, then the projection."""
    for c, values in (filters or {}).items():
        df = df.filter(F.col(c).isin(*values))
    return df.select(*columns) if columns else df
