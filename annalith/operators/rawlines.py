"""Rows that fail to parse (problem 3): typed rows on one side, reasons with byte offsets on the other.

The tokenizer reads whole Arrow batches of records. Physical lines become records in ``records``: what a line
does to the state it is entered in, inside or outside of quotes, is a map; the maps of all lines compose along
the file, in blocks where a file is long, so every line's entry state is known without reading the file in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.fsm import tokenize
from ..session import cut, map_arrow, small
from .blocks import blocked, running

SEPARATOR, QUOTE = "|", '"'


def _bytes_of(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines begin and end in their bytes, which lie one after the other."""
    lines = pa.concat_arrays([lines.cast(pa.large_string()).fill_null("")])
    offsets = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1, lines.offset * 8)
    data = lines.buffers()[2]
    buffer = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return offsets - offsets[0], buffer


def _fields_of(lines: pa.Array, separator: int, quote: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """list<string> of raw fields, list<int> of the bytes they begin at, and that of the quoting fault (null: none) for an array of lines."""
    n = len(lines)
    if not n:
        return pa.array([], pa.list_(pa.large_string())), pa.array([], pa.list_(pa.int64())), pa.array([], pa.int64())
    offsets, buffer = _bytes_of(lines)
    at, record, fault, starts, _ = tokenize(buffer, offsets[1:], separator, quote)
    # the fields' bytes without the separators between them
    parting = at < offsets[1:][record]
    keep = np.ones(len(buffer), bool)
    keep[at[parting]] = False
    bounds = np.concatenate(([0], at - (np.cumsum(parting) - parting)))
    values = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(buffer[keep].tobytes()))
    counts = np.bincount(record, minlength=n)
    owners = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
    fields = pa.ListArray.from_arrays(owners, values)
    begins = np.zeros(len(at), np.int64)
    begins[1:] = np.where(record[1:] == record[:-1], at[:-1] + 1 - starts[record[1:]], 0)
    return fields, pa.ListArray.from_arrays(owners, pa.array(begins)), pa.array(fault, pa.int64(), mask=fault < 0)


def tokenized(rows: DataFrame, line: str = "raw_line", separator: str = SEPARATOR, quote: str = QUOTE) -> DataFrame:
    """Adds fields (array of raw fields), begins (their byte offsets) and quoting_at (byte offset of the quoting fault, null if none).

    One trailing carriage return is taken off first. A null line is an empty one.
    """
    sep, q = ord(separator), ord(quote)
    rows = rows.withColumn(line, F.regexp_replace(F.col(line), "\\r\\z", ""))
    schema = T.StructType([*rows.schema.fields, T.StructField("fields", T.ArrayType(T.StringType())), T.StructField("begins", T.ArrayType(T.LongType())), T.StructField("quoting_at", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fields, begins, fault = _fields_of(b.column(b.schema.get_field_index(line)), sep, q)
            yield pa.RecordBatch.from_arrays([*b.columns, fields, begins, fault], names=[*b.schema.names, "fields", "begins", "quoting_at"])

    return map_arrow(rows, run, schema)


def value_fits(value: Column, kind: Column) -> Column:
    """Whether a non-empty value fits its declared type; unknown types are strings."""
    number = value.rlike(r"\A-?[0-9]+\z") & value.try_cast("int").isNotNull()
    stamp = value.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]\z") & value.try_cast("timestamp_ntz").isNotNull()
    return F.when(kind == "int", number).when(kind == "double", value.rlike(r"\A-?[0-9]+(\.[0-9]+)?\z")).when(kind == "timestamp", stamp).when(kind == "flag", value.isin("Y", "N")).otherwise(F.lit(True))


def judged(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """Adds values (unquoted fields), reason and fault_at; reason is null for good rows.

    fault_at is a byte offset in the line: of the quoting fault, of the first field that is ill or too many, or
    the line's end where fields are missing. A layout_code that is null or has no layout expects no fields, so
    its lines fail by 'columns'.
    """
    shape = layout.filter("layout_code is not null").groupBy("layout_code").agg(F.array_sort(F.collect_list(F.struct("col_pos", "col_type", "may_be_empty", "col_name"))).alias("layout"))
    base = [c for c in rows.columns if c not in ("layout", "fields", "begins", "quoting_at", "values", "reason", "fault_at")]
    split = tokenized(rows.select(*base)).join(small(shape), "layout_code", "left")
    quoted = lambda f: f.startswith(QUOTE) & f.endswith(QUOTE) & (F.length(f) >= 2)
    values = F.transform("fields", lambda f: F.when(quoted(f), F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit(QUOTE * 2), F.lit(QUOTE))).otherwise(f))
    split = split.withColumn("values", F.when(F.col("quoting_at").isNull(), values))
    fine = F.zip_with("values", "layout", lambda v, c: F.when(v == "", F.coalesce(c["may_be_empty"], F.lit(False))).otherwise(value_fits(v, c["col_type"])))
    width, found = F.coalesce(F.size("layout"), F.lit(0)), F.size("fields")
    split = split.withColumn("misfit", F.when(F.col("quoting_at").isNull() & (found == width), F.array_position(fine, False)))
    reason = F.when(F.col("quoting_at").isNotNull(), "quoting").when(found != width, "columns").when(F.col("misfit") > 0, "value")
    beyond = F.coalesce(F.get("begins", width), F.octet_length("raw_line").cast("bigint"))
    at = F.when(F.col("quoting_at").isNotNull(), F.col("quoting_at")).when(found != width, beyond).when(F.col("misfit") > 0, F.get("begins", F.col("misfit") - 1))
    return split.withColumns({"reason": reason, "fault_at": at}).drop("misfit", "begins")


def rejects(rows: DataFrame, layout: DataFrame) -> DataFrame:
    """One row per bad line: reason, where, the sender's label and the fields the tokenizer and the sender counted."""
    return judged(rows, layout).filter("reason is not null").select("line_id", "reason", "fault_at", "pid_rowid", "field_count", F.size("fields").alias("fields_found"))


#: Spark types of the layout's types; all others are strings.
TYPED = {"int": "int", "double": "double", "timestamp": "timestamp_ntz"}


def loaded(rows: DataFrame, layout: DataFrame) -> dict[str, DataFrame]:
    """The good lines as typed rows, one frame per layout: line_id and the layout's columns; empty fields are null.

    A flag is a boolean. The layouts come to the driver, as they decide schemas. All frames read one table of
    judged lines in the shared folder, parted by layout.
    """
    shapes: dict[str, list[tuple[str, str]]] = {}
    for r in layout.filter("layout_code is not null").orderBy("layout_code", "col_pos").collect():
        shapes.setdefault(r["layout_code"], []).append((r["col_name"], r["col_type"]))
    good = cut(judged(rows.select("line_id", "layout_code", "raw_line"), layout).filter("reason is null").select("line_id", "layout_code", "values"))

    def column(k: int, name: str, kind: str) -> Column:
        v = F.nullif(F.get("values", F.lit(k)), F.lit(""))
        return (v == "Y" if kind == "flag" else v.cast(TYPED.get(kind, "string"))).alias(name)

    return {code: good.filter(F.col("layout_code") == code).select("line_id", *(column(k, n, t) for k, (n, t) in enumerate(columns))) for code, columns in shapes.items()}


def records(lines: DataFrame, file: str = "file_name", number: str = "line_no", line: str = "raw_line", hot_rows: int | None = None) -> DataFrame:
    """(file, number, line): the records of physical lines; those that a quoted field goes over are joined by line feeds under the first one's number.

    A quote that is never closed holds all that follows in its file, as it does for any reader; `judged` then names its offset.
    """
    schema = "file string, number bigint, line string, clear int, quoted int"
    given = lines.select(F.col(file).alias("file"), F.col(number).cast("bigint").alias("number"), F.coalesce(F.col(line), F.lit("")).alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(b.schema.get_field_index("line"))
            inside = [open_at_end(text), open_at_end(pc.binary_join_element_wise(QUOTE, text, ""))]
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, inside)], names=["file", "number", "line", "clear", "quoted"])

    mapped = blocked(map_arrow(given, run, schema), ["file"], "number", hot_rows)
    # a line that ends alike whatever it is entered in fixes the state; the others keep or turn it
    fixed, turn = F.when(F.col("clear") == F.col("quoted"), F.col("clear")), F.when(F.col("clear") > F.col("quoted"), 1).otherwise(0)
    seen = running(mapped.withColumns({"fixed": fixed, "turn": turn}), ["file"], ["number"], {"turns": ("sum", F.col("turn"))})
    seen = running(seen, ["file"], ["number"], {"last": ("last", F.when(F.col("fixed").isNotNull(), F.struct("fixed", "turns")))})
    state = F.pmod(F.coalesce("last.fixed", F.lit(0)) + F.col("turns") - F.coalesce("last.turns", F.lit(0)), F.lit(2))
    seen = running(seen.withColumn("open", state), ["file"], ["number"], {"before": ("last", F.col("open"))}, inclusive=False)
    begun = running(seen, ["file"], ["number"], {"record": ("last", F.when(F.coalesce("before", F.lit(0)) == 0, F.col("number")))})
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", "line"))), lambda x: x["line"]), "\n")
    return begun.groupBy("file", "record").agg(joined.alias("line")).select(F.col("file").alias(file), F.col("record").alias(number), F.col("line").alias(line))


def open_at_end(lines: pa.Array) -> np.ndarray:
    """1 for lines that end inside a quoted field."""
    offsets, buffer = _bytes_of(lines)
    return tokenize(buffer, offsets[1:], ord(SEPARATOR), ord(QUOTE))[4].astype(np.int32)


def p3_found(rows: DataFrame, layout: DataFrame) -> DataFrame:
    return judged(rows.select("line_id", "layout_code", "raw_line"), layout).filter("reason is not null").select("line_id", "reason")
