"""Token counts under a public byte-level BPE vocabulary.

A text splits into pieces before any merge, and the count of a piece never changes, so counts of pieces
are kept. For ASCII texts the split runs on the standard pattern engine, whose classes are spelled out
to be the tokenizer's own; other texts go to the tokenizer whole.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, types as T

from ..session import map_arrow

VOCABULARY = os.environ.get("ANNALITH_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the split pattern of the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
KEPT_PIECES = 500_000
"""Pieces kept at most; then the memory starts anew."""
KEPT_LENGTH = 24
"""Longer pieces (encoded images) are counted each time."""


class Counts(dict):
    """Tokens by piece, filled as pieces come."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = n
        return n


@lru_cache(maxsize=4)
def counter(path: str = VOCABULARY):
    """A function from text to its number of tokens."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
    encode = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    counts = Counts(encode)

    def count(text: str) -> int:
        return sum(map(counts.__getitem__, ASCII.findall(text))) if text.isascii() else len(encode(text))

    return count


def with_tokens(rows: DataFrame, text: str = "text", out: str = "n_tokens", vocabulary: str = VOCABULARY) -> DataFrame:
    """Replaces the text by its number of tokens; 0 for a null text."""
    sc = rows.sparkSession.sparkContext
    if vocabulary not in getattr(sc, "_annalith_files", ()):
        sc.addFile(vocabulary)  # the workers read their own copy
        sc._annalith_files = (*getattr(sc, "_annalith_files", ()), vocabulary)
    name = os.path.basename(vocabulary)
    schema = T.StructType([*(f for f in rows.schema.fields if f.name not in (text, out)), T.StructField(out, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(SparkFiles.get(name))
        for b in batches:
            at = b.schema.get_field_index(text)
            n = [count(x.as_py()) if x.is_valid else 0 for x in b.column(at)]
            keep = [f.name for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in keep), pa.array(n, pa.int64())], names=[*keep, out])

    return map_arrow(rows, run, schema)
