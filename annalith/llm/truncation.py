"""Text cut off by field limits or in transfer (problem 10).

Two kinds of evidence, both taken from the corpus itself.

*Hidden limits.* The length of every text is recomputed under the encodings and escapings a store could
have measured it in. A length that many different texts of one source share is a storage limit of it.

*Endings.* Every text is cut into blocks (paragraphs, cells, outputs), and a line is reduced to its
shape: words, identifiers, numbers with their decimals and strings by class. The ends of all inner
blocks tell how complete blocks end. A text whose last line has a shape that never, or far more rarely
than at the end of texts, ends an inner block was cut; so was one that ends in a fragment of a word, in
an open fence or record, or in a table row shorter than the one before. A line that closes many texts
word for word is a closing line. At a limit also an ending that could be complete counts as cut,
unless it closes a sentence, a fence or a record.

One pass over the texts gives a small row per document and per-slice counts of shapes and words, which
are written to the shared folder; the rest works on these.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import bytes_of, cut, is_table, map_arrow, ship
from .leaks import slices
from .mixing import source_key

ENCODINGS = ("characters", "utf8", "utf16", "characters_crlf", "utf8_crlf", "json", "json_ascii", "entities", "entities_quotes")
LIMIT_TEXTS, NEAR, SIGMAS = 5, 16, 6.0
"""A length is a limit if at least so many different texts have it, and more than is usual among so many lengths to either side by so many deviations."""
EXCESS = 4.0
"""Times more often than inside texts that a shape must end texts to tell of cuts."""
CLOSING_SHARE, CLOSING_LINES = 0.0005, 2
"""Share and number of texts that a closing line must end."""
LINE_AS_WRITTEN = 60
"""Longer lines are compared by a hash of 128 bits."""
WORD_SHARE, WORD_TIMES = 0.0002, 2
"""A word is known if it occurs, but for ends of texts, so often per document and at least so many times."""

#: Joining words, which shapes keep, and conjunctions, which are one class.
JOINING = frozenset("the of is and a an in to for as by at on or none not from with der die das und von ist la el de es y le les et est".split())
CONJUNCTIONS = frozenset("so while because although unless whenever before after when if".split())
TOKEN = re.compile(r"""'[^'\n]*'|"[^"\n]*"|\d+\.\d+|\d+|[^\W\d]\w*|\s+|.""")
IMAGE = re.compile(r"[A-Za-z0-9+/]{40,}")
LETTERS = re.compile(r"[^\W\d_]+")
LAST_WORD = re.compile(r"[^\W\d_]+$")
NUMBER = re.compile(r"\d+(\.\d+)?$")
LENGTH_BLOCK = 4096
"""Lengths of a source and encoding are looked through in blocks of so many."""
BESIDE_BYTES = 512 << 10
"""Stored size up to which a side is broadcast; in the driver's heap it may be a hundred times as large."""
SHORT_WORD = 3
"""Words up to this length are known only if they also end an inner block: names in code are often so short."""


def shape(kind: str, line: str) -> str:
    """The class of a line: of prose only its ending, of headings and lists the number of words, of code and output every token's class."""
    t = line.strip()
    if kind == "prose":
        if t.startswith("#"):
            mark, _, rest = t.partition(" ")
            return f"{'heading' if not mark.strip('#') else 'tag'} {len(rest.split())}"
        if t == "-" or t.startswith("- "):
            return f"list {len(t[2:].split())}"
        return "prose ..." if t.endswith("...") else f"prose {'a' if t[-1:].isalpha() else '9' if t[-1:].isdigit() else t[-1:]}"
    out = []
    for m in TOKEN.finditer(IMAGE.sub("@", t)):
        x = m.group()
        if x[0] in "'\"" and len(x) > 1:
            out.append("s")
        elif x[0].isdigit():
            out.append(f"9.{'d' * len(x.partition('.')[2])}" if "." in x else "9")
        elif x[0].isspace():
            out.append(" ")
        elif x[0].isalpha() or x[0] == "_":
            low = x.lower()
            out.append("i" if "_" in x else "c" if low in CONJUNCTIONS else low if low in JOINING else "w")
        else:
            out.append(x)
    return f"{kind} {''.join(out)}"


def plain(kind: str, line: str, percent: bool) -> str:
    """The line without the comment marks of the percent layout."""
    if percent and kind == "prose":
        return line[2:] if line.startswith("# ") else line[1:] if line.startswith("#") else line
    if percent and kind == "output":
        return line[2:].lstrip() if line.startswith("#>") else line
    return line


def read_blocks(text: str) -> tuple[list[tuple[str, str]], str, str, str]:
    """(ends of inner blocks as (kind, line), kind of the last block, last line, line before it).

    The kind is 'prose', 'code', 'output', 'fence' right after a closing fence, 'open' in an open one,
    'record' and 'open' for texts of one record per line.
    """
    if text.startswith('{"cell"'):
        last = text.rstrip("\n").rpartition("\n")[2]
        return [], "open" if last.startswith("{") and not last.endswith('"}') else "record" if last.startswith("{") else "prose", last, ""
    percent = "# %%" in text
    ends, fence, kind, prev, before = [], None, "prose", "", ""
    for line in (text[:-1] if text.endswith("\n") else text).split("\n"):
        if not percent and line.startswith("```"):
            if fence is None:
                fence = kind = "output" if line.startswith("```output") else "code"
            else:
                ends.append((fence, prev))
                fence, kind = None, "fence"
        elif fence is None:
            if not line or line.isspace():
                if kind != "fence" and prev and not prev.isspace():
                    ends.append((kind, plain(kind, prev, percent)))
                if not (percent and kind == "prose"):
                    kind = "prose"
            elif line.startswith("# %% [markdown]"):
                kind = "prose"
            elif line.startswith(("# %%", "In [")):
                kind = "code"
            elif line.startswith(("Out[", "#>")):
                kind = "output"
            elif kind == "fence":
                kind = "prose"
        before, prev = prev, line
    kind = "open" if fence is not None else kind
    return ends, kind, plain(kind, prev, percent), plain(kind, before, percent)


def short_row(line: str, before: str) -> bool:
    """Whether a table row has fewer cells than the row or header before it tells."""
    cells, above = line.split(), before.split()
    if len(cells) < 2 or not all(NUMBER.match(c) for c in cells):
        return False
    if above and all(NUMBER.match(c) for c in above):
        return len(cells) < len(above)
    return len(above) > 1 and all(c.isalpha() for c in above) and len(cells) < len(above) + 1


def lengths(text: str) -> list[int]:
    """The length under each of ENCODINGS."""
    n, lines, quotes, slashes = len(text), text.count("\n"), text.count('"'), text.count("\\")
    size = n if text.isascii() else len(text.encode("utf-8", "replace"))
    marked = 4 * text.count("&") + 3 * (text.count("<") + text.count(">"))
    escaped = lines + quotes + slashes + text.count("\t") + text.count("\r")
    wide = 0 if text.isascii() else sum(12 if ord(c) > 0xFFFF else 6 for c in text if ord(c) > 127) - sum(1 for c in text if ord(c) > 127)
    astral = 0 if text.isascii() else sum(ord(c) > 0xFFFF for c in text)
    return [n, size, 2 * (n + astral), n + lines, size + lines, size + escaped, n + escaped + wide, n + marked, n + marked + 5 * quotes + 5 * text.count("'")]


def line_key(line: str) -> str:
    return line if len(line) <= LINE_AS_WRITTEN else "#" + hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=16).hexdigest()


SCHEMA = "doc_id bigint, source string, text_hash bigint, lengths array<bigint>, shape string, word string, line string, what string, n bigint"


def scan(documents: DataFrame) -> DataFrame:
    """One row per text ('text': its lengths and ending), and per slice the counts of shapes of inner ends ('shape'), of words ('word') and of short words that end inner blocks ('end')."""
    rows = documents.select("doc_id", "text", source_key(F.col("source")).alias("source"), F.xxhash64("text").alias("text_hash")).filter("text is not null")
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, more in slices(batches):
            inner, words, last_words, out = Counter(), Counter(), Counter(), []
            for doc_id, text, (source, text_hash) in zip(ids, texts, more):
                ends, kind, line, before = read_blocks(text)
                inner.update(shape(k, x) for k, x in ends)
                last_words.update(m.group().lower() for _, x in ends if (m := LAST_WORD.search(x.rstrip(". "))) and len(m.group()) <= SHORT_WORD)
                found = LETTERS.findall(IMAGE.sub(" ", text).lower())
                last = LAST_WORD.search(line.rstrip("."))
                words.update(found)
                word = last.group().lower() if last else None
                if word and found and found[-1] == word:
                    words[word] -= 1
                if kind in ("open", "fence", "record"):
                    form = kind
                elif not text or text.isspace():
                    form = "empty"
                elif not line or line.isspace() or line[-1].isspace():
                    form = "blank"
                elif short_row(line, before):
                    form = "short row"
                else:
                    form = shape(kind, line)
                t = line.strip()
                out.append((doc_id, source, text_hash, lengths(text), form, word, line_key(t) if kind == "prose" and t and not t[-1].isalnum() else None, "text", 1))
            out += [(None, None, None, None, s, None, None, "shape", n) for s, n in inner.items()]
            out += [(None, None, None, None, None, w, None, "word", n) for w, n in words.items() if n > 0]
            out += [(None, None, None, None, None, w, None, "end", n) for w, n in last_words.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return map_arrow(rows, run, SCHEMA)


def distinct_limits(sets: list[tuple[list[tuple[int, int]], int]], least: dict[tuple[int, int], float]) -> list[tuple[int, int]]:
    """The (encoding, length) that explain the texts, those of most texts first, given the candidates of every text, with the number of texts.

    One counts only if it stands out (``least``) by texts that those before it leave.
    """
    found = []
    while True:
        left: Counter = Counter()
        for given, n in sets:
            left.update(dict.fromkeys(given, n))
        best = max((c for c in left if left[c] > least[c]), key=lambda c: (left[c], -c[0], -c[1]), default=None)
        if best is None:
            return found
        found.append(best)
        sets = [(given, n) for given, n in sets if best not in given]


def beside(df: DataFrame) -> DataFrame:
    """The side of a join, written once: broadcast if that is small, else merged. Spark's own threshold would broadcast up to 10 MB of files or of compressed shuffle."""
    df = df if is_table(df) else cut(df)
    return df.hint("broadcast" if bytes_of(df) <= BESIDE_BYTES else "merge")


def surrounded(counts: DataFrame) -> DataFrame:
    """The counts with ``near``: the texts of up to NEAR lengths to either side, without the greatest of these, which may be a limit too.

    Lengths near the edge of a block are in the next one as well, so each row meets all its neighbours in its own block.
    """
    place = F.expr(f"at_length div if(encoding = {ENCODINGS.index('utf16')}, 2, 1)")  # in utf16 odd lengths don't occur
    block = lambda at: F.floor(at / LENGTH_BLOCK)
    spread = counts.withColumn("place", place).withColumn("block", F.explode(F.sequence(block(F.col("place") - NEAR), block(F.col("place") + NEAR))))
    by_length = Window.partitionBy("source", "encoding", "block").orderBy("place")
    sides = by_length.rangeBetween(-NEAR, -1), by_length.rangeBetween(1, NEAR)
    n = F.lit(0)
    for side in sides:
        n += F.coalesce(F.sum("n_texts").over(side), F.lit(0))
    near = n - F.coalesce(F.greatest(*(F.max("n_texts").over(side) for side in sides)), F.lit(0))
    return spread.withColumn("near", near).filter(F.col("block") == block(F.col("place"))).drop("block")


def limits(texts: DataFrame) -> DataFrame:
    """(source, encoding, at_length, n_texts): the hidden limits of each source, each in the encoding that shows it best; texts of no source are one source, ''."""
    ship(texts.sparkSession)
    place = ["source", "encoding", "at_length"]
    flat = texts.select(F.coalesce("source", F.lit("")).alias("source"), "text_hash", F.posexplode("lengths").alias("encoding", "at_length"))
    counts = flat.groupBy(*place).agg(F.countDistinct("text_hash").alias("n_texts"))
    usual = F.col("near") / (NEAR - 1 + F.least(F.lit(NEAR), F.col("place")))
    least = F.greatest(F.lit(LIMIT_TEXTS - 1), usual + SIGMAS * F.sqrt(usual) + LIMIT_TEXTS - 1)
    spikes = cut(surrounded(counts).filter(F.col("n_texts") >= LIMIT_TEXTS).withColumn("least", least).filter("n_texts > least").select(*place, "n_texts", "least"))
    by_text = flat.join(beside(spikes), place).groupBy("source", "text_hash").agg(F.sort_array(F.collect_set(F.struct("encoding", "at_length", "least"))).alias("given"))
    sets = by_text.groupBy("source", "given").agg(F.count("*").alias("n"))

    def chosen(pdf: pd.DataFrame) -> pd.DataFrame:
        least = {(e["encoding"], e["at_length"]): e["least"] for given in pdf["given"] for e in given}
        found = distinct_limits([([(e["encoding"], e["at_length"]) for e in given], n) for given, n in zip(pdf["given"], pdf["n"])], least)
        return pd.DataFrame([(pdf["source"].iat[0], *c) for c in found], columns=place)

    return spikes.drop("least").join(sets.groupBy("source").applyInPandas(chosen, "source string, encoding int, at_length bigint").hint("merge"), place)


def judged(documents: DataFrame) -> DataFrame:
    """(doc_id, source, ending, at_limit, truncated) of every non-null text; empty texts aren't truncated."""
    scanned = cut(scan(documents))
    texts = scanned.filter("what = 'text'").select("doc_id", "source", "text_hash", "lengths", "shape", "word", "line")
    inner = scanned.filter("what = 'shape'").groupBy("shape").agg(F.sum("n").alias("inner_n"))
    words = scanned.filter("what = 'word'").groupBy("word").agg(F.sum("n").alias("word_n"))
    finals = texts.groupBy("shape").agg(F.count("*").alias("final_n"))
    closing = texts.filter("line is not null").groupBy("line").agg(F.count("*").alias("line_n"))
    totals = texts.agg(F.count("*").alias("docs")).collect()[0][0], scanned.filter("what = 'shape'").agg(F.sum("n")).collect()[0][0] or 1
    n_docs, n_inner = totals
    ending_words = scanned.filter("what = 'end'").select("word").distinct().withColumn("ends", F.lit(True))
    usual = words.filter(F.col("word_n") >= max(WORD_TIMES, WORD_SHARE * n_docs)).join(ending_words.hint("merge"), "word", "left")
    known = usual.filter((F.length("word") > SHORT_WORD) | F.col("ends")).select("word", F.lit(True).alias("known"))
    closes = closing.filter(F.col("line_n") >= max(CLOSING_LINES, CLOSING_SHARE * n_docs)).select("line", F.lit(True).alias("closes"))
    rates = finals.join(inner.hint("merge"), "shape", "left").select("shape", F.coalesce("inner_n", F.lit(0)).alias("inner_n"), "final_n")
    limited = limits(texts).groupBy(F.col("source").alias("of")).agg(F.collect_list(F.struct("encoding", "at_length")).alias("limits"))
    joined = texts.withColumn("of", F.coalesce("source", F.lit(""))).join(beside(limited), "of", "left").join(beside(rates), "shape").join(beside(known), "word", "left").join(beside(closes), "line", "left")
    # a limit in bytes may fall into a character, of which up to three bytes are then lost
    wide = F.get("lengths", F.lit(ENCODINGS.index("characters"))) != F.get("lengths", F.lit(ENCODINGS.index("utf8")))
    in_bytes = [ENCODINGS.index(e) for e in ("utf8", "utf8_crlf", "json")]
    reaches = lambda x: F.get("lengths", x["encoding"]).between(x["at_length"] - F.when(wide & x["encoding"].isin(in_bytes), 3).otherwise(0), x["at_length"])
    at_limit = F.coalesce(F.exists("limits", reaches), F.lit(False))
    whole = F.col("shape").isin("fence", "record", "empty")
    sentence = F.col("shape").isin("prose .", "prose !", "prose ?", "prose :")
    closing_line = F.coalesce("closes", F.lit(False)) & ~sentence
    never = F.col("inner_n") == 0
    expected = F.col("inner_n") * n_docs / n_inner
    rarely = F.col("final_n") > EXCESS * (expected + F.sqrt(expected) + 1)
    fragment = F.col("word").isNotNull() & F.col("known").isNull() & ~sentence
    odd = F.col("shape").isin("open", "blank", "short row") | ((never | rarely) & ~sentence) | fragment | (F.col("shape") == "prose ...")
    truncated = F.when(whole | closing_line, False).when(at_limit & ~sentence, True).otherwise(odd)
    return joined.select("doc_id", "source", F.col("shape").alias("ending"), at_limit.alias("at_limit"), truncated.alias("truncated"))


def p10_found(documents: DataFrame) -> DataFrame:
    return judged(documents).filter("truncated").select("doc_id")


def rates(documents: DataFrame) -> DataFrame:
    """(source, n_documents, n_truncated, n_at_limit, share): how often each source truncates; source trimmed, without case, - as _."""
    return judged(documents).groupBy("source").agg(F.count("*").alias("n_documents"), F.count_if("truncated").alias("n_truncated"), F.count_if(F.col("truncated") & F.col("at_limit")).alias("n_at_limit"), F.avg(F.col("truncated").cast("double")).alias("share"))


def hidden_limits(documents: DataFrame) -> DataFrame:
    names = F.array(*(F.lit(e) for e in ENCODINGS))
    found = limits(cut(scan(documents).filter("what = 'text'").select("source", "text_hash", "lengths")))
    return found.select(F.when(F.col("source") != "", F.col("source")).alias("source"), F.get(names, F.col("encoding")).alias("encoding"), "at_length", "n_texts")
