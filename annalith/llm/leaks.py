"""Evaluation texts leaking into training text (problem 8).

The held-out items form an inverted index whose terms are their five-word shingles, with BM25 weights
and, per block of a posting list, the largest weight. Every document is cut into overlapping passages,
each a query. Block-max WAND retrieves all items at or above a threshold, and an exact look at the words
follows. The threshold loses nothing: it is, per item, the least score of any of its runs of RUN words,
so a passage that holds such a run reaches it.

The held-out items are indexed in blocks of at most INDEX_WORDS words, however many items there are and however
long they are: a longer item is indexed in pieces that overlap by RUN - 1 words. A block is a handful of arrays,
some 40 bytes a word, besides its vocabulary; each is built on the driver and shipped to the workers. The corpus
never leaves its partitions; it is read once per block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import map_arrow

RUN = 15
SHINGLE = 5
PASSAGE, STRIDE = 45, 30
"""Words per passage and from one to the next: any run of RUN words lies in one passage."""
BLOCK = 8
"""Postings per block of a list."""
INDEX_WORDS = 4_000_000
K1, B = 1.2, 0.75
SLICE_CHARS = 1 << 20
"""Texts are worked on in slices of about so many characters; a longer text is one slice."""

WORD = re.compile(r"[^\W_]+")
ASCII_WORDS = {c: (chr(c).lower() if chr(c).isalnum() else " ") for c in range(128)}
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return text.translate(ASCII_WORDS).split() if text.isascii() else WORD.findall(text.lower())


def run_keys(ids: np.ndarray, length: int = SHINGLE) -> np.ndarray:
    """A 64-bit key of each ``length`` ids in a row."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(length):
        keys = (keys + x[k : k + n]) * MULTIPLIER
        keys ^= keys >> np.uint64(29)
    return keys


class ItemIndex:
    """Inverted index of items with block maxima and lossless per-item thresholds, all in arrays.

    ``pointer`` has where the postings of each term begin, ``post_item`` and ``post_weight`` the postings by term and
    item, ``block_pointer`` where the blocks of each term begin, ``block_last`` and ``block_best`` their last items and
    largest weights. ``flat`` has the words of all items; ``run_key`` the keys of all runs of RUN words in order, and
    ``run_at`` where they begin in ``flat``.
    """

    def __init__(self, items: list[tuple[int, str]] | list[tuple[int, list[str]]]):
        self.words: dict[str, int] = {}
        ids_of, own = [], []
        for item_id, text in items:
            words = words_of(text or "") if not isinstance(text, list) else text
            ids = np.array([self.words.setdefault(w, len(self.words) + 1) for w in words], np.int32)
            if len(ids) >= RUN:
                own.append(item_id)
                ids_of.append(ids)
        self.item_ids = own
        n = len(own)
        per_item = [run_keys(ids) for ids in ids_of]
        self.keys = np.unique(np.concatenate(per_item)) if n else np.zeros(0, np.uint64)
        sizes = np.array([len(k) for k in per_item], np.int64)
        term = np.searchsorted(self.keys, np.concatenate(per_item)) if n else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(n), sizes)
        pairs, back, tf = np.unique(term * max(n, 1) + owner, return_inverse=True, return_counts=True)
        terms, self.post_item = pairs // max(n, 1), (pairs % max(n, 1)).astype(np.int32)
        df = np.bincount(terms, minlength=len(self.keys))
        self.pointer = np.concatenate(([0], np.cumsum(df)))
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        length = sizes / (sizes.mean() if n else 1)
        self.post_weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.post_item])) if n else np.zeros(0)
        blocks = -(-df // BLOCK)
        self.block_pointer = np.concatenate(([0], np.cumsum(blocks)))
        inner = np.arange(int(blocks.sum())) - np.repeat(self.block_pointer[:-1], blocks)
        begins = np.repeat(self.pointer[:-1], blocks) + inner * BLOCK
        ends = np.minimum(begins + BLOCK, np.repeat(self.pointer[1:], blocks))
        self.block_last = self.post_item[ends - 1]
        self.block_best = np.maximum.reduceat(self.post_weight, begins) if len(begins) else np.zeros(0)
        self.best = np.maximum.reduceat(self.block_best, self.block_pointer[:-1]) if n else np.zeros(0)
        self.threshold = np.zeros(n)
        at = np.concatenate(([0], np.cumsum(sizes)))
        for i in range(n):
            own_terms, weight = term[at[i] : at[i + 1]], self.post_weight[back[at[i] : at[i + 1]]]
            # of a term that is there twice in a run only the first counts
            order = np.argsort(own_terms, kind="stable")
            earlier = np.full(len(own_terms), -1)
            again = np.flatnonzero(own_terms[order][1:] == own_terms[order][:-1]) + 1
            earlier[order[again]] = order[again - 1]
            width = RUN - SHINGLE + 1
            view = np.lib.stride_tricks.sliding_window_view
            fresh = view(earlier, width) < np.arange(len(own_terms) - width + 1)[:, None]
            self.threshold[i] = (view(weight, width) * fresh).sum(axis=1).min() - 1e-9
        self.least = float(self.threshold.min()) if n else math.inf
        self.flat = np.concatenate(ids_of) if n else np.zeros(0, np.int32)
        self.begins = np.concatenate(([0], np.cumsum([len(x) for x in ids_of]))).astype(np.int64)
        runs = [run_keys(ids, RUN) for ids in ids_of]
        where = np.concatenate([self.begins[i] + np.arange(len(r)) for i, r in enumerate(runs)]) if n else np.zeros(0, np.int64)
        key = np.concatenate(runs) if n else np.zeros(0, np.uint64)
        order = np.argsort(key, kind="stable")
        self.run_key, self.run_at = key[order], where[order].astype(np.int32 if len(self.flat) < 1 << 31 else np.int64)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def postings(self, t: int) -> tuple[list[int], list[float], list[tuple[int, float]]]:
        """Items and weights of a term, and (last item, largest weight) of each block."""
        own, blocks = slice(self.pointer[t], self.pointer[t + 1]), slice(self.block_pointer[t], self.block_pointer[t + 1])
        return self.post_item[own].tolist(), self.post_weight[own].tolist(), list(zip(self.block_last[blocks].tolist(), self.block_best[blocks].tolist()))

    def holds(self, item: int, window: np.ndarray) -> bool:
        """Whether the words hold RUN consecutive ones of the item: looked up by key, then compared word by word."""
        keys = run_keys(window, RUN)
        low, high = np.searchsorted(self.run_key, keys), np.searchsorted(self.run_key, keys, side="right")
        for k in np.flatnonzero(high > low):
            for at in self.run_at[low[k] : high[k]]:
                if self.begins[item] <= at < self.begins[item + 1] and (self.flat[at : at + RUN] == window[k : k + RUN]).all():
                    return True
        return False

    def search(self, terms: list[int]) -> list[int]:
        """Items whose score over the distinct terms reaches their threshold, by block-max WAND."""
        cursors = [[0, self.postings(t), self.best[t]] for t in terms]
        found = []
        while cursors:
            cursors.sort(key=lambda c: c[1][0][c[0]])
            bound, pivot = 0.0, None
            for k, c in enumerate(cursors):
                bound += c[2]
                if bound >= self.least:
                    pivot = k
                    break
            if pivot is None:
                break
            item = cursors[pivot][1][0][cursors[pivot][0]]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][1][0][cursors[pivot + 1][0]] == item:
                pivot += 1
            near = [next((b for b in c[1][2][c[0] // BLOCK :] if b[0] >= item), (item, 0.0)) for c in cursors[: pivot + 1]]
            if sum(b[1] for b in near) < self.threshold[item]:
                # no item before the end of the nearest block can be one: skip there
                beyond = min([b[0] for b in near] + [c[1][0][c[0]] - 1 for c in cursors[pivot + 1 : pivot + 2]]) + 1 if self.least >= self.threshold[item] else item + 1
                target = max(beyond, item + 1)
            else:
                if sum(c[1][1][p] for c in cursors[: pivot + 1] if (p := _seek(c[1][0], c[0], item)) is not None) >= self.threshold[item]:
                    found.append(item)
                target = item + 1
            for c in cursors[: pivot + 1]:
                while c[0] < len(c[1][0]) and c[1][0][c[0]] < target:
                    c[0] += 1
            cursors = [c for c in cursors if c[0] < len(c[1][0])]
        return found

    def leaked(self, texts: list[str]) -> list[tuple[int, int]]:
        """(position of text, item id) of the texts that hold RUN consecutive words of an item."""
        gap = [0] * SHINGLE
        ids, starts = [], []
        get = self.words.get
        for text in texts:
            starts.append(len(ids))
            ids += [get(w, 0) for w in words_of(text)]
            ids += gap
        if not self.item_ids or not ids:
            return []
        flat = np.array(ids, np.int64)
        keys = run_keys(flat)
        at = np.flatnonzero(self.maybe[(keys >> np.uint64(44)).astype(np.int64)])
        term = np.searchsorted(self.keys, keys[at])
        known = self.keys[np.minimum(term, len(self.keys) - 1)] == keys[at]
        at, term = at[known], term[known]
        if not len(at):
            return []
        bounds = np.array([*starts, len(ids)])
        doc = np.searchsorted(bounds, at, side="right") - 1
        inner = at - bounds[doc]
        # a shingle at word p lies in the passages k with k * STRIDE <= p <= k * STRIDE + PASSAGE - SHINGLE
        last = inner // STRIDE
        first = np.maximum(0, -(-(inner - (PASSAGE - SHINGLE)) // STRIDE))
        reps = last - first + 1
        index = np.repeat(np.arange(len(at)), reps)
        passage = np.repeat(first, reps) + np.arange(len(index)) - np.repeat(np.cumsum(reps) - reps, reps)
        owner = doc[index]
        order = np.lexsort((passage, owner))
        index, passage, owner = index[order], passage[order], owner[order]
        new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (passage[1:] != passage[:-1]))))
        weight = np.add.reduceat(self.best[term[index]], new)
        out = set()
        ends = np.append(new[1:], len(index))
        for s, e in zip(new[weight >= self.least], ends[weight >= self.least]):
            d, begin = int(owner[s]), int(bounds[owner[s]] + passage[s] * STRIDE)
            for item in self.search(sorted(set(term[index[s:e]].tolist()))):
                if (d, self.item_ids[item]) not in out:
                    if self.holds(item, flat[begin : min(begin + PASSAGE, int(bounds[d + 1]))]):
                        out.add((d, self.item_ids[item]))
        return sorted(out)


def _seek(items: list[int], start: int, item: int) -> int | None:
    for p in range(start, len(items)):
        if items[p] >= item:
            return p if items[p] == item else None
    return None


def slices(batches: Iterator[pa.RecordBatch], chars: int = SLICE_CHARS) -> Iterator[tuple[list, list[str], list[list]]]:
    """(first column, texts, other columns) of rows with a text, in slices of about so many characters."""
    keys, texts, more, size = [], [], [], 0
    for b in batches:
        for row in zip(b.column(0), b.column(1), *(b.column(k) for k in range(2, b.num_columns))):
            text = row[1].as_py()
            if text is None:
                continue
            keys.append(row[0].as_py())
            texts.append(text)
            more.append([x.as_py() for x in row[2:]])
            size += len(text)
            if size >= chars:
                yield keys, texts, more
                keys, texts, more, size = [], [], [], 0
    if texts:
        yield keys, texts, more


def item_blocks(items: DataFrame, words: int | None = None) -> Iterator[list[tuple[int, list[str]]]]:
    """(item_id, words) of all items, in blocks of at most so many words; a longer item comes in pieces that share RUN - 1 words."""
    limit = INDEX_WORDS if words is None else words
    block, size = [], 0
    for r in items.select("item_id", "text").filter("text is not null and item_id is not null").orderBy("item_id").toLocalIterator():
        own = words_of(r[1])
        for a in range(0, max(1, len(own) - RUN + 1), max(1, limit - RUN + 1)):
            piece = own[a : a + limit]
            if block and size + len(piece) > limit:
                yield block
                block, size = [], 0
            block.append((r[0], piece))
            size += len(piece)
    yield block


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id): the document holds at least RUN consecutive words of the item; each pair once.

    Null and short texts hold none. Items of fewer than RUN words leak never.
    """
    rows = documents.select("doc_id", "text").filter("text is not null")
    found = None
    for block in item_blocks(items):
        shared = documents.sparkSession.sparkContext.broadcast(ItemIndex(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for ids, texts, _ in slices(batches):
                hits = shared.value.leaked(texts)
                yield pa.RecordBatch.from_arrays([pa.array([ids[d] for d, _ in hits], pa.int64()), pa.array([i for _, i in hits], pa.int64())], names=["doc_id", "item_id"])

        part = map_arrow(rows, run, "doc_id bigint, item_id bigint")
        found = part if found is None else found.unionByName(part)
    return found.distinct()


def p8_found(documents: DataFrame, items: DataFrame) -> DataFrame:
    return leaks(documents, items)


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per item the number of documents that hold a passage of it; items that leaked nowhere have 0."""
    counts = leaks(documents, items).groupBy("item_id").agg(F.count("*").alias("n_documents"))
    return items.select("item_id", "item_set").join(counts, "item_id", "left").select("item_id", "item_set", F.coalesce("n_documents", F.lit(0)).cast("bigint").alias("n_documents"))
