"""Plain Python versions of problems 5, 8 and 9, written from their statements alone."""

from __future__ import annotations

import re
from collections import defaultdict

import pandas as pd

EMPTY = {"", "n/a", "null", "unk", "?", "--"}


def p5(lab: pd.DataFrame, sites: pd.DataFrame) -> set:
    trust = dict(zip(sites.site_code, sites.trust_rank))
    groups = defaultdict(list)
    for r in lab.itertuples(index=False):
        k = r.key_hash.strip().lower() if isinstance(r.key_hash, str) else ""
        if k:
            groups[k].append(r)
    out = set()
    for k, rows in groups.items():
        if len(rows) < 2:
            continue
        rows.sort(key=lambda r: (trust.get(r.site_code, 10**6), -r.incr_counter, -r.received_dtm.value, -r.row_id))
        for f in ("result_txt", "unit_of_measure_txt", "normal_range_txt", "specimen_txt"):
            for r in rows:
                v = getattr(r, f)
                if isinstance(v, str) and v.strip().lower() not in EMPTY:
                    out.add((k, f, r.row_id))
                    break
    return out


def p8(docs: pd.DataFrame, items: pd.DataFrame, run: int = 15) -> set:
    words = lambda t: re.findall(r"[^\W_]+", t.lower())
    grams = defaultdict(set)
    for r in items.itertuples(index=False):
        w = words(r.text)
        for k in range(len(w) - run + 1):
            grams[tuple(w[k : k + run])].add(r.item_id)
    out = set()
    for r in docs.itertuples(index=False):
        w = words(r.text) if isinstance(r.text, str) else []
        for k in range(len(w) - run + 1):
            for i in grams.get(tuple(w[k : k + run]), ()):
                out.add((r.doc_id, i))
    return out
