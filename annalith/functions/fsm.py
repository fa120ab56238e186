"""Quote-aware finite-state tokenizer over many raw records at once.

States: START of a field, PLAIN field, QUOTED field, CLOSED (a quote inside a quoted field, closing it or
the first of a doubled one), BAD. Only quotes, separators, record ends and the runs between them matter,
so a byte buffer becomes a stream of tokens, each a map from state to state. The stream is cut into
chunks; the maps of a chunk compose into one, whatever the state it is entered in; a short scan over the
chunk maps gives every chunk its entry state; a second pass replays the chunks with known states. Both
passes walk all chunks side by side.
"""

from __future__ import annotations

import numpy as np

START, PLAIN, QUOTED, CLOSED, BAD = range(5)
CHUNK = 256

#: maps from state to state by token
QUOTE = (QUOTED, PLAIN, CLOSED, QUOTED, BAD)
SEPARATOR = (START, START, QUOTED, START, BAD)
END = (START,) * 5
RUN = (PLAIN, PLAIN, QUOTED, BAD, BAD)


def _step_table() -> np.ndarray:
    """Rows: 2 * token + (1 if a run of other characters lies before it)."""
    rows = []
    for token in (QUOTE, SEPARATOR, END):
        rows += [list(token), [token[RUN[s]] for s in range(5)]]
    return np.array(rows, dtype=np.uint8)


STEPS = _step_table()
RUN_MAP = np.array(RUN, dtype=np.uint8)


def entry_states(tokens: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """State before each token (before the run that precedes it), from START at the first."""
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint8)
    k = -(-n // chunk)
    padded = np.full(k * chunk, 4, np.int64)
    padded[:n] = tokens
    grid = padded.reshape(k, chunk)
    composed = np.tile(np.arange(5, dtype=np.uint8), (k, 1))
    for j in range(chunk):
        composed = np.take_along_axis(STEPS[grid[:, j]], composed.astype(np.int64), axis=1)
    entry = np.zeros(k, np.uint8)
    state = START
    for c in range(k):
        entry[c] = state
        state = composed[c, state]
    states = np.empty((k, chunk), np.uint8)
    current = entry.astype(np.int64)
    for j in range(chunk):
        states[:, j] = current
        current = STEPS[grid[:, j], current].astype(np.int64)
    return states.reshape(-1)[:n]


def tokenize(buffer: np.ndarray, ends: np.ndarray, separator: int = ord("|"), quote: int = ord('"'), chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fields and faults of records that lie one after the other in a byte buffer, record i ending before ends[i].

    Returns the byte positions at which fields end and the record of each, in order; and per record the
    byte offset of its quoting fault, -1 if it has none: the first byte after a closing quote that is no
    separator, or the opening quote of a field that is never closed. Last come the records' starts, and whether each ends inside quotes.
    """
    n = len(ends)
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    special = np.flatnonzero((buffer == separator) | (buffer == quote))
    # record ends are tokens too, after all bytes of the record: order by (position, is it an end) with ends before bytes at the same place
    at = np.concatenate((ends.astype(np.int64), special))
    kind = np.concatenate((np.full(n, 2), np.where(buffer[special] == quote, 0, 1)))
    order = np.argsort(at * 2 + (kind != 2), kind="stable")
    at, kind = at[order], kind[order]
    is_end = kind == 2
    record = np.cumsum(is_end) - is_end
    before = np.empty(len(at), np.int64)
    before[0] = 0
    before[1:] = at[:-1] + (kind[:-1] != 2)
    run = at > before
    entry = entry_states(2 * kind + run, chunk)
    state = np.where(run, RUN_MAP[entry], entry)
    cut = is_end | ((kind == 1) & (state != QUOTED) & (state != BAD))
    fault = np.full(n, -1, np.int64)
    # a run or a token that leads from CLOSED to BAD
    broke = (entry == CLOSED) & run
    where = np.flatnonzero(broke)[::-1]
    fault[record[where]] = before[where] - starts[record[where]]
    open_end = is_end & (state == QUOTED)
    if open_end.any():
        opening = np.flatnonzero((kind == 0) & (entry == START) & ~run)
        last = np.searchsorted(opening, np.flatnonzero(open_end)) - 1
        hit = np.flatnonzero(open_end)
        fault[record[hit]] = at[opening[last]] - starts[record[hit]]
    return at[cut], record[cut], fault, starts, state[is_end] == QUOTED
