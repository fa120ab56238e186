"""Mixed timestamp formats and time zones to one UTC instant (problem 2).

Each text is split once by the pattern of its shape into year, month, day, clock, fraction and zone; all
of it stays in generated code. A zone or offset in the text holds. Otherwise the text is local and needs
its source's offset history, which is estimated: the lags between local texts and their ingestion are
compared, day by day and under the histories of all zones there are, with the lags of the same source's
texts that name their offset. A text after its own ingestion is a violation. The history that makes
these lags likeliest is taken; it may change from one zone to another on the way, at a price, as a source
may move. A zone declared for the source is an audit: where it contradicts the estimate, the source is
reported by ``zones_by_alignment`` and its declared zone is used.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import fenced
from ..session import cut, ship, small

#: The shapes of texts. TIME ends every shape that may have a clock.
TIME = r"(?:[Tt ]+(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?\s*(?:([AaPp][Mm])|([Zz]|[+-]\d{2}:?\d{2}|[A-Za-z]{3,4}))?)?$"
ISO = r"^(\d{4})-(\d{2})-(\d{2})" + TIME
PARTED = r"^(\d{1,2})[/.](\d{1,2})[/.](\d{4})" + TIME
NAMED = r"^(\d{1,2})[- ]([A-Za-z]{3})[- ](\d{4})" + TIME
COMPACT = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})()()()$"
DIGITS = r"^\d+$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
#: Zone abbreviations and their minutes from UTC.
ABBREVIATIONS = {"Z": 0, "UTC": 0, "GMT": 0, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "CET": 60, "CEST": 120, "IST": 330, "AEST": 600, "AEDT": 660}
FIRST, AFTER = -631_152_000_000_000, 4_102_444_800_000_000
"""Microseconds of 1950-01-01 and 2100-01-01: texts outside denote no instant."""
SECOND, DAY = 1_000_000, 86_400_000_000
QUARTER = 900
"""Seconds per step of lags and offsets."""
EARLIEST, LATEST = -200, 400
"""Quarters of an hour between which lags are told apart; those beyond count as the outermost."""
STATED_WEIGHT = 40.0
"""Stated lags that the general expectation (lags not below zero, long ones rare) counts as."""
DAWN = 3 * 3600 * SECOND
"""Days begin so much after midnight, when clocks have been turned: a time that occurs twice, taken as the first, is of the day before."""
CHANGE_PRICE, PIECE_DAYS = 30.0, 28
"""Log-likelihood that a change of zone must win, and days between the points at which one may lie."""
FIELDS = ("nfer_dtm", "flowsheet_row_captured_dtm")


def parse(rows: DataFrame, text: str = "text", date_order: str = "date_order") -> DataFrame:
    """Adds local_micros (the clock as written, or the instant itself) and offset_minutes (null: the source's zone is needed).

    local_micros is null where the text denotes no date or time, or a year outside 1950 to 2099. Without
    date_order a date written with slashes or dots stays null.
    """
    t, order, s = F.col("trimmed"), F.col(date_order), "\x01"
    split = lambda pattern, date: F.regexp_replace(t, pattern, s.join([date, *(f"${g}" for g in range(4, 10))]))
    fifth, size = F.substring(t, 5, 1), F.length(t)
    # a cheap look picks the one pattern to try; a text that it doesn't fit stays whole
    parts = (
        F.when(fifth == "-", split(ISO, "$1-$2-$3")).when(size.isin(10, 13, 16) & t.rlike(DIGITS), F.concat(F.lit("epoch" + s), t)).when((size == 14) & t.rlike(DIGITS), split(COMPACT, "$1-$2-$3"))
        .when(~F.substring(t, 2, 2).rlike("[/.]"), split(NAMED, "$3-$2-$1")).when(order == "MDY", split(PARTED, "$3-$1-$2")).when(order == "DMY", split(PARTED, "$3-$2-$1"))
    )
    trimmed = fenced(rows, trimmed=F.btrim(F.col(text), F.lit(" \t\r\n")))
    split_up = fenced(trimmed, parts=F.split(parts, s)).filter(F.size("parts") > 1)
    date, hour, half = (F.get("parts", F.lit(i)) for i in (0, 1, 5))
    minute, second, frac, zone = (F.get("parts", F.lit(i)) for i in (2, 3, 4, 6))
    month = (F.instr(F.lit(MONTHS), F.lower(F.substring(date, 6, 3))) + 2) / 3
    named = F.concat(F.substring(date, 1, 5), F.when(month == F.floor(month), month.cast("int").cast("string")), F.substring(date, 9, 3))
    hour12 = F.when(hour.cast("int").between(1, 12), (hour.cast("int") % 12 + F.when(F.upper(half) == "PM", 12).otherwise(0)).cast("string"))
    two = lambda c: F.lpad(c, 2, "0")
    stamp = F.concat(F.when(date.rlike("[A-Za-z]"), named).otherwise(date), F.lit(" "), two(F.when(half != "", hour12).otherwise(hour)), F.lit(":"), two(minute), F.lit(":"), two(second), F.lit("."), F.rpad(F.substring(frac, 1, 6), 6, "0"), F.lit("Z"))
    epoch = date == "epoch"
    ticks = hour.try_cast("bigint") * F.when(F.length(hour) == 10, 1_000_000).when(F.length(hour) == 13, 1_000).otherwise(1).cast("bigint")
    told = fenced(split_up, written=F.when(epoch, ticks).otherwise(F.unix_micros(F.when(~epoch, stamp).try_cast("timestamp"))), zone=F.when(epoch, "Z").otherwise(F.upper(zone)))
    digits = F.regexp_replace("zone", ":", "")
    hours, minutes = F.substring(digits, 2, 2).try_cast("int"), F.substring(digits, 4, 2).try_cast("int")
    by_sign = F.when((hours <= 18) & (minutes < 60), (hours * 60 + minutes) * F.when(F.col("zone").startswith("-"), -1).otherwise(1))
    table = F.create_map(*(x for k, v in ABBREVIATIONS.items() for x in (F.lit(k), F.lit(v))))
    offset = F.when(F.col("zone").rlike("^[+-]"), by_sign).when(F.col("zone") != "", F.element_at(table, F.col("zone")))
    placed = fenced(told, offset_minutes=offset)
    sound = F.col("written").between(FIRST, AFTER - 1) & ((F.col("zone") == "") | F.col("offset_minutes").isNotNull())
    return placed.withColumn("local_micros", F.when(sound, F.col("written"))).drop("trimmed", "parts", "written", "zone")


def to_utc(local_micros: Column, zone: Column) -> tuple[Column, Column]:
    """(instant of a local time in a zone, local time of the column ``utc`` in it), in microseconds.

    Of two instants it is the first; where the second value isn't the local time again, the clock skipped it.
    """
    return F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(local_micros), zone)), F.unix_micros(F.from_utc_timestamp(F.timestamp_micros("utc"), zone))


def lag_counts(parsed: DataFrame) -> DataFrame:
    """(source, day, local, quarter, n): how often the lag from the text to its ingestion lies in a quarter of an hour.

    Days are of the text's clock; of local texts the lag is as if the clock were UTC. All rows fold map-side, so a
    source has as many rows as days times quarters, whatever its size.
    """
    usable = parsed.filter("source is not null and received_micros is not null")
    lag = F.col("received_micros") - F.col("local_micros") + F.coalesce(F.col("offset_minutes"), F.lit(0)).cast("bigint") * 60 * SECOND
    quarter = F.greatest(F.lit(4 * EARLIEST), F.least(F.lit(4 * LATEST), F.floor(lag / (QUARTER * SECOND)))).cast("int")
    return usable.groupBy("source", F.floor((F.col("local_micros") - DAWN) / DAY).alias("day"), F.col("offset_minutes").isNull().alias("local"), quarter.alias("quarter")).agg(F.count("*").alias("n"))


FIXED_OFFSET = re.compile(r"(?:UTC|GMT)?([+-])(\d{1,2})(?::?(\d{2}))?$")


def day_offsets(zone: str, days: np.ndarray) -> np.ndarray | None:
    """Quarters of an hour from UTC at noon of days since 1970; None if no zone has this name."""
    if m := FIXED_OFFSET.match(zone):
        minutes = int(m[2]) * 60 + int(m[3] or 0)
        return np.full(len(days), (minutes if m[1] == "+" else -minutes) // 15)
    try:
        info = ZoneInfo(zone)
    except (KeyError, ValueError, OSError):
        return None
    noon = datetime(1970, 1, 1, 12, tzinfo=timezone.utc)
    at = lambda d: int((noon + timedelta(days=int(d))).astimezone(info).utcoffset().total_seconds()) // QUARTER
    grid = np.unique(np.append(np.arange(days[0], days[-1], 21), days[-1]))
    values, starts, offsets = [at(d) for d in grid], [int(grid[0])], [at(grid[0])]
    for k in range(1, len(grid)):
        if values[k] != values[k - 1]:  # the day of the change lies between
            low, high = int(grid[k - 1]), int(grid[k])
            while high - low > 1:
                mid = (low + high) // 2
                low, high = (mid, high) if at(mid) == values[k - 1] else (low, mid)
            starts.append(high)
            offsets.append(values[k])
    return np.array(offsets)[np.searchsorted(starts, days, side="right") - 1]


@lru_cache(maxsize=8)
def histories(first: int, last: int) -> tuple[list[str], np.ndarray]:
    """The different offset histories of all zones between two days, one zone's name for each, with the offsets of all days."""
    days, found = np.arange(first, last + 1), {}
    for zone in sorted(available_timezones()):
        if "/" in zone and not zone.startswith("Etc/") or zone == "UTC":
            found.setdefault(day_offsets(zone, days).tobytes(), zone)
    table = np.array([np.frombuffer(key, np.int64) for key in found])
    return list(found.values()), table


def expected_lags(quarters: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-probability of a lag per quarter from EARLIEST to LATEST, from stated lags and a general expectation."""
    at = np.arange(EARLIEST, LATEST + 1)
    general = np.where(at < 0, 1e-4, 1 / (1 + np.maximum(at, 0) / 16))
    seen = np.bincount(np.clip(quarters, EARLIEST, LATEST) - EARLIEST, counts, len(at))
    return np.log((seen + STATED_WEIGHT * general / general.sum()) / (seen.sum() + STATED_WEIGHT))


def fit_zone(rows: pd.DataFrame, declared: str | None) -> list[tuple[str, int, int, int, int, bool]]:
    """Pieces (zone, from_day, to_day, violations, days, agrees) of one source's offset history, from its ``lag_counts``.

    Among histories of equal likelihood the declared zone's is taken. ``agrees`` says that the declared zone has the
    estimate's offsets on all days of the piece.
    """
    local, stated = rows[rows["local"]], rows[~rows["local"]]
    if not len(local):
        return []
    likely = expected_lags(stated["quarter"].to_numpy(), stated["n"].to_numpy())
    days, row = np.unique(local["day"].to_numpy(), return_inverse=True)
    quarter, n = local["quarter"].to_numpy(), local["n"].to_numpy()
    shifts = np.arange(-56, 64)
    score, late = np.zeros((len(days), len(shifts))), np.zeros((len(days), len(shifts)))
    for k, s in enumerate(shifts):
        lag = np.clip(quarter + s, EARLIEST, LATEST)
        score[:, k] = np.bincount(row, n * likely[lag - EARLIEST], len(days))
        late[:, k] = np.bincount(row, n * (lag < 0), len(days))
    names, table = histories(int(days[0]) // 366 * 366, (int(days[-1]) // 366 + 1) * 366)
    offsets = table[:, days - int(days[0]) // 366 * 366]
    own = day_offsets(declared, days) if declared else None
    if own is not None:
        names, offsets = [declared, *names], np.vstack([own, offsets])
    column = np.clip(offsets + 56, 0, len(shifts) - 1)
    each = score[np.arange(len(days)), column]
    piece = (days - days[0]) // PIECE_DAYS
    bounds = np.flatnonzero(np.diff(piece, prepend=-1))
    gains = np.add.reduceat(each, bounds, axis=1).T
    best, back = gains[0].copy(), []
    for g in gains[1:]:
        top = int(best.argmax())
        moves = best[top] - CHANGE_PRICE > best
        back.append(np.where(moves, top, np.arange(len(best))))
        best = np.maximum(best, best[top] - CHANGE_PRICE) + g
    path = [int(best.argmax())]
    for came in reversed(back):
        path.append(int(came[path[-1]]))
    path = np.repeat(path[::-1], np.diff(np.append(bounds, len(days))))
    out, cuts = [], np.flatnonzero(np.diff(path, prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(days)]):
        z = path[a]
        agrees = own is not None and bool((offsets[z, a:b] == own[a:b]).all())
        violations = int(late[np.arange(a, b), column[z, a:b]].sum())
        out.append((names[z], int(days[a]) if len(out) else -(1 << 40), int(days[b]) if b < len(days) else 1 << 40, violations, b - a, agrees))
    return out


HISTORY = "source string, declared string, estimated_zone string, from_day bigint, to_day bigint, violations bigint, days bigint, agrees boolean"


def zone_history(parsed: DataFrame, declared: DataFrame) -> DataFrame:
    """(source, declared, estimated_zone, from_day, to_day, violations, days, agrees): the offset history that best aligns a source's local texts with ingestion.

    parsed: source, received_micros, local_micros, offset_minutes. declared: source, declared. Days are of the
    local clock, to_day excluded, the first and the last piece open. Sources without local texts have no row, and
    rows without source or ingestion time say nothing.
    """
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        source, zone = rows["source"].iat[0], rows["declared"].iat[0]
        return pd.DataFrame([(source, zone, *p) for p in fit_zone(rows, zone)], columns=[c.split()[0] for c in HISTORY.split(", ")])

    ship(parsed.sparkSession)
    return lag_counts(parsed).join(small(declared), "source", "left").groupBy("source").applyInPandas(fit, HISTORY)


def field_texts(rows: DataFrame, sites: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(row_id, dtm_field, source, tz_name, received_micros, local_micros, offset_minutes), one per row and non-null field."""
    known = sites.filter("site_code is not null").groupBy("site_code").agg(F.min("tz_name").alias("tz_name"), F.min("date_order").alias("date_order"))
    stacked = rows.select(
        "row_id", "site_code", F.unix_micros(F.col("received_dtm").cast("timestamp")).alias("received_micros"),
        F.inline(F.array(*(F.struct(F.lit(f).alias("dtm_field"), F.col(f).alias("text")) for f in fields))),
    ).filter("text is not null")
    parsed = parse(stacked.join(small(known), "site_code", "left"))
    return parsed.select("row_id", "dtm_field", F.col("site_code").alias("source"), "tz_name", "received_micros", "local_micros", "offset_minutes").filter("local_micros is not null")


def instants(rows: DataFrame, sites: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(row_id, dtm_field, utc_micros): one row per text that denotes an instant.

    The texts are parsed once, into a table of the shared folder. A local text takes the zone of its day in its
    source's estimated history; a source whose declared zone contradicts it takes that. A source of which
    nothing is known but its declared zone takes that too. A text that needs a zone where the source is null has no row.
    """
    texts = cut(field_texts(rows, sites, fields))
    declared = declared_zones(sites)
    found = cut(zone_history(texts, declared))
    sound = found.groupBy("source").agg(F.min("agrees").alias("sound"))
    pieces = found.join(small(sound), "source").filter(F.col("sound") | F.col("declared").isNull()).select("source", F.struct("estimated_zone", "from_day", "to_day").alias("p"))
    pieces = small(pieces.groupBy("source").agg(F.collect_list("p").alias("pieces")))
    day = F.floor((F.col("local_micros") - DAWN) / DAY)
    own = F.get(F.filter("pieces", lambda p: (p["from_day"] <= day) & (day < p["to_day"])), F.lit(0))["estimated_zone"]
    placed = texts.join(pieces, "source", "left").withColumn("zone", F.when(F.col("offset_minutes").isNull(), F.coalesce(own, "tz_name"))).drop("pieces")
    there, back = to_utc(F.col("local_micros"), F.col("zone"))
    zoned = fenced(placed, utc=F.coalesce(F.col("local_micros") - F.col("offset_minutes").cast("bigint") * 60 * SECOND, there))
    skipped = F.col("zone").isNotNull() & (back != F.col("local_micros"))
    return zoned.filter(F.col("utc").isNotNull() & ~skipped).select("row_id", "dtm_field", F.col("utc").alias("utc_micros"))


def declared_zones(sites: DataFrame) -> DataFrame:
    return sites.filter("site_code is not null").groupBy(F.col("site_code").alias("source")).agg(F.min("tz_name").alias("declared"))


def zones_by_alignment(rows: DataFrame, sites: DataFrame) -> DataFrame:
    """(site_code, tz_name, estimated_zone, from_day, to_day, violations, days, agrees): what alignment with ingestion finds for each source, and whether the declared zone agrees."""
    found = zone_history(field_texts(rows, sites, FIELDS), declared_zones(sites)).drop("declared")
    return declared_zones(sites).join(found, "source", "full").withColumnsRenamed({"source": "site_code", "declared": "tz_name"})


def p2_found(rows: DataFrame, sites: DataFrame) -> DataFrame:
    return instants(rows, sites, FIELDS)
