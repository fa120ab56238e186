"""Plain Python versions of problems 1 to 4, 6 and 7, written from their statements alone."""

from __future__ import annotations

import re
from collections import defaultdict
from datetime import datetime, timedelta, timezone
from statistics import median
from zoneinfo import ZoneInfo

import pandas as pd

ATTRS = ["patient_clinic_number", "patient_merged_flag", "zipcode", "race_code", "deceased_flag"]


def tidy(v):
    v = None if v is None or (isinstance(v, float) and v != v) else str(v).strip().lower()
    return v or None


def p1(feed: pd.DataFrame) -> set:
    best = {}
    for r in feed.itertuples(index=False):
        pdk = (r.patient_dk or "").strip() if isinstance(r.patient_dk, str) else ""
        if not pdk:
            continue
        key = (pdk, float(r.version))
        rank = (-1 if r.incr_counter is None or r.incr_counter != r.incr_counter else r.incr_counter, r.received_dtm, r.feed_row_id)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, None if r.record_state == "D" else tuple(tidy(getattr(r, a)) for a in ATTRS), r.version.strip())
    out, by = set(), defaultdict(list)
    for (pdk, v), (_, state, text) in best.items():
        by[pdk].append((v, state, text))
    for pdk, rows in by.items():
        rows.sort(key=lambda x: x[0])
        opened = None
        for _, state, text in rows:
            if opened and state != opened[0]:
                out.add((pdk, opened[1], text))
                opened = None
            if opened is None and state is not None:
                opened = (state, text)
        if opened:
            out.add((pdk, opened[1], "0.0"))
    return out


ABBR = {"EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "CET": 1, "CEST": 2, "UTC": 0, "GMT": 0}


def instant(text, site):
    t = text.strip()
    if re.fullmatch(r"\d{10}|\d{13}", t):
        return int(t) * (10**6 if len(t) == 10 else 10**3)
    zone = None
    if m := re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)(?:[T ](\d\d):(\d\d)(?::(\d\d)(?:\.(\d+))?)?\s*(Z|[+-]\d\d:?\d\d|[A-Z]{3,4})?)?", t):
        y, mo, d, h, mi, s, frac, zone = m.groups()
    elif m := re.fullmatch(r"(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)", t):
        (y, mo, d, h, mi, s), frac = m.groups(), None
    elif m := re.fullmatch(r"(\d\d?)[/.](\d\d?)[/.](\d{4}) (\d\d?):(\d\d)(?::(\d\d))?\s*([AP]M)?", t):
        if site is None:
            return None
        a, b, y, h, mi, s, half = m.groups()
        frac = None
        mo, d = (a, b) if site["date_order"] == "MDY" else (b, a)
        if half:
            if not 1 <= int(h) <= 12:
                return None
            h = int(h) % 12 + 12 * (half == "PM")
    elif m := re.fullmatch(r"(\d\d?)-([A-Z][a-z]{2})-(\d{4}) (\d\d):(\d\d):(\d\d)", t):
        d, name, y, h, mi, s = m.groups()
        frac = None
        mo = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split().index(name) + 1
    else:
        return None
    try:
        local = datetime(int(y), int(mo), int(d), int(h or 0), int(mi or 0), int(s or 0), int(((frac or "") + "000000")[:6]))
    except ValueError:
        return None
    if not 1950 <= local.year < 2100:
        return None
    if zone:
        if zone[0] in "+-":
            z = zone.replace(":", "")
            off = (int(z[1:3]) * 60 + int(z[3:5])) * (-1 if z[0] == "-" else 1)
        else:
            off = 0 if zone == "Z" else ABBR[zone] * 60
        utc = local.replace(tzinfo=timezone.utc) - timedelta(minutes=off)
    else:
        if site is None:
            return None
        tz = ZoneInfo(site["tz_name"])
        utc = local.replace(tzinfo=tz, fold=0).astimezone(timezone.utc)
        if utc.astimezone(tz).replace(tzinfo=None) != local:
            return None
    return (utc - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def p2(flow: pd.DataFrame, sites: pd.DataFrame) -> set:
    known = {r["site_code"]: r for r in sites.to_dict("records")}
    out = set()
    for f in ("nfer_dtm", "flowsheet_row_captured_dtm"):
        for row_id, site, text in zip(flow.row_id, flow.site_code, flow[f]):
            if isinstance(text, str) and (u := instant(text, known.get(site))) is not None:
                out.add((row_id, f, u))
    return out


def fields_of(line: str):
    out, i = [], 0
    while True:
        if line[i : i + 1] == '"':
            j, value = i + 1, ""
            while True:
                k = line.find('"', j)
                if k < 0:
                    return None
                value += line[j:k]
                if line[k + 1 : k + 2] == '"':
                    value, j = value + '"', k + 2
                    continue
                break
            i = k + 1
            if i < len(line) and line[i] != "|":
                return None
            out.append(value)
        else:
            k = line.find("|", i)
            k = len(line) if k < 0 else k
            out.append(line[i:k])
            i = k
        if i >= len(line):
            return out
        i += 1


def fits(v, kind):
    if kind == "int":
        return bool(re.fullmatch(r"-?[0-9]+", v)) and -(2**31) <= int(v) < 2**31
    if kind == "double":
        return bool(re.fullmatch(r"-?[0-9]+(\.[0-9]+)?", v))
    if kind == "timestamp":
        if not re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", v, re.A):
            return False
        try:
            datetime.strptime(v, "%Y-%m-%d %H:%M:%S")
            return not v.endswith(":60")
        except ValueError:
            return False
    return v in ("Y", "N") if kind == "flag" else True


def reason(line, layout):
    line = line or ""
    line = line[:-1] if line.endswith("\r") else line
    got = fields_of(line)
    if got is None:
        return "quoting"
    if len(got) != len(layout):
        return "columns"
    for v, (kind, empty) in zip(got, layout):
        if not (empty if v == "" else fits(v, kind)):
            return "value"
    return None


def p3(lines: pd.DataFrame, layout: pd.DataFrame) -> set:
    shapes = {k: list(zip(g.sort_values("col_pos").col_type, g.sort_values("col_pos").may_be_empty)) for k, g in layout.groupby("layout_code")}
    return {(r.line_id, w) for r in lines.itertuples() if (w := reason(r.raw_line, shapes.get(r.layout_code, [])))}


def p4(snap: pd.DataFrame) -> set:
    best = {}
    for r in snap.itertuples(index=False):
        k = tidy(r.key_hash)
        if k is None:
            continue
        v = r.version.strip()
        key = (v, k)
        if key not in best or r.loaded_dtm > best[key][0]:
            u = tidy(r.map_updated_by)
            best[key] = (r.loaded_dtm, (r.map_fact_id, r.fact_guid, float(u or 0)))
    by = defaultdict(dict)
    for (v, k), (_, x) in best.items():
        by[v][k] = x
    vs, out = sorted(by, key=float), set()
    for a, b in zip(vs, vs[1:]):
        out |= {(b, k, "added") for k in by[b].keys() - by[a].keys()} | {(b, k, "removed") for k in by[a].keys() - by[b].keys()}
        out |= {(b, k, "changed") for k in by[a].keys() & by[b].keys() if by[a][k] != by[b][k]}
    return out


def p6(flow: pd.DataFrame, variables: pd.DataFrame) -> set:
    lim = {r.flowsheet_row_name_dk: (r.range_min, r.range_max) for r in variables.itertuples()}
    out, series = set(), defaultdict(lambda: defaultdict(list))
    for r in flow.itertuples():
        if r.derived_value is None or r.derived_value != r.derived_value:
            continue
        lo, hi = lim.get(r.flowsheet_row_name_dk, (float("nan"),) * 2)
        inside = not (r.derived_value < lo or r.derived_value > hi)
        if not inside:
            out.add((r.row_id, "impossible"))
        if isinstance(r.device_id, str) and r.seq_nbr == r.seq_nbr:
            series[r.device_id, r.flowsheet_row_name_dk][r.seq_nbr].append((r.row_id, r.derived_value, inside))
    for steps in series.values():
        order = [(min(v)[1], min(v)[2], v) for _, v in sorted(steps.items())]
        good = [x for x, ok, _ in order if ok]
        if good:
            level = median(good)
            scale = median(abs(x - level) for x in good)
            out |= {(i, "spike") for _, _, v in order for i, x, ok in v if ok and abs(x - level) > 10 * scale}
        i = 0
        while i < len(order):
            j = i
            while j < len(order) and order[j][0] == order[i][0]:
                j += 1
            if j - i >= 8:
                out |= {(r, "stuck") for _, _, v in order[i:j] for r, _, _ in v}
            i = j
    return out


UNITS = {
    "mmhg": "mmHg", "mm hg": "mmHg", "mm[hg]": "mmHg", "kpa": "kPa", "cmh2o": "cmH2O", "cm h2o": "cmH2O", "degc": "degC", "deg c": "degC", "°c": "degC", "c": "degC", "celsius": "degC",
    "degf": "degF", "deg f": "degF", "°f": "degF", "f": "degF", "fahrenheit": "degF", "kg": "kg", "kg.": "kg", "kgs": "kg", "kilograms": "kg", "g": "g", "gm": "g", "gms": "g", "grams": "g",
    "lb": "lb", "lbs": "lb", "lbs.": "lb", "pounds": "lb", "oz": "oz", "ounces": "oz", "cm": "cm", "cm.": "cm", "cms": "cm", "centimeters": "cm", "m": "m", "mtr": "m", "meters": "m", "metres": "m",
    "in": "in", "inch": "in", "inches": "in", "mg/dl": "mg/dL", "mg / dl": "mg/dL", "mg per dl": "mg/dL", "mmol/l": "mmol/L", "mmol per l": "mmol/L",
    "umol/l": "umol/L", "µmol/l": "umol/L", "μmol/l": "umol/L", "micromol/l": "umol/L", "ml": "mL", "milliliters": "mL", "cc": "mL", "l": "L", "liters": "L", "litres": "L", "dl": "dL",
    "fl oz": "fl_oz", "fl. oz.": "fl_oz", "fluid ounces": "fl_oz",
}


def value_of(t, mark):
    if "," in t and "." in t:
        t = t.replace(".", "").replace(",", ".") if t.rfind(",") > t.rfind(".") else t.replace(",", "")
    elif "," in t or "." in t:
        m = "," if "," in t else "."
        thousands = re.fullmatch(rf"[1-9]\d{{0,2}}(\{m}\d{{3}})+", t) and m != mark
        t = t.replace(m, "") if thousands else t.replace(m, ".")
    return float(t)


def p7(flow: pd.DataFrame, variables: pd.DataFrame, factors: pd.DataFrame, sites: pd.DataFrame) -> set:
    var = dict(zip(variables.flowsheet_row_name_dk, variables.variable_id))
    fac = {(r.variable_id, r.unit_code): (r.pre_add, r.factor) for r in factors.itertuples()}
    marks = dict(zip(sites.site_code, sites.decimal_mark))
    num = r"(\d+(?:[.,]\d+)*)"
    out = set()
    for r in flow[flow.flowsheet_subtype_description != "Monitor"].itertuples():
        t, mark = tidy(r.flowsheet_result_txt), marks.get(r.site_code, ".")
        if t is None:
            continue
        t = re.sub(r"^(approx|reads)\s+", "", re.sub(r",\s*repeated later$|\s*\(bed scale\)$", "", t))
        if m := re.fullmatch(num + r"\s*(?:ft|feet|')\s*" + num + r"\s*(?:in|inches|\")?", t):
            x, unit = value_of(m[1], mark) * 12 + value_of(m[2], mark), "in"
        elif m := re.fullmatch(num + r"\s*(?:lbs?|pounds)\s*" + num + r"\s*(?:oz|ounces)", t):
            x, unit = value_of(m[1], mark) + value_of(m[2], mark) / 16, "lb"
        elif m := re.fullmatch(num + r"\s*(\D.*)?", t):
            if m[2] and m[2] not in UNITS and m[2] != "cmh2o":
                continue
            x, unit = value_of(m[1], mark), UNITS.get(m[2] or (tidy(r.flowsheet_unit_of_measure_txt) or ""))
        else:
            continue
        if (f := fac.get((var.get(r.flowsheet_row_name_dk), unit))) is not None:
            out.add((r.row_id, round((x + f[0]) * f[1] * 1000)))
    return out
