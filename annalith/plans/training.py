"""Queries of the general problems 1 to 4, 6 and 7; the SQL beside them runs on whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import instants, ledger, rawlines, readings, snapshots, unit_switches, units
from ..session import cut, table

LOADS = 60
"""The feed's counters up to this one are the stored ledger of p1_ledger; the later ones are appended."""


def p1_ledger(feed):
    """The ledger in two steps: what is stored, and the loads appended to it."""
    given = ledger.assertions(feed)
    stored = cut(ledger.ledger(given.filter(f"recorded <= {LOADS}")))
    return ledger.append(stored, given.filter(f"recorded > {LOADS}"))


def p3_loaded(lines, layout):
    """The typed rows of all layouts, as JSON since each has its own columns."""
    frames = [f.select("line_id", F.lit(code).alias("layout_code"), F.to_json(F.struct(*f.columns[1:]), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}).alias("row")) for code, f in rawlines.loaded(lines, layout).items()]
    return reduce(lambda a, b: a.unionByName(b), frames)


QUERIES = {
    "p1_found": lambda s, d: ledger.p1_found(table(s, d, "profile_feed")),
    "p1_ledger": lambda s, d: p1_ledger(table(s, d, "profile_feed")),
    "p2_found": lambda s, d: instants.p2_found(table(s, d, "fact_flowsheets"), table(s, d, "source_sites")),
    "p2_zones": lambda s, d: instants.zones_by_alignment(table(s, d, "fact_flowsheets"), table(s, d, "source_sites")),
    "p3_found": lambda s, d: rawlines.p3_found(table(s, d, "fact_lines"), table(s, d, "line_layout")),
    "p3_rejects": lambda s, d: rawlines.rejects(table(s, d, "fact_lines"), table(s, d, "line_layout")),
    "p3_loaded": lambda s, d: p3_loaded(table(s, d, "fact_lines"), table(s, d, "line_layout")),
    "p4_found": lambda s, d: snapshots.p4_found(table(s, d, "fact_map_snapshots")),
    "p4_changed_values": lambda s, d: snapshots.changed_values(snapshots.latest_rows(table(s, d, "fact_map_snapshots"))),
    "p6_found": lambda s, d: readings.p6_found(table(s, d, "fact_flowsheets"), table(s, d, "rule_variables")),
    "p7_found": lambda s, d: unit_switches.p7_found(table(s, d, "fact_flowsheets"), table(s, d, "rule_variables"), table(s, d, "unit_factors"), table(s, d, "source_sites")),
    "p7_inferred": lambda s, d: unit_switches.inferred_units(table(s, d, "fact_flowsheets"), table(s, d, "rule_variables"), table(s, d, "unit_factors"), table(s, d, "source_sites")),
}

TIDY = "nullif(lower(trim({0})), '')"
_STATE = " || chr(31) || ".join(f"coalesce('=' || {TIDY.format(a)}, '~')" for a in ledger.ATTRIBUTES)
_ASSERTED = f"""SELECT nullif(trim(patient_dk), '') AS k, round(version::double * 1000)::bigint AS v, incr_counter AS r, CASE WHEN lower(trim(record_state)) = 'd' THEN 'D' ELSE {_STATE} END AS state, received_dtm, feed_row_id FROM profile_feed WHERE nullif(trim(patient_dk), '') IS NOT NULL"""
_VERSION = "CASE WHEN {0} = 0 THEN '0.0' ELSE ({0} // 1000)::varchar || '.' || lpad(({0} % 1000)::varchar, 3, '0') END"

SQL: dict[str, str] = {
    "p1_found": f"""WITH a AS ({_ASSERTED}), w AS (SELECT k, v, state FROM a QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY r DESC, received_dtm DESC, feed_row_id DESC) = 1),
t AS (SELECT * FROM (SELECT *, lag(state) OVER (PARTITION BY k ORDER BY v) AS b FROM w) WHERE state IS DISTINCT FROM b), p AS (SELECT k, v, state, coalesce(lead(v) OVER (PARTITION BY k ORDER BY v), 0) AS u FROM t)
SELECT k AS patient_dk, {_VERSION.format("v")} AS version, {_VERSION.format("u")} AS updated_by FROM p WHERE state <> 'D'""",
    "p1_ledger": f"""WITH w AS (SELECT k AS entity, v, coalesce(r, -1)::bigint AS r, state FROM ({_ASSERTED}) QUALIFY row_number() OVER (PARTITION BY k, v, r ORDER BY received_dtm DESC, feed_row_id DESC) = 1),
a AS (SELECT *, coalesce(lead(r) OVER (PARTITION BY entity, v ORDER BY r), {ledger.FOREVER}) AS u FROM w), f AS (SELECT entity, v, min(r) AS f FROM w GROUP BY ALL UNION ALL SELECT DISTINCT entity, {ledger.FOREVER}, {-ledger.FOREVER} FROM w),
s AS (SELECT a.*, f.v AS e, f.f, (SELECT coalesce(min(g.f), {ledger.FOREVER}) FROM f g WHERE g.entity = a.entity AND g.v > a.v AND g.v < f.v) AS nearer FROM a JOIN f ON a.entity = f.entity AND f.v > a.v)
SELECT entity, CASE WHEN state = 'D' THEN 'D' ELSE 'A' || state END AS state, v AS valid_from, e AS valid_to, greatest(r, f) AS recorded_from, least(u, nearer) AS recorded_to FROM s WHERE greatest(r, f) < least(u, nearer)""",
    "p4_found": f"""WITH r AS (SELECT lower(trim(key_hash)) AS k, round(version::double * 1000)::bigint AS v, map_fact_id, fact_guid, coalesce(round(try_cast(trim(map_updated_by) AS double) * 1000)::bigint, 0) AS u, loaded_dtm FROM fact_map_snapshots WHERE trim(key_hash) <> ''),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY loaded_dtm DESC, map_fact_id DESC, fact_guid DESC, u DESC) = 1), o AS (SELECT v, lead(v) OVER (ORDER BY v) AS nx FROM (SELECT DISTINCT v FROM l)),
a AS (SELECT k, nx AS v, map_fact_id, fact_guid, u FROM l JOIN o USING (v) WHERE nx IS NOT NULL), n AS (SELECT k, v, map_fact_id, fact_guid, u FROM l WHERE v > (SELECT min(v) FROM o)),
j AS (SELECT coalesce(a.k, n.k) AS k, coalesce(a.v, n.v) AS v, CASE WHEN a.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN (a.map_fact_id, a.fact_guid, a.u) IS DISTINCT FROM (n.map_fact_id, n.fact_guid, n.u) THEN 'changed' END AS change_kind FROM a FULL JOIN n ON a.k = n.k AND a.v = n.v)
SELECT {_VERSION.format("v")} AS version, k AS key_hash, change_kind FROM j WHERE change_kind IS NOT NULL""",
    "p2_found": rf"""WITH u AS (UNPIVOT (SELECT row_id, site_code, nfer_dtm, flowsheet_row_captured_dtm FROM fact_flowsheets) ON nfer_dtm, flowsheet_row_captured_dtm INTO NAME dtm_field VALUE v), t AS (SELECT row_id, dtm_field, trim(v) AS x, tz_name, date_order FROM u LEFT JOIN source_sites USING (site_code)),
e AS (SELECT *, regexp_extract(x, '^(\d{{4}})-(\d\d)-(\d\d)(?:[T ](\d\d):(\d\d)(?::(\d\d)(?:\.(\d+))?)?\s*(Z|[+-]\d\d:?\d\d|[A-Z]{{3,4}})?)?$', ['y', 'm', 'd', 'h', 'mi', 's', 'f', 'z']) AS i, regexp_extract(x, '^(\d{{4}})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$', ['y', 'm', 'd', 'h', 'mi', 's']) AS c,
 regexp_extract(x, '^(\d\d?)[/.](\d\d?)[/.](\d{{4}}) (\d\d?):(\d\d)(?::(\d\d))?\s*([AP]M)?$', ['a', 'b', 'y', 'h', 'mi', 's', 'p']) AS q, regexp_extract(x, '^(\d\d?)-([A-Z][a-z]{{2}})-(\d{{4}}) (\d\d):(\d\d):(\d\d)$', ['d', 'm', 'y', 'h', 'mi', 's']) AS n FROM t),
w AS (SELECT row_id, dtm_field, tz_name, CASE WHEN regexp_full_match(x, '\d{{10}}|\d{{13}}') THEN 'Z' ELSE i.z END AS z, CASE WHEN regexp_full_match(x, '\d{{10}}|\d{{13}}') THEN make_timestamp(x::bigint * CASE WHEN length(x) = 10 THEN 1000000 ELSE 1000 END)
 WHEN i.y <> '' THEN try_cast(i.y || '-' || i.m || '-' || i.d || ' ' || coalesce(nullif(i.h, ''), '00') || ':' || coalesce(nullif(i.mi, ''), '00') || ':' || coalesce(nullif(i.s, ''), '00') || '.' || rpad(i.f[1:6], 6, '0') AS timestamp)
 WHEN c.y <> '' THEN try_cast(c.y || '-' || c.m || '-' || c.d || ' ' || c.h || ':' || c.mi || ':' || c.s AS timestamp)
 WHEN n.y <> '' THEN try_cast(n.y || '-' || lpad(((instr('JanFebMarAprMayJunJulAugSepOctNovDec', n.m) + 2) // 3)::varchar, 2, '0') || '-' || lpad(n.d, 2, '0') || ' ' || n.h || ':' || n.mi || ':' || n.s AS timestamp)
 WHEN q.y <> '' AND date_order IS NOT NULL AND (q.p = '' OR try_cast(q.h AS int) BETWEEN 1 AND 12) THEN try_cast(q.y || '-' || lpad(CASE WHEN date_order = 'MDY' THEN q.a ELSE q.b END, 2, '0') || '-' || lpad(CASE WHEN date_order = 'MDY' THEN q.b ELSE q.a END, 2, '0') || ' ' || lpad((CASE WHEN q.p = '' THEN try_cast(q.h AS int) ELSE try_cast(q.h AS int) % 12 + CASE WHEN q.p = 'PM' THEN 12 ELSE 0 END END)::varchar, 2, '0') || ':' || q.mi || ':' || coalesce(nullif(q.s, ''), '00') AS timestamp) END AS l FROM e),
o AS (SELECT *, CASE WHEN z LIKE '+%' OR z LIKE '-%' THEN (substr(replace(z, ':', ''), 2, 2)::int * 60 + substr(replace(z, ':', ''), 4, 2)::int) * CASE WHEN z LIKE '-%' THEN -1 ELSE 1 END ELSE map {{{", ".join(f"'{k}': {v}" for k, v in instants.ABBREVIATIONS.items())}}}[z] END AS off, CASE WHEN z = '' AND tz_name IS NOT NULL THEN timezone(tz_name, l) END AS a FROM w WHERE l >= '1950-01-01' AND l < '2100-01-01'),
r AS (SELECT *, CASE WHEN timezone(tz_name, a - INTERVAL 1 hour) = l THEN a - INTERVAL 1 hour ELSE a END AS b FROM o)
SELECT row_id, dtm_field, CASE WHEN z <> '' THEN epoch_us(l) - off::bigint * 60000000 ELSE epoch_us(b) END AS utc_micros FROM r WHERE CASE WHEN z <> '' THEN off IS NOT NULL ELSE b IS NOT NULL AND timezone(tz_name, b) = l END""",
    "p3_rejects": r"""WITH l AS (SELECT line_id, layout_code, pid_rowid, field_count, CASE WHEN right(raw_line, 1) = chr(13) THEN raw_line[:-2] ELSE coalesce(raw_line, '') END AS t FROM fact_lines), p AS (SELECT layout_code, col_type, may_be_empty, row_number() OVER (PARTITION BY layout_code ORDER BY col_pos) AS pos FROM line_layout), w AS (SELECT layout_code, count(*) AS width FROM p GROUP BY 1),
q AS (SELECT l.*, coalesce(width, 0) AS width, regexp_full_match(t, '(?s)("([^"]|"")*"|[^"|][^|]*|)(\|("([^"]|"")*"|[^"|][^|]*|))*') AS sound, regexp_extract(t, '(?s)^((?:"(?:[^"]|"")*"|[^"|][^|]*|)\|)*') AS pre FROM l LEFT JOIN w USING (layout_code)),
f AS (SELECT *, CASE WHEN sound THEN regexp_extract_all('|' || t, '(?s)\|("(?:[^"]|"")*"|[^|]*)', 1) ELSE regexp_extract_all(pre, '(?s)("(?:[^"]|"")*"|[^"|][^|]*|)\|', 1) END AS fields, regexp_extract(substr(t, length(pre) + 1), '(?s)^("(?:[^"]|"")*")[^"]', 1) AS closed FROM q),
v AS (SELECT line_id, layout_code, unnest(fields) AS x, generate_subscripts(fields, 1) AS pos FROM f WHERE sound AND len(fields) = width), u AS (SELECT line_id, layout_code, pos, CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END AS x FROM v),
b AS (SELECT line_id, min(pos) AS pos FROM u JOIN p USING (layout_code, pos) WHERE NOT CASE WHEN x = '' THEN coalesce(may_be_empty, false) WHEN col_type = 'int' THEN regexp_full_match(x, '-?[0-9]+') AND try_cast(x AS integer) IS NOT NULL WHEN col_type = 'double' THEN regexp_full_match(x, '-?[0-9]+(\.[0-9]+)?')
 WHEN col_type = 'timestamp' THEN regexp_full_match(x, '[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') AND try_cast(x AS timestamp) IS NOT NULL WHEN col_type = 'flag' THEN x IN ('Y', 'N') ELSE true END GROUP BY 1),
s AS (SELECT f.*, b.pos, list_transform(fields, lambda x: strlen(x) + 1) AS sizes FROM f LEFT JOIN b USING (line_id) WHERE NOT sound OR len(fields) <> width OR b.pos IS NOT NULL)
SELECT line_id, CASE WHEN NOT sound THEN 'quoting' WHEN len(fields) <> width THEN 'columns' ELSE 'value' END AS reason, (CASE WHEN NOT sound THEN strlen(pre) + strlen(closed) WHEN len(fields) < width THEN strlen(t) ELSE coalesce(list_sum(sizes[1:CASE WHEN len(fields) > width THEN width ELSE pos - 1 END]), 0) END)::bigint AS fault_at,
 pid_rowid, field_count, (len(fields) + CASE WHEN sound THEN 0 ELSE 1 END)::int AS fields_found FROM s""",
    "p7_found": rf"""WITH n(w, code) AS (VALUES {", ".join(f"('{w.replace(chr(39), chr(39) * 2)}', '{c}')" for c, words in units.SPELLINGS.items() for w in words)}), g AS (SELECT row_id, flowsheet_row_name_dk AS var, coalesce(decimal_mark, '.') AS mark, lower(trim(flowsheet_result_txt)) AS raw, lower(trim(flowsheet_unit_of_measure_txt)) AS col FROM fact_flowsheets LEFT JOIN source_sites USING (site_code) WHERE derived_value IS NULL AND flowsheet_result_txt IS NOT NULL),
t AS (SELECT *, regexp_replace(regexp_replace(raw, ',\s*repeated later$|\s*\(bed scale\)$', ''), '^(approx|reads)\s+', '') AS x FROM g), m AS (SELECT *, regexp_extract(x, '^(\d+(?:[.,]\d+)*)\s*(?:ft|feet|'')\s*(\d+(?:[.,]\d+)*)\s*(?:in|inches|")?$', ['a', 'b']) AS ft, regexp_extract(x, '^(\d+(?:[.,]\d+)*)\s*(?:lbs?|pounds)\s*(\d+(?:[.,]\d+)*)\s*(?:oz|ounces)$', ['a', 'b']) AS lb, regexp_extract(x, '^(\d+(?:[.,]\d+)*)\s*([^0-9].*)?$', ['a', 'u']) AS one FROM t),
k AS (SELECT row_id, var, mark, col, CASE WHEN ft.a <> '' THEN ft.a WHEN lb.a <> '' THEN lb.a ELSE one.a END AS a, CASE WHEN ft.a <> '' THEN ft.b WHEN lb.a <> '' THEN lb.b END AS b, CASE WHEN ft.a <> '' THEN 'in' WHEN lb.a <> '' THEN 'lb' END AS two, one.u AS u FROM m WHERE ft.a <> '' OR lb.a <> '' OR one.a <> ''),
c AS (SELECT *, list_transform([a, b], lambda y: CASE WHEN y IS NULL THEN NULL WHEN contains(y, ',') AND contains(y, '.') THEN CASE WHEN instr(reverse(y), ',') < instr(reverse(y), '.') THEN replace(replace(y, '.', ''), ',', '.') ELSE replace(y, ',', '') END
 WHEN contains(y, ',') THEN CASE WHEN regexp_full_match(y, '[1-9][0-9]{{0,2}}(,[0-9]{{3}})+') AND mark <> ',' THEN replace(y, ',', '') ELSE replace(y, ',', '.') END WHEN contains(y, '.') AND regexp_full_match(y, '[1-9][0-9]{{0,2}}(\.[0-9]{{3}})+') AND mark <> '.' THEN replace(y, '.', '') ELSE y END::double) AS v, regexp_replace(replace(replace(replace(CASE WHEN two IS NOT NULL THEN two WHEN u <> '' THEN u ELSE col END, 'micro', 'u'), 'µ', 'u'), 'μ', 'u'), '\sper\s', '/', 'g') AS said FROM k),
z AS (SELECT c.row_id, var, CASE two WHEN 'in' THEN v[1] * 12 + v[2] WHEN 'lb' THEN v[1] + v[2] / 16 ELSE v[1] END AS amount, code FROM c JOIN n ON n.w = replace(regexp_replace(said, '[\s.\[\]°]', '', 'g'), 'hho', 'h2o') OR n.w = regexp_replace(said, '[\s.\[\]°]', '', 'g'))
SELECT DISTINCT row_id, round_even((amount + pre_add) * factor * 1000, 0)::bigint AS common_milli FROM z JOIN rule_variables r ON r.flowsheet_row_name_dk = z.var JOIN unit_factors f ON f.variable_id = r.variable_id AND f.unit_code = z.code""",
    "p4_changed_values": f"""WITH r AS (SELECT lower(trim(key_hash)) AS k, round(version::double * 1000)::bigint AS v, map_fact_id, fact_guid, coalesce(round(try_cast(trim(map_updated_by) AS double) * 1000)::bigint, 0) AS u, loaded_dtm FROM fact_map_snapshots WHERE trim(key_hash) <> ''),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY k, v ORDER BY loaded_dtm DESC, map_fact_id DESC, fact_guid DESC, u DESC) = 1), o AS (SELECT v, lead(v) OVER (ORDER BY v) AS nx FROM (SELECT DISTINCT v FROM l))
SELECT a.k AS key, n.v AS snapshot, a.v AS old_snapshot, a.map_fact_id AS old_map_fact_id, a.fact_guid AS old_fact_guid, a.u AS old_updated_milli, n.map_fact_id AS new_map_fact_id, n.fact_guid AS new_fact_guid, n.u AS new_updated_milli
FROM l a JOIN o ON a.v = o.v JOIN l n ON n.k = a.k AND n.v = o.nx WHERE (a.map_fact_id, a.fact_guid, a.u) IS DISTINCT FROM (n.map_fact_id, n.fact_guid, n.u)""",
    "p3_found": r"""WITH l AS (SELECT line_id, layout_code, CASE WHEN right(raw_line, 1) = chr(13) THEN raw_line[:-2] ELSE coalesce(raw_line, '') END AS t FROM fact_lines),
q AS (SELECT *, regexp_full_match(t, '(?s)("([^"]|"")*"|[^"|][^|]*|)(\|("([^"]|"")*"|[^"|][^|]*|))*') AS sound FROM l),
f AS (SELECT line_id, layout_code, sound, CASE WHEN sound THEN regexp_extract_all('|' || t, '(?s)\|("(?:[^"]|"")*"|[^|]*)', 1) END AS fields FROM q), w AS (SELECT layout_code, count(*) AS width FROM line_layout GROUP BY 1),
c AS (SELECT f.*, coalesce(width, 0) AS width FROM f LEFT JOIN w USING (layout_code)), e AS (SELECT line_id, layout_code, unnest(fields) AS x, generate_subscripts(fields, 1) AS pos FROM c WHERE sound AND len(fields) = width),
v AS (SELECT line_id, layout_code, pos, CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END AS x FROM e), p AS (SELECT layout_code, col_type, may_be_empty, row_number() OVER (PARTITION BY layout_code ORDER BY col_pos) AS pos FROM line_layout),
b AS (SELECT DISTINCT line_id FROM v JOIN p USING (layout_code, pos) WHERE NOT CASE WHEN x = '' THEN coalesce(may_be_empty, false) WHEN col_type = 'int' THEN regexp_full_match(x, '-?[0-9]+') AND try_cast(x AS integer) IS NOT NULL WHEN col_type = 'double' THEN regexp_full_match(x, '-?[0-9]+(\.[0-9]+)?')
 WHEN col_type = 'timestamp' THEN regexp_full_match(x, '[0-9]{4}-[0-9]{2}-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') AND try_cast(x AS timestamp) IS NOT NULL WHEN col_type = 'flag' THEN x IN ('Y', 'N') ELSE true END)
SELECT line_id, CASE WHEN NOT sound THEN 'quoting' WHEN len(fields) <> width THEN 'columns' ELSE 'value' END AS reason FROM c WHERE NOT sound OR len(fields) <> width OR line_id IN (SELECT line_id FROM b)""",
    "p6_found": """WITH r AS (SELECT row_id, device_id, flowsheet_row_name_dk AS var, seq_nbr AS q, derived_value AS x, coalesce(x >= CASE WHEN NOT isnan(range_min) THEN range_min END, true) AND coalesce(x <= CASE WHEN NOT isnan(range_max) THEN range_max END, true) AS inside
 FROM fact_flowsheets LEFT JOIN rule_variables USING (flowsheet_row_name_dk) WHERE derived_value IS NOT NULL AND NOT isnan(derived_value)),
s AS (SELECT device_id, var, q, min_by(x, row_id) AS x, min_by(inside, row_id) AS inside FROM r WHERE device_id IS NOT NULL AND var IS NOT NULL AND q IS NOT NULL GROUP BY 1, 2, 3),
m AS (SELECT device_id, var, median(x) AS m FROM s WHERE inside GROUP BY 1, 2), d AS (SELECT device_id, var, m, median(abs(x - m)) AS mad FROM s JOIN m USING (device_id, var) WHERE inside GROUP BY ALL),
g AS (SELECT *, CASE WHEN x = lag(x) OVER w THEN 0 ELSE 1 END AS b FROM s WINDOW w AS (PARTITION BY device_id, var ORDER BY q)), h AS (SELECT *, sum(b) OVER (PARTITION BY device_id, var ORDER BY q) AS run FROM g),
k AS (SELECT * FROM h QUALIFY count(*) OVER (PARTITION BY device_id, var, run) >= 8)
SELECT row_id, 'impossible' AS fault FROM r WHERE NOT inside UNION ALL SELECT row_id, 'spike' FROM r JOIN d USING (device_id, var) WHERE inside AND abs(x - m) > 10 * mad UNION ALL SELECT row_id, 'stuck' FROM r SEMI JOIN k USING (device_id, var, q)""",
}
