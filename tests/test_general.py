"""Problems 1 to 4, 6 and 7: whole tables against plain Python, then the odd cases."""

from __future__ import annotations

from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st

from annalith.functions.fsm import tokenize
from annalith.operators import blocks, instants, ledger, rawlines, readings, snapshots, unit_switches
from annalith.plans import training

from . import brute_general as brute
from .conftest import SF

TABLES = {
    "p1": ["profile_feed"], "p2": ["fact_flowsheets", "source_sites"], "p3": ["fact_lines", "line_layout"], "p4": ["fact_map_snapshots"],
    "p6": ["fact_flowsheets", "rule_variables"], "p7": ["fact_flowsheets", "rule_variables", "unit_factors", "source_sites"],
}
AT = datetime(2024, 1, 1, tzinfo=timezone.utc)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("problem", TABLES)
def test_whole_tables(spark, problem):
    want = getattr(brute, problem)(*(pd.read_parquet(f"{SF}/{t}.parquet") for t in TABLES[problem]))
    assert set(rows(training.QUERIES[f"{problem}_found"](spark, SF))) == want


FEED = "feed_row_id long, version string, updated_by string, incr_counter int, patient_dk string, patient_clinic_number string, patient_merged_flag string, zipcode string, race_code string, deceased_flag string, record_state string, received_dtm timestamp, entity string, state string"


def feed(spark, *given):
    """(id, version, counter, patient, zip, state): the other attributes are null; columns that clash with the operator's own."""
    return spark.createDataFrame([(i, v, None, n, p, None, None, z, None, None, s, AT, "x", "y") for i, v, n, p, z, s in given], FEED)


def test_periods(spark):
    f = feed(spark, (1, "4.001", 1, "a", "Z1", "A"), (2, "4.005", 9, "a", " z1 ", "A"), (3, "4.003", 12, "a", "Z2", "A"), (4, "4.007", 20, "a", None, "D"), (5, "4.009", 30, "a", "Z1", "A"), (6, "4.001", 1, None, "Z", "A"), (7, "4.001", 1, "  ", "Z", "A"), (8, None, 1, "a", "Z", "A"), (3, "4.003", 12, "a", "Z2", "A"), (9, "4.003", None, "a", "Z9", "A"))
    assert rows(ledger.p1_found(f)) == [("a", "4.001", "4.003"), ("a", "4.003", "4.005"), ("a", "4.005", "4.007"), ("a", "4.009", "0.0")]
    assert rows(ledger.p1_found(f.limit(0))) == []


def test_late_update_splits_without_overwriting(spark):
    book = ledger.ledger(ledger.assertions(feed(spark, (1, "4.001", 1, "a", "Z1", "A"), (2, "4.005", 5, "a", "Z5", "A"), (3, "4.003", 9, "a", "Z3", "A"))))
    end = ledger.FOREVER
    assert sorted((r.valid_from, r.valid_to, r.recorded_from, r.recorded_to) for r in book.collect()) == [(4001, 4003, 9, end), (4001, 4005, 5, 9), (4001, end, 1, 5), (4003, 4005, 9, end), (4005, end, 5, end)]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6), st.sampled_from("xyz")), min_size=1, max_size=14, unique_by=lambda t: t[:2]), st.integers(1, 5))
def test_ledger_appended_in_loads_is_the_whole(spark, given_rows, cut):
    asserted = spark.createDataFrame([("k" if s < "z" else "l", v, r, s) for v, r, s in given_rows], "entity string, valid bigint, recorded bigint, state string")
    stored = ledger.ledger(asserted.filter(f"recorded <= {cut}"))
    assert rows(ledger.append(stored, asserted.filter(f"recorded > {cut}"))) == rows(ledger.ledger(asserted))


def test_a_load_older_than_the_ledger_is_an_error(spark):
    asserted = spark.createDataFrame([("k", 1, 5, "x")], "entity string, valid bigint, recorded bigint, state string")
    with pytest.raises(Exception, match="older than the ledger"):
        ledger.append(ledger.ledger(asserted), asserted).collect()


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 6), st.sampled_from("xyz")), min_size=1, max_size=14, unique_by=lambda t: t[:2]))
def test_ledger_as_recorded(spark, given_rows):
    asserted = spark.createDataFrame([("k", v, r, s) for v, r, s in given_rows], "entity string, valid bigint, recorded bigint, state string")
    book = ledger.ledger(asserted).collect()
    for at in range(1, 7):
        known = {}
        for v, r, s in sorted(given_rows, key=lambda x: x[1]):
            if r <= at:
                known[v] = s
        order = sorted(known)
        want = sorted((known[v], v, order[i + 1] if i + 1 < len(order) else ledger.FOREVER) for i, v in enumerate(order))
        assert sorted((b.state, b.valid_from, b.valid_to) for b in book if b.recorded_from <= at < b.recorded_to) == want


SITES = "site_code string, tz_name string, date_order string, decimal_mark string, trust_rank int"


def sites(spark):
    return spark.createDataFrame([("N", "America/New_York", "MDY", ".", 1), ("B", "Europe/Berlin", "DMY", ",", 2), (None, "UTC", "DMY", ".", 3)], SITES)


INSTANTS = [
        ("N", "2021-11-07 01:30:00", "2021-11-07T05:30:00"), ("N", "2021-03-14 02:30:00", None), ("N", " 2021-03-14T03:30 ", "2021-03-14T07:30:00"), ("N", "03/04/2021 12:05 AM", "2021-03-04T05:05:00"),
        ("B", "04.03.2021 12:05", "2021-03-04T11:05:00"), ("B", "31-Dec-2021 23:59:59", "2021-12-31T22:59:59"), (None, "2021-01-01T00:00:00.1234567Z", "2021-01-01T00:00:00.123456"), (None, "2021-01-01 00:00:00", None),
        (None, "1609459200", "2021-01-01T00:00:00"), ("N", "1609459200123", "2021-01-01T00:00:00.123000"), ("N", "2021-02-30", None), ("N", "1949-12-31", None), ("N", "2100-01-01", None), ("B", "2021-07-01", "2021-06-30T22:00:00"),
        ("N", "13:00", None), ("N", "", None), ("N", None, None), ("N", "2021-01-01 00:00:00 XYZ", None), ("B", "2021-06-01 10:00:00 EDT", "2021-06-01T14:00:00"), ("N", "20210102030405", "2021-01-02T08:04:05"), ("N", "x" * 50_000, None), ("N", "13/13/2021 10:00", None),
]


def test_instants(spark):
    df = spark.createDataFrame([(i, site, AT, text, None, "clash") for i, (site, text, _) in enumerate(INSTANTS)], "row_id long, site_code string, received_dtm timestamp, nfer_dtm string, flowsheet_row_captured_dtm string, zone string")
    assert rows(instants.p2_found(df, sites(spark))) == [(i, "nfer_dtm", int(np.datetime64(want, "us").astype(int))) for i, (_, _, want) in enumerate(INSTANTS) if want]
    assert rows(instants.p2_found(df.limit(0), sites(spark))) == []


def zoned(spark, zone, n=1500, moved=None):
    """Texts of one source, a fifth with their offset: lags to ingestion from ten minutes to eleven hours, some of weeks. ``moved``: the zone of the later half."""
    from zoneinfo import ZoneInfo

    rng, made = np.random.default_rng(5), []
    for i in range(n):
        at = datetime(2021, 1, 1, tzinfo=timezone.utc).timestamp() + i * 1400 * 86_400 / n
        lag = rng.uniform(600, 39_600) if rng.random() < 0.95 else rng.uniform(10, 60) * 86_400
        offset = datetime.fromtimestamp(at, ZoneInfo(moved if moved and i > n // 2 else zone)).utcoffset().total_seconds()
        stated = i % 5 == 0
        made.append(("N", int((at + lag) * 1e6), int((at + offset) * 1e6), int(offset // 60) if stated else None))
    made += [(None, 1, 1, None), ("N", None, 1, None)]
    return spark.createDataFrame(made, "source string, received_micros bigint, local_micros bigint, offset_minutes int")


@pytest.mark.parametrize("zone", ["America/New_York", "Europe/Berlin", "Asia/Kolkata", "Australia/Adelaide"])
def test_zone_is_found_among_all(spark, zone):
    found = instants.zone_history(zoned(spark, zone), spark.createDataFrame([("N", None)], "source string, declared string")).collect()
    days = np.arange(18_700, 20_000)
    assert len(found) == 1 and (instants.day_offsets(found[0].estimated_zone, days) == instants.day_offsets(zone, days)).mean() > 0.99
    audited = instants.zone_history(zoned(spark, zone), spark.createDataFrame([("N", zone)], "source string, declared string")).collect()
    assert [(r.estimated_zone, r.agrees) for r in audited] == [(zone, True)]
    wrong = instants.zone_history(zoned(spark, zone), spark.createDataFrame([("N", "Asia/Tokyo")], "source string, declared string")).collect()
    assert [r.agrees for r in wrong] == [False]


def test_a_source_that_moves_has_two_zones(spark):
    found = sorted(instants.zone_history(zoned(spark, "Asia/Kolkata", moved="Asia/Tokyo"), spark.createDataFrame([], "source string, declared string")).collect(), key=lambda r: r.from_day)
    assert [instants.day_offsets(r.estimated_zone, np.array([19_000]))[0] for r in found] == [22, 36] and abs(found[1].from_day - 19_328) < 60


def test_many_undeclared_sources_are_all_converted(spark):
    """260 sources in zones of their own, none declared; every text comes out, by the estimate where there is one, and by the declared zone where it alone is known."""
    names = [z for z in sorted(instants.available_timezones()) if "/" in z][:260]
    one = zoned(spark, "Asia/Kolkata", n=1200).filter("source is not null and received_micros is not null")
    rows = one.selectExpr("timestamp_micros(received_micros) as received_dtm", "date_format(timestamp_micros(local_micros), 'yyyy-MM-dd HH:mm:ss') || case when offset_minutes is null then '' else '+05:30' end as nfer_dtm", "local_micros div 1000000 - 19800 as want")
    wide = rows.selectExpr("*", f"explode(sequence(0, {len(names) - 1})) as k").selectExpr("row_number() over (order by k, want) as row_id", "'S' || k as site_code", "received_dtm", "nfer_dtm", "cast(null as string) as flowsheet_row_captured_dtm", "want")
    declared = spark.createDataFrame([(f"S{k}", None, "DMY", ".", 1) for k in range(len(names))], SITES)
    got = instants.p2_found(wide, declared).join(wide, "row_id")
    assert got.count() == 1200 * len(names) and got.filter("utc_micros div 1000000 <> want").count() == 0
    own = spark.createDataFrame([(f"S{k}", z, "DMY", ".", 1) for k, z in enumerate(names)], SITES)
    bare = spark.createDataFrame([(k, f"S{k}", None, "2021-01-10 12:00:00", None) for k in range(len(names))], "row_id long, site_code string, received_dtm timestamp, nfer_dtm string, flowsheet_row_captured_dtm string")
    assert instants.p2_found(bare, own).count() == len(names)


LINE = st.text(alphabet='ab"|\n ', max_size=24)


@settings(max_examples=300, deadline=None)
@given(st.lists(LINE, min_size=1, max_size=9), st.integers(1, 7))
def test_tokenizer_composes_over_chunks(lines, chunk):
    data = "".join(lines).encode()
    ends = np.cumsum([len(x) for x in lines])
    at, record, fault, starts, _ = tokenize(np.frombuffer(data, np.uint8), ends, chunk=chunk)
    for i, line in enumerate(lines):
        want = brute.fields_of(line)
        assert (fault[i] >= 0) == (want is None)
        if want is not None:
            bounds = at[record == i] - starts[i]
            pieces = [line[a:b] for a, b in zip([0, *(bounds[:-1] + 1)], bounds)]
            assert [p[1:-1].replace('""', '"') if p.startswith('"') else p for p in pieces] == want


LAYOUT = [("L", 1, "id", "int", False), ("L", 2, "x", "double", True), ("L", 3, "at", "timestamp", True), ("L", 4, "f", "flag", True), ("L", 5, "t", "string", True)]


LINES = [
        ("1||||", None), ("1||||\r", None), ("1||||\r\r", None), ('1|"2.5"|"2024-02-29 00:00:00"|"Y"|"a|""b"""', None), ('1||||"a', "quoting"), ('1||||"a"b', "quoting"), ('1|||a"b|', "value"), ("1|||", "columns"), ("", "columns"), (None, "columns"),
        ("||||", "value"), ("2147483648||||", "value"), ("-2147483648||||", None), ("+1||||", "value"), ("1|1e5|||", "value"), ("1|.5|||", "value"), ("1||2023-02-29 00:00:00||", "value"), ("1||2023-02-28 24:00:00||", "value"), ("1|||y|", "value"), ('1||||x\ny', None), ('1||||"' + "a|" * 40_000 + '"', None), ("1\n||||", "value"),
]


def test_lines(spark):
    layout = spark.createDataFrame(LAYOUT, "layout_code string, col_pos int, col_name string, col_type string, may_be_empty boolean")
    df = spark.createDataFrame([(i, "L", line, "p", 3, "clash") for i, (line, _) in enumerate(LINES)], "line_id long, layout_code string, raw_line string, pid_rowid string, field_count int, fields string")
    assert rows(rawlines.p3_found(df, layout)) == [(i, want) for i, (_, want) in enumerate(LINES) if want]
    typed = rawlines.loaded(df, layout)["L"]
    assert rows(typed.select("line_id")) == [(i,) for i, (_, want) in enumerate(LINES) if not want]
    assert typed.dtypes == [("line_id", "bigint"), ("id", "int"), ("x", "double"), ("at", "timestamp_ntz"), ("f", "boolean"), ("t", "string")]
    assert tuple(typed.filter("line_id = 3").first()) == (3, 1, 2.5, datetime(2024, 2, 29), True, 'a|"b"') and tuple(typed.filter("line_id = 0").first()) == (0, 1, None, None, None, None)
    assert rows(rawlines.p3_found(df.withColumn("layout_code", df.pid_rowid), layout)) == [(i, "quoting" if want == "quoting" else "columns") for i, (_, want) in enumerate(LINES)]
    assert rows(rawlines.p3_found(df.limit(0), layout)) == []


def test_reject_offsets(spark):
    layout = spark.createDataFrame(LAYOUT, "layout_code string, col_pos int, col_name string, col_type string, may_be_empty boolean")
    made = ['1|"ab"c|||', '1|2|"x', "1|é|||", "1||||t|more", "1||", "é||||"]
    df = spark.createDataFrame([(i, "L", x, "p|1", 4) for i, x in enumerate(made)], "line_id long, layout_code string, raw_line string, pid_rowid string, field_count int")
    assert rows(rawlines.rejects(df, layout).select("line_id", "reason", "fault_at", "pid_rowid")) == [(0, "quoting", 6, "p|1"), (1, "quoting", 4, "p|1"), (2, "value", 2, "p|1"), (3, "columns", 7, "p|1"), (4, "columns", 3, "p|1"), (5, "value", 0, "p|1")]


@pytest.mark.parametrize("hot_rows", [None, 10])
def test_records_over_lines(spark, hot_rows):
    """Whole files cut at every line feed come back as their records, whatever lines a quoted field goes over."""
    rng, want, lines = np.random.default_rng(3), [], []
    for f in ("a", "b", "empty"):
        n = 0
        for _ in range(60 if f != "empty" else 0):
            fields = ['"' + "".join(rng.choice(list('x|\n\n')) if rng.random() < 0.9 else '""' for _ in range(rng.integers(0, 9))) + '"' if rng.random() < 0.4 else rng.choice(["", "p", 'q"r', "é"]) for _ in range(3)]
            record = "|".join(fields)
            want.append((f, n, record))
            for x in record.split("\n"):
                lines.append((f, n, x, "clash"))
                n += 1
    df = spark.createDataFrame(lines, "file_name string, line_no int, raw_line string, open string")
    assert rows(rawlines.records(df, hot_rows=hot_rows)) == sorted(want)
    assert rows(rawlines.records(df.limit(0))) == []


def test_snapshots(spark):
    schema = "version string, key_hash string, nfer_pid long, file_id int, map_fact_id int, fact_guid long, map_updated_by string, loaded_dtm timestamp, key string, rank int"
    late = datetime(2024, 1, 2, tzinfo=timezone.utc)
    made = [("4.001", "K1", 1, "0", AT), ("4.001", " k2", 1, None, AT), ("4.001", "k4", None, "0", AT), ("4.0030", "k1 ", 1, "0.000", AT), ("4.003", "k3", 5, "4.003", AT), ("4.003", "k3", 6, "4.003", late), ("4.003", None, 1, "0", AT), ("4.003", "k4", 3, "0", AT), ("4.005", "k1", 1, " 4.0050", AT), ("4.005", "k2", 1, "0", AT), ("4.005", "k3", 6, "4.0030", AT), ("4.005", "k3", 6, "4.003", AT), ("4.005", "k4", 3, "x", AT), (None, "k9", 1, "0", AT)]
    df = spark.createDataFrame([(v, k, 1, 1, m, 7, u, t, "c", 1) for v, k, m, u, t in made], schema)
    assert rows(snapshots.p4_found(df)) == [("4.003", "k2", "removed"), ("4.003", "k3", "added"), ("4.003", "k4", "changed"), ("4.005", "k1", "changed"), ("4.005", "k2", "added")]
    assert rows(snapshots.p4_found(df.limit(0))) == []
    assert rows(snapshots.changed_values(snapshots.latest_rows(df.limit(0)))) == []
    old_new = rows(snapshots.changed_values(snapshots.latest_rows(df)).select("key", "old_map_fact_id", "new_map_fact_id", "old_updated_milli", "new_updated_milli"))
    assert old_new == [("k1", 1, 1, 0, 4005), ("k4", None, 3, 0, 0)]


def test_probing_shuffles_the_new_snapshot_only(spark):
    """Two indexes in the same buckets meet without an exchange; a snapshot that is as the last one changes nothing."""
    made = spark.createDataFrame([(f"k{i}", i % 7, i, 0) for i in range(500)], "key string, map_fact_id int, fact_guid long, updated_milli long")
    index = snapshots.SnapshotIndex(spark, buckets=4)
    assert index.advance(made, 1) is None and index.advance(made, 2).count() == 0
    after = index._write(made)
    plan = spark.table(index.current).join(spark.table(after).withColumnRenamed("hash", "h"), "key", "full")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    changed = index.advance(made.filter("fact_guid > 3").union(made.limit(1).selectExpr("'new'", "1", "1", "0")), 3)
    assert sorted(tuple(r) for r in changed.groupBy("change_kind").count().collect()) == [("added", 1), ("removed", 4)]
    spark.sql(f"DROP TABLE {after}")
    index.close()


FLOW = "row_id long, device_id string, flowsheet_row_name_dk int, seq_nbr int, derived_value double, level string"


def test_readings(spark, monkeypatch):
    monkeypatch.setattr(readings, "BLOCK", 4)
    variables = spark.createDataFrame([(1, 10, "v", "u", 0.0, 100.0, "true"), (2, 20, "w", "u", None, float("nan"), "false")], "variable_id int, flowsheet_row_name_dk int, display_name string, units string, range_min double, range_max double, is_valid_range string")
    values = [50.0, 51.0, 49.0, 90.0, 150.0] + [52.0] * 8 + [50.0, None, float("nan"), 48.0] + [47.0] * 7
    made = [(i, "d", 10, i, x, "c") for i, x in enumerate(values)] + [(100, "d", 10, 5, 52.0, "c"), (101, None, 10, 1, 200.0, "c"), (102, "d", None, 1, 5.0, "c"), (103, "d", 20, 1, 1e9, "c"), (104, "d", 10, None, -1.0, "c")]
    df = spark.createDataFrame(made, FLOW)
    got = rows(readings.p6_found(df, variables))
    assert set(got) == brute.p6(df.toPandas(), variables.toPandas()) and len(got) == len(set(got))
    assert {r for r, f in got if f == "stuck"} == {*range(5, 13), 100} and (3, "spike") in got and (101, "impossible") in got
    assert rows(readings.p6_found(df.limit(0), variables)) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from([0.0, 1.0, 1.5, 2.0, 30.0, -30.0, 1e9]), st.booleans()), min_size=1, max_size=40, unique_by=lambda t: t[0]), st.sampled_from([0.0, 0.1, 1.0]))
def test_no_spike_escapes_the_details(steps, scale):
    """Details and coarsest approximation sum up to the reading, and their thresholds find all readings beyond the border."""
    steps.sort()
    seq, x, inside = (np.array(c) for c in zip(*steps))
    group = seq >> 3
    details, coarse = readings.haar_details(group, seq, x, inside.astype(float), 8)
    assert np.allclose(sum(details) + coarse, x) and len(details) == 3
    got = {seqs[0] for _, _, what, _, _, seqs in readings.analysed(group, seq, x, inside, np.full(len(x), 1.0), np.full(len(x), scale), 8) if what == "spike"}
    assert got == {int(q) for q, v, ok in steps if ok and abs(v - 1.0) > 10 * scale}


def test_medians_are_exact(spark):
    """Series of any length, one of them with a third of all rows and nearly as many values, and with ties at the middle."""
    rng = np.random.default_rng(6)
    given = {"hot": rng.normal(size=20_000), "ties": np.repeat([1.0, 2.0, 3.0], [400, 1, 401]), "one": [5.0], "two": [1.0, 4.0], **{f"s{k}": rng.integers(0, 9, k + 1).astype(float) for k in range(30)}}
    df = spark.createDataFrame(pd.DataFrame([(d, 1, float(v)) for d, xs in given.items() for v in xs], columns=[*readings.SERIES, "x"]))
    got = {r.device_id: r.m for r in readings.medians(df, "m").collect()}
    assert got == {d: float(np.median(xs)) for d, xs in given.items()}
    assert readings.medians(df.limit(0), "m").count() == 0


AMOUNTS = [
        ("N", "5 ft 11 in", None, 180340), ("N", "5'11\"", "cm", 180340), ("N", "1,234", "g", None), ("N", "1.80 m", None, 180000), ("B", "1,80", "m", 180000), ("B", "1.234", "cm", 1234000), ("N", "1.234", "cm", 1234), ("N", "1,234", "cm", 1234000), (None, "1,234", "cm", 1234000), ("N", "1,234.5 cm", None, 1234500),
        ("N", "approx 180 CM, repeated later", "m", 180000), ("N", "180 cm (bed scale)", None, 180000), ("N", "<180", "cm", None), ("N", "170-180", "cm", None), ("N", "120/80", "cm", None), ("N", "180", "N/A", None), ("N", "2 attempts, none read", "cm", None), ("N", "", "cm", None), ("N", None, "cm", None), ("N", "x" * 60_000, "cm", None), ("N", "less than 5", "cm", None), ("N", "180 kg", "cm", None),
]


def test_units(spark):
    variables = spark.createDataFrame([(8, 4171, "h", "cm", 1.0, 2.0, "true")], "variable_id int, flowsheet_row_name_dk int, display_name string, units string, range_min double, range_max double, is_valid_range string")
    factors = spark.createDataFrame([(8, "cm", 0.0, 1.0), (8, "m", 0.0, 100.0), (8, "in", 0.0, 2.54)], "variable_id int, unit_code string, pre_add double, factor double")
    schema = "row_id long, site_code string, flowsheet_row_name_dk int, flowsheet_result_txt string, flowsheet_unit_of_measure_txt string, derived_value double, amount string, received_dtm timestamp, device_id string"
    df = spark.createDataFrame([(i, site, 4171, text, unit, None, "clash", AT if i % 3 else None, "d" if i % 2 else None) for i, (site, text, unit, _) in enumerate(AMOUNTS)] + [(99, "N", 4171, "180 cm", None, 5.0, "clash", AT, None), (98, "N", 4171, "180 cm", None, float("nan"), "clash", AT, None)], schema)
    assert rows(unit_switches.p7_found(df, variables, factors, sites(spark))) == [(i, want) for i, (*_, want) in enumerate(AMOUNTS) if want is not None]
    assert rows(unit_switches.p7_found(df.limit(0), variables, factors, sites(spark))) == []


def test_unit_switches_are_decoded():
    rng = np.random.default_rng(1)
    truth = ["kg"] * 60 + ["lb"] * 60 + ["kg"] * 30
    common = np.exp(rng.normal(4.3, 0.08, len(truth)))
    values = [c if u == "kg" else c / 0.45359237 for c, u in zip(common, truth)]
    got = unit_switches.decode(values, [None] * len(truth), [("kg", 0.0, 1.0), ("lb", 0.0, 0.45359237)], 4.3, 0.08)
    assert np.mean([a == b for a, b in zip(got, truth)]) > 0.97
    told = unit_switches.decode(values[:3], ["lb", None, None], [("kg", 0.0, 1.0), ("lb", 0.0, 0.45359237)], 4.3, 0.08)
    assert told[0] == "lb"


@pytest.mark.parametrize("seed", range(5))
def test_blocks_decode_as_the_whole_chain(seed):
    rng = np.random.default_rng(seed)
    for k in (1, 2, 3, 4):
        logs = -0.5 * rng.normal(0, 2, (80, k)) ** 2
        cuts = sorted(rng.choice(np.arange(1, 80), 12, replace=False))
        parts = np.split(logs, cuts)
        for rate in (0, 0.1, 0.9):
            told = np.where(rng.random(80) < rate, rng.integers(0, k, 80), -1)
            sure = np.where((told >= 0)[:, None], np.where(np.arange(k) == told[:, None], 0.0, -np.inf), logs)
            ends = unit_switches.boundaries([unit_switches.transfer(x, t) for x, t in zip(parts, np.split(told, cuts))])
            got = np.concatenate([unit_switches.decoded_path(x, t, before=b, last=e) for x, t, (b, e) in zip(parts, np.split(told, cuts), ends)])
            assert (got == unit_switches.viterbi(sure)).all()


def test_unit_is_kept_over_block_ends_and_levels_are_the_sources(spark, monkeypatch):
    """One told reading in January, then a reading without a unit in each later month that alone would be kg; and a source far from its variable's level."""
    variables = spark.createDataFrame([("v", "V"), ("v", "W")], "variable_id string, flowsheet_row_name_dk string")
    factors = spark.createDataFrame([("v", "kg", 0.0, 1.0), ("v", "lb", 0.0, 0.45359237)], "variable_id string, unit_code string, pre_add double, factor double")
    site = spark.createDataFrame([("A", "."), ("B", "."), ("C", ".")], "site_code string, decimal_mark string")
    rng, given = np.random.default_rng(4), []
    for m in range(1, 13):
        for x in np.exp(rng.normal(3.6, 0.5, 12)):
            given.append((len(given), "B", "V", None, f"{x:.2f} kg", None, datetime(2024, m, 3, tzinfo=timezone.utc)))
    given.append((1000, "A", "V", None, "47 lb", None, datetime(2024, 1, 5, tzinfo=timezone.utc)))
    given += [(1000 + m, "A", "V", None, "47", None, datetime(2024, m, 5, tzinfo=timezone.utc)) for m in range(2, 13)]
    given.append((1100, "A", "V", None, "47", None, None))
    given += [(2000 + i, "C" if i < 100 else "B", "W", None, f"{100 + i % 5 if i < 100 else 44 + i % 5} kg", None, datetime(2024, 6, 1 + i % 20, tzinfo=timezone.utc)) for i in range(250)]
    given += [(3000, "C", "W", None, "101", None, datetime(2024, 6, 25, tzinfo=timezone.utc))]
    df = spark.createDataFrame(given, "row_id long, site_code string, flowsheet_row_name_dk string, derived_value double, flowsheet_result_txt string, flowsheet_unit_of_measure_txt string, received_dtm timestamp")
    got = {r.row_id: (r.unit, r.common_milli) for r in unit_switches.inferred_units(df, variables, factors, site).collect()}
    assert {i: u for i, (u, _) in got.items() if 1000 < i < 1100} == {1000 + m: "lb" for m in range(2, 13)}
    assert got[1002][1] == round(47_000 * 0.45359237) and got[3000] == ("kg", 101_000) and 1100 in got
    whole = rows(unit_switches.decoded_units(df, variables, factors, site))
    monkeypatch.setattr(blocks, "HOT_ROWS", 20)  # now the chains fall into parts, of which levels have their own medians
    parted = {r.row_id: r.unit for r in unit_switches.decoded_units(df, variables, factors, site).collect()}
    assert {r[0]: r[2] for r in whole} == parted
    assert unit_switches.smoothed([0, 1, 50], [1.0, np.nan, 3.0], [100, 0, 100], 0.0) == pytest.approx([1.04, 1.1, 2.95], abs=0.1)
