"""The query catalogue against DuckDB, and what SQL can't say: round trips, stable ids, episodes, sources and sinks."""

from __future__ import annotations

import random

import __spark_entry__ as entry
import pytest
from pyspark.sql import functions as F, types as T

from annalith import session
from annalith.operators import blocks, derive, enrich, ids, joins, keys, pipelines, quality, sequences, versioning
from annalith.plans import composites, history, jobs, scalars, stores, summaries, training
from annalith.sources import config, readers, sinks, store
from annalith.streaming import events as streams

from .oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
SQL = {n: (m.QUERIES[n], q) for m in (scalars, history, summaries, jobs, stores, composites, training) for n, q in m.SQL.items()}


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", SQL)
def test_query(spark, duck, name):
    query, sql = SQL[name]
    assert compare(spark, name, query, sql, SMALL, duck).startswith("ok")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_guid_round_trip_with_high_tables(spark):
    df = spark.createDataFrame([(200, 2**28 - 1, 5), (0, 0, 0), (127, 1, 2**28 - 1)], "t int, k bigint, f bigint")
    guid = keys.pack_guid(F.col("t"), F.col("k"), F.col("f"))
    got = df.select("t", "k", "f", *keys.unpack_guid(guid)).collect()
    assert all((r[0], r[1], r[2]) == (r[3], r[4], r[5]) for r in got)


def test_ids_are_stable_and_append_only(spark):
    none = spark.createDataFrame([], "id bigint, v string")
    words = spark.createDataFrame([(w,) for w in ("b", "a", None, "a", "d")], "v string")
    first = ids.extend_dictionary(none, words, "v", "id")
    more = ids.extend_dictionary(first, spark.createDataFrame([("c",), ("a",)], "v string"), "v", "id")
    assert {r.v: r.id for r in first.collect()} == {"a": 1, "b": 2, "d": 3}
    assert {r.v: r.id for r in more.collect()} == {"a": 1, "b": 2, "d": 3, "c": 4}


def test_as_of_gives_back_each_version(spark):
    v1 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    v2 = spark.createDataFrame([(1, "a"), (2, "c"), (3, "d")], "k int, x string")
    table = versioning.merge_derived(versioning.stamped(v1, 1), v2, ["k"], ["x"], 2)
    for n, v in ((1, v1), (2, v2)):
        assert sorted(versioning.as_of(table, n, latest_only=True).select("k", "x").collect()) == sorted(v.collect())


def test_nearest_is_brute_force(spark):
    left = [("a", t) for t in (0, 5, 10, 11, 30)] + [("b", 7), ("c", 1)]
    right = [("a", 4, 1), ("a", 6, 2), ("a", 20, 3), ("a", 20, 9), ("b", 7, 4)]
    got = joins.nearest(spark.createDataFrame(left, "e string, t bigint"), spark.createDataFrame(right, "e string, rt bigint, id bigint"), "e", "t", "rt", ["id"])
    want = set()
    for e, t in left:
        best = min(((abs(t - rt), rt, i) for f, rt, i in right if f == e), default=(None, None, None))
        want.add((e, t, best[2], best[0]))
    assert {tuple(r) for r in got.collect()} == want


DAY = sequences.DAY


def plain_episodes(events, primary="primary", reach=2 * DAY, restart=30):
    """Episodes of one entity's (at, source, tag) by a plain walk over them; events in the order of time, source, tag."""
    events, found, start = sorted(set(events), key=lambda e: (e[0], e[1] is not None, e[1] or "", e[2])), [], None
    linked = lambda a, b: events[b][0] - events[a][0] <= reach
    for i, (at, source, tag) in enumerate(events):
        stands = start is not None and events[start][1] == primary and (at - events[start][0]) // DAY <= restart
        if tag == 1 and not stands:
            start = i
        if tag == -1 and start is not None and events[start][1] == source:
            first = max((k + 1 for k in range(start) if not linked(k, k + 1) or events[k][2] == -1), default=0)
            last = min((k for k in range(i, len(events) - 1) if not linked(k, k + 1) or events[k + 1][2] == 1), default=len(events) - 1)
            found.append((events[first][0], events[last][0]))
            start = None
    merged = []
    for begin, end in found:
        if merged and begin <= merged[-1][1]:
            merged[-1] = (merged[-1][0], end)
        else:
            merged.append((begin, end))
    return [(n, (end - begin) // DAY + 1, begin, end) for n, (begin, end) in enumerate(merged, 1)]


def test_plain_episodes():
    run = lambda at, tags, source: plain_episodes(list(zip(at, source, tags)), "h")
    assert run([0, DAY, 3 * DAY, 4 * DAY, 60 * DAY, 61 * DAY], [0, 1, -1, 0, 1, -1], "hhhhhh") == [(1, 5, 0, 4 * DAY), (2, 2, 60 * DAY, 61 * DAY)]
    assert run([0, DAY, 2 * DAY], [1, 1, -1], "xhh") == [(1, 3, 0, 2 * DAY)]
    assert run([0], [1], "h") == [] and run([0, 100 * DAY], [1, -1], "hh") == [(1, 101, 0, 100 * DAY)]


@pytest.mark.parametrize("hot_rows", [None, 150])
def test_episodes(spark, hot_rows):
    """Random events over years, some entities with very many, in the case of ``hot_rows`` cut into blocks."""
    rng, given = random.Random(2), {}
    for e in range(120):
        at, own = 0, []
        for _ in range(rng.randrange(1, 25) if e else 2000):
            at += rng.choice((0, DAY // 2, DAY, 5 * DAY, 20 * DAY, 40 * DAY, 95 * DAY, 200 * DAY))
            own.append((at, rng.choice(("primary", "other", "z", None)), rng.choice((1, 1, 0, -1))))
        given[e] = own
    df = spark.createDataFrame([(e, at, tag, s) for e, own in given.items() for at, s, tag in own] + [(None, 1, 1, "primary"), (5, None, 1, "other")], "e bigint, t bigint, tag int, s string")
    got = [tuple(r) for r in sequences.episodes(df, "e", "t", "tag", "s", "primary", hot_rows=hot_rows).collect()]
    want = {(e, *c) for e, own in given.items() for c in plain_episodes(own)}
    assert len(got) == len(want) and set(got) == want
    assert sequences.episodes(df.limit(0), "e", "t", "tag", "s", "primary").count() == 0


def hot_events(spark, n=4000):
    """A third of all rows on entity 0; times repeat."""
    rng = random.Random(4)
    return spark.createDataFrame([(0 if i % 3 == 0 else rng.randrange(1, 200), rng.randrange(5 * n), i, rng.choice("abc")) for i in range(n)], "e bigint, t bigint, id bigint, v string")


def test_hot_groups_give_the_same_rows(spark):
    """Every operator on an entity's order, with and without blocks."""
    df = hot_events(spark)
    right = df.filter("id % 2 = 1").select("e", F.col("t").alias("rt"), F.col("id").alias("other"))
    stays = df.select("e", F.col("t").alias("start_ts"), (F.col("t") + F.col("id") % 97 * 50).alias("end_ts"), F.col("v").alias("kind"))
    cases = {
        "nearest": lambda h: joins.nearest(df.filter("id % 2 = 0"), right, "e", "t", "rt", ["other"], h),
        "gaps": lambda h: sequences.gap_cycles(df, "e", "t", 5, h),
        "changes": lambda h: sequences.changes_only(df, ["e"], "t", "v", ["id"], h),
        "doses": lambda h: sequences.doses(df.filter("e <> 0 or id % 20 = 0").withColumns({"n": F.lit(3), "w": F.col("v")}), "e", "t", "v", "w", "n", hot_rows=h),
        "stays": lambda h: derive.stay_days(df, stays, "e", "kind", {"a": "a_days"}, "t", hot_rows=h),
        "numbers": lambda h: blocks.numbered(df, ["e"], [F.col("t").desc(), F.col("id")], "n", h),
    }
    for name, run in cases.items():
        a, b = (sorted(map(tuple, run(h).collect()), key=repr) for h in (None, 100))
        assert a == b and a, name
    spread = blocks.blocked(df, ["e"], "t", 100).groupBy("e", blocks.BLOCK).count().agg(F.max("count")).first()[0]
    assert spread < 300


def test_stays_are_brute_force(spark):
    rng = random.Random(8)
    points = {(rng.randrange(6), rng.randrange(40) * DAY // 4) for _ in range(80)}
    spans = [(rng.randrange(6), s := rng.randrange(60) * DAY // 4, s + rng.randrange(0, 9) * DAY // 2, rng.choice("ab")) for _ in range(90)]
    pdf, sdf = spark.createDataFrame(sorted(points), "e bigint, at bigint"), spark.createDataFrame(spans, "e bigint, start_ts bigint, end_ts bigint, kind string")
    want = set()
    for e, at in points:
        by = {}
        for f, s, t, k in spans:
            if f == e and s < t and t > at:
                c = by.setdefault(max(at, s), [0, 0])
                days = t // DAY - max(at, s) // DAY
                by[max(at, s)] = [max(c[0], days), max(c[1], days if k == "a" else 0)]
        if by:
            want.add((e, at, min(by), len(by), sum(c[0] for c in by.values()), sum(c[1] for c in by.values())))
    assert {tuple(r) for r in derive.stay_days(pdf, sdf, "e", "kind", {"a": "a_days"}).collect()} == want
    inside = {(e, at, s, t, k) for e, at in points for f, s, t, k in spans if f == e and s < at < t}
    assert {tuple(r) for r in joins.within(pdf, sdf, "e", "at", "start_ts", "end_ts").select("e", "at", "start_ts", "end_ts", "kind").collect()} == inside


def test_broadcasts_are_measured(spark):
    wide = spark.range(3000).select(*(F.sha2((F.col("id") * k).cast("string"), 512).alias(f"c{k}") for k in range(12)))
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    assert not hinted(session.small(wide, 100_000)) and hinted(session.small(wide.limit(5), 100_000))


def test_repeated_keys_of_a_derived_table_are_an_error(spark):
    v1 = versioning.stamped(spark.createDataFrame([(1, "a")], "k int, x string"), 1)
    with pytest.raises(Exception, match="repeated key"):
        versioning.merge_derived(v1, spark.createDataFrame([(1, "b"), (1, "c")], "k int, x string"), ["k"], ["x"], 2).collect()


def test_repeated_facts_get_one_number(spark):
    none = spark.createDataFrame([], "key_hash string, entity_id bigint, key_id bigint, fact_id bigint, fact_key_id bigint, valid_from bigint, superseded_by bigint")
    data = spark.createDataFrame([("h", 1, 9), ("h", 1, 9), ("i", 1, 9)], "key_hash string, entity_id bigint, key_id bigint")
    got = versioning.stamp_facts(data, none, none.select("key_id"), 1, 5).select("key_hash", "fact_id", "fact_key_id").collect()
    assert sorted(map(tuple, got)) == [("h", 1, 1), ("h", 1, 1), ("i", 2, 2)]


def test_formulas_divide_and_multiply(spark):
    df = spark.createDataFrame([(4.0, "_value * 0.5"), (4.0, "_value / 0.5"), (4.0, "_value"), (4.0, None), (4.0, "_value/0")], "x double, f string")
    from annalith.operators.normalize import apply_formula

    assert [r[0] for r in df.select(apply_formula(F.col("x"), F.col("f"))).collect()] == [2.0, 8.0, 4.0, 4.0, 4.0]


def test_guards(spark):
    twice = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        joins.no_fanout(twice, ["k"])
    with pytest.raises(ValueError):
        quality.require(False, "no")
    with pytest.raises(ValueError):
        readers.safe_select(twice, ["k"], ["missing"])


def test_schemas():
    assert readers.spark_type("long") == T.LongType() and readers.spark_type("odd") == T.StringType()
    assert [f.dataType for f in readers.overlay_schema(["A", "B"], {"a": "INTEGER"}, {"B": "DOUBLE"})] == [T.IntegerType(), T.DoubleType()]
    nested = readers.nested_schema({"a": {"b": "LONG"}, "c": [{"d": "STRING"}]})
    assert nested["a"].dataType["b"].dataType == T.LongType() and readers.upper_names(nested)["C"].dataType.elementType.names == ["D"]
    assert readers.flat_names({"a": {"b": "x", "c": "y"}, "d": "z"}) == ["a__b", "a__c", "d"]
    assert readers.newest_version(["4.001", "4.010", "5.001"], "4.100") == "4.010"
    assert readers.manifest(["/x/lab_1.csv|2", "/x/lab_0.csv|1", "/y/other.csv|1"], "lab_*") == [(1, ["/x/lab_0.csv"]), (2, ["/x/lab_1.csv"])]


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a|b", 2.5), (2, "é", None)], "k int, s string, x double")
    sinks.write_delimited(df, str(tmp_path / "d"), sep="$$$", header=False)
    back = readers.read_delimited(spark, str(tmp_path / "d"), df.schema, sep="$$$")
    assert sorted(back.collect()) == sorted(df.collect())
    sinks.write_header(df, str(tmp_path / "h.csv"))
    assert readers.read_sidecar(spark, str(tmp_path / "d"), str(tmp_path / "h.csv"), "|").columns == df.columns
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "part_7.csv").write_bytes("1|é\n".encode("iso-8859-1"))
    latin = readers.read_delimited(spark, str(tmp_path / "l"), T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType())]), encoding="ISO-8859-1")
    assert latin.select("s", readers.file_number(F.input_file_name())).collect()[0][:] == ("é", 7)
    versioned = versioning.stamped(df, 1)
    kept = store.Store(spark, str(tmp_path / "store"))
    assert kept.publish(versioned, store.FACT, "T", 4001) == 2 and kept.read(store.FACT, "T").filter("valid_from = 1").count() == 2
    assert kept.publish(versioned.limit(0), store.FACT, "E", 4001) == 0 and kept.read(store.FACT, "none") is None and kept.read_or_empty(store.FACT, "none", "k int").count() == 0
    assert kept.backup(kept.path(4001, store.FACT, "T")).endswith(".bkup") and kept.latest(store.FACT, "T") is None
    kept.copy(kept.path(4001, store.FACT, "T") + ".bkup", kept.path(4001, store.FACT, "T"))
    assert kept.latest(store.FACT, "T") == 4001 and kept.first_run(store.FACT, "U") and not kept.source_changed(["T"], 4001)
    with pytest.raises(ValueError):
        kept.release(4002)
    assert readers.read_parquet(spark, str(tmp_path / "none")) is None
    assert sinks.blocks(df.withColumn("b", F.lit(1)), "b", [F.col("k")]).count() == 2


def test_stream_upserts(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (1, "b")], "k int, x string").write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema("k int, x string").parquet(str(tmp_path / "in"))
    streams.upsert_batches(stream, lambda df, n: seen.append(df.count()), str(tmp_path / "c")).awaitTermination(60)
    assert sum(seen) == 2


def test_braced_sets(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "c"), (3, None)], "k int, x string")
    assert {r[0]: r[1] for r in df.groupBy("k").agg(derive.braced_set(F.col("x"))).collect()} == {1: "{a|b}", 2: "c", 3: None}


def test_table_lists():
    tables, big = ["LAB", "ORDERS", "NOTES", "FLOW"], ["ORDERS", "FLOW"]
    lists = lambda word, **how: store.resolve(word, tables, big, ["NOTES"], **how)
    assert lists("ALL") == ["LAB", "NOTES", "ORDERS", "FLOW"] and lists("big") == big and lists("NotBig") == ["LAB", "NOTES"] and lists("ENRICHED") == ["NOTES"]
    assert lists("~lab,~flow") == ["NOTES", "ORDERS"] and lists("flow, lab") == ["FLOW", "LAB"] and lists("ALL", skipped=["NOTES"]) == ["LAB", "ORDERS", "FLOW"] and lists("x") == ["X"]


def test_jobs_and_providers(spark):
    done = []
    job = store.TableJob(lambda: spark.range(3), lambda df: df.filter("id > 0"), lambda df: df.count(), done.append)
    assert job.run() == 2 and done == [2] and store.TableJob(lambda: None, None, None).run() is None
    with pytest.raises(ValueError, match="no reader"):
        store.read_provider("nobody")
    assert store.milli("4.010") == 4010 and store.milli("4") == 4000 and store.text(4003) == "4.003" and versioning.is_refresh(4004, 4000) and not versioning.is_refresh(4000, 4000)


def test_gates_and_guards(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "s"))
    with pytest.raises(ValueError, match="no enrichment"):
        s.located("T", "t", [4001])
    store.write_enrichment(s, spark.createDataFrame([(1, "x")], "k int, tag string"), "T", 4001, ["k"], "t1")
    with pytest.raises(ValueError, match="has tag t1"):
        s.located("T", "t2", [4001])
    with pytest.raises(ValueError, match="collide"):
        store.publish_dictionary(s, spark.createDataFrame([(1, 1, "a"), (1, 1, "b")], "e int, id int, v string"), "D", 4001, "e", "id", "v")
    with pytest.raises(ValueError, match="were expected"):
        enrich.within_expected(spark.createDataFrame([(10, 9, 90.0)], "n int, changed int, percent double"), 50.0)
    with pytest.raises(ValueError, match="above"):
        pipelines.check_preprocessed({"INPUT": {"RAW_TOTAL": 10, "RAW_DUPLICATE": 9, "FACT_ONLY_PATIENT": 0}, "OUTPUT": {"TOTAL": 1}}, 80)
    with pytest.raises(ValueError, match="repeated"):
        pipelines.derived_table(None, spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string"), ["k"], ["v"], 1)
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="repeated keys"):
        joins.guarded_left(one, one.union(one).withColumnRenamed("v", "w"), ["k"])


def test_settings():
    tables = config.read_tables('{"t": {"raw": ["a", {"b": {"c": "LONG"}}], "types": {"B__C": "LONG"}, "hashed": ["a"], "add_ons": ["x"]}}')
    assert tables["T"].raw_columns() == ["A", "B__C"] and [f.dataType for f in tables["T"].raw_schema()] == [T.StringType(), T.LongType()] and "X" in tables["T"].final_columns() and "GUID" in tables["T"].map_columns()
    with pytest.raises(TypeError):
        config.read_tables('{"t": {"odd": 1}}')
    assert not config.bootstrap('{"version": 1, "base": 1}').sample and config.bootstrap('{"version": 1, "base": 1}', '{"sample_rows": 5}').sample


def test_no_rows(spark):
    """Composite operators on empty tables give empty ones, and nulls in keys don't stop them."""
    none = lambda schema: spark.createDataFrame([], schema)
    assert derive.hospital_events(none("e int, admit_ts bigint, discharge_ts bigint, type string"), none("e int, at bigint, code string"), "e", {"a": "b"}).count() == 0
    assert derive.association_facets(none("entity_id int, prediction_type string, entity_1 string, entity_2 string, score double, sentence_hash string, published_ts bigint"), none("entity_id int, at_ts bigint")).count() == 0
    assert enrich.enriched(none("k int"), none("k int, x string"), ["k"], ["x"]).count() == 0
    assert {r.check for r in pipelines.map_faults(none("key_hash string, key_id int, entity_id int, fact_id int, guid bigint, superseded_by int"), none("entity_id int")).collect() if r.n == 0} >= {"empty_ids", "key_active"}
    assert derive.signal_ids(none("id bigint, k int"), spark.createDataFrame([(None,), (3,)], "k int"), ["k"], "id").count() == 1
    nearest = joins.nearest(spark.createDataFrame([(None, 1), (1, None), (1, 5)], "e int, t bigint"), none("e int, rt bigint, x int"), "e", "t", "rt", ["x"])
    assert [tuple(r)[2:] for r in nearest.collect()] == [(None, None)] * 3
