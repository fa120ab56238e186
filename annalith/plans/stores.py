"""Sources, sinks and stores as round trips: what is written to the shared folder and read back equals the table."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import functions as F, types as T

from ..operators import pipelines, versioning
from ..operators.keys import bucket_id
from ..session import checkpoint_dir, forget_at_end, table
from ..sources import config, readers, sinks
from ..sources.store import DIM, DROP, FACT, MAP, SYN, Store, aliased, front, keys_to_rows, provider, publish_dictionary, read_provider, release, transformed, write_enrichment
from .registry import Plans

P = Plans()
QUERIES, SQL = P.queries, P.sql
PART = "SELECT p_partkey, p_name, p_brand, p_size FROM part"


def folder(s, name: str) -> str:
    path = f"{checkpoint_dir(s)}/annalith-{name}-{uuid.uuid4().hex}"
    forget_at_end(s, path)
    return path


def part(s, d):
    return table(s, d, "part").select("p_partkey", "p_name", "p_brand", "p_size")


@P.add(PART)
def src_delimited(s, d):
    path, df = folder(s, "csv"), part(s, d)
    sinks.write_delimited(df, path)
    return readers.read_delimited(s, path, df.schema)


@P.add("SELECT p_partkey, replace(p_name, ' ', '|') AS p_name, p_brand, p_size FROM part")
def src_multichar_separator(s, d):
    path, df = folder(s, "csv"), part(s, d).withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit("|")))
    sinks.write_delimited(df, path, sep="$$$")
    return readers.read_delimited(s, path, df.schema, sep="$$$")


@P.add("SELECT p_partkey, p_name || 'é' AS p_name FROM part")
def src_legacy_encoding(s, d):
    path, df = folder(s, "csv"), part(s, d).select("p_partkey", F.concat("p_name", F.lit("é")).alias("p_name"))
    df.write.csv(path, sep="|", encoding="ISO-8859-1")
    return readers.read_delimited(s, path, df.schema, encoding="ISO-8859-1")


@P.add("SELECT p_partkey::varchar AS P_PARTKEY, p_name AS P_NAME, p_size::double AS P_SIZE FROM part")
def src_header_overlay(s, d):
    """A file with a header in its own order: an override makes the key text, a declared type the size a double, names come in upper case."""
    path, df = folder(s, "csv"), part(s, d).select("p_size", "p_partkey", "p_name")
    sinks.write_delimited(df, path, header=True)
    schema = readers.overlay_schema(df.columns, {"p_size": "DOUBLE", "p_partkey": "LONG"}, {"P_PARTKEY": "STRING"})
    return front(readers.upper_all(readers.read_delimited(s, path, schema, header=True)), ["P_PARTKEY", "P_NAME", "MISSING"])


@P.add("SELECT p_partkey, p_name, ((p_partkey % 8) * 10000 + 1)::int AS file_id FROM part")
def src_bucket_files(s, d):
    """Headerless files, one per bucket, with a side-car of names and types; the bucket comes back from the file's name."""
    path = folder(s, "buckets")
    df = part(s, d).select("p_partkey", "p_name").withColumn("bucket", bucket_id(F.col("p_partkey"), 8))
    files = sinks.bucket_files(df, path, "bucket")
    Store(s, path).write_text(f"{path}/header.csv", sinks.header_text(df.drop("bucket")))
    names, types = readers.parse_header(Store(s, path).read_text(f"{path}/header.csv"))
    return readers.read_delimited(s, files, readers.schema_of(names, types)).withColumn("file_id", readers.file_number(F.input_file_name()))


@P.add("SELECT event_id, event_type, (props::json ->> 'k')::bigint AS k FROM events")
def src_json_lines(s, d):
    path = folder(s, "json")
    table(s, d, "events").select("event_id", "event_type", F.from_json("props", "k bigint").alias("data")).write.json(path)
    schema = readers.nested_schema({"event_id": "STRING", "event_type": "STRING", "data": {"k": "LONG"}})
    return readers.read_json(s, path, schema, strict=True, casts={"event_id": "bigint"}).select("event_id", "event_type", F.col("data.k").alias("k"))


@P.add(PART + " WHERE p_size > 10")
def src_guarded_parquet(s, d):
    path = folder(s, "parquet")
    written = sinks.write_counted(part(s, d).filter("p_size > 10"), path)
    back = readers.read_parquet(s, path)
    if readers.read_parquet(s, path + "-none") is not None or back.count() != written:
        raise ValueError("a folder that isn't there was read, or rows were lost")
    return readers.safe_select(back, ["p_partkey", "missing", "p_name", "p_brand", "p_size"], ["p_partkey"])


@P.add("SELECT c_custkey, c_name, 1 AS incr_counter FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, NULL, 2 FROM customer WHERE c_custkey % 2 = 1")
def src_dim_batches(s, d):
    """A dimension in two batches, of which the second lacks a column, by a manifest and the reader of its provider."""
    path, c = folder(s, "dims"), table(s, d, "customer")
    sinks.write_delimited(c.filter("c_custkey % 2 = 0").select("c_custkey", "c_name"), f"{path}/DIM/a_1.txt", header=True)
    sinks.write_delimited(c.filter("c_custkey % 2 = 1").select("c_custkey"), f"{path}/DIM/a_2.txt", header=True)

    @provider("twofold")
    def read(spark, lines, pattern):
        types = {"c_custkey": T.LongType(), "c_name": T.StringType()}
        one = lambda f: readers.read_delimited(spark, f, T.StructType([T.StructField(n, types[n]) for n in readers.names_in(spark, f)]), header=True)
        return readers.union_batches([(n, one(files[0])) for n, files in readers.manifest(lines, pattern)])

    return read_provider("TwoFold", s, [f"{path}/DIM/a_{n}.txt|{n}" for n in (1, 2)], "a_*.txt")


@P.add("SELECT p_brand AS test_id, p_size AS gene, p_type AS status FROM part GROUP BY ALL")
def panel_consolidation(s, d):
    """One folder of results per panel; the folder's name is the panel."""
    from ..operators.derive import panels

    path = folder(s, "panels")
    table(s, d, "part").select("p_brand", F.col("p_size").alias("gene"), F.col("p_type").alias("status")).withColumn("folder", F.col("p_brand")).write.partitionBy("folder").csv(path, header=True)
    tests = {unquote(name.split("=")[1]): readers.read_delimited(s, f"{path}/{name}", T.StructType([T.StructField("x", T.StringType()), T.StructField("gene", T.IntegerType()), T.StructField("status", T.StringType())]), sep=",", header=True).drop("x") for name in readers.listing(s, path) if "=" in name}
    return panels(tests, ["gene", "status"])


@P.add("SELECT 1 + o_orderkey % 3 AS valid_from, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 2 + o_orderkey % 3 END AS superseded_by, count(*) AS n, sum(o_custkey)::bigint AS checksum FROM orders GROUP BY ALL")
def snk_version_partitions(s, d):
    """A published table lies in one folder per version and end; publishing it again skips it, and a change of one end rewrites its partition only."""
    k, store = F.col("o_orderkey"), Store(s, folder(s, "store"))
    df = table(s, d, "orders").select("o_orderkey", "o_custkey", (1 + k % 3).alias("valid_from"), F.when(k % 4 == 0, 0).otherwise(2 + k % 3).cast("bigint").alias("superseded_by"))
    n = store.publish(df, FACT, "T", 4001)
    if store.publish(df.limit(0), FACT, "T", 4001, skip_if_exists=True) != n or store.newest(FACT, "T") != {"version": "4.001", "rows": n}:
        raise ValueError("a table was published twice")
    path = store.path(4001, FACT, "T")
    store.publish_changes(path, df.filter("superseded_by = 0 and valid_from = 1").repartition(1), FACT, "T")
    back = s.read.parquet(path)
    return back.groupBy(F.col("valid_from").cast("bigint"), F.col("superseded_by").cast("bigint")).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("checksum"))


@P.add("SELECT bucket, count(*) AS n, max(row_id)::bigint AS max_row_id, count(*) = max(row_id) AS equal FROM (SELECT ((o_custkey % 16) * 10000 + 1)::int AS bucket, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_orderkey) AS row_id FROM orders) GROUP BY 1")
def snk_blocks(s, d):
    """The block layout written and read back: in every bucket the greatest row id is the number of rows."""
    path = folder(s, "blocks")
    df = table(s, d, "orders").select("o_orderkey", bucket_id(F.col("o_custkey"), 16).alias("bucket"))
    sinks.write_counted(sinks.blocks(df, "bucket", [F.col("o_orderkey")]), path, ["bucket"])
    from ..operators.quality import row_ids_complete

    return row_ids_complete(s.read.parquet(path), "bucket", "row_id")


@P.add("SELECT n_nationkey, n_name FROM nation")
def snk_single_file(s, d):
    path = folder(s, "single")
    sinks.write_delimited(table(s, d, "nation").select("n_nationkey", "n_name"), path, sep=",", single=True, header=True)
    if len([f for f in readers.listing(s, path) if f.startswith("part-")]) != 1:
        raise ValueError("there is more than one file")
    return s.read.csv(path, header=True, schema="n_nationkey int, n_name string")


@P.add("SELECT n_name AS line FROM nation")
def snk_text_lines(s, d):
    """A bounded list of rows (one per nation) collected to a text file, and a statistic to a JSON file."""
    store = Store(s, folder(s, "text"))
    names = [r[0] for r in table(s, d, "nation").select("n_name").collect()]
    store.write_text(f"{store.root}/names.txt", "\n".join(names) + "\n")
    store.write_stats({"n": len(names)}, SYN, "names", 4001)
    if store.stats(SYN, "names", 4001) != {"n": len(names)}:
        raise ValueError("the statistic changed")
    return s.read.text(f"{store.root}/names.txt").withColumnRenamed("value", "line")


V1, V2 = "o_orderkey % 10 <> 3", "o_custkey % 17 <> 0"
AGG = "SELECT o_custkey, max(o_orderpriority) AS top, count(*) AS n FROM orders WHERE {} AND o_custkey <> 0 GROUP BY 1"


def _agg(s, d, where):
    return table(s, d, "orders").filter(where).groupBy("o_custkey").agg(F.max("o_orderpriority").alias("top"), F.count("*").alias("n"))


def _published(s, d):
    """Two versions of a derived table, published one after the other."""
    store = Store(s, folder(s, "store"), base=4001)
    for v, where in ((4001, V1), (4003, V2)):
        old = store.last(SYN, "T", v)
        before = None if old is None else store.table(SYN, "T", old)
        df = pipelines.derived_table(before, _agg(s, d, where), ["o_custkey"], ["top", "n"], v, "o_custkey", 16)
        store.publish(df, SYN, "T", v)
    return store


MERGED = f"""WITH o AS ({AGG.format(V1)}), n AS ({AGG.format(V2)}), m AS (SELECT o.o_custkey, o.top, o.n, 4001::bigint AS valid_from, (CASE WHEN n.o_custkey IS NULL OR o.top <> n.top OR o.n <> n.n THEN 4003 ELSE 0 END)::bigint AS superseded_by FROM o LEFT JOIN n USING (o_custkey)
 UNION ALL SELECT n.o_custkey, n.top, n.n, 4003, 0 FROM n LEFT JOIN o USING (o_custkey) WHERE o.o_custkey IS NULL OR o.top <> n.top OR o.n <> n.n)
"""


@P.add(MERGED + "SELECT o_custkey, top, n, valid_from, superseded_by, ((o_custkey % 16) * 10000 + 1)::int AS bucket_id, row_number() OVER (PARTITION BY o_custkey % 16 ORDER BY o_custkey, valid_from) AS row_id FROM m")
def syn_publish(s, d):
    return _published(s, d).table(SYN, "T", 4003)


@P.add(MERGED + """SELECT count(*) AS n, count(*) FILTER (superseded_by = 0) AS active, count(*) FILTER (valid_from = 4003) AS inserted, count(*) FILTER (superseded_by = 4003) AS updated, count(DISTINCT o_custkey) FILTER (superseded_by = 0) AS entities_active,
 (SELECT count(*) FROM (SELECT o_custkey FROM m GROUP BY 1 HAVING max((superseded_by = 0)::int) = 0 AND max((valid_from < 4003)::int) = 1)) AS entities_dropped, count(*) FILTER (n > 20) AS busy FROM m""")
def syn_publish_stats(s, d):
    return pipelines.derived_stats(_published(s, d).table(SYN, "T", 4003), 4003, "o_custkey", {"busy": F.col("n") > 20})


@P.add(f"SELECT o_custkey, top, ((o_custkey % 16) * 10000 + 1)::int AS bucket_id, 0::bigint AS superseded_by FROM ({AGG.format(V1)}) WHERE top IN ('1-URGENT', '2-HIGH')")
def versioned_read(s, d):
    """An older version of the newest published table: its rows as they stood, filtered, with their bucket."""
    return _published(s, d).read(SYN, "T", 4002, ["o_custkey", "top", "bucket_id", "superseded_by"], {"top": ["1-URGENT", "2-HIGH"]}, buckets=("o_custkey", 8))


@P.add(MERGED + "SELECT o_custkey, n, valid_from, superseded_by FROM m")
def versioned_read_all(s, d):
    return _published(s, d).read(SYN, "T", None, ["o_custkey", "n", "valid_from", "superseded_by"], latest_only=False)


def _dropped(s, d):
    """A table published at 4.001, and drops of 4.002 and 4.003 with the map of the newest."""
    store, o = Store(s, folder(s, "store")), table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    store.publish(versioning.stamped(o.filter("o_orderkey % 10 <> 3"), 4001), FACT, "T", 4001)
    drops = {4002: o.filter("o_orderkey % 5 = 3"), 4003: o.filter("o_orderkey % 15 = 3")}
    for v, df in drops.items():
        store.publish(df, DROP, "T", v)
    again = drops[4003].select("o_orderkey", F.lit(True).alias("again"))
    rows = drops[4002].join(again, "o_orderkey", "left").select("o_orderkey", F.lit(4002).cast("bigint").alias("valid_from"), F.when(F.col("again"), 4003).otherwise(0).cast("bigint").alias("superseded_by"))
    store.publish(rows.unionByName(versioning.stamped(drops[4003].select("o_orderkey"), 4003)), MAP, "T", 4003)
    return store


@P.add("""SELECT o_orderkey, o_orderstatus, 4001::bigint AS valid_from, (CASE WHEN o_orderkey % 5 = 3 THEN 4002 ELSE 0 END)::bigint AS superseded_by FROM orders WHERE o_orderkey % 10 <> 3
 UNION ALL SELECT o_orderkey, o_orderstatus, 4002, CASE WHEN o_orderkey % 15 = 3 THEN 4003 ELSE 0 END FROM orders WHERE o_orderkey % 5 = 3 UNION ALL SELECT o_orderkey, o_orderstatus, 4003, 0 FROM orders WHERE o_orderkey % 15 = 3""")
def replayed_store_read(s, d):
    return _dropped(s, d).read_replayed("T", "o_orderkey", 4003, latest_only=False)


@P.add("SELECT o_orderkey, 'raw' AS place FROM orders WHERE o_orderkey % 5 = 3 UNION ALL SELECT o_orderkey, 'published' FROM orders WHERE o_orderkey % 10 <> 3 UNION ALL SELECT o_orderkey, 'delta' FROM orders WHERE o_orderkey % 10 <> 3 UNION ALL SELECT o_orderkey, 'delta' FROM orders WHERE o_orderkey % 5 = 3")
def source_choosers(s, d):
    """The raw drop where it has the columns, the published table where not; and what a delta run reads."""
    store = _dropped(s, d)
    chosen = lambda df, place: df.select("o_orderkey", F.lit(place).alias("place"))
    return chosen(store.choose("T", 4002, ["o_orderkey"]), "raw").unionByName(chosen(store.choose("T", 4002, ["o_orderkey", "valid_from"]), "published")).unionByName(chosen(store.by_mode("T", "delta", 4002), "delta"))


@P.add("SELECT row_number() OVER (ORDER BY p_brand, p_type) AS concept_id, p_brand, p_type FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 20) UNION ALL SELECT (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_size <= 20)) + row_number() OVER (ORDER BY p_brand, p_type), p_brand, p_type FROM (SELECT p_brand, p_type FROM part WHERE p_size > 20 EXCEPT SELECT p_brand, p_type FROM part WHERE p_size <= 20)")
def concept_dim_append(s, d):
    """A concept dimension of two runs: the first finds no table and starts from none, the second appends to what the store has."""
    from ..operators.enrich import refreshed_concepts

    store, p = Store(s, folder(s, "store")), table(s, d, "part")
    schema = "concept_id bigint, p_brand string, p_type string"
    for v, where in ((4001, "p_size <= 20"), (4002, "p_size > 20")):
        known = store.read_or_empty(DIM, "concepts", schema, v, latest_only=False)
        store.publish(refreshed_concepts(known, p.filter(where), ["p_brand", "p_type"], "concept_id"), DIM, "concepts", v)
    return store.table(DIM, "concepts", 4002)


@P.add("SELECT * FROM (VALUES ('4.001', 'SUCCESS', 2::bigint), ('4.002', 'CREATED', 1)) t(version, status, files)")
def version_lifecycle(s, d):
    """Two versions made of three files, of which the first is released; a third finds nothing new."""
    store = Store(s, folder(s, "store"), base=4001)
    first = store.create_run(["/in/a.txt", "/in/b.txt"], [("/in/a.txt", 1), ("/in/b.txt", 2)])
    store.publish(table(s, d, "region"), FACT, "T", first)
    store.release(first)
    store.create_run(["/in/a.txt", "/in/c.txt"], [("/in/c.txt", 3)])
    if store.create_run(["/in/c.txt"], []) != 0 or store.manifest(first) != ["/in/a.txt|1", "/in/b.txt|2"]:
        raise ValueError("a file was taken twice")
    return s.createDataFrame([(v, r["STATUS"], r["FILES"]) for v, r in store.runs().items()], "version string, status string, files bigint")


@P.add("SELECT n_nationkey AS code, n_name AS name, 'NATION' AS source, '{\"n_name\":\"' || n_name || '\",\"n_regionkey\":\"' || n_regionkey || '\"}' AS meta, NULL::varchar AS vocabulary, n_name AS old_name FROM nation")
def configured_transforms(s, d):
    out = transformed(table(s, d, "nation"), ["code", "name", "source", "meta", "vocabulary"], {"code": "n_nationkey", "name": "n_name"}, {"source": "NATION"}, {"meta": ["n_name", "n_regionkey"]})
    return aliased(out.withColumn("meta", F.to_json("meta")), {"old_name": "name", "code": "name"})


@P.add("SELECT * FROM (VALUES ('12', '100'), ('13', '250')) t(entity, event_ts)")
def json_keys_to_rows(s, d):
    return keys_to_rows(s, {"12_100": {"is_valid": True}, "12_200": {"is_valid": False}, "13_250": {"is_valid": True}}, ["entity", "event_ts"])


CONFIG = """{"part": {"raw": ["p_partkey", {"detail": {"p_name": "STRING", "p_size": "INTEGER"}}], "types": {"p_partkey": "LONG", "detail__p_size": "INTEGER"}, "unique": ["p_partkey"], "add_ons": ["tag"], "hashed": ["detail__p_name"], "big": true},
 "nation": {"raw": ["n_nationkey"], "types": {"n_nationkey": "INTEGER"}}}"""


@P.add("SELECT p_partkey AS P_PARTKEY, p_name AS DETAIL__P_NAME, p_size AS DETAIL__P_SIZE FROM part WHERE p_partkey IN (1, 5, 77)")
def configured_read(s, d):
    """A file read by its table's declaration, in a sample run of three entities."""
    store, df = Store(s, folder(s, "config")), part(s, d).select("p_partkey", "p_name", "p_size")
    store.write_text(f"{store.root}/tables.json", CONFIG)
    tables = config.read_tables(store.read_text(f"{store.root}/tables.json"))
    run = config.bootstrap('{"version": 4001, "base": 4001, "buckets": 8}', '{"sample_entities": [1, 5, 77]}')
    sinks.write_delimited(df, f"{store.root}/part")
    declared = tables["PART"]
    if not run.sample or config.hash_fields(tables) != {"PART": {"source_id": 0, "field_ids": {"detail__p_name": 0}}} or declared.final_columns()[-3:] != ["TAG", *config.VERSIONED]:
        raise ValueError("the declaration was misread")
    return config.typed(run.restricted(readers.read_delimited(s, f"{store.root}/part", declared.raw_schema()), "P_PARTKEY"), {"DETAIL__P_SIZE": "INTEGER"})


@P.add("SELECT p_brand, min((p_type, p_size))[1] AS p_type, min((p_type, p_size))[2] AS p_size FROM part GROUP BY 1")
def dim_preprocess(s, d):
    path = folder(s, "dim")
    sinks.write_counted(config.dim_rows(table(s, d, "part"), ["p_brand", "p_type", "p_size"], ["p_brand"]).coalesce(1), path)
    return s.read.parquet(path)


@P.add("""SELECT o_orderkey AS row_key, o_orderstatus AS status, o_orderstatus AS legacy, 4001::bigint AS valid_from, (CASE WHEN o_orderkey % 5 = 3 THEN 4002 ELSE 0 END)::bigint AS superseded_by FROM orders WHERE o_orderkey % 10 <> 3
 UNION ALL SELECT o_orderkey, o_orderstatus, o_orderstatus, 4002, 0 FROM orders WHERE o_orderkey % 5 = 3""")
def release_table(s, d):
    """A fact table published anew at the version of its last drop, with a renamed column and its legacy alias."""
    store, o = Store(s, folder(s, "store")), table(s, d, "orders").select(F.col("o_orderkey").alias("row_key"), "o_orderstatus")
    store.publish(versioning.stamped(o.filter("row_key % 10 <> 3"), 4001), FACT, "T", 4001)
    drop = o.filter("row_key % 5 = 3")
    store.publish(drop, DROP, "T", 4002)
    store.publish(versioning.stamped(drop.select("row_key"), 4002), MAP, "T", 4002)
    release(store, FACT, "T", 4002, ["row_key", "status", "legacy"], {"legacy": "status"}, {"o_orderstatus": "status"})
    return store.table(FACT, "T", 4002)


@P.add("SELECT c_custkey, upper(c_mktsegment) AS tag, 'meta' AS kind FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, NULL, 'map' FROM customer WHERE c_custkey % 2 = 0")
def enrichment_write(s, d):
    """An enrichment written with its tag, found again under it, and the map of rows it changed."""
    store, c = Store(s, folder(s, "store")), table(s, d, "customer").filter("c_custkey % 2 = 0")
    df = c.select("c_custkey", F.upper("c_mktsegment").alias("tag"), F.lit(1).alias("row_id"), F.col("c_custkey").alias("guid"), "c_name")
    write_enrichment(store, df, "T", 4002, ["c_custkey", "tag"], "t1", ("c_custkey", "row_id", "guid"))
    return store.located("T", "t1", [4003, 4002]).withColumn("kind", F.lit("meta")).unionByName(store.table(MAP, "T", 4002).select("c_custkey", F.lit(None).cast("string").alias("tag"), F.lit("map").alias("kind")))


@P.add("SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS id, event_type FROM (SELECT DISTINCT user_id, event_type FROM events)")
def dictionary_publish(s, d):
    from ..operators.ids import extend_per_entity

    store = Store(s, folder(s, "store"))
    made = extend_per_entity(s.createDataFrame([], "user_id bigint, id bigint, event_type string"), table(s, d, "events"), "user_id", "event_type", "id")
    store.write_text(f"{store.root}/interim/x.txt", "x")
    publish_dictionary(store, made, "T", 4001, "user_id", "id", "event_type", [f"{store.root}/interim"])
    if store.exists(f"{store.root}/interim"):
        raise ValueError("the interim folder is still there")
    return store.table(MAP, "T", 4001)
