"""Keys, ids, text and time normalisation, lookups and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from ..operators import joins, keys, normalize
from ..sources import readers
from ..session import checkpoint_dir, table
from .registry import Plans

P = Plans()
QUERIES, SQL = P.queries, P.sql
BUCKETS = 48


@P.add(f"SELECT o_orderkey, (((o_custkey % {BUCKETS}) * 10000) + 1)::int AS bucket_id FROM orders")
def bucket_ids(s, d):
    return keys.with_bucket(table(s, d, "orders"), "o_custkey", BUCKETS).select("o_orderkey", "bucket_id")


@P.add(f"SELECT o_orderkey, ((o_custkey % {BUCKETS}) * 10000 + 1 + ((o_custkey // {BUCKETS}) % 5) * 2000)::int AS bucket_id FROM orders")
def bucket_ids_big(s, d):
    return keys.with_bucket(table(s, d, "orders"), "o_custkey", BUCKETS, split=True).select("o_orderkey", "bucket_id")


@P.add("SELECT p_partkey, sha256(concat_ws('|', coalesce(p_brand, ''), coalesce(p_partkey, 0)::varchar, coalesce(p_size, 0)::varchar, coalesce(p_type, ''))) AS key_hash FROM part")
def key_hash_sha256(s, d):
    part = table(s, d, "part")
    return part.select("p_partkey", keys.key_hash(part, ["p_type", "p_size", "p_brand", "p_partkey"]).alias("key_hash"))


@P.add("SELECT p_partkey, sha256(concat_ws('|', CASE WHEN p_size % 3 = 0 THEN 0 ELSE p_size END::varchar, CASE WHEN p_size % 4 = 0 THEN '' ELSE p_brand END, p_type)) AS key_hash FROM part")
def key_hash_prefixed_names(s, d):
    """One key column's name begins another's, and both have nulls: code_dk goes before code, and their nulls are 0 and ''."""
    rows = table(s, d, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_brand")).alias("code"), F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("code_dk"), F.col("p_type").alias("kind"))
    return rows.select("p_partkey", keys.key_hash(rows, ["kind", "code", "code_dk"]).alias("key_hash"))


@P.add("SELECT n_nationkey, md5(concat_ws('|', n_nationkey::varchar, coalesce(nullif(n_name, 'FRANCE'), chr(1)), coalesce(CASE WHEN n_regionkey <> 2 THEN n_regionkey END::varchar, chr(1)))) AS row_hash FROM nation")
def row_hash_md5(s, d):
    n = table(s, d, "nation").select("n_nationkey", F.nullif("n_name", F.lit("FRANCE")).alias("n_name"), F.when(F.col("n_regionkey") != 2, F.col("n_regionkey")).alias("n_regionkey"))
    return n.select("n_nationkey", keys.row_md5(["n_nationkey", "n_name", "n_regionkey"]).alias("row_hash"))


@P.add("SELECT l_orderkey, l_linenumber, ((7::bigint << 56) | (l_partkey << 28) | l_suppkey) AS guid FROM lineitem")
def guid_pack(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", keys.pack_guid(F.lit(7), F.col("l_partkey"), F.col("l_suppkey")).alias("guid"))


@P.add("SELECT l_orderkey, l_linenumber, 7::bigint AS table_id, l_partkey AS key_id, l_suppkey AS fact_key_id FROM lineitem")
def guid_unpack(s, d):
    parts = keys.unpack_guid(F.col("guid"))
    return guid_pack(s, d).select("l_orderkey", "l_linenumber", *(c.alias(n) for c, n in zip(parts, ("table_id", "key_id", "fact_key_id"))))


@P.add("SELECT l_orderkey, l_linenumber, ((l_partkey << 32) | l_suppkey) AS pair FROM lineitem")
def pair_pack(s, d):
    return table(s, d, "lineitem").select("l_orderkey", "l_linenumber", keys.pack_pair(F.col("l_partkey"), F.col("l_suppkey")).alias("pair"))


@P.add()
def surrogate_hash(s, d):
    return table(s, d, "part").select("p_partkey", keys.surrogate_id(table(s, d, "part"), ["p_brand", "p_type"]).alias("concept_id"), keys.surrogate_id(table(s, d, "part"), ["p_name"], absolute=True).alias("name_id"))


@P.add("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN epoch_us(date_trunc('second', ts)) // 1000000 WHEN 1 THEN epoch_us(date_trunc('second', ts)) // 1000000
 WHEN 2 THEN epoch_us(date_trunc('second', ts)) // 1000000 + (5 * 60 + 30) * 60 WHEN 3 THEN epoch_us(date_trunc('day', ts)::timestamp) // 1000000 END AS event_ts FROM events""")
def ts_ladder(s, d):
    t, k = F.col("ts"), F.col("event_id") % 6
    iso = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(k == 1, iso).when(k == 2, F.concat(iso, F.lit("-05:30"))).when(k == 3, F.date_format(t, "yyyy-MM-dd")).when(k == 4, F.date_format(t, "MM/dd/yyyy HH:mm")).otherwise("unknown")
    return table(s, d, "events").select("event_id", normalize.parse_ladder(text).alias("event_ts"))


@P.add("SELECT event_id, user_id * 60 + 1000000 AS event_ts FROM events")
def relative_ts(s, d):
    return table(s, d, "events").select("event_id", normalize.parse_ladder((F.col("user_id") * 60).cast("string"), relative_to=F.lit(1_000_000)).alias("event_ts"))


@P.add(f"""SELECT event_id, CASE event_id % 6 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(ts) // 1000000 WHEN 2 THEN epoch_us(ts) // 1000000 + 500 WHEN 3 THEN epoch_us(date_trunc('day', ts)::timestamp) // 1000000
 WHEN 4 THEN user_id + 500 ELSE {normalize.BAD_DATE} END AS event_ts FROM events""")
def dtm_length_dispatch(s, d):
    """Among the texts are ten-digit epochs, which are as long as a date."""
    k, t = F.col("event_id") % 6, F.col("ts")
    text = F.when(k == 0, F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS")).when(k == 1, F.date_format(t, "yyyy-MM-dd HH:mm:ss")).when(k == 2, normalize.seconds(t).cast("string")).when(k == 3, F.date_format(t, "yyyy-MM-dd")).when(k == 4, F.col("user_id").cast("string")).otherwise("-")
    return table(s, d, "events").select("event_id", normalize.parse_by_length(text, offset=F.lit(500)).alias("event_ts"))


@P.add("SELECT o_orderkey, trunc((epoch_us(o_orderdate) // 1000000 - o_custkey * 86400) / 31536000)::bigint AS age FROM orders")
def age_years(s, d):
    return table(s, d, "orders").select("o_orderkey", normalize.age_years(normalize.seconds(F.col("o_orderdate")), F.col("o_custkey") * 86_400).alias("age"))


@P.add("""SELECT o_orderkey, ((o_orderdate::date) - to_months((CASE WHEN o_orderkey % 9 = 0 THEN 90 ELSE o_orderkey % 89 END * 12)::int))::date AS birth FROM orders""")
def dob_from_age(s, d):
    age = F.when(F.col("o_orderkey") % 9 == 0, "89+").otherwise((F.col("o_orderkey") % 89).cast("string"))
    return table(s, d, "orders").select("o_orderkey", normalize.birth_from_age(F.col("o_orderdate").cast("date"), age).alias("birth"))


@P.add("""SELECT o_orderkey, CASE WHEN lower(o_orderpriority) LIKE '1-%' THEN 'INPATIENT' WHEN contains(lower(o_orderpriority), 'high') THEN 'EMERGENCY' WHEN lower(o_orderpriority) = '5-low' THEN 'OUTPATIENT' ELSE 'OTHER' END AS visit FROM orders""")
def category_ladder(s, d):
    return table(s, d, "orders").select("o_orderkey", normalize.ladder(F.col("o_orderpriority"), [("starts", "1-", "INPATIENT"), ("has", "high", "EMERGENCY"), ("is", "5-low", "OUTPATIENT")], "OTHER").alias("visit"))


@P.add("""SELECT n_nationkey, CASE WHEN lower(n_name) LIKE 'united%' THEN 'NORTH' WHEN contains(lower(n_name), 'an') THEN 'EAST' ELSE 'UNKNOWN' END AS site FROM nation""")
def site_ladder(s, d):
    return table(s, d, "nation").select("n_nationkey", normalize.ladder(F.col("n_name"), [("starts", "united", "NORTH"), ("has", "an", "EAST")], "UNKNOWN").alias("site"))


@P.add("SELECT p_partkey, array_to_string(list_sort(string_split(replace(p_name, '|', '-'), ' ')), '^') AS tokens FROM part")
def token_sort(s, d):
    return table(s, d, "part").select("p_partkey", normalize.sorted_tokens(F.col("p_name"), " ", "^").alias("tokens"))


@P.add("SELECT o_orderkey, coalesce(c_custkey, 0)::bigint AS entity_id, coalesce(c_name, '') AS c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) ON o_custkey = c_custkey")
def lookup_left_default(s, d):
    people = table(s, d, "customer").filter("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("entity_id"), "c_name", F.col("c_custkey").alias("o_custkey"))
    return joins.lookup_left(table(s, d, "orders").select("o_orderkey", "o_custkey"), people, "o_custkey", {"entity_id": 0, "c_name": ""}).select("o_orderkey", "entity_id", "c_name")


@P.add("""SELECT p_partkey, g.n AS n FROM part LEFT JOIN (SELECT p_brand, p_size, count(*) AS n FROM part WHERE p_size > 10 GROUP BY ALL) g USING (p_brand, p_size)""")
def lookup_multi_key(s, d):
    part = table(s, d, "part")
    sizes = part.filter("p_size > 10").groupBy("p_brand", "p_size").agg(F.count("*").alias("n"))
    return joins.lookup_left(part.select("p_partkey", "p_brand", "p_size"), joins.no_fanout(sizes, ["p_brand", "p_size"]), ["p_brand", "p_size"]).select("p_partkey", "n")


@P.add("""WITH a AS (SELECT p_partkey, nullif(p_brand, 'Brand#11') AS b, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS z FROM part), g AS (SELECT b, z, count(*) AS n FROM a GROUP BY ALL)
SELECT p_partkey, n FROM a LEFT JOIN g ON a.b IS NOT DISTINCT FROM g.b AND a.z IS NOT DISTINCT FROM g.z""")
def null_safe_join(s, d):
    a = table(s, d, "part").select("p_partkey", F.when(F.col("p_brand") == "Brand#11", "").otherwise(F.col("p_brand")).alias("b"), F.when(F.col("p_size") % 3 != 0, F.col("p_size")).alias("z"))
    g = a.withColumn("b", F.nullif("b", F.lit(""))).groupBy("b", "z").agg(F.count("*").alias("n"))
    return joins.null_safe_join(a, g, ["b", "z"]).select("p_partkey", "n")


@P.add("SELECT event_id, k.label FROM events JOIN (VALUES (4, 'four'), (5, 'five'), (6, 'six'), (8, 'eight')) k(len, label) ON length(event_type) = k.len")
def computed_key_join(s, d):
    sizes = s.createDataFrame([(4, "four"), (5, "five"), (6, "six"), (8, "eight")], "len int, label string")
    events = table(s, d, "events")
    return events.join(F.broadcast(sizes), F.length(events.event_type) == sizes.len).select("event_id", "label")


NEAR = """WITH c AS (SELECT event_id, user_id, epoch_us(ts) // 1000000 AS t FROM events WHERE event_type = 'click'), p AS (SELECT user_id, epoch_us(ts) // 1000000 AS t, min(event_id) AS other_id FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT event_id, other_id, abs(c.t - p.t) AS distance FROM c LEFT JOIN p USING (user_id) QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs(c.t - p.t), p.t) = 1"""


@P.add(NEAR)
def nearest_event(s, d):
    e = table(s, d, "events").withColumn("t", normalize.seconds(F.col("ts")))
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", "t")
    buys = e.filter("event_type = 'purchase'").select("user_id", F.col("t").alias("bt"), F.col("event_id").alias("other_id"))
    return joins.nearest(clicks, buys, "user_id", "t", "bt", ["other_id"]).select("event_id", "other_id", "distance")


STAYS = "(SELECT o_custkey AS entity, epoch_us(l_shipdate) // 1000000 AS start_ts, epoch_us(l_shipdate) // 1000000 + 7 * 86400 AS end_ts, l_linestatus AS kind FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
POINTS = "(SELECT o_custkey AS entity, o_orderkey, epoch_us(o_orderdate) // 1000000 AS at_ts FROM orders)"


def stays(s, d):
    owner = table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity"))
    t = normalize.seconds(F.col("l_shipdate"))
    return table(s, d, "lineitem").select("l_orderkey", t.alias("start_ts"), (t + 7 * 86_400).alias("end_ts"), F.col("l_linestatus").alias("kind")).join(owner, "l_orderkey").select("entity", "start_ts", "end_ts", "kind")


def points(s, d):
    return table(s, d, "orders").select(F.col("o_custkey").alias("entity"), "o_orderkey", normalize.seconds(F.col("o_orderdate")).alias("at_ts"))


@P.add(f"SELECT o_orderkey, start_ts, end_ts, kind FROM {POINTS} p JOIN {STAYS} s USING (entity) WHERE start_ts < at_ts AND at_ts < end_ts")
def interval_stays(s, d):
    return joins.within(points(s, d), stays(s, d), "entity", "at_ts", "start_ts", "end_ts").select("o_orderkey", "start_ts", "end_ts", "kind")


@P.add("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def left_anti_new_keys(s, d):
    orders = table(s, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return table(s, d, "customer").join(orders, "c_custkey", "left_anti").select("c_custkey")


@P.add("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)")
def semi_filter(s, d):
    orders = table(s, d, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(s, d, "customer").join(orders, "c_custkey", "left_semi").select("c_custkey", "c_name")


@P.add("SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def except_keys(s, d):
    return table(s, d, "customer").select("c_nationkey").subtract(table(s, d, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))


@P.add("SELECT event_id, (props::json ->> 'k')::bigint AS k FROM events")
def json_extract(s, d):
    return table(s, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@P.add("SELECT event_id, (props::json ->> 'k')::bigint AS k FROM events")
def json_repair(s, d):
    broken = F.regexp_replace(F.regexp_replace("props", '"k"', "'k'"), r"\}\s*$", ", }")
    return table(s, d, "events").select("event_id", readers.repaired_json(broken, T.StructType([T.StructField("k", T.LongType())]))["k"].alias("k"))


@P.add("SELECT year(o_orderdate)::bigint AS incr_counter, count(*) AS n, sum(o_custkey)::bigint AS checksum FROM orders GROUP BY 1")
def batch_union_incr(s, d):
    """The year of an order is the batch it came in: written as one folder a batch, read back by a manifest of the folders."""
    path = f"{checkpoint_dir(s)}/annalith-batches-{uuid.uuid4().hex}"
    table(s, d, "orders").withColumn("batch", F.year("o_orderdate")).write.partitionBy("batch").parquet(path)
    batches = readers.manifest_of(s, path, "batch")
    return readers.union_batches([(n, s.read.parquet(*files)) for n, files in batches]).groupBy(F.col("incr_counter").cast("bigint").alias("incr_counter")).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("checksum"))


@P.add("SELECT doc_id, (length(text) - length(replace(text, chr(10), '')) + 1)::bigint AS n_lines, (length(text) - length(replace(text, '|', '')) + 1)::bigint AS n_columns FROM documents")
def text_column_counts(s, d):
    count = lambda c: (F.length("text") - F.length(F.replace("text", F.lit(c), F.lit(""))) + 1).cast("bigint")
    return table(s, d, "documents").select("doc_id", count("\n").alias("n_lines"), count("|").alias("n_columns"))


@P.add("SELECT p_partkey, nullif(p_brand, '') AS p_brand, p_retailprice FROM part WHERE NOT isnan(p_retailprice)")
def null_rules(s, d):
    return table(s, d, "part").select("p_partkey", normalize.blank_to_null(F.col("p_brand")).alias("p_brand"), normalize.nan_to_null(F.col("p_retailprice")).alias("p_retailprice")).filter("p_retailprice is not null")
