"""Duplicates, dictionaries, versions and quality contracts.

Two versions of a table are made of one by key: version 1 lacks the newest tenth of the keys; version 2
lacks every 17th and changes every 10th.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedupe, derive, ids, quality, versioning
from ..operators.keys import bucket_id
from ..session import cut, table
from .registry import Plans

P = Plans()
QUERIES, SQL = P.queries, P.sql

PART1 = "(SELECT p_partkey, p_brand, p_size FROM part WHERE p_partkey % 10 <> 3)"
PART2 = "(SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN 'Brand#99' ELSE p_brand END AS p_brand, p_size FROM part WHERE p_partkey % 17 <> 0)"


def part1(s, d):
    return table(s, d, "part").filter("p_partkey % 10 <> 3").select("p_partkey", "p_brand", "p_size")


def part2(s, d):
    return table(s, d, "part").filter("p_partkey % 17 <> 0").select("p_partkey", F.when(F.col("p_partkey") % 10 == 0, "Brand#99").otherwise(F.col("p_brand")).alias("p_brand"), "p_size")


@P.add(f"""SELECT count(*) FILTER (a.h = b.h) AS unchanged, count(*) FILTER (a.h IS NULL) AS added, count(*) FILTER (a.h <> b.h) AS changed, count(*) FILTER (b.h IS NULL) AS missing FROM
 (SELECT p_partkey, md5(concat_ws('|', p_partkey::varchar, p_brand, p_size::varchar)) AS h FROM {PART1}) a FULL JOIN (SELECT p_partkey, md5(concat_ws('|', p_partkey::varchar, p_brand, p_size::varchar)) AS h FROM {PART2}) b USING (p_partkey)""")
def full_outer_change_counts(s, d):
    return versioning.dim_changes(part1(s, d), part2(s, d), ["p_partkey"], ["p_partkey", "p_brand", "p_size"])


DIM = f"""WITH o AS (SELECT * FROM {PART1}), n AS (SELECT * FROM {PART2}), j AS (SELECT p_partkey, o.p_brand AS ob, o.p_size AS oz, n.p_brand AS nb, n.p_size AS nz, o.p_partkey IS NOT NULL AS ino, n.p_partkey IS NOT NULL AS inn FROM o FULL JOIN n USING (p_partkey)),
m AS (SELECT p_partkey, ob AS p_brand, oz AS p_size, 1::bigint AS valid_from, (CASE WHEN inn AND ob <> nb THEN 2 ELSE 0 END)::bigint AS superseded_by FROM j WHERE ino
 UNION ALL SELECT p_partkey, nb, nz, 2::bigint, 0::bigint FROM j WHERE inn AND (NOT ino OR ob <> nb))
"""


def _dim(s, d):
    return versioning.merge_dim(versioning.stamped(part1(s, d), 1), part2(s, d), ["p_partkey"], ["p_partkey", "p_brand", "p_size"], 2)


@P.add(DIM + "SELECT * FROM m")
def dim_scd2(s, d):
    return _dim(s, d)


@P.add(DIM + "SELECT valid_from, superseded_by, count(*) AS n FROM m GROUP BY ALL")
def dim_scd2_stats(s, d):
    return _dim(s, d).groupBy("valid_from", "superseded_by").agg(F.count("*").alias("n"))


@P.add(DIM + "SELECT p_partkey, p_brand, p_size, valid_from, 0::bigint AS superseded_by FROM m WHERE valid_from <= 1")
def as_of_read(s, d):
    return versioning.as_of(_dim(s, d), 1, latest_only=True)


SHIFTED = "(SELECT p_partkey, CASE WHEN {0} THEN p_brand END AS x, CASE WHEN NOT ({0}) THEN p_brand END AS y FROM part)"


@P.add(f"SELECT count(*) FILTER ((a.x, a.y) IS NOT DISTINCT FROM (b.x, b.y)) AS unchanged, 0::bigint AS added, count(*) FILTER ((a.x, a.y) IS DISTINCT FROM (b.x, b.y)) AS changed, 0::bigint AS missing FROM {SHIFTED.format('p_partkey % 2 = 0')} a JOIN {SHIFTED.format('p_partkey % 4 = 0')} b USING (p_partkey)")
def dim_shifted_values(s, d):
    """The only change is a value that moves from one nullable column to the next."""
    v = lambda where: table(s, d, "part").select("p_partkey", F.when(F.expr(where), F.col("p_brand")).alias("x"), F.when(~F.expr(where), F.col("p_brand")).alias("y"))
    return versioning.dim_changes(v("p_partkey % 2 = 0"), v("p_partkey % 4 = 0"), ["p_partkey"], ["p_partkey", "x", "y"])


AGG = "SELECT o_custkey, max(o_orderpriority) AS top, count(*) AS n FROM orders WHERE {} GROUP BY 1"
SYN = f"""WITH o AS ({AGG.format("o_orderkey % 10 <> 3")}), n AS ({AGG.format("o_custkey % 17 <> 0")})"""


def _derived(s, d):
    agg = lambda where: table(s, d, "orders").filter(where).groupBy("o_custkey").agg(F.max("o_orderpriority").alias("top"), F.count("*").alias("n"))
    return versioning.merge_derived(versioning.stamped(agg("o_orderkey % 10 <> 3"), 1), agg("o_custkey % 17 <> 0"), ["o_custkey"], ["top", "n"], 2)


@P.add(SYN + """SELECT o.o_custkey, o.top, o.n, 1::bigint AS valid_from, (CASE WHEN n.o_custkey IS NULL OR o.top <> n.top OR o.n <> n.n THEN 2 ELSE 0 END)::bigint AS superseded_by FROM o LEFT JOIN n USING (o_custkey)
 UNION ALL SELECT n.o_custkey, n.top, n.n, 2::bigint, 0::bigint FROM n LEFT JOIN o USING (o_custkey) WHERE o.o_custkey IS NULL OR o.top <> n.top OR o.n <> n.n""")
def syn_scd2_diff(s, d):
    return _derived(s, d)


FACT = """WITH v1 AS (SELECT sha256(o_orderkey::varchar) AS key_hash, o_custkey % 100 AS entity_id, o_custkey AS key_id FROM orders WHERE o_orderkey % 10 <> 3),
m AS (SELECT key_hash, entity_id, key_id, row_number() OVER (PARTITION BY entity_id ORDER BY key_hash)::bigint AS fact_id, row_number() OVER (PARTITION BY key_id ORDER BY key_hash)::bigint AS fact_key_id FROM v1),
d AS (SELECT sha256(o_orderkey::varchar) AS key_hash, CASE WHEN o_custkey % 50 = 0 THEN 7 ELSE o_custkey % 100 END AS entity_id, o_custkey AS key_id FROM orders WHERE o_orderkey % 10 IN (3, 5)),
tf AS (SELECT entity_id, max(fact_id) AS tf FROM m GROUP BY 1), tk AS (SELECT key_id, max(fact_key_id) AS tk FROM m GROUP BY 1),
j AS (SELECT d.*, CASE WHEN m.entity_id = d.entity_id THEN m.fact_id END AS of, CASE WHEN m.key_id = d.key_id THEN m.fact_key_id END AS ok, coalesce(tf, 0) AS tf, coalesce(tk, 0) AS tk FROM d LEFT JOIN m USING (key_hash) LEFT JOIN tf ON tf.entity_id = d.entity_id LEFT JOIN tk ON tk.key_id = d.key_id),
n AS (SELECT key_hash, entity_id, key_id, coalesce(of, tf + row_number() OVER (PARTITION BY entity_id, of IS NULL ORDER BY key_hash))::bigint AS fact_id, coalesce(ok, tk + row_number() OVER (PARTITION BY key_id, ok IS NULL ORDER BY key_hash))::bigint AS fact_key_id FROM j),
r AS (SELECT key_hash, entity_id, key_id, fact_id, fact_key_id, 1::bigint AS valid_from, (CASE WHEN key_hash IN (SELECT key_hash FROM d) OR key_id % 97 = 0 THEN 2 ELSE 0 END)::bigint AS superseded_by FROM m UNION ALL SELECT *, 2::bigint, 0::bigint FROM n)
"""


def _facts(s, d):
    orders = table(s, d, "orders").withColumn("key_hash", F.sha2(F.col("o_orderkey").cast("string"), 256))
    entity = F.when(F.col("o_custkey") % 50 == 0, 7).otherwise(F.col("o_custkey") % 100)
    none = s.createDataFrame([], "key_hash string, entity_id bigint, key_id bigint, fact_id bigint, fact_key_id bigint, valid_from bigint, superseded_by bigint")
    nobody = s.createDataFrame([], "key_id bigint")
    first = orders.filter("o_orderkey % 10 <> 3").select("key_hash", (F.col("o_custkey") % 100).alias("entity_id"), F.col("o_custkey").alias("key_id"))
    known = cut(versioning.stamp_facts(first, none, nobody, 1, 5).drop("guid"))  # the stored map of version 1
    delta = orders.filter("o_orderkey % 10 in (3, 5)").select("key_hash", entity.alias("entity_id"), F.col("o_custkey").alias("key_id"))
    return versioning.stamp_facts(delta, known, known.filter("key_id % 97 = 0").select("key_id"), 2, 5)


@P.add(FACT + "SELECT *, ((5::bigint << 56) | (key_id << 28) | fact_key_id) AS guid FROM r")
def fact_stamp(s, d):
    return _facts(s, d)


@P.add(FACT + "SELECT valid_from, superseded_by, count(*) AS n, count(DISTINCT entity_id) AS n_entities FROM r GROUP BY ALL")
def fact_stamp_counts(s, d):
    return _facts(s, d).groupBy("valid_from", "superseded_by").agg(F.count("*").alias("n"), F.countDistinct("entity_id").alias("n_entities"))


@P.add("""WITH p AS (SELECT o_orderkey, o_orderstatus, 1::bigint AS valid_from, 0::bigint AS superseded_by FROM orders WHERE o_orderkey % 10 <> 3), x AS (SELECT o_orderkey, o_orderstatus, 2::bigint AS valid_from, 0::bigint AS superseded_by FROM orders WHERE o_orderkey % 5 = 3)
SELECT o_orderkey, o_orderstatus, valid_from, (CASE WHEN o_orderkey % 5 = 3 THEN 2 ELSE 0 END)::bigint AS superseded_by FROM p UNION ALL SELECT * FROM x""")
def replay_read(s, d):
    orders = table(s, d, "orders").select("o_orderkey", "o_orderstatus")
    published = versioning.stamped(orders.filter("o_orderkey % 10 <> 3"), 1)
    drops = versioning.stamped(orders.filter("o_orderkey % 5 = 3"), 2)
    return versioning.replay(published, drops, drops.select("o_orderkey", F.lit(2).cast("bigint").alias("superseded_by")), "o_orderkey")


@P.add("SELECT c_custkey, c_name AS old_c_name, c_custkey AS old_entity, CASE WHEN c_custkey % 11 = 0 THEN 'merged' ELSE c_name END AS new_c_name, c_custkey // 2 AS new_entity FROM customer WHERE c_custkey % 11 = 0")
def identity_change_capture(s, d):
    c = table(s, d, "customer")
    old = c.select("c_custkey", "c_name", F.col("c_custkey").alias("entity"))
    new = c.select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, "merged").otherwise(F.col("c_name")).alias("c_name"), F.floor(F.col("c_custkey") / 2).alias("entity"))
    return versioning.identity_changes(old, new, "c_custkey", "c_name", "entity")


@P.add("SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC) > 1 AS is_duplicate FROM lineitem")
def dedupe_neighbour(s, d):
    return dedupe.mark_duplicates(table(s, d, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"), ["l_suppkey", "l_partkey"], ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "is_duplicate")


@P.add("SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber) = 1")
def dedupe_keep_first(s, d):
    return dedupe.keep_first(table(s, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber"), ["l_suppkey"], [F.col("l_orderkey"), F.col("l_linenumber")])


@P.add("SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC) = 1")
def dedupe_newest(s, d):
    return dedupe.newest_rows(table(s, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"), ["l_suppkey"], ["l_orderkey", "l_linenumber"])


INDICATED = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 7 THEN 'VALIDATION' WHEN dup AND l_linenumber % 2 = 0 THEN 'RAW_DUPLICATE' WHEN dup THEN 'RE_PROCESSED_DUPLICATE'
 WHEN l_suppkey % 9 = 0 THEN 'FACT_ONLY_PATIENT' WHEN l_linenumber % 2 = 1 THEN 'RE_PROCESSED_RECORDS' ELSE 'RAW_RECORDS' END AS indicator FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) > 1 AS dup FROM lineitem))"""


def _indicated(s, d):
    marked = dedupe.mark_duplicates(table(s, d, "lineitem"), ["l_orderkey", "l_returnflag"], ["l_linenumber", "l_partkey", "l_suppkey"], "dup")
    marker = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7), "CHECK-7").otherwise("")
    return marked.withColumn("indicator", dedupe.drop_indicator(F.col("dup"), F.col("l_linenumber") % 2, F.col("l_suppkey") % 9, marker, "CHECK")).select("l_orderkey", "l_linenumber", "indicator")


@P.add("SELECT * FROM " + INDICATED)
def drop_indicator(s, d):
    return _indicated(s, d)


@P.add("SELECT " + ", ".join(f"count(*) FILTER (indicator = '{c}') AS {c.lower()}" for c in dedupe.CLASSES) + ", count(*) FILTER (indicator IN ('RAW_RECORDS', 'RAW_DUPLICATE')) AS raw_total, count(*) FILTER (indicator IN ('RE_PROCESSED_RECORDS', 'RE_PROCESSED_DUPLICATE')) AS re_processed_total FROM " + INDICATED)
def drop_indicator_stats(s, d):
    return dedupe.indicator_stats(_indicated(s, d))


@P.add("SELECT o_orderkey FROM orders WHERE o_orderkey % 10 = 3 OR o_orderkey % 10 = 0")
def false_update_filter(s, d):
    orders = table(s, d, "orders")
    new = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 10 == 0, "X").otherwise(F.col("o_orderstatus")).alias("h"))
    old = orders.filter("o_orderkey % 10 <> 3").select("o_orderkey", F.col("o_orderstatus").alias("h"))
    return dedupe.false_updates(new, old, "o_orderkey", "h").select("o_orderkey")


@P.add("SELECT o_orderkey, 0::bigint AS incr FROM orders WHERE o_orderkey % 10 <> 3 AND o_custkey % 13 = 0 UNION ALL SELECT o_orderkey, 5::bigint FROM orders WHERE o_orderkey % 10 = 3")
def reprocess_history(s, d):
    orders = table(s, d, "orders").select("o_orderkey", "o_custkey")
    new, past = orders.filter("o_orderkey % 10 = 3").withColumn("incr", F.lit(5)), orders.filter("o_orderkey % 10 <> 3").withColumn("incr", F.lit(1))
    return dedupe.with_history(new, past, table(s, d, "customer").filter("c_custkey % 13 = 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "incr").select("o_orderkey", F.col("incr").cast("bigint").alias("incr"))


@P.add("""WITH k AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS id FROM customer WHERE c_custkey % 3 = 0), f AS (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT c_name FROM k))
SELECT id::bigint AS id, c_name FROM k UNION ALL SELECT (SELECT max(id) FROM k) + row_number() OVER (ORDER BY c_name), c_name FROM f""")
def id_extend_global(s, d):
    c = table(s, d, "customer").select("c_name")
    none = s.createDataFrame([], "id bigint, c_name string")
    known = ids.extend_dictionary(none, table(s, d, "customer").filter("c_custkey % 3 = 0").select("c_name"), "c_name", "id")
    return ids.extend_dictionary(known, c, "c_name", "id")


@P.add("""WITH k AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_type) AS id FROM (SELECT DISTINCT user_id, event_type FROM events WHERE event_id % 3 = 0)),
f AS (SELECT DISTINCT user_id, event_type FROM events ANTI JOIN k USING (user_id, event_type)), t AS (SELECT user_id, max(id) AS top FROM k GROUP BY 1)
SELECT user_id, id::bigint AS id, event_type FROM k UNION ALL SELECT user_id, coalesce(top, 0) + row_number() OVER (PARTITION BY user_id ORDER BY event_type), event_type FROM f LEFT JOIN t USING (user_id)""")
def id_extend_per_entity(s, d):
    e = table(s, d, "events")
    none = s.createDataFrame([], "user_id bigint, id bigint, event_type string")
    known = ids.extend_per_entity(none, e.filter("event_id % 3 = 0"), "user_id", "event_type", "id")
    return ids.extend_per_entity(known, e, "user_id", "event_type", "id")


@P.add("""WITH v AS (SELECT DISTINCT user_id, event_type AS v FROM events UNION SELECT DISTINCT user_id, props FROM events), i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY v) AS id FROM v)
SELECT e.user_id, event_id, x.id AS event_type, y.id AS props FROM events e JOIN i x ON x.user_id = e.user_id AND x.v = event_type JOIN i y ON y.user_id = e.user_id AND y.v = props""")
def hash_compaction_roundtrip(s, d):
    none = s.createDataFrame([], "user_id bigint, hash_id bigint, value string")
    return ids.compact_hashes(table(s, d, "events").select("user_id", "event_id", "event_type", "props"), "user_id", "event_id", ["event_type", "props"], none)[0]


@P.add("SELECT 'c_nationkey' AS side, c_nationkey::varchar AS value, count(DISTINCT c_mktsegment) AS n FROM customer GROUP BY 2 HAVING n > 1 UNION ALL SELECT 'c_mktsegment', c_mktsegment, count(DISTINCT c_nationkey) AS n FROM customer GROUP BY 2 HAVING n > 1")
def one_to_one_violations(s, d):
    return ids.one_to_one(table(s, d, "customer"), "c_nationkey", "c_mktsegment")


@P.add("""WITH b AS (SELECT l_orderkey, l_linenumber, (((l_suppkey % 8) * 10000) + 1)::int AS bucket FROM lineitem), o AS (SELECT bucket, count(*) AS top FROM b WHERE l_orderkey % 4 <> 0 GROUP BY 1)
SELECT l_orderkey, l_linenumber, bucket, (coalesce(top, 0) + row_number() OVER (PARTITION BY bucket ORDER BY l_orderkey, l_linenumber))::bigint AS row_id FROM b LEFT JOIN o USING (bucket) WHERE l_orderkey % 4 = 0""")
def row_id_continue(s, d):
    b = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", bucket_id(F.col("l_suppkey"), 8).alias("bucket"))
    last = b.filter("l_orderkey % 4 <> 0").groupBy("bucket").agg(F.count("*").alias("max_row_id"))
    return versioning.continue_row_ids(b.filter("l_orderkey % 4 = 0"), last, "bucket", [F.col("l_orderkey"), F.col("l_linenumber")])


@P.add("SELECT n_nationkey, coalesce(v.n_name, n.n_name) AS n_name, n_regionkey FROM nation n LEFT JOIN (VALUES (3, 'PATCHED'), (5, NULL), (99, 'NOWHERE')) v(n_nationkey, n_name) USING (n_nationkey)")
def data_overrides(s, d):
    return versioning.patch(table(s, d, "nation"), s.createDataFrame([(3, "PATCHED"), (5, None), (99, "NOWHERE")], "n_nationkey int, n_name string"), "n_nationkey")


DQ = "SELECT count(*) AS n, count(*) FILTER (o_custkey % 50 = 0) AS zero_id, count(*) FILTER (o_orderdate >= '1998-01-01') AS future, count(*) FILTER (o_totalprice < 1000) AS low FROM orders"


def _dq(s, d):
    return quality.counters(table(s, d, "orders"), zero_id=F.col("o_custkey") % 50 == 0, future=F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"), low=F.col("o_totalprice") < 1000)


@P.add(DQ)
def dq_counters(s, d):
    return _dq(s, d)


@P.add(f"WITH c AS ({DQ}) SELECT * FROM (SELECT 'zero_id' AS name, round(zero_id * 100.0::double / n, 4) AS share FROM c UNION ALL SELECT 'future', round(future * 100.0::double / n, 4) FROM c UNION ALL SELECT 'low', round(low * 100.0::double / n, 4) FROM c) WHERE share > 1.5")
def pct_thresholds(s, d):
    return quality.breaches(_dq(s, d), 1.5, ["zero_id", "future", "low"])


@P.add("SELECT l_orderkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL HAVING n > 1")
def uniqueness_validators(s, d):
    return quality.repeated(table(s, d, "lineitem"), ["l_orderkey", "l_returnflag"])


@P.add("""SELECT coalesce(a.b, o.b) AS bucket, coalesce(a.n, 0) AS a_rows, coalesce(o.n, 0) AS b_rows, coalesce(a.n, 0) = coalesce(o.n, 0) AS equal FROM (SELECT (((l_orderkey % 8) * 10000) + 1)::int AS b, count(*) AS n FROM lineitem GROUP BY 1) a
 FULL JOIN (SELECT (((o_orderkey % 16) * 10000) + 1)::int AS b, count(*) AS n FROM orders GROUP BY 1) o ON a.b = o.b""")
def bucket_reconcile(s, d):
    a = table(s, d, "lineitem").select(bucket_id(F.col("l_orderkey"), 8).alias("bucket"))
    return quality.reconcile(a, table(s, d, "orders").select(bucket_id(F.col("o_orderkey"), 16).alias("bucket")), "bucket")


@P.add("SELECT l_partkey, l_suppkey, min(v)::bigint AS version FROM (SELECT l_partkey, l_suppkey, 1 AS v FROM lineitem WHERE l_orderkey % 2 = 0 UNION ALL SELECT l_partkey, l_suppkey, 2 FROM lineitem WHERE l_orderkey % 3 = 0) GROUP BY ALL")
def bridge_accumulate(s, d):
    l = table(s, d, "lineitem")
    v = lambda where, n: l.filter(where).select("l_partkey", "l_suppkey", F.lit(n).cast("bigint").alias("version"))
    return derive.accumulated([v("l_orderkey % 2 = 0", 1), v("l_orderkey % 3 = 0", 2)], ["l_partkey", "l_suppkey"])
