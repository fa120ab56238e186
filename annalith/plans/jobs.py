"""The composed jobs as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pipelines, versioning
from ..operators.normalize import age_years, seconds
from ..operators.quality import day_strings
from ..session import table
from ..sources.readers import path_part
from .registry import Plans

P = Plans()
QUERIES, SQL = P.queries, P.sql
BUCKETS = 16
KNOWN = "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) AS entity_id FROM customer"


def identity(s, d):
    none = lambda schema: s.createDataFrame([], schema)
    people = table(s, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return pipelines.identities(people, none("entity_id bigint, c_name string"), none("key_id bigint, c_custkey bigint"), "c_custkey", "c_name", ["c_acctbal"], BUCKETS, 1)


@P.add(f"""WITH p AS (SELECT c_custkey, c_name, dense_rank() OVER (ORDER BY c_name) AS entity_id, row_number() OVER (ORDER BY c_custkey) AS key_id FROM customer), b AS (SELECT *, ((entity_id % {BUCKETS}) * 10000 + 1)::int AS bucket_id FROM p)
SELECT *, row_number() OVER (PARTITION BY bucket_id ORDER BY entity_id, key_id) AS row_id, 1::bigint AS valid_from, 0::bigint AS superseded_by FROM b""")
def identity_pipeline(s, d):
    return identity(s, d)


RAW = f"""(WITH k AS (SELECT * FROM ({KNOWN}) WHERE c_custkey % 9 <> 0), r AS (SELECT o_orderkey, o_custkey, o_orderpriority, coalesce(entity_id, 0) AS entity_id, (((coalesce(entity_id, 0)) % {BUCKETS}) * 10000 + 1)::int AS bucket_id, sha256(concat_ws('|', o_custkey::varchar, o_orderpriority)) AS key_hash FROM orders LEFT JOIN k ON o_custkey = c_custkey)
SELECT *, CASE WHEN row_number() OVER (PARTITION BY bucket_id, key_hash ORDER BY o_orderkey DESC) > 1 THEN 'RAW_DUPLICATE' WHEN entity_id = 0 THEN 'FACT_ONLY_PATIENT' ELSE 'RAW_RECORDS' END AS indicator FROM r)"""


def preprocessed(s, d):
    """Every ninth customer is unknown."""
    raw = table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return pipelines.preprocess(raw, identity(s, d).filter("c_custkey % 9 <> 0").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", ["o_custkey", "o_orderpriority"], ["o_orderkey"], BUCKETS)


@P.add(f"SELECT * FROM {RAW}")
def preprocess_pipeline(s, d):
    return preprocessed(s, d)


@P.add(f"SELECT o_orderkey, o_custkey, o_orderpriority, entity_id, bucket_id, key_hash, row_number() OVER (PARTITION BY bucket_id ORDER BY key_hash) + 5 AS row_id, 3::bigint AS valid_from, 0::bigint AS superseded_by FROM {RAW} WHERE indicator = 'RAW_RECORDS'")
def fact_pipeline(s, d):
    last = s.range(BUCKETS).select((F.col("id") * 10_000 + 1).cast("int").alias("bucket_id"), F.lit(5).alias("max_row_id"))
    return pipelines.facts(preprocessed(s, d), last, 3)


@P.add(f"""WITH k AS ({KNOWN}), f AS (SELECT entity_id, o_orderdate FROM orders JOIN k ON o_custkey = c_custkey)
SELECT entity_id, string_agg(d::varchar || ':' || c::varchar, ',' ORDER BY d) AS days, sum(c)::bigint AS total, max(age) AS oldest FROM (SELECT entity_id, o_orderdate::date AS d, count(*) AS c, max(trunc((epoch_us(o_orderdate) // 1000000 - entity_id * 86400) / 31536000)::bigint) AS age FROM f GROUP BY ALL) GROUP BY 1""")
def versioned_orders(s, d):
    """Flagship: orders resolved to entities, as of a version, with their days and the entity's greatest age."""
    known = versioning.as_of(identity(s, d), 1, latest_only=True).select("entity_id", F.col("c_custkey").alias("o_custkey"))
    events = table(s, d, "orders").select("o_custkey", "o_orderdate").join(known, "o_custkey")
    ages = events.groupBy("entity_id").agg(F.max(age_years(seconds(F.col("o_orderdate")), F.col("entity_id") * 86_400)).alias("oldest"))
    return day_strings(events, "entity_id", F.col("o_orderdate").cast("date")).join(ages, "entity_id")


MAP = "(SELECT o_orderkey AS k, 1 + o_orderkey % 3 AS valid_from, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 2 + o_orderkey % 3 END AS superseded_by FROM orders)"


def _map(s, d):
    k = F.col("o_orderkey")
    return table(s, d, "orders").select(k.alias("k"), (1 + k % 3).alias("valid_from"), F.when(k % 4 == 0, 0).otherwise(2 + k % 3).cast("bigint").alias("superseded_by"))


@P.add(f"SELECT o.o_orderkey AS k, coalesce(m.valid_from, 9)::bigint AS valid_from, coalesce(m.superseded_by, 0)::bigint AS superseded_by FROM orders o LEFT JOIN (SELECT * FROM {MAP} WHERE k % 5 <> 0) m ON m.k = o.o_orderkey")
def version_repair(s, d):
    data = versioning.stamped(table(s, d, "orders").select(F.col("o_orderkey").alias("k")), 9)
    return pipelines.repair_versions(data, _map(s, d).filter("k % 5 <> 0"), ["k"])


@P.add(f"""WITH m AS (SELECT * FROM {MAP} UNION ALL SELECT o_orderkey, 0, 1 + o_orderkey % 3 FROM orders WHERE o_orderkey % 2 = 0), r AS (SELECT *, max((superseded_by = 0)::int) OVER (PARTITION BY k) AS has, row_number() OVER (PARTITION BY k ORDER BY superseded_by DESC, valid_from DESC) AS n FROM m)
SELECT k, valid_from::bigint AS valid_from, (CASE WHEN has = 0 AND n = 1 THEN 0 ELSE superseded_by END)::bigint AS superseded_by FROM r""")
def reactivated_facts(s, d):
    """Half of the keys have two rows, of which only the one superseded last comes back."""
    k = F.col("o_orderkey")
    earlier = table(s, d, "orders").filter(k % 2 == 0).select(k.alias("k"), F.lit(0).cast("bigint").alias("valid_from"), (1 + k % 3).alias("superseded_by"))
    return pipelines.reactivate(_map(s, d).unionByName(earlier), "k")


@P.add(f"SELECT valid_from, count(*) AS n, count(*) FILTER (superseded_by = 0) AS n_active FROM {MAP} GROUP BY 1")
def version_counts(s, d):
    return pipelines.version_counts(_map(s, d))


@P.add("SELECT k, valid_from, (CASE WHEN superseded_by = 0 AND k % 10 = 3 THEN 9 ELSE superseded_by END)::bigint AS superseded_by FROM " + MAP + " UNION ALL SELECT o_orderkey, 9, 0 FROM orders WHERE o_orderkey % 10 = 3")
def identity_expiry(s, d):
    new = versioning.stamped(table(s, d, "orders").filter("o_orderkey % 10 = 3").select(F.col("o_orderkey").alias("k")), 9)
    return pipelines.expire_seen(_map(s, d), new, "k", 9)


@P.add("SELECT p_brand, max((p_type LIKE 'STANDARD%')::int)::bigint AS has_standard, max((p_type LIKE 'PROMO%')::int)::bigint AS has_promo, count(*) FILTER (p_type LIKE 'STANDARD%') AS n_standard, count(*) FILTER (p_type LIKE 'PROMO%') AS n_promo FROM part GROUP BY 1")
def prefix_flag_table(s, d):
    return pipelines.prefix_flags(table(s, d, "part"), "p_brand", "p_type", {"standard": "STANDARD", "promo": "PROMO"})


@P.add("SELECT l_orderkey, l_linenumber, epoch_us(CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE l_shipdate END) // 1000000 AS at_ts FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def encounter_time_override(s, d):
    lines = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", seconds(F.col("l_shipdate")).alias("at_ts"))
    orders = table(s, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), seconds(F.col("o_orderdate")).alias("at_ts"))
    return pipelines.override_time(lines, orders, "l_orderkey", "at_ts")


@P.add("SELECT p_partkey, p_brand AS folder FROM part")
def path_to_ids(s, d):
    path = F.concat_ws("/", F.lit("/root"), "p_brand", F.concat(F.lit("img_"), F.col("p_partkey").cast("string"), F.lit(".nii")))
    return table(s, d, "part").select("p_partkey", path_part(path, 1).alias("folder"))
