"""Whole jobs and composite summaries: preprocessing with history, facts with ages and enrichments, validators, harmonising rules, hospital events, associations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive, enrich, joins, pipelines, quality, sequences, versioning
from ..operators.keys import bucket_id, key_hash
from ..operators.normalize import seconds
from ..session import cut, table
from .jobs import BUCKETS, identity
from .registry import Plans
from .summaries import TS, events

P = Plans()
QUERIES, SQL = P.queries, P.sql

PEOPLE = "(SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) AS entity_id FROM customer)"
BATCHES = """(SELECT o_orderkey, o_custkey, o_orderpriority, o_clerk_mark, 2::bigint AS batch, 0::bigint AS row_id FROM b WHERE o_orderkey % 2 = 0 UNION ALL
 SELECT o_orderkey, o_custkey, o_orderpriority, o_clerk_mark, 0, o_orderkey + 1 FROM b WHERE o_orderkey % 2 = 1 AND o_custkey % 13 = 0)"""
FULL = f"""WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 29 = 0 THEN -1 ELSE o_custkey END AS o_custkey, o_orderpriority, CASE WHEN o_orderkey % 31 = 0 THEN 'CHECK' ELSE '' END AS o_clerk_mark FROM orders),
r AS (SELECT x.*, coalesce(entity_id, 0) AS entity_id, ((coalesce(entity_id, 0) % {BUCKETS}) * 10000 + 1)::int AS bucket_id, sha256(concat_ws('|', o_custkey::varchar, o_orderpriority)) AS key_hash FROM {BATCHES} x LEFT JOIN {PEOPLE} p ON x.o_custkey = p.c_custkey),
k AS (SELECT *, row_number() OVER (PARTITION BY bucket_id, key_hash ORDER BY batch DESC, o_orderkey DESC) > 1 AS dup FROM r),
p AS (SELECT * EXCLUDE (dup), CASE WHEN o_clerk_mark = 'CHECK' THEN 'VALIDATION' WHEN dup AND row_id = 0 THEN 'RAW_DUPLICATE' WHEN dup THEN 'RE_PROCESSED_DUPLICATE' WHEN entity_id = 0 THEN 'FACT_ONLY_PATIENT' WHEN row_id <> 0 THEN 'RE_PROCESSED_RECORDS' ELSE 'RAW_RECORDS' END AS indicator FROM k)
"""


def _preprocessed(s, d):
    """New rows of batch 2, and rows of batch 0 of customers whose identity changed: all six classes occur."""
    o = table(s, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 29 == 0, -1).otherwise(F.col("o_custkey")).cast("bigint").alias("o_custkey"), "o_orderpriority", F.when(F.col("o_orderkey") % 31 == 0, "CHECK").otherwise("").alias("o_clerk_mark"))
    new, past = o.filter("o_orderkey % 2 = 0").withColumn("batch", F.lit(2).cast("bigint")), o.filter("o_orderkey % 2 = 1").withColumns({"batch": F.lit(1).cast("bigint"), "row_id": F.col("o_orderkey") + 1})
    merged = o.filter("o_custkey % 13 = 0").select("o_custkey")
    people = identity(s, d).withColumnRenamed("c_custkey", "o_custkey")
    return pipelines.preprocess(new, people, "o_custkey", ["o_custkey", "o_orderpriority"], ["batch", "o_orderkey"], BUCKETS, F.col("o_clerk_mark"), "CHECK", past, merged)


@P.add(FULL + "SELECT o_orderkey, o_custkey, o_orderpriority, o_clerk_mark, batch, row_id, entity_id, bucket_id, key_hash, indicator FROM p")
def preprocess_full(s, d):
    return _preprocessed(s, d)


@P.add(FULL + """SELECT * FROM (SELECT 'INPUT' AS side, c AS class, (SELECT count(*) FROM p WHERE indicator = c) AS n FROM (VALUES ('VALIDATION'), ('RAW_DUPLICATE'), ('RE_PROCESSED_DUPLICATE'), ('FACT_ONLY_PATIENT')) v(c)
 UNION ALL SELECT 'INPUT', 'RAW_TOTAL', count(*) FROM p WHERE indicator IN ('RAW_RECORDS', 'RAW_DUPLICATE') UNION ALL SELECT 'INPUT', 'RE_PROCESSED_TOTAL', count(*) FROM p WHERE indicator IN ('RE_PROCESSED_RECORDS', 'RE_PROCESSED_DUPLICATE')
 UNION ALL SELECT 'OUTPUT', c, (SELECT count(*) FROM p WHERE indicator = c) FROM (VALUES ('RAW_RECORDS'), ('RE_PROCESSED_RECORDS')) v(c) UNION ALL SELECT 'OUTPUT', 'TOTAL', count(*) FROM p WHERE indicator IN ('RAW_RECORDS', 'RE_PROCESSED_RECORDS'))""")
def preprocess_stats(s, d):
    stats = pipelines.preprocess_stats(_preprocessed(s, d))
    pipelines.check_preprocessed(stats, 80)
    return s.createDataFrame([(side, c, n) for side, counts in stats.items() for c, n in counts.items()], "side string, class string, n bigint")


FACT = """WITH x AS (SELECT o_orderkey, o_custkey AS entity_id, ((o_custkey % 16) * 10000 + 1)::int AS bucket_id, epoch_us(o_orderdate) // 1000000 AS order_ts, CASE WHEN o_orderkey % 5 <> 0 THEN epoch_us(o_orderdate) // 1000000 + 86400 END AS ship_ts, nullif(o_orderpriority, '5-LOW') AS priority FROM orders),
e AS (SELECT o_orderpriority AS priority, min(upper(o_orderpriority)) AS label FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1 UNION ALL SELECT NULL, 'NONE'),
y AS (SELECT x.*, e.label, coalesce(ship_ts, least(ship_ts, order_ts)) AS event_ts FROM x LEFT JOIN e ON x.priority IS NOT DISTINCT FROM e.priority),
z AS (SELECT *, trunc((event_ts - CASE WHEN entity_id % 3 <> 0 THEN entity_id * 86400 * 40 END) / 31536000)::bigint AS age FROM y)
"""


def _facts(s, d):
    o, at = table(s, d, "orders"), seconds(F.col("o_orderdate"))
    rows = o.select("o_orderkey", F.col("o_custkey").alias("entity_id"), bucket_id(F.col("o_custkey"), 16).alias("bucket_id"), at.alias("order_ts"), F.when(F.col("o_orderkey") % 5 != 0, at + 86_400).alias("ship_ts"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    births = table(s, d, "customer").filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("entity_id"), (F.col("c_custkey") * 86_400 * 40).alias("birth_ts"))
    labels = o.filter("o_orderpriority <> '1-URGENT'").select(F.col("o_orderpriority").alias("priority"), F.upper("o_orderpriority").alias("label")).unionByName(s.createDataFrame([(None, "NONE")], "priority string, label string"))
    return pipelines.aged(enrich.enriched(rows, labels, ["priority"], ["label"]), births, "ship_ts", ["order_ts", "ship_ts"])


@P.add(FACT + "SELECT o_orderkey, entity_id, bucket_id, priority, label, event_ts, age, row_number() OVER (PARTITION BY bucket_id ORDER BY o_orderkey) + 7 AS row_id FROM z")
def fact_full(s, d):
    """Facts enriched null-safe, with event times, ages and row ids that go on in each bucket."""
    last = s.range(16).select((F.col("id") * 10_000 + 1).cast("int").alias("bucket_id"), F.lit(7).alias("max_row_id"))
    return versioning.continue_row_ids(_facts(s, d), last, "bucket_id", [F.col("o_orderkey")]).drop("order_ts", "ship_ts")


@P.add(FACT + "SELECT count(*) AS n, count(*) FILTER (event_ts IS NULL) AS null_time, count(*) FILTER (event_ts > 890000000) AS future, count(*) FILTER (entity_id = 0) AS nobody, count(*) FILTER (age < 0) AS negative_age, count(*) FILTER (age IS NULL) AS empty_age, count(*) FILTER (age > 90) AS over_90, count(*) FILTER (label IS NULL) AS not_enriched FROM z")
def fact_counters(s, d):
    return pipelines.fact_counters(_facts(s, d), ["label"], 890_000_000)


@P.add("""WITH h AS (SELECT sha256(p_brand) AS v, row_number() OVER (ORDER BY sha256(p_brand)) AS id FROM (SELECT DISTINCT p_brand FROM part WHERE p_size > 5))
SELECT p_partkey, h.id AS brand, g.id AS other FROM part LEFT JOIN h ON h.v = sha256(p_brand) LEFT JOIN h g ON g.v = sha256(p_type)""")
def hash_to_id(s, d):
    from ..operators.ids import extend_dictionary

    hashed = table(s, d, "part").select("p_partkey", F.sha2("p_brand", 256).alias("brand"), F.sha2("p_type", 256).alias("other"))
    known = extend_dictionary(s.createDataFrame([], "id bigint, v string"), table(s, d, "part").filter("p_size > 5").select(F.sha2("p_brand", 256).alias("v")), "v", "id")
    return pipelines.replace_hashes(hashed, known, ["brand", "other"], "v", "id")


FAULTY = """(SELECT CASE WHEN o_orderkey % 997 <> 0 THEN sha256((o_orderkey // 2)::varchar) END AS key_hash, o_custkey AS key_id, o_custkey % 100 AS entity_id, o_orderkey % 4000 AS fact_id, o_orderkey // 3 AS guid, CASE WHEN o_orderkey % 4 = 0 THEN 2 ELSE 0 END AS superseded_by FROM orders)"""


def _map(s, d):
    k = F.col("o_orderkey")
    return table(s, d, "orders").select(F.when(k % 997 != 0, F.sha2(F.floor(k / 2).cast("string"), 256)).alias("key_hash"), F.col("o_custkey").alias("key_id"), (F.col("o_custkey") % 100).alias("entity_id"), (k % 4000).alias("fact_id"), F.floor(k / 3).alias("guid"), F.when(k % 4 == 0, 2).otherwise(0).alias("superseded_by"))


@P.add(f"""WITH m AS (SELECT * FROM {FAULTY}), a AS (SELECT * FROM m WHERE superseded_by = 0) SELECT 'empty_ids' AS check, count(*) AS n FROM m WHERE key_hash IS NULL OR fact_id IS NULL OR guid IS NULL
 UNION ALL SELECT 'key_across', count(*) FROM (SELECT 1 FROM m GROUP BY key_id, key_hash HAVING count(DISTINCT guid) > 1) UNION ALL SELECT 'guid_across', count(*) FROM (SELECT 1 FROM m GROUP BY key_id, guid HAVING count(DISTINCT key_hash) > 1)
 UNION ALL SELECT 'key_active', count(*) FROM (SELECT 1 FROM a GROUP BY key_id, key_hash HAVING count(*) > 1) UNION ALL SELECT 'fact_id_active', count(*) FROM (SELECT 1 FROM a GROUP BY entity_id, fact_id HAVING count(*) > 1)
 UNION ALL SELECT 'obsolete_active', count(*) FROM a WHERE entity_id % 50 = 7 UNION ALL SELECT 'rows', abs(count(*) - 1000) FROM m""")
def map_validators(s, d):
    m = _map(s, d)
    return pipelines.map_faults(m, m.filter("entity_id % 50 = 7").select("entity_id"), (400, 600))


@P.add(f"SELECT count(DISTINCT guid) FILTER (superseded_by = 0) AS active, count(DISTINCT guid) AS n, count(DISTINCT guid) FILTER (superseded_by = 0) = count(DISTINCT guid) AS equal FROM {FAULTY}")
def guid_activity(s, d):
    return pipelines.guid_activity(_map(s, d))


RULES5 = "SELECT p_brand AS brand, nullif(p_type, 'STANDARD') AS kind, CASE WHEN p_size % 3 <> 0 THEN p_size END AS size, p_size // 10 AS tens, p_name[1:1] AS initial"


@P.add(f"""WITH m AS ({RULES5}, p_partkey FROM part), r AS ({RULES5}, count(*) AS weight FROM part WHERE p_partkey % 2 = 0 GROUP BY ALL)
SELECT m.p_partkey, r.weight FROM m JOIN r ON lower(m.brand) = lower(r.brand) AND m.kind IS NOT DISTINCT FROM r.kind AND m.size IS NOT DISTINCT FROM r.size AND m.tens IS NOT DISTINCT FROM r.tens AND m.initial IS NOT DISTINCT FROM r.initial""")
def rule_join_5key(s, d):
    """One key equal, four attributes null-safe; the rules are written in capitals and with spaces."""
    p, z = table(s, d, "part"), F.col("p_size")
    five = lambda df: df.select("p_partkey", F.col("p_brand").alias("brand"), F.nullif("p_type", F.lit("STANDARD")).alias("kind"), F.when(z % 3 != 0, z).alias("size"), F.floor(z / 10).alias("tens"), F.substring("p_name", 1, 1).alias("initial"))
    rules = five(p.filter("p_partkey % 2 = 0")).groupBy("brand", "kind", "size", "tens", "initial").agg(F.count("*").alias("weight"))
    loud = rules.withColumns({"brand": F.concat(F.lit(" "), F.upper("brand")), "kind": F.concat(F.upper("kind"), F.lit(" "))})
    return joins.rule_join(five(p), loud, ["brand"], ["kind", "size", "tens", "initial"]).select("p_partkey", "weight")


@P.add("""SELECT r.variable_id, p_partkey, coalesce(nullif(display_name, ''), 'v' || r.variable_id) AS display_name, units FROM part JOIN rule_variables r ON p_partkey % 17 + 1 = r.variable_id WHERE p_size % 5 <> 0 AND r.variable_id % 4 <> 0""")
def rule_mapping(s, d):
    """Rules of valid variables whose entities aren't excluded; a variable without display name goes by its own name."""
    v = table(s, d, "rule_variables").select("variable_id", F.nullif("display_name", F.lit("")).alias("display_name"), F.concat(F.lit("v"), F.col("variable_id").cast("string")).alias("variable_name"), "units", F.lit(99).alias("derived_type"), F.when(F.col("variable_id") % 4 == 0, 1).otherwise(4).alias("state"))
    e = table(s, d, "part").select((F.col("p_partkey") % 17 + 1).cast("int").alias("variable_id"), "p_partkey", F.when(F.col("p_size") % 5 == 0, True).alias("excluded"))
    return derive.rule_mapping(e, v, 99).select("variable_id", "p_partkey", "display_name", "units")


@P.add("""WITH e AS (SELECT nullif(kernel, '') AS kernel, nullif(lang, '') AS lang, min(coalesce(source, '') || '##' || coalesce(kernel, '')) AS tag FROM documents GROUP BY ALL)
SELECT doc_id, array_to_string(list_sort(string_split(replace(tag, '|', '-'), '##')), ',') AS tag FROM documents d LEFT JOIN e ON nullif(d.kernel, '') IS NOT DISTINCT FROM e.kernel AND nullif(d.lang, '') IS NOT DISTINCT FROM e.lang""")
def enrichment_join(s, d):
    """Documents with the tokens of the first label of their kernel and language, both of which may be null; labels are repeated and unsorted."""
    docs = table(s, d, "documents").select("doc_id", "kernel", "lang")
    labels = table(s, d, "documents").select(F.nullif("kernel", F.lit("")).alias("kernel"), F.nullif("lang", F.lit("")).alias("lang"), F.concat_ws("##", F.coalesce("source", F.lit("")), F.coalesce("kernel", F.lit(""))).alias("tag"))
    return enrich.enriched(docs, labels, ["kernel", "lang"], ["tag"]).select("doc_id", "tag")


TAGS = "(SELECT c_custkey, ((c_custkey % 16) * 10000 + 1)::int AS bucket_id, c_mktsegment AS tag, c_custkey % 6 = 0 AS moved, c_custkey % 10 = 0 AS turned FROM customer)"


def _tagged(s, d):
    """Customers with a tag of two tokens in some order; the enrichment changes a sixth of them and only turns the tokens of others."""
    k = F.col("c_custkey")
    old = table(s, d, "customer").select("c_custkey", bucket_id(k, 16).alias("bucket_id"), F.concat_ws(",", "c_mktsegment", F.lit("ZZ")).alias("tag"), k.alias("row_id"))
    new = table(s, d, "customer").select("c_custkey", F.when(k % 6 == 0, F.concat_ws("##", "c_mktsegment", F.lit("NEW"))).when(k % 10 == 0, F.concat_ws("##", F.lit("ZZ"), "c_mktsegment")).otherwise(F.concat_ws("##", "c_mktsegment", F.lit("ZZ"))).alias("tag"))
    last = old.groupBy("bucket_id").agg(F.max("row_id").alias("max_row_id"))
    return enrich.refreshed(old, new, ["c_custkey"], ["tag", "unknown"], last, "bucket_id", 4002)


@P.add(f"""WITH t AS (SELECT *, max(c_custkey) OVER (PARTITION BY bucket_id) AS top FROM {TAGS})
SELECT c_custkey, bucket_id, array_to_string(list_sort([tag, 'NEW']), ',') AS tag, top + row_number() OVER (PARTITION BY bucket_id ORDER BY c_custkey) AS row_id, 4002::bigint AS valid_from, 0::bigint AS superseded_by FROM t WHERE moved""")
def enrichment_diff(s, d):
    changed, stats = _tagged(s, d)
    enrich.within_expected(stats, 20.0)
    return changed


@P.add(f"SELECT count(*) AS n, count(*) FILTER (moved) AS changed, round(count(*) FILTER (moved) * 100.0::double / count(*), 4) AS percent FROM {TAGS}")
def enrichment_diff_stats(s, d):
    return _tagged(s, d)[1]


@P.add("""WITH e AS (SELECT p_partkey, p_brand FROM part WHERE p_partkey % 3 <> 0) SELECT 1 AS version, l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem LEFT JOIN e ON l_partkey = p_partkey WHERE l_orderkey % 2 = 0
 UNION ALL SELECT 2, l_orderkey, l_linenumber, l_partkey, p_brand FROM lineitem LEFT JOIN e ON l_partkey = p_partkey WHERE l_orderkey % 2 = 1""")
def enrichment_backfill(s, d):
    """A new column for the drops of two versions, of which the second has an older form of it already."""
    l, extra = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), table(s, d, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    drops = {1: l.filter("l_orderkey % 2 = 0"), 2: l.filter("l_orderkey % 2 = 1").withColumn("p_brand", F.lit("old"))}
    filled = enrich.backfilled(drops, extra, ["l_partkey"], ["p_brand"])
    return filled[1].withColumn("version", F.lit(1)).unionByName(filled[2].withColumn("version", F.lit(2)))


def _hospital(s, d):
    e = events(s, d)
    stays = e.filter("event_type in ('login', 'view')").select("user_id", F.col("t").alias("admit_ts"), F.when(F.col("event_id") % 7 != 0, F.col("t") + 3 * 86_400).alias("discharge_ts"), F.col("event_type").alias("type"))
    procedures = e.select("user_id", F.col("t").alias("at"), F.col("event_type").alias("code"))
    return derive.hospital_events(stays, procedures, "user_id", {"click": "subsequent hospital", "purchase": "critical care"})


HOSPITAL = f"""(SELECT user_id, event_ts, tag, source, min(type) AS type FROM (SELECT user_id, {TS} AS event_ts, 'initial hospital' AS tag, 'ADT' AS source, event_type AS type FROM events WHERE event_type IN ('login', 'view')
 UNION ALL SELECT user_id, {TS} + 3 * 86400, 'discharge', 'ADT', event_type FROM events WHERE event_type IN ('login', 'view') AND event_id % 7 <> 0 UNION ALL SELECT user_id, {TS}, CASE event_type WHEN 'click' THEN 'subsequent hospital' ELSE 'critical care' END, 'PROCEDURE', event_type FROM events WHERE event_type IN ('click', 'purchase')) GROUP BY ALL)"""


@P.add(f"SELECT * FROM {HOSPITAL}")
def hospital_events(s, d):
    return _hospital(s, d).withColumnRenamed("at", "event_ts")


@P.add(f"""WITH g AS (SELECT user_id, event_ts AS z, CASE WHEN event_ts - lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts) <= 86400 THEN 0 ELSE 1 END AS b FROM {HOSPITAL} WHERE tag = 'critical care'), c AS (SELECT user_id, z, sum(b) OVER (PARTITION BY user_id ORDER BY z) AS cycle FROM g),
k AS (SELECT user_id, cycle::bigint AS cycle, ((max(z) - min(z)) // 86400 + 1)::bigint AS days, min(z) AS start_ts, max(z) AS end_ts FROM c GROUP BY ALL)
SELECT k.*, CASE WHEN user_id % 3 <> 0 THEN trunc(date_diff('day', DATE '1980-01-01' + (user_id % 9000)::int, make_timestamp(start_ts * 1000000)::date) / 365.25)::int END AS start_age, CASE WHEN user_id % 3 <> 0 THEN trunc(date_diff('day', DATE '1980-01-01' + (user_id % 9000)::int, make_timestamp(end_ts * 1000000)::date) / 365.25)::int END AS end_age FROM k""")
def critical_care_cycles(s, d):
    care = _hospital(s, d).filter("tag = 'critical care'")
    births = table(s, d, "events").select("user_id").distinct().filter("user_id % 3 <> 0").withColumn("birth", F.expr("date_add(date'1980-01-01', cast(user_id % 9000 as int))"))
    return derive.with_ages(sequences.gap_cycles(care, "user_id", "at"), births, "user_id")


KINDS = ["Has_Disease", "Therapeutic", "Adverse_Event", "Disease_Stage", "Positive_For_Biomarker", "Negative_For_Biomarker", "Other"]
SAID = f"""(SELECT user_id % 6 AS entity_id, (['{"', '".join(KINDS)}'])[event_id % 7 + 1] AS prediction_type, 'd' || (event_id % 3) AS entity_1, 'd' || (user_id % 3) AS entity_2, (event_id % 100) / 100.0::double AS score, 's' || (event_id % 40) AS sentence_hash, {TS} AS published_ts FROM events)"""


@P.add(f"""WITH g AS (SELECT * FROM {SAID} WHERE score > 0.8 AND prediction_type <> 'Other'), k AS (SELECT entity_id, prediction_type, entity_1, entity_2 FROM g GROUP BY ALL HAVING count(DISTINCT sentence_hash) >= 2),
r AS (SELECT entity_id, published_ts - published_ts % 86400 AS day_ts, sentence_hash, prediction_type AS kind, CASE WHEN prediction_type IN ('Therapeutic', 'Adverse_Event') THEN entity_2 ELSE entity_1 END AS disease, CASE WHEN prediction_type IN ('Therapeutic', 'Adverse_Event') THEN entity_1 ELSE entity_2 END AS other FROM g JOIN k USING (entity_id, prediction_type, entity_1, entity_2)),
u AS (SELECT DISTINCT sentence_hash, disease, other AS drug, kind AS drug_relation FROM r WHERE kind IN ('Therapeutic', 'Adverse_Event')), st AS (SELECT DISTINCT sentence_hash, disease, other AS stage FROM r WHERE kind = 'Disease_Stage'),
m AS (SELECT DISTINCT sentence_hash, disease, other AS marker, CASE WHEN kind = 'Positive_For_Biomarker' THEN 'Positive' ELSE 'Negative' END AS marker_relation FROM r WHERE kind LIKE '%Biomarker'),
f AS (SELECT * FROM u FULL JOIN st USING (sentence_hash, disease) FULL JOIN m USING (sentence_hash, disease)), di AS (SELECT DISTINCT entity_id, day_ts, sentence_hash, disease, kind AS sentiment FROM r WHERE kind = 'Has_Disease'),
n AS (SELECT user_id % 6 AS entity_id, {TS} - {TS} % 86400 AS day_ts, min({TS}) AS first_ts FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT DISTINCT entity_id, coalesce(first_ts, day_ts) AS at_ts, disease, sentiment, drug, drug_relation, stage, marker, marker_relation FROM di LEFT JOIN f USING (sentence_hash, disease) LEFT JOIN n USING (entity_id, day_ts)""")
def association_facets(s, d):
    e, text = events(s, d), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    u, k = F.col("user_id"), F.col("event_id")
    said = e.select((u % 6).alias("entity_id"), F.get(F.array(*map(F.lit, KINDS)), (k % 7).cast("int")).alias("prediction_type"), text("d", k % 3).alias("entity_1"), text("d", u % 3).alias("entity_2"), ((k % 100) / 100.0).alias("score"), text("s", k % 40).alias("sentence_hash"), F.col("t").alias("published_ts"))
    return derive.association_facets(said, e.filter("event_type = 'view'").select((u % 6).alias("entity_id"), F.col("t").alias("at_ts")))


@P.add(f"""WITH k AS (SELECT user_id, z, row_number() OVER (ORDER BY user_id, z) AS signal_id FROM (SELECT DISTINCT user_id, {TS} AS z FROM events WHERE event_id % 3 = 0)), f AS (SELECT DISTINCT user_id, {TS} AS z FROM events WHERE event_type = 'click' EXCEPT SELECT user_id, z FROM k)
SELECT signal_id, user_id, z AS event_ts FROM k UNION ALL SELECT (SELECT max(signal_id) FROM k) + row_number() OVER (ORDER BY user_id, z), user_id, z FROM f""")
def signal_ids(s, d):
    e = events(s, d).withColumnRenamed("t", "event_ts")
    none = s.createDataFrame([], "signal_id bigint, user_id bigint, event_ts bigint")
    known = derive.signal_ids(none, e.filter("event_id % 3 = 0"), ["user_id", "event_ts"], "signal_id")
    return derive.signal_ids(known, e.filter("event_type = 'click'"), ["user_id", "event_ts"], "signal_id")


@P.add("SELECT o_orderkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag <> 'N'")
def specimen_join(s, d):
    lines = table(s, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.nullif("l_returnflag", F.lit("N")).alias("described"))
    return derive.with_specimen(table(s, d, "orders").select("o_orderkey"), lines, ["o_orderkey"], ["described"])


@P.add("SELECT p_brand, p_type, min('{\"name\":\"' || p_name || '\"}') AS meta FROM part GROUP BY ALL")
def distinct_with_maps(s, d):
    rows = table(s, d, "part").select("p_brand", "p_type", F.create_map(F.lit("name"), F.col("p_name")).alias("meta"))
    return derive.once_by_others(rows, ["meta"]).withColumn("meta", F.to_json("meta"))


@P.add("SELECT c_custkey, n_name, n_regionkey FROM customer RIGHT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 9000")
def right_outer_lookup(s, d):
    rich = table(s, d, "customer").filter("c_acctbal > 9000").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    return rich.join(table(s, d, "nation"), "n_nationkey", "right").select("c_custkey", "n_name", "n_regionkey")


@P.add("SELECT l_orderkey, l_linenumber, CASE WHEN o_orderkey IS NOT NULL THEN sha256(concat_ws('|', o_custkey::varchar, o_orderkey::varchar)) END AS original_hash FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderkey % 11 <> 0")
def add_hash_lookup(s, d):
    """The hash of the original row joined to all that came of it; keys are checked before, the number of rows after."""
    orders = table(s, d, "orders").filter("o_orderkey % 11 <> 0").select("o_orderkey", "o_custkey")
    hashed = orders.select(F.col("o_orderkey").alias("l_orderkey"), key_hash(orders, ["o_orderkey", "o_custkey"]).alias("original_hash"))
    return joins.guarded_left(table(s, d, "lineitem").select("l_orderkey", "l_linenumber"), hashed, ["l_orderkey"])


@P.add("SELECT (length(l) - length(replace(l, ',', '')) + 1)::bigint AS n_columns, count(*) AS n_lines FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents) GROUP BY 1")
def text_columns_by_line(s, d):
    return quality.columns_by_line(table(s, d, "documents"), "text", ",")


@P.add("SELECT c_custkey AS entity_id, CASE WHEN c_acctbal < -500 THEN trunc((1700000000 - (c_custkey % 20000) * 86400) / 31536000)::bigint END AS age FROM customer WHERE c_acctbal < 0")
def death_filter(s, d):
    """The deceased with their age at death, where its time is known."""
    c = table(s, d, "customer").select(F.col("c_custkey").alias("entity_id"), (F.col("c_acctbal") < 0).alias("deceased"), F.when(F.col("c_acctbal") < -500, 1_700_000_000).cast("bigint").alias("death_ts"), (F.col("c_custkey") % 20_000 * 86_400).alias("birth_ts"))
    return derive.deaths(c, "entity_id", "deceased", "death_ts", "birth_ts")


EVENT_TEST = f"(SELECT user_id AS entity, {TS} AS z, CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END AS flag, 's' || (event_id % 4) AS site FROM events)"
EVENT_STAYS = f"(SELECT user_id AS entity, {TS} + 43200 AS a, {TS} + 43200 + (event_id % 5) * 86400 AS b, CASE WHEN event_id % 2 = 0 THEN 'icu' WHEN event_id % 3 = 0 THEN 'home' ELSE 'ward' END AS kind FROM events WHERE event_type IN ('login', 'view'))"


def _summary_sql(first: str, stays: str, since: str) -> str:
    return f"""WITH f AS ({first}), s AS (SELECT entity, z, greatest(z, a) AS g, b // 86400 - greatest(z, a) // 86400 AS days, kind FROM f JOIN {stays} s USING (entity) WHERE b > z AND a < b),
g AS (SELECT entity, z, g, max(days) AS days, max(CASE WHEN kind = 'icu' THEN days ELSE 0 END) AS icu_days FROM s GROUP BY ALL), r AS (SELECT entity, z, min(g) AS first_start, count(*) AS n_stays, sum(days)::bigint AS days, sum(icu_days)::bigint AS icu_days FROM g GROUP BY ALL),
p AS (SELECT DISTINCT user_id AS entity, 1704067200 + (user_id % 40) * 86400 AS death_ts FROM events WHERE user_id % 3 = 0)
SELECT entity, flag, z AS at_ts, site, first_start, coalesce(n_stays, 0) AS n_stays, coalesce(days, 0)::bigint AS days, coalesce(icu_days, 0)::bigint AS icu_days, CASE WHEN coalesce(icu_days, 0) > 0 THEN 'Y' ELSE 'N' END AS has_icu_days, CASE WHEN death_ts > {since} THEN 'Y' ELSE 'N' END AS deceased FROM f LEFT JOIN r USING (entity, z) LEFT JOIN p USING (entity)"""


def _summary(s, d, **how):
    e = events(s, d)
    tests = e.select(F.col("user_id").alias("entity"), F.col("t").alias("at"), F.when(F.col("event_type") == "purchase", "Detected").otherwise("negative").alias("result"), F.concat(F.lit("s"), (F.col("event_id") % 4).cast("string")).alias("site"))
    k = F.col("event_id")
    stays = e.filter("event_type in ('login', 'view')").select(F.col("user_id").alias("entity"), (F.col("t") + 43_200).alias("start_ts"), (F.col("t") + 43_200 + k % 5 * 86_400).alias("end_ts"), F.when(k % 2 == 0, "icu").when(k % 3 == 0, "home").otherwise("ward").alias("kind"))
    people = e.filter("user_id % 3 = 0").select(F.col("user_id").alias("entity"), (F.lit(1_704_067_200) + F.col("user_id") % 40 * 86_400).alias("death_ts")).distinct()
    return derive.positive_summary(tests, stays, people, "entity", {"icu": "icu_days"}, **how).withColumnRenamed("at", "at_ts")


@P.add(_summary_sql(f"SELECT entity, min((flag = 'N', z, flag, site))[2] AS z, min((flag = 'N', z, flag, site))[3] AS flag, min((flag = 'N', z, flag, site))[4] AS site FROM {EVENT_TEST} GROUP BY 1", EVENT_STAYS, "first_start"))
def positive_summary(s, d):
    return _summary(s, d)


@P.add(_summary_sql(f"SELECT entity, z, min((flag = 'N', flag, site))[2] AS flag, min((flag = 'N', flag, site))[3] AS site FROM {EVENT_TEST} GROUP BY 1, 2", f"(SELECT * FROM {EVENT_STAYS} WHERE kind <> 'home')", "z"))
def positive_summary_every_test(s, d):
    return _summary(s, d, every_test=True, left_out="home")


@P.add("SELECT 'lab' AS family, o_orderkey::varchar AS row_id, o_orderstatus AS value, NULL::varchar AS unit FROM orders UNION ALL SELECT 'flow', c_custkey::varchar, c_mktsegment, 'u' FROM customer")
def harmonised_union(s, d):
    lab = table(s, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_orderstatus").alias("value"))
    flow = table(s, d, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("value"), F.lit("u").alias("unit"))
    return derive.harmonised({"lab": lab, "flow": flow}, ["row_id", "value", "unit"])


@P.add("""WITH d AS (SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN NULL WHEN p_size % 3 = 1 THEN p_brand ELSE p_brand || ' , ' || p_type END AS code, p_name, p_type FROM part), x AS (SELECT p_partkey, 'PART' AS source_table, unnest(coalesce(string_split_regex(code, '\\s*,\\s*'), [NULL])) AS code, CASE WHEN code IS NOT NULL THEN 'ICD' END AS vocabulary, p_name, p_type FROM d)
SELECT DISTINCT x.p_partkey, source_table, code, vocabulary, n AS record_count, e AS entity_count, '{"descriptions":{"p_name":"' || p_name || '"},"other_fields":{"p_type":"' || p_type || '"}}' AS meta FROM x LEFT JOIN (SELECT l_partkey, count(*) AS n, count(DISTINCT l_suppkey) AS e FROM lineitem GROUP BY 1) ON l_partkey = x.p_partkey""")
def concept_meta(s, d):
    """Parts as concepts, given twice, with up to two codes; counted in the line items."""
    z = F.col("p_size")
    p = table(s, d, "part").select("p_partkey", "p_name", "p_type", F.when(z % 3 == 1, F.col("p_brand")).when(z % 3 == 2, F.concat_ws(" , ", "p_brand", "p_type")).alias("code"), F.lit("ICD").alias("vocabulary"))
    facts = table(s, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    return derive.concept_meta(p.unionByName(p), facts, "p_partkey", "l_suppkey", ["p_name"], ["p_type"], "code", constants={"source_table": "PART"}).withColumn("meta", F.to_json("meta"))


@P.add("""WITH o AS (SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_size <= 20 GROUP BY ALL), w AS (SELECT p_brand, p_type, count(*) AS n FROM part WHERE p_size > 20 GROUP BY ALL), i AS (SELECT p_brand, p_type, 4000000000 + row_number() OVER (ORDER BY p_brand, p_type) AS id FROM o),
j AS (SELECT * FROM i UNION ALL SELECT p_brand, p_type, (SELECT max(id) FROM i) + row_number() OVER (ORDER BY p_brand, p_type) FROM w ANTI JOIN i USING (p_brand, p_type))
SELECT id, p_brand, p_type, (coalesce(o.n, 0) + coalesce(w.n, 0))::bigint AS n FROM j LEFT JOIN o USING (p_brand, p_type) LEFT JOIN w USING (p_brand, p_type)""")
def concept_accumulate(s, d):
    counted = lambda where: table(s, d, "part").filter(where).groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    none = s.createDataFrame([], "id bigint, p_brand string, p_type string, n bigint")
    first = derive.accumulate_counts(none, counted("p_size <= 20"), ["p_brand", "p_type"], ["n"], "id")
    return derive.accumulate_counts(first, counted("p_size > 20"), ["p_brand", "p_type"], ["n"], "id")


@P.add(f"""WITH x AS (SELECT event_id, user_id % 9 AS entity_id, event_id % 30 AS sentence_index, (['Has_Disease', 'Therapeutic', 'Other'])[event_id % 3 + 1] AS prediction_type, 'e' || (event_id % 5) AS entity_1, CASE WHEN event_id % 4 <> 0 THEN 'f' || (user_id % 7) END AS entity_2, CASE WHEN event_id % 11 = 0 THEN 1988150400 ELSE {TS} * 20 - 32500000000 + event_id END AS p, '{{"id":"' || event_id || '"}}' AS meta FROM events),
t AS (SELECT *, CASE WHEN p > -2209008070 AND p <= 1988150399 THEN p END AS z FROM x)
SELECT event_id, entity_id, sentence_index, prediction_type, entity_1, entity_2, meta, CASE prediction_type WHEN 'Has_Disease' THEN 'Sentiments' WHEN 'Therapeutic' THEN 'Associations' ELSE '' END AS model_type, z AS at_ts, dense_rank() OVER (ORDER BY entity_1) AS entity_1_id, CASE WHEN entity_2 IS NOT NULL THEN dense_rank() OVER (ORDER BY entity_2 NULLS LAST) END AS entity_2_id,
 row_number() OVER (PARTITION BY entity_id, entity_1, entity_2, sentence_index ORDER BY z NULLS FIRST, meta) > 1 AS is_duplicate FROM t""")
def text_associations(s, d):
    e, text = events(s, d), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    u, k = F.col("user_id"), F.col("event_id")
    said = e.select("event_id", (u % 9).alias("entity_id"), (k % 30).alias("sentence_index"), F.get(F.array(*map(F.lit, ("Has_Disease", "Therapeutic", "Other"))), (k % 3).cast("int")).alias("prediction_type"), text("e", k % 5).alias("entity_1"), F.when(k % 4 != 0, text("f", u % 7)).alias("entity_2"), F.when(k % 11 == 0, 1_988_150_400).otherwise(F.col("t") * 20 - 32_500_000_000 + k).alias("published_ts"), F.concat(F.lit('{"id":"'), k.cast("string"), F.lit('"}')).alias("meta"))
    return derive.text_associations(said).withColumn("meta", F.to_json("meta"))


@P.add("SELECT o_orderkey, o_orderkey || '/' || o_custkey AS sentence_indexes FROM orders")
def note_sentences(s, d):
    notes = table(s, d, "orders").select("o_orderkey", F.concat_ws("|", "o_orderkey", F.lit("x"), "o_custkey").alias("indexes"))
    return derive.note_sentences(notes, "o_orderkey", "indexes").withColumn("sentence_indexes", F.array_join(F.transform("sentence_indexes", lambda x: x.cast("string")), "/"))


@P.add("""SELECT l_orderkey, l_linenumber, CASE WHEN l_shipmode LIKE '%AIR%' THEN 'air' WHEN l_returnflag = 'R' THEN l_shipmode ELSE l_linestatus END AS code, CASE WHEN l_shipmode LIKE '%AIR%' THEN 'by air' WHEN l_returnflag = 'R' THEN nullif(l_shipmode, 'RAIL') ELSE l_linestatus END AS description, coalesce(CASE WHEN l_linenumber <> 3 THEN l_orderkey END, -1) AS at_ts FROM (SELECT *, 'RAIL' AS l_shipmode FROM lineitem WHERE l_linenumber % 2 = 0 UNION ALL SELECT *, 'REG AIR' FROM lineitem WHERE l_linenumber % 2 = 1 AND l_linenumber <> 5 UNION ALL SELECT *, 'SHIP' FROM lineitem WHERE l_linenumber = 5) WHERE description IS NOT NULL""")
def catalogue_codes(s, d):
    n, mode = F.col("l_linenumber"), F.col("mode")
    lines = table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.when(n % 2 == 0, "RAIL").when(n == 5, "SHIP").otherwise("REG AIR").alias("mode"), F.when(n != 3, F.col("l_orderkey")).alias("at_ts"))
    rules = [(mode.contains("AIR"), F.lit("air"), F.lit("by air")), (F.col("l_returnflag") == "R", mode, F.nullif(mode, F.lit("RAIL"))), (F.lit(True), F.col("l_linestatus"), F.col("l_linestatus"))]
    return derive.catalogue_code(lines, rules, "at_ts", -1).select("l_orderkey", "l_linenumber", "code", "description", "at_ts")


@P.add("SELECT count(*) AS n, count(*) FILTER (c_custkey % 4 = 0) AS added, count(*) FILTER (c_custkey % 4 <> 0 AND c_custkey % 11 = 0) AS changed, 0::bigint AS collisions FROM customer")
def identity_counters(s, d):
    new = identity(s, d)
    old = table(s, d, "customer").filter("c_custkey % 4 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 11 == 0, "was").otherwise(F.col("c_name")).alias("c_name"))
    return pipelines.identity_counters(old, new, "c_custkey", "c_name")


@P.add("""WITH v AS (SELECT sha256(o_orderkey::varchar) AS key_hash, o_custkey % 100 AS entity_id, o_custkey AS key_id, o_orderkey FROM orders), m AS (SELECT key_hash, entity_id, key_id, row_number() OVER (PARTITION BY entity_id ORDER BY key_hash) AS fact_id, row_number() OVER (PARTITION BY key_id ORDER BY key_hash) AS fact_key_id FROM v WHERE o_orderkey % 10 <> 3),
d AS (SELECT v.key_hash, v.entity_id, v.key_id, m.fact_id AS f, m.fact_key_id AS k, coalesce((SELECT max(fact_id) FROM m x WHERE x.entity_id = v.entity_id), 0) AS tf, coalesce((SELECT max(fact_key_id) FROM m x WHERE x.key_id = v.key_id), 0) AS tk FROM v LEFT JOIN m ON m.key_hash = v.key_hash)
SELECT key_hash, fact_id::bigint AS fact_id, fact_key_id::bigint AS fact_key_id, 1::bigint AS valid_from, 2::bigint AS superseded_by FROM m UNION ALL SELECT key_hash, coalesce(f, tf + row_number() OVER (PARTITION BY entity_id, f IS NULL ORDER BY key_hash)), coalesce(k, tk + row_number() OVER (PARTITION BY key_id, k IS NULL ORDER BY key_hash)), 2, 0 FROM d""")
def fact_stamp_full(s, d):
    """A full delivery: all old rows are superseded, whether they come again or not."""
    rows = table(s, d, "orders").select(F.sha2(F.col("o_orderkey").cast("string"), 256).alias("key_hash"), (F.col("o_custkey") % 100).alias("entity_id"), F.col("o_custkey").alias("key_id"), "o_orderkey")
    none = s.createDataFrame([], "key_hash string, entity_id bigint, key_id bigint, fact_id bigint, fact_key_id bigint, valid_from bigint, superseded_by bigint")
    known = versioning.stamp_facts(rows.filter("o_orderkey % 10 <> 3").drop("o_orderkey"), none, none.select("key_id"), 1, 5).drop("guid")
    return versioning.stamp_facts(rows.drop("o_orderkey"), cut(known), none.select("key_id"), 2, 5, full=True).select("key_hash", "fact_id", "fact_key_id", "valid_from", "superseded_by")


@P.add("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def global_order(s, d):
    """A total order as a number: ranges are sorted by themselves and shifted."""
    from ..operators.ids import number_globally

    o = table(s, d, "orders").select("o_orderkey", F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey").alias("by"))
    return number_globally(o, "by", "place").select("by.o_orderkey", "place")
