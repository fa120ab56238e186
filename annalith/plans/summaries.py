"""Profiles, sequences and summary tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive, quality, sequences
from ..operators.ids import extend_dictionary
from ..operators.normalize import age_years, seconds
from ..session import table
from ..streaming import events as streams
from .registry import Plans
from .scalars import POINTS, STAYS, points, stays

P = Plans()
QUERIES, SQL = P.queries, P.sql
TS = "epoch_us(ts) // 1000000"


def events(s, d):
    return table(s, d, "events").withColumn("t", seconds(F.col("ts")))


@P.add("SELECT event_type AS value, count(DISTINCT user_id) AS n_entities, count(*) AS n_rows FROM events GROUP BY 1")
def value_counts(s, d):
    return quality.value_counts(table(s, d, "events"), "event_type", "user_id")


@P.add("""WITH b AS (SELECT unnest([1, 5]) AS b UNION SELECT s * (10 ** e)::bigint FROM range(1, 11) r(s), range(1, 8) q(e)), n AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT bucket, count(*) AS n_entities FROM (SELECT user_id, max(b)::bigint AS bucket FROM n JOIN b ON b <= n GROUP BY 1) GROUP BY 1""")
def log_bucket_hist(s, d):
    return quality.log_histogram(table(s, d, "events"), "user_id")


@P.add("""SELECT user_id, string_agg(d::varchar || ':' || c::varchar, ',' ORDER BY d) AS days, sum(c)::bigint AS total FROM (SELECT user_id, ts::date AS d, count(*) AS c FROM events GROUP BY ALL) GROUP BY 1""")
def day_count_strings(s, d):
    return quality.day_strings(table(s, d, "events"), "user_id", F.col("ts").cast("date"))


@P.add("""WITH c AS (SELECT event_type, user_id % 5 AS g, ts::date::varchar AS d, count(*) AS c FROM events GROUP BY ALL), i AS (SELECT event_type, g, '{' || string_agg('"' || d || '":' || c, ',' ORDER BY d) || '}' AS j FROM c GROUP BY ALL)
SELECT event_type, '{' || string_agg('"' || g || '":' || j, ',' ORDER BY g) || '}' AS days FROM i GROUP BY 1""")
def nested_date_json(s, d):
    e = table(s, d, "events").withColumn("g", (F.col("user_id") % 5).cast("string"))
    return quality.nested_days(e, "event_type", "g", F.col("ts").cast("date")).withColumnRenamed("raw", "days")


@P.add("SELECT o_orderpriority AS value, count(DISTINCT o_custkey) AS n_entities, count(*) AS n_rows FROM orders GROUP BY 1")
def code_counts(s, d):
    return quality.value_counts(table(s, d, "orders"), "o_orderpriority", "o_custkey")


@P.add("""WITH e AS (SELECT o_custkey AS e, year(o_orderdate)::bigint AS y FROM orders), f AS (SELECT y, count(*) AS n_first FROM (SELECT e, min(y) AS y FROM e GROUP BY 1) GROUP BY 1)
SELECT e.y AS year, count(*) AS n_rows, count(DISTINCT e) AS n_entities, coalesce(any_value(n_first), 0) AS n_first FROM e LEFT JOIN f ON e.y = f.y GROUP BY 1 UNION ALL SELECT 0, count(*), count(DISTINCT e), count(DISTINCT e) FROM e""")
def year_cohorts(s, d):
    return quality.year_cohorts(table(s, d, "orders"), "o_custkey", F.year("o_orderdate"))


OBSERVED = f"SELECT user_id AS entity, 'events' AS source, min({TS}) AS first_ts, max({TS}) AS last_ts FROM events GROUP BY 1 UNION ALL SELECT o_custkey, 'orders', min(epoch_us(o_orderdate) // 1000000), max(epoch_us(o_orderdate) // 1000000) FROM orders GROUP BY 1"


@P.add(f"WITH u AS ({OBSERVED}) SELECT * FROM u UNION ALL SELECT entity, 'ALL_TABLES', min(first_ts), max(last_ts) FROM u GROUP BY 1")
def observed_range_rollup(s, d):
    orders = table(s, d, "orders").select(F.col("o_custkey").alias("user_id"), seconds(F.col("o_orderdate")).alias("t"))
    return quality.observed_range({"events": events(s, d), "orders": orders}, "user_id", "t")


@P.add("SELECT row_number() OVER (ORDER BY p_brand || '|' || p_type) AS concept_id, p_brand || '|' || p_type AS concept FROM (SELECT DISTINCT p_brand, p_type FROM part)")
def concept_dim(s, d):
    rows = derive.concept_rows(table(s, d, "part"), ["p_brand", "p_type"]).select(F.concat_ws("|", "p_brand", "p_type").alias("concept"))
    return extend_dictionary(s.createDataFrame([], "concept_id bigint, concept string"), rows, "concept", "concept_id")


@P.add("SELECT user_id || '/' || ts::date AS user_day, CASE WHEN count(DISTINCT event_type) > 1 THEN 'MULTI-' || string_agg(DISTINCT event_type, '|' ORDER BY event_type) ELSE any_value(event_type) END AS event_type FROM events GROUP BY 1")
def multi_category_merge(s, d):
    day = F.concat_ws("/", F.col("user_id").cast("string"), F.col("ts").cast("date").cast("string"))
    return derive.merged_category(table(s, d, "events").select(day.alias("user_day"), "event_type"), "user_day", "event_type")


@P.add(f"SELECT o_orderkey, trunc((epoch_us(o_orderdate) // 1000000 - c_custkey * 86400) / 31536000)::bigint AS age FROM orders JOIN customer ON o_custkey = c_custkey")
def add_age_lookup(s, d):
    born = table(s, d, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") * 86_400).alias("birth"))
    return table(s, d, "orders").join(born, "o_custkey").select("o_orderkey", age_years(seconds(F.col("o_orderdate")), F.col("birth")).alias("age"))


FIRST = f"(SELECT user_id, arg_min(flag, (flag = 'N', t)) AS flag, arg_min(t, (flag = 'N', t)) AS at_ts FROM (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END AS flag, {TS} AS t FROM events) GROUP BY 1)"


def _first(s, d):
    e = events(s, d).withColumn("result", F.when(F.col("event_type") == "purchase", "Detected").otherwise("negative"))
    return derive.first_positive(e, "user_id", "t", "result").select(F.col("user_id").alias("entity"), "flag", F.col("at").alias("at_ts"))


@P.add(f"SELECT user_id AS entity, flag, at_ts FROM {FIRST}")
def first_positive_summary(s, d):
    return _first(s, d)


def _rollup_sql(pts: str) -> str:
    return f"""WITH s AS (SELECT entity, at_ts, greatest(at_ts, start_ts) AS f, (end_ts // 86400 - greatest(at_ts, start_ts) // 86400) AS days, kind FROM {pts} p JOIN {STAYS} s USING (entity) WHERE end_ts > at_ts),
g AS (SELECT entity, at_ts, f, max(days) AS days, max(CASE WHEN kind = 'O' THEN days ELSE 0 END) AS o_days FROM s GROUP BY ALL)
SELECT entity, at_ts, min(f) AS first_start, count(*) AS n_stays, sum(days)::bigint AS days, sum(o_days)::bigint AS o_days FROM g GROUP BY ALL"""


@P.add(_rollup_sql("(SELECT entity, at_ts FROM (SELECT o_custkey AS entity, max(epoch_us(o_orderdate) // 1000000) AS at_ts FROM orders GROUP BY 1))"))
def stay_rollup(s, d):
    last = points(s, d).groupBy("entity").agg(F.max("at_ts").alias("at_ts"))
    return derive.stay_days(last, stays(s, d), "entity", "kind", {"O": "o_days"}, at="at_ts")


@P.add(_rollup_sql(f"(SELECT DISTINCT entity, at_ts FROM {POINTS})"))
def per_event_summary(s, d):
    return derive.stay_days(points(s, d).select("entity", "at_ts").distinct(), stays(s, d), "entity", "kind", {"O": "o_days"}, at="at_ts")


@P.add(f"""WITH e AS (SELECT DISTINCT user_id, {TS} AS at_ts, user_id % 3 AS code FROM events WHERE event_type = 'purchase'),
n AS (SELECT *, row_number() OVER w AS nth, coalesce(at_ts - lag(at_ts) OVER w, 0) AS since, string_agg('d' || code, '_') OVER (w ROWS UNBOUNDED PRECEDING) AS names FROM e WINDOW w AS (PARTITION BY user_id ORDER BY at_ts, code))
SELECT user_id, at_ts, nth, since, 'd' || code AS name, names, 'NO' AS completes FROM n UNION ALL SELECT user_id, at_ts + 14 * 86400, nth, NULL, NULL, NULL, 'YES' FROM n WHERE nth = code + 1""")
def dose_sequence(s, d):
    e = events(s, d).filter("event_type = 'purchase'").withColumn("code", F.col("user_id") % 3)
    e = e.select("user_id", F.col("t").alias("at_ts"), "code", F.concat(F.lit("d"), F.col("code").cast("string")).alias("name"), (F.col("code") + 1).alias("needed"))
    return sequences.doses(e, "user_id", "at_ts", "code", "name", "needed").withColumnRenamed("at", "at_ts")


CYCLES = f"""WITH RECURSIVE e AS (SELECT DISTINCT user_id, ({TS} - 1704067200) * 24 AS z, CASE WHEN event_type IN ('login', 'view') THEN 1 WHEN event_type IN ('purchase', 'logout') THEN -1 ELSE 0 END AS tag, CASE WHEN event_id % 3 = 0 THEN 'primary' ELSE 'other' END AS source FROM events),
o AS (SELECT *, row_number() OVER w AS n, coalesce(z - lag(z) OVER w > 172800 OR lag(tag) OVER w = -1, true) AS b, coalesce(lead(z) OVER w - z > 172800 OR lead(tag) OVER w = 1, true) AS f FROM e WINDOW w AS (PARTITION BY user_id ORDER BY z, source, tag)),
q AS (SELECT *, max(CASE WHEN b THEN z END) OVER (PARTITION BY user_id ORDER BY n) AS back, min(CASE WHEN f THEN z END) OVER (PARTITION BY user_id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS forth FROM o),
r AS (SELECT user_id, n, CASE WHEN tag = 1 THEN z END AS s, source AS ss, back AS sb, NULL::bigint AS cb, NULL::bigint AS ce FROM q WHERE n = 1 UNION ALL
 SELECT q.user_id, q.n, CASE WHEN take THEN z WHEN hit THEN NULL ELSE s END, CASE WHEN take THEN source ELSE ss END, CASE WHEN take THEN back ELSE sb END, CASE WHEN hit THEN sb END, CASE WHEN hit THEN forth END FROM
 (SELECT q.*, r.s, r.ss, r.sb, q.tag = 1 AND (r.s IS NULL OR r.ss <> 'primary' OR (q.z - r.s) // 86400 > 30) AS take, q.tag = -1 AND r.s IS NOT NULL AND r.ss = q.source AS hit FROM q JOIN r ON q.user_id = r.user_id AND q.n = r.n + 1) q),
c AS (SELECT user_id, n, cb, ce, sum(CASE WHEN cb <= l THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY n) AS cycle FROM (SELECT *, lag(ce) OVER (PARTITION BY user_id ORDER BY n) AS l FROM r WHERE cb IS NOT NULL))
SELECT user_id, cycle::bigint AS cycle, ((max(ce) - min(cb)) // 86400 + 1)::bigint AS days, min(cb) AS start_ts, max(ce) AS end_ts FROM c GROUP BY user_id, cycle"""


@P.add(CYCLES)
def cycles_state_machine(s, d):
    """A month of events stretched to two years, so that stays last over months without an event."""
    tag = F.when(F.col("event_type").isin("login", "view"), 1).when(F.col("event_type").isin("purchase", "logout"), -1).otherwise(0)
    e = events(s, d).select("user_id", ((F.col("t") - 1_704_067_200) * 24).alias("t"), tag.alias("tag"), F.when(F.col("event_id") % 3 == 0, "primary").otherwise("other").alias("source"))
    return sequences.episodes(e, "user_id", "t", "tag", "source", "primary")


@P.add(f"""WITH g AS (SELECT user_id, t, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t) <= 3600 THEN 0 ELSE 1 END AS b FROM (SELECT user_id, {TS} AS t FROM events)), c AS (SELECT user_id, t, sum(b) OVER (PARTITION BY user_id ORDER BY t) AS cycle FROM g)
SELECT user_id, cycle::bigint AS cycle, ((max(t) - min(t)) // 86400 + 1)::bigint AS days, min(t) AS start_ts, max(t) AS end_ts FROM c GROUP BY ALL""")
def gap_cycles(s, d):
    return sequences.gap_cycles(events(s, d).select("user_id", "t"), "user_id", "t", 3600)


TOKENS = "SELECT l_orderkey AS o, l_partkey % 2 AS g, unnest(string_split(p_name, ' ')) AS t FROM lineitem JOIN part ON l_partkey = p_partkey UNION ALL SELECT o_orderkey, 0, unnest(string_split(replace(o_orderpriority, '-', ' '), ' ')) FROM orders"


@P.add(f"SELECT o, g, string_agg(t, ' ' ORDER BY t) AS tokens, count(*) AS n FROM (SELECT DISTINCT o, g, trim(t) AS t FROM ({TOKENS}) WHERE trim(t) <> '') GROUP BY ALL")
def token_sets_multi_source(s, d):
    parts = table(s, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("tokens"))
    a = table(s, d, "lineitem").select("l_partkey", F.col("l_orderkey").alias("o"), (F.col("l_partkey") % 2).alias("g")).join(parts, "l_partkey").select("o", "g", "tokens")
    b = table(s, d, "orders").select(F.col("o_orderkey").alias("o"), F.lit(0).cast("bigint").alias("g"), F.replace("o_orderpriority", F.lit("-"), F.lit(" ")).alias("tokens"))
    return derive.token_sets([a, b], "o", "g", "tokens", " ")


@P.add("""WITH p AS (SELECT c_custkey % 200 AS e, c_mktsegment AS m, c_nationkey AS n, c_custkey % 5 = 0 AS merged, c_custkey % 2 = 0 AS active FROM customer), f AS (SELECT e, min(CASE WHEN NOT merged THEN m || '|' || n END) < max(CASE WHEN NOT merged THEN m || '|' || n END) AS c,
 min(CASE WHEN active THEN m || '|' || n END) < max(CASE WHEN active THEN m || '|' || n END) AS y, min((merged, m, n)) AS r FROM p GROUP BY 1) SELECT e, r[2] AS m, r[3] AS n, CASE WHEN coalesce(c, false) THEN 'C' WHEN coalesce(y, false) THEN 'Y' ELSE 'N' END AS conflict FROM f""")
def conflict_flags(s, d):
    k = F.col("c_custkey")
    rows = table(s, d, "customer").select((k % 200).alias("e"), F.col("c_mktsegment").alias("m"), F.col("c_nationkey").alias("n"), F.when(k % 5 == 0, "Y").otherwise("N").alias("merged"), (k % 2 == 0).alias("active"))
    return derive.conflicts(rows, "e", "merged", F.col("active"), ["m", "n"])


@P.add("""SELECT user_id, first(nullif(event_type, 'click') ORDER BY event_id) FILTER (nullif(event_type, 'click') IS NOT NULL) AS kind, first(CASE WHEN event_id % 3 = 0 THEN event_id END ORDER BY event_id) FILTER (event_id % 3 = 0) AS id FROM events GROUP BY 1""")
def first_nonnull_consolidate(s, d):
    e = table(s, d, "events").select("user_id", "event_id", F.nullif("event_type", F.lit("click")).alias("kind"), F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("id"))
    return sequences.first_values(e.withColumn("o", F.col("event_id")), ["user_id"], ["o"], ["kind", "id"])


@P.add("SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) > 1 THEN '{' || string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) || '}' ELSE any_value(o_orderpriority) END AS priorities FROM orders GROUP BY 1")
def profile_sets_string(s, d):
    return table(s, d, "orders").groupBy("o_custkey").agg(derive.braced_set(F.col("o_orderpriority")).alias("priorities"))


@P.add(f"""SELECT event_id FROM (SELECT event_id, event_type = lag(event_type) OVER w AND {TS} // 86400 = lag({TS}) OVER w // 86400 AS same FROM events WINDOW w AS (PARTITION BY user_id ORDER BY {TS}, event_id)) WHERE NOT coalesce(same, false)""")
def change_compression(s, d):
    return sequences.changes_only(events(s, d), ["user_id"], "t", "event_type", ["event_id"]).select("event_id")


RULES = [("click", "_value * 0.5", "true", 0.0, 40.0, "a"), ("view", "_value/4", "false", None, None, "b"), ("purchase", "_value", "true", 10.0, 1000.0, "c")]


@P.add("""WITH r(event_type, f, v, lo, hi, display_name) AS (VALUES ('click', 0.5::double, true, 0.0::double, 40.0::double, 'a'), ('view', 0.25, false, NULL, NULL, 'b'), ('purchase', 1.0, true, 10.0, 1000.0, 'c')), m AS (SELECT event_id, event_type, trunc(value) AS x FROM events WHERE value IS NOT NULL)
SELECT event_id, display_name, x * f AS value FROM m JOIN r USING (event_type) WHERE (NOT v OR x * f BETWEEN lo AND hi) AND (display_name <> 'c' OR x * f <= 60)""")
def measure_harmonise_numeric(s, d):
    rules = s.createDataFrame([(t, "U", f, v, lo, hi, n) for t, f, v, lo, hi, n in RULES], "event_type string, unit string, formula string, is_valid_range string, range_min double, range_max double, display_name string")
    ranges = s.createDataFrame([("c", None, 60.0)], "name string, range_min double, range_max double")
    m = table(s, d, "events").filter("value is not null").select("event_id", "event_type", F.lit(" u ").alias("unit"), F.col("value").cast("bigint").cast("string").alias("result_txt"))
    return derive.harmonise_numbers(m, rules, ["event_type"], ["unit"], ranges).select("event_id", "display_name", "value")


@P.add("SELECT o_orderkey, g AS group_name FROM orders JOIN (VALUES ('F', 'f', 'closed'), ('O', 'o', 'open')) v(s, t, g) ON o_orderstatus = v.s")
def measure_harmonise_categorical(s, d):
    rules = s.createDataFrame([("F", " F", "closed"), ("O", "o ", "open")], "k string, original_token string, group_name string")
    return derive.harmonise_tokens(table(s, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("k"), F.lower("o_orderstatus").alias("result_txt")), rules, ["k"]).select("o_orderkey", "group_name")


@P.add("SELECT p_brand, p_type, n FROM (SELECT p_brand, p_type, count(DISTINCT p_partkey) AS n FROM part GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) = 1")
def mode_code(s, d):
    return derive.modal_value(table(s, d, "part"), "p_brand", "p_type", "p_partkey")


SENTENCES = f"(SELECT user_id % 10 AS entity_id, event_type AS prediction_type, 'd' || (user_id % 4) AS entity_1, 'e' || (event_id % 6) AS entity_2, (event_id % 100) / 100.0::double AS score, 's' || (event_id % 50) AS sentence_hash, {TS} AS published_ts FROM events)"


@P.add(f"""WITH g AS (SELECT * FROM {SENTENCES} WHERE score > 0.8), n AS (SELECT entity_id, prediction_type, entity_1, entity_2, count(DISTINCT sentence_hash) AS n_sentences FROM g GROUP BY ALL HAVING n_sentences >= 2)
SELECT DISTINCT entity_id, prediction_type, entity_1, entity_2, published_ts - published_ts % 86400 AS day_ts, n_sentences FROM g JOIN n USING (entity_id, prediction_type, entity_1, entity_2)""")
def association_matrix(s, d):
    e, text = events(s, d), lambda p, c: F.concat(F.lit(p), c.cast("string"))
    u, k = F.col("user_id"), F.col("event_id")
    rows = e.select((u % 10).alias("entity_id"), F.col("event_type").alias("prediction_type"), text("d", u % 4).alias("entity_1"), text("e", k % 6).alias("entity_2"), ((k % 100) / 100.0).alias("score"), text("s", k % 50).alias("sentence_hash"), F.col("t").alias("published_ts"))
    return derive.associations(rows)


@P.add("SELECT user_id, event_id, n_types FROM events JOIN (SELECT user_id, count(DISTINCT event_type) AS n_types FROM events GROUP BY 1) USING (user_id)")
def window_distinct_count(s, d):
    return derive.running_distinct(table(s, d, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_type", "n_types").select("user_id", "event_id", "n_types")


@P.add("SELECT c_custkey FROM (SELECT c_custkey FROM customer ORDER BY c_custkey LIMIT 20) UNION SELECT c_custkey FROM customer WHERE c_custkey IN (77, 99, 101)")
def sample_topk_union(s, d):
    return derive.top_with_extras(table(s, d, "customer").select("c_custkey"), "c_custkey", 20, [77, 99, 101])


@P.add("SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, event_type, count(*) AS n, count(DISTINCT user_id) AS n_users FROM events GROUP BY ALL")
def tumbling_window(s, d):
    return streams.tumbling(table(s, d, "events"), "ts", "1 hour", ["event_type"], n=F.count("*"), n_users=F.countDistinct("user_id"))


@P.add("""WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 30 minute THEN 0 ELSE 1 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), c AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g)
SELECT min(ts) AS session_start, max(ts) + INTERVAL 30 minute AS session_end, user_id, count(*) AS n FROM c GROUP BY user_id, k""")
def session_window(s, d):
    return streams.sessions(table(s, d, "events"), "ts", "30 minutes", ["user_id"], n=F.count("*"))
