"""Summary tables: positives and stays, token sets, conflicts, categories, harmonised measures, associations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import small
from .blocks import blocked, met, numbered, running
from .ids import number_globally
from .joins import null_safe_join
from .normalize import apply_formula

#: Result texts that are positive.
POSITIVE = ("detected", "positive", "presumptive positive")


def positive_flag(result: Column) -> Column:
    return F.when(F.lower(result).isin(*POSITIVE), "Y").otherwise("N")


def first_positive(tests: DataFrame, entity: str, at: str, result: str) -> DataFrame:
    """(entity, flag, at): the first positive of every entity, else its first negative."""
    flagged = tests.withColumn("flag", positive_flag(F.col(result)))
    first = flagged.groupBy(entity, "flag").agg(F.min(at).alias("at"))
    return first.groupBy(entity).agg(F.min_by(F.struct("flag", "at"), F.when(F.col("flag") == "Y", 0).otherwise(1)).alias("r")).select(entity, "r.flag", "r.at")


def stay_days(points: DataFrame, stays: DataFrame, entity: str, kind: str, kinds: dict[str, str], at: str = "at", start: str = "start_ts", end: str = "end_ts", hot_rows: int | None = None) -> DataFrame:
    """(entity, at, first_start, n_stays, days and days per kind): stays that reach beyond a point, counted from it on. Points without any have no row.

    Of several stays with one start the longest counts, per kind; those begun before the point all start at it.
    One sweep per entity, no product: what stays begun by then still last to is a running maximum of ends, what
    begins later is a running sum backwards over the distinct starts.
    """
    day = lambda c: F.floor(c / 86_400)
    ends = {"all": F.max(end), **{name: F.max(F.when(F.col(kind) == k, F.col(end))) for k, name in kinds.items()}}
    starts = stays.filter(F.col(start) < F.col(end)).groupBy(F.col(entity).alias("e"), F.col(start).alias("t")).agg(*(v.alias(f"end_{n}") for n, v in ends.items()))
    starts = starts.select("e", "t", F.lit(0).alias("asked"), *(f"end_{n}" for n in ends))
    asked = points.select(F.col(entity).alias("e"), F.col(at).alias("t")).distinct().select("e", "t", F.lit(1).alias("asked"), *(F.lit(None).cast("bigint").alias(f"end_{n}") for n in ends))
    both = blocked(starts.unionByName(asked), ["e"], "t", hot_rows)
    begun = running(both, ["e"], ["t", "asked"], {f"lasts_{n}": ("max", F.col(f"end_{n}")) for n in ends})
    own = {n: F.when(F.col(f"end_{n}").isNotNull(), day(F.col(f"end_{n}")) - day(F.col("t"))) for n in ends}
    later = {"next_start": ("last", F.when(F.col("asked") == 0, F.col("t"))), "n_later": ("sum", F.when(F.col("asked") == 0, 1))}
    swept = running(begun, ["e"], ["t", "asked"], later | {f"later_{n}": ("sum", c) for n, c in own.items()}, reverse=True, inclusive=False).filter("asked = 1")
    still = {n: F.when(F.col(f"lasts_{n}") > F.col("t"), day(F.col(f"lasts_{n}")) - day(F.col("t"))) for n in ends}
    lasting = F.col("lasts_all") > F.col("t")
    days = {n: (F.coalesce(still[n], F.lit(0)) + F.coalesce(f"later_{n}", F.lit(0))).cast("bigint") for n in ends}
    n_stays = (F.when(lasting, 1).otherwise(0) + F.coalesce("n_later", F.lit(0))).cast("bigint")
    return swept.select(F.col("e").alias(entity), F.col("t").alias(at), F.when(lasting, F.col("t")).otherwise(F.col("next_start")).alias("first_start"), n_stays.alias("n_stays"), days["all"].alias("days"), *(days[n].alias(n) for n in kinds.values())).filter("n_stays > 0")


def token_sets(sources: Sequence[DataFrame], entity: str, at: str, tokens: str, separator: str = ",") -> DataFrame:
    """(entity, at, tokens, n): the distinct tokens of all sources in order, joined by the separator.

    One aggregate: repeated texts of a group fold before the shuffle, and texts are split only after it.
    """
    union = sources[0].select(entity, at, tokens)
    for s in sources[1:]:
        union = union.unionByName(s.select(entity, at, tokens))
    grouped = union.groupBy(entity, at).agg(F.collect_set(tokens).alias("texts"))
    split = F.flatten(F.transform("texts", lambda x: F.split(x, separator)))
    each = F.array_sort(F.array_distinct(F.filter(F.transform(split, lambda t: F.trim(t)), lambda t: t != "")))
    return grouped.withColumn("each", each).filter(F.size("each") > 0).select(entity, at, F.array_join("each", separator).alias(tokens), F.size("each").cast("bigint").alias("n"))


def conflicts(profiles: DataFrame, entity: str, merged: str, active: Column, columns: Sequence[str]) -> DataFrame:
    """One row per entity with conflict 'C' (rows that were never merged differ over all versions), 'Y' (only active ones differ) or 'N'.

    The row is the least of the rows not merged, or of the merged ones for entities that have no other.
    """
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns))
    rows = profiles.withColumns({"__h": text, "__m": F.col(merged) == "Y", "__a": active})
    span = lambda keep: F.min(F.when(keep, F.col("__h"))) < F.max(F.when(keep, F.col("__h")))
    own = F.struct("__m", *columns)
    out = rows.groupBy(entity).agg(span(~F.col("__m")).alias("c"), span(F.col("__a")).alias("y"), F.min(own).alias("r"))
    flag = F.when(F.coalesce("c", F.lit(False)), "C").when(F.coalesce("y", F.lit(False)), "Y").otherwise("N")
    return out.select(entity, *(f"r.{c}" for c in columns), flag.alias("conflict"))


def merged_category(df: DataFrame, entity: str, category: str, prefix: str = "MULTI-") -> DataFrame:
    """(entity, category): the single category, or the prefix and all distinct ones in order."""
    sets = df.filter(F.col(category).isNotNull()).groupBy(entity).agg(F.array_sort(F.collect_set(category)).alias("s"))
    return sets.select(entity, F.when(F.size("s") > 1, F.concat(F.lit(prefix), F.array_join("s", "|"))).otherwise(F.get("s", F.lit(0))).alias(category))


def braced_set(c: Column) -> Column:
    """Aggregate: distinct non-null values, '{a|b}' if several, the value if one, null if none."""
    s = F.array_sort(F.collect_set(c))
    return F.when(F.size(s) > 1, F.concat(F.lit("{"), F.array_join(s, "|"), F.lit("}"))).otherwise(F.get(s, F.lit(0)))


def modal_value(df: DataFrame, by: str, value: str, entity: str) -> DataFrame:
    """(by, value, n): the value with most distinct entities; ties go to the lesser value."""
    counts = df.groupBy(by, value).agg(F.countDistinct(entity).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("b")
    return counts.groupBy(by).agg(best).select(by, F.col("b.v").alias(value), (-F.col("b.m")).alias("n"))


def harmonise_numbers(measures: DataFrame, rules: DataFrame, key: Sequence[str], attributes: Sequence[str], ranges: DataFrame | None = None, name: str = "display_name") -> DataFrame:
    """Measures with a rule for their key (equal) and attributes (null-safe): the number, converted by the rule's formula and within its range.

    Texts that are no numbers are dropped. A rule restricts to range_min..range_max if is_valid_range is
    'true'; then a custom range of the rule's name holds, if there is one.
    """
    low = lambda df: df.withColumns({c: F.lower(F.trim(F.col(c).cast("string"))) for c in attributes})
    joined = null_safe_join(low(measures), low(rules), [*key, *attributes], "inner").filter(" and ".join(f"{k} is not null" for k in key))
    number = F.round(F.col("result_txt").try_cast("double"), 2)
    out = joined.withColumn("value", apply_formula(number, F.col("formula"))).filter("value is not null")
    out = out.filter((F.col("is_valid_range") != "true") | F.col("value").between(F.col("range_min"), F.col("range_max")))
    if ranges is not None:
        limits = ranges.select(F.col("name").alias(name), F.col("range_min").alias("__lo"), F.col("range_max").alias("__hi"))
        out = out.join(small(limits), name, "left").filter("(__lo is null or value >= __lo) and (__hi is null or value <= __hi)").drop("__lo", "__hi")
    return out


def harmonise_tokens(measures: DataFrame, rules: DataFrame, key: Sequence[str]) -> DataFrame:
    """Measures whose result text equals a rule's token (trimmed, without case): the rule's group."""
    fold = lambda df, c: df.withColumn("__t", F.lower(F.trim(F.col(c))))
    return fold(measures, "result_txt").join(fold(rules, "original_token"), [*key, "__t"]).drop("__t")


def associations(sentences: DataFrame, least_score: float = 0.8, least_sentences: int = 2, span: tuple[int, int] = (-2_209_008_070, 1_988_150_399)) -> DataFrame:
    """(entity_id, prediction_type, entity_1, entity_2, day_ts, n_sentences): pairs that enough different sentences of high score support.

    Times outside the span are null; days are floored.
    """
    good = sentences.filter(F.col("score") > least_score)
    ts = F.when((F.col("published_ts") > span[0]) & (F.col("published_ts") <= span[1]), F.col("published_ts"))
    pair = ["entity_id", "prediction_type", "entity_1", "entity_2"]
    support = good.groupBy(*pair).agg(F.countDistinct("sentence_hash").alias("n_sentences")).filter(F.col("n_sentences") >= least_sentences)
    days = good.select(*pair, (ts - F.pmod(ts, F.lit(86_400))).alias("day_ts")).distinct()
    return days.join(support, pair)


def concept_rows(df: DataFrame, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """Distinct combinations, without those of ``known``."""
    out = df.select(*columns).distinct()
    return out if known is None else out.join(known.select(*columns), list(columns), "left_anti")


def accumulated(versions: Sequence[DataFrame], columns: Sequence[str], version: str = "version") -> DataFrame:
    """All rows of a bridge over its versions, each once with its first version."""
    union = versions[0]
    for v in versions[1:]:
        union = union.unionByName(v)
    return union.groupBy(*columns).agg(F.min(version).alias(version))


def top_with_extras(df: DataFrame, key: str, n: int, extras: Sequence[object]) -> DataFrame:
    """A sample of entities: the n least by key, and the named ones."""
    return df.orderBy(key).limit(n).unionByName(df.filter(F.col(key).isin(*extras))).distinct()


def running_distinct(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct non-null values per group on every row; they fold to one number per group before they meet the rows."""
    counts = df.groupBy(*by).agg(F.countDistinct(value).alias("__n"))
    return met(df, counts, by).select(*df.columns, F.col("__n").cast("bigint").alias(out))


def hospital_events(stays: DataFrame, procedures: DataFrame, entity: str, tags: dict[str, str], primary: str = "ADT", secondary: str = "PROCEDURE") -> DataFrame:
    """(entity, at, tag, type, source): admissions and discharges of stays, and procedures by the tag of their code, each once.

    stays: entity, admit_ts, discharge_ts, type. procedures: entity, at, code; codes without a tag are left out.
    """
    side = lambda at, tag: stays.select(entity, F.col(at).alias("at"), F.lit(tag).alias("tag"), "type", F.lit(primary).alias("source")).dropna()
    table = F.create_map(*(F.lit(x) for pair in tags.items() for x in pair))
    other = procedures.select(entity, "at", F.element_at(table, F.col("code")).alias("tag"), F.col("code").alias("type"), F.lit(secondary).alias("source")).filter("tag is not null")
    union = side("admit_ts", "initial hospital").unionByName(side("discharge_ts", "discharge")).unionByName(other)
    return union.groupBy(entity, "at", "tag", "source").agg(F.min("type").alias("type")).select(entity, "at", "tag", "type", "source")


#: Tags of events as the episode rules count them.
EPISODE_TAGS = {"initial hospital": 1, "subsequent hospital": 0, "discharge": -1}


def tagged(events: DataFrame) -> DataFrame:
    """Events whose tag counts for episodes, with it as a number."""
    table = F.create_map(*(F.lit(x) for pair in EPISODE_TAGS.items() for x in pair))
    return events.withColumn("tag", F.element_at(table, F.col("tag"))).filter("tag is not null")


def with_ages(cycles: DataFrame, births: DataFrame, entity: str) -> DataFrame:
    """Cycles with the ages at start and end, in years of 365.25 days; births: entity, birth (a date)."""
    age = lambda at: (F.datediff(F.timestamp_seconds(at).cast("date"), F.col("birth")) / 365.25).cast("int")
    return cycles.join(small(births), entity, "left").withColumns({"start_age": age("start_ts"), "end_age": age("end_ts")}).drop("birth")


#: Prediction types by the role of their second entity.
DRUG_TYPES = ("Therapeutic", "Adverse_Event", "Potential_Adverse_Event")
STAGE_TYPES = ("Disease_Stage",)
MARKER_TYPES = ("Negative_For_Biomarker", "Positive_For_Biomarker")
DISEASE_TYPES = ("Has_Disease",)


def association_facets(sentences: DataFrame, notes: DataFrame, least_score: float = 0.8, least_sentences: int = 2, span: tuple[int, int] = (-2_209_008_070, 1_988_150_399)) -> DataFrame:
    """(entity_id, at_ts, disease, sentiment, drug, drug_relation, stage, marker, marker_relation): diseases of an entity with what the same sentences say of drugs, stages and markers.

    Of drug relations the second entity is the disease, else the first. Pairs need enough different sentences of high
    score. The three facets meet in full joins on sentence and disease. Times outside the span are null, the others are
    floored to the day, and take the first time that ``notes`` (entity_id, at_ts) has of that entity and day, if it has one.
    """
    kinds = [*DISEASE_TYPES, *DRUG_TYPES, *STAGE_TYPES, *MARKER_TYPES]
    good = sentences.filter((F.col("score") > least_score) & F.col("prediction_type").isin(kinds))
    pair = ["entity_id", "prediction_type", "entity_1", "entity_2"]
    support = good.groupBy(*pair).agg(F.countDistinct("sentence_hash").alias("__n")).filter(F.col("__n") >= least_sentences).drop("__n")
    kind = F.col("prediction_type")
    ts = F.when((F.col("published_ts") > span[0]) & (F.col("published_ts") <= span[1]), F.col("published_ts"))
    routed = met(good, support, pair).select("entity_id", (ts - F.pmod(ts, F.lit(86_400))).alias("day_ts"), "sentence_hash", kind, F.when(kind.isin(*DRUG_TYPES), F.col("entity_2")).otherwise(F.col("entity_1")).alias("disease"), F.when(kind.isin(*DRUG_TYPES), F.col("entity_1")).otherwise(F.col("entity_2")).alias("other"))
    facet = lambda types, *columns: routed.filter(kind.isin(*types)).select("sentence_hash", "disease", *columns).distinct()
    drugs = facet(DRUG_TYPES, F.col("other").alias("drug"), kind.alias("drug_relation"))
    stages = facet(STAGE_TYPES, F.col("other").alias("stage"))
    markers = facet(MARKER_TYPES, F.col("other").alias("marker"), F.when(kind == "Positive_For_Biomarker", "Positive").otherwise("Negative").alias("marker_relation"))
    said = drugs.join(stages, ["sentence_hash", "disease"], "full").join(markers, ["sentence_hash", "disease"], "full")
    diseases = routed.filter(kind.isin(*DISEASE_TYPES)).select("entity_id", "day_ts", "sentence_hash", "disease", kind.alias("sentiment")).distinct()
    joined = diseases.join(said, ["sentence_hash", "disease"], "left").drop("sentence_hash").distinct()
    first = notes.groupBy("entity_id", (F.col("at_ts") - F.pmod("at_ts", F.lit(86_400))).alias("day_ts")).agg(F.min("at_ts").alias("__at"))
    timed = met(joined, first, ["entity_id", "day_ts"], "left")
    return timed.select("entity_id", F.coalesce("__at", "day_ts").alias("at_ts"), "disease", "sentiment", "drug", "drug_relation", "stage", "marker", "marker_relation").distinct()


def rule_mapping(entities: DataFrame, variables: DataFrame, derived_type: int, state: int = 4) -> DataFrame:
    """Rules to join measures with: entities that aren't excluded, of variables of a derived type and state; the display name, else the variable's name."""
    good = variables.filter((F.col("derived_type") == derived_type) & (F.col("state") == state))
    joined = entities.filter(~F.coalesce("excluded", F.lit(False))).join(small(good), "variable_id")
    return joined.withColumn("display_name", F.coalesce("display_name", "variable_name")).drop("excluded", "derived_type", "state")


def panels(tests: dict[str, DataFrame], required: Sequence[str], name: str = "test_id") -> DataFrame:
    """The results of all panels with their test id, each row once; rows without the required values are left out. Panels may lack columns."""
    union = None
    for test, df in tests.items():
        one = df.withColumn(name, F.lit(test))
        union = one if union is None else union.unionByName(one, allowMissingColumns=True)
    return union.dropna(subset=list(required)).distinct()


def signal_ids(known: DataFrame, seen: DataFrame, key: Sequence[str], id_col: str) -> DataFrame:
    """(id, key...) of all signals ever seen: old ones keep their id, new ones go on after the greatest in order of the key."""
    from .enrich import refreshed_concepts

    return refreshed_concepts(known, seen.dropna(subset=list(key)), key, id_col)


def with_specimen(facts: DataFrame, specimens: DataFrame, on: Sequence[str], described: Sequence[str]) -> DataFrame:
    """Facts that have a fully described specimen, once for each of its rows."""
    return facts.join(specimens.dropna(subset=[*on, *described]).select(*on), list(on))


def once_by_others(df: DataFrame, payload: Sequence[str]) -> DataFrame:
    """One row for every combination of all columns but the payload, which may be maps or structs that can't be compared; which payload stays is that of the least JSON text."""
    rest = [c for c in df.columns if c not in payload]
    chosen = df.groupBy(*rest).agg(F.min_by(F.struct(*payload), F.to_json(F.struct(*payload))).alias("__p"))
    return chosen.select(*(c if c in rest else F.col(f"__p.{c}").alias(c) for c in df.columns))


def deaths(people: DataFrame, entity: str, deceased: str, at: str, birth: str) -> DataFrame:
    """(entity, age): the deceased, each once, with the age at the earliest time of death; null where none is known."""
    from .normalize import age_years

    return people.filter(deceased).groupBy(entity).agg(F.min(age_years(F.col(at), F.col(birth))).alias("age"))


def positive_summary(tests: DataFrame, stays: DataFrame, people: DataFrame, entity: str, kinds: dict[str, str], every_test: bool = False, left_out: str | None = None) -> DataFrame:
    """(entity, flag, at, site, first_start, days, n_stays, days and has_ flag per kind, deceased): the first positive test of every entity, else its first negative, with the stays after it.

    tests: entity, at, result, site. stays: entity, start_ts, end_ts, kind. people: entity, death_ts. What is missing
    is 'N' or 0; deceased are those who died after their first stay began. ``every_test`` gives a row for each
    test time instead (positive if any test of it is), without stays of the kind ``left_out``; deceased then are those who died after the test.
    """
    flagged = tests.withColumn("flag", positive_flag(F.col("result")))
    best = F.struct(F.when(F.col("flag") == "Y", 0).otherwise(1).alias("o"), "at", "flag", "site")
    by = [entity, "at"] if every_test else [entity]
    first = flagged.groupBy(*by).agg(F.min(best).alias("b")).select(entity, "b.flag", "b.at", "b.site")
    counted = stays.filter(F.col("kind") != left_out) if left_out else stays
    found = stay_days(first.select(entity, "at"), counted, entity, "kind", kinds)
    joined = first.join(found, [entity, "at"], "left").join(people.select(entity, "death_ts"), entity, "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("days", "n_stays", *kinds.values())}
    flags = {f"has_{n}": F.when(F.coalesce(n, F.lit(0)) > 0, "Y").otherwise("N") for n in kinds.values()}
    since = F.col("at") if every_test else F.col("first_start")
    dead = F.when(F.col("death_ts") > since, "Y").otherwise("N")
    return joined.withColumns(zero).withColumns(flags).withColumn("deceased", dead).drop("death_ts")


def harmonised(families: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """All families of harmonised measures with their name as ``family``; numbers are texts too, and columns a family lacks are null."""
    union = None
    for name, df in families.items():
        one = df.withColumn("family", F.lit(name))
        one = one.select("family", *((F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(c) for c in columns))
        union = one if union is None else union.unionByName(one)
    return union


def concept_meta(dim: DataFrame, facts: DataFrame, key: str, entity: str, descriptions: Sequence[str], others: Sequence[str], codes: str | None = None, vocabulary: str = "vocabulary", constants: dict[str, object] | None = None) -> DataFrame:
    """(key, constants, codes, vocabulary, record_count, entity_count, meta): a lookup's rows as concepts, counted in the facts.

    ``meta`` is a struct of two maps of columns. Comma-separated codes become a row each; without a code there is no
    vocabulary. Rows that are equal but for the meta count once.
    """
    text = lambda columns: F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c).cast("string"))))
    rows = dim.withColumns({n: F.lit(v) for n, v in (constants or {}).items()}).withColumn("meta", F.struct(text(descriptions).alias("descriptions"), text(others).alias("other_fields")))
    columns = [key, *(constants or {})]
    if codes:
        rows = rows.withColumn(vocabulary, F.when(F.col(codes).isNotNull(), F.col(vocabulary))).withColumn(codes, F.explode_outer(F.split(codes, r"\s*,\s*")))
        columns += [codes, vocabulary]
    once = once_by_others(rows.select(*columns, "meta"), ["meta"])
    counts = facts.groupBy(key).agg(F.count("*").alias("record_count"), F.countDistinct(entity).alias("entity_count"))
    return once.join(counts, key, "left").select(*columns, "record_count", "entity_count", "meta")


def accumulate_counts(old: DataFrame, new: DataFrame, key: Sequence[str], counts: Sequence[str], id_col: str, first_id: int = 4_000_000_000) -> DataFrame:
    """Concepts with ids and counts over versions: known ones keep their id and add up, new ones go on after the greatest id, from ``first_id`` on."""
    from .enrich import refreshed_concepts

    base = old.select(F.greatest(F.col(id_col), F.lit(first_id)).alias(id_col), *key)
    ids = refreshed_concepts(base, new, key, id_col) if not old.isEmpty() else refreshed_concepts(base, new, key, id_col).withColumn(id_col, F.col(id_col) + F.lit(first_id))
    union = old.select(*key, *counts).unionByName(new.select(*key, *counts))
    return met(union.groupBy(*key).agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in counts)), ids, key).select(id_col, *key, *counts)


#: Prediction types by model.
SENTIMENTS = ("Has_Disease", "May_Have_Disease", "Does_Not_Have_Disease", "Received_Medication", "Family_History_For_Disease", "No_Family_History_For_Disease", "Procedure_Performed")
ASSOCIATIONS = ("Adverse_Event", "Disease_Stage", "Negative_For_Biomarker", "Positive_For_Biomarker", "Potential_Adverse_Event", "Therapeutic", "Associated_Disease_Location", "Associated_Diagnosis_Date", "Gene_Associated_With_Mutation")


def text_associations(sentences: DataFrame, span: tuple[int, int] = (-2_209_008_070, 1_988_150_399)) -> DataFrame:
    """Sentences with model type, sane time, meta as a map, ids of both entities, and whether they repeat an earlier one.

    sentences: entity_id, sentence_index, prediction_type, entity_1, entity_2, published_ts, meta (JSON). Of sentences of
    one entity, pair and index the earliest counts. Ids are dense in order of the names, over all names of a column.
    """
    kind, at = F.col("prediction_type"), F.col("published_ts")
    model = F.when(kind.isin(*SENTIMENTS), "Sentiments").when(kind.isin(*ASSOCIATIONS), "Associations").otherwise("")
    out = sentences.withColumns({"model_type": model, "at_ts": F.when((at > span[0]) & (at <= span[1]), at), "meta": F.from_json("meta", "map<string,string>")}).drop("published_ts")
    for c in ("entity_1", "entity_2"):
        ids = number_globally(sentences.filter(F.col(c).isNotNull()).select(c), c, f"{c}_id")
        out = out.join(small(ids), c, "left")
    out = numbered(out, ["entity_id", "entity_1", "entity_2", "sentence_index"], [F.col("at_ts").asc_nulls_first(), F.to_json("meta").asc()], "__n")
    return out.withColumn("is_duplicate", F.col("__n") > 1).drop("__n")


def note_sentences(notes: DataFrame, note: str, indexes: str) -> DataFrame:
    """(note, sentence_indexes as numbers) from '|'-separated texts; what is no number is left out."""
    return notes.select(note, F.filter(F.transform(F.split(indexes, r"\|"), lambda x: x.try_cast("bigint")), lambda x: x.isNotNull()).alias("sentence_indexes"))


def catalogue_code(df: DataFrame, rules: Sequence[tuple[Column, Column, Column]], at: str, bad_time: int) -> DataFrame:
    """Adds code and description by the first rule (applies, code, description) that applies, and a time where it is missing; rows without description are left out."""
    code = description = F.lit(None).cast("string")
    for applies, c, text in reversed(list(rules)):
        code, description = F.when(applies, c).otherwise(code), F.when(applies, text).otherwise(description)
    coded = df.withColumns({"code": code, "description": description}).filter("description is not null")
    return coded.withColumn(at, F.coalesce(at, F.lit(bad_time)))
