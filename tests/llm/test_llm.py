"""Problems 5, 8, 9 and 10: whole tables against plain Python, held-out accuracy, then the odd cases."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pytest
import tiktoken

from annalith.llm import fusion, leaks, mixing, queries, tokens, truncation

from ..conftest import SF
from ..oracle import compare, connect
from . import brute_llm as brute

AT = datetime(2024, 1, 1, tzinfo=timezone.utc)
DOCS = "doc_id long, text string, source string, block string, n_tokens int"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def read(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


def docs(spark, *given):
    return spark.createDataFrame([(i, t, s, "clash", 1) for i, t, s in given], DOCS)


def test_survivors_of_whole_table(spark):
    assert set(rows(queries.QUERIES["p5_found"](spark, SF))) == brute.p5(read("fact_lab_raw"), read("source_sites"))


@pytest.mark.parametrize("name", queries.SQL)
def test_query(spark, name):
    assert compare(spark, name, queries.QUERIES[name], queries.SQL[name], SF, connect(SF)).startswith("ok")


LAB = "row_id long, key_hash string, result_txt string, unit_of_measure_txt string, normal_range_txt string, specimen_txt string, site_code string, incr_counter int, received_dtm timestamp, best string"


def lab(spark, *given):
    return spark.createDataFrame([(i, k, r, None, " ", "N/A", s, n, AT, "clash") for i, k, r, s, n in given], LAB)


def sites(spark):
    return spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), ("D", 4), ("E", 5), (None, 9)], "site_code string, trust_rank int")


def test_survivor_order_and_odd_rows(spark):
    df = lab(spark, (1, " K ", "x", "B", 9), (2, "k", "y", "A", 1), (3, "k", "unk", "A", 5), (4, "k", "z", None, 99), (5, "one", "x", "A", 1), (6, None, "x", "A", 1), (7, " ", "x", "A", 1), (8, "m", None, "A", 1), (9, "m", None, "B", 1), (10, "n", "x", "?", None), (11, "n", "x", "?", None))
    assert rows(fusion.p5_found(df, sites(spark))) == [("k", "result_txt", 2), ("n", "result_txt", 11)]
    assert rows(fusion.p5_found(df.limit(0), sites(spark))) == [] and rows(fusion.fuse(df.limit(0), sites(spark))) == []


def test_fusion_discounts_copies(spark):
    rng, made, truth = random.Random(3), [], {}
    row = 0
    for k in range(400):
        truth[f"k{k}"] = "t"
        said = {"A": "t" if rng.random() < 0.9 else f"f{rng.randrange(9)}", "B": "t" if rng.random() < 0.9 else f"f{rng.randrange(9)}", "C": "t" if rng.random() < 0.4 else f"f{rng.randrange(9)}"}
        said["D"] = said["E"] = said["C"]  # copies of a bad source
        for s, v in said.items():
            row += 1
            made.append((row, f"k{k}", v, s, 1))
    df = lab(spark, *made)
    fused = {r.key_hash: r.value for r in fusion.fuse(df, sites(spark)).collect()}
    votes = {k: Counter(v for _, kk, v, _, _ in made if kk == k).most_common(1)[0][0] for k in truth}
    right = lambda d: np.mean([d[k] == "t" for k in truth])
    assert right(fused) > 0.85 and right(fused) > right(votes) + 0.2
    found = {r.source: (r.accuracy, r.copies_with, r.dependence) for r in fusion.source_accuracy(df, sites(spark)).collect()}
    assert found["C"][1] in ("D", "E") and found["C"][2] > 0.9 and found["A"][0] > found["C"][0]


def test_fusion_counts_all_values_of_a_hot_key(spark):
    """One source claims 50 values for a key, 40 of them with another; all share the key's probability, and all count as votes."""
    made = [(i, "hot", f"v{i}", "A", 1) for i in range(50)] + [(100 + i, "hot", f"v{i}", "B", 1) for i in range(40)]
    df = lab(spark, *made)
    voted = fusion.claims(df, sites(spark))
    items = fusion.items_of(voted)
    (pattern,) = items.select("pattern").first()
    assert [(e.voters, e.n) for e in pattern] == [([1], 10), ([1, 2], 40)]
    accuracy, _, scored = fusion.estimated(items, 6)
    posterior = {tuple(e.voters): p for r in scored.collect() for e, p in zip(r.pattern, r.posteriors)}
    assert 10 * posterior[1,] + 40 * posterior[1, 2] == pytest.approx(1)
    (best,) = fusion.fuse(df, sites(spark)).collect()
    assert (best.value, best.n_values) == ("v0", 50) and best.posterior == pytest.approx(posterior[1, 2]) and best.posterior <= 1 / 40
    assert accuracy[1] < 0.06 and accuracy[3] == pytest.approx(0.8)  # a source without votes has the prior


def test_fusion_of_very_many_sources(spark):
    """120 sources, half of them right; with the order of trust as prior the posterior stands beside the chosen row."""
    rng, names = random.Random(1), [f"S{k:03d}" for k in range(120)]
    where = spark.createDataFrame([(s, k) for k, s in enumerate(names)], "site_code string, trust_rank int")
    made = [(100 * k + i, f"k{k}", "t" if names.index(s) % 2 else f"f{rng.randrange(20)}", s, 1) for k in range(30) for i, s in enumerate(rng.sample(names, 8))]
    df = lab(spark, *made)
    fused = fusion.fuse(df, where).collect()
    assert len(fused) == 30 and sum(r.value == "t" for r in fused) >= 28
    kept = {r.key_hash: r for r in fusion.survivors(df, where).collect()}
    first = {k: min((r for r in made if r[1] == f"k{k}"), key=lambda r: names.index(r[3])) for k in range(30)}
    assert all(kept[f"k{k}"].row_id == r[0] for k, r in first.items())
    best = {r.key_hash: r.posterior for r in fused}
    assert all(0 < r.posterior <= best[k] + 1e-9 for k, r in kept.items()) and any(r.posterior < 0.5 < best[k] for k, r in kept.items())


def test_leaks_of_whole_table(spark):
    got = rows(queries.QUERIES["p8_found"](spark, SF))
    assert set(got) == brute.p8(read("documents"), read("eval_items")) and len(got) == len(set(got))


def test_leaks_in_odd_texts(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(1, "s", " ".join(words[:40])), (2, "s", " ".join(words[20:60])), (3, "s", "too short"), (4, "s", None), (5, "s", ("a " * 40))], "item_id long, item_set string, text string")
    long = "x " * 60_000 + " ".join(words[22:37]) + " y" * 60_000
    df = docs(spark, (1, " ".join(words[:15]), "s"), (2, " ".join(words[:14]), "s"), (3, long, "s"), (4, None, "s"), (5, "", None), (6, "é" + "__".join(words[3:19]).upper() + "!", "s"), (7, " ".join(words[:7] + ["q"] + words[7:20]), "s"), (8, "a-" * 15, "s"), (8, "a-" * 15, "s"))
    want = [(1, 1), (3, 1), (3, 2), (6, 1), (8, 5)]
    assert rows(leaks.p8_found(df, items)) == want
    monkeypatch.setattr(leaks, "SLICE_CHARS", 10)
    assert rows(leaks.p8_found(df.limit(0), items)) == [] and rows(leaks.p8_found(df, items.limit(0))) == []
    blocks = list(leaks.item_blocks(items, words=20))
    assert max(sum(len(w) for _, w in b) for b in blocks) <= 20 and {i for b in blocks for i, _ in b} == {1, 2, 3, 5}
    monkeypatch.setattr(leaks, "INDEX_WORDS", 20)  # now every item lies in pieces over several blocks
    assert rows(leaks.p8_found(df, items)) == want


@pytest.mark.parametrize("seed", range(6))
def test_wand_finds_all_that_brute_force_scores(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(7)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(15, 60)))) for i in range(60)]
    index = leaks.ItemIndex(items)
    for _ in range(80):
        terms = sorted(rng.sample(range(len(index.keys)), min(len(index.keys), rng.randrange(1, 60))))
        scores = np.zeros(len(index.item_ids))
        for t in terms:
            for i, w in zip(*index.postings(t)[:2]):
                scores[i] += w
        assert index.search(terms) == [i for i in range(len(scores)) if scores[i] >= index.threshold[i]]


def test_token_counts_are_the_tokenizers():
    import base64

    with open(tokens.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    encode = tiktoken.Encoding("t", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    count = tokens.counter()
    odd = ["", " ", "\n\n  x\t", "it's  'LL we'll", "a\x1cb\x1f c", "naïve – 12½", "A" * 5000, "x" + " " * 300 + "\ny", "<|endoftext|>"]
    assert all(count(t) == len(encode(t)) for t in [*odd, *read("documents").text])


def test_mix_reaches_targets(spark):
    found = rows(queries.QUERIES["p9_found"](spark, SF))
    assert found == [("archive_dump",), ("field_station",)]
    mixed = queries.QUERIES["p9_mix"](spark, SF).toPandas()
    d, m = read("documents"), read("mix_targets").set_index("source")
    total = sum(map(tokens.counter(), d.text))
    got = mixed.groupby("source").n_tokens.sum() / total
    caps = mixed.groupby(["source", "doc_id"]).size().groupby("source").max()
    assert all(n <= m.max_repeats[s] for s, n in caps.items()) and not mixed.duplicated(["doc_id", "copy"]).any()
    quota, largest = m.target_share * total, mixed.groupby("source").n_tokens.max()
    assert all(0 <= got[s] * total - quota[s] + 1 and got[s] * total - quota[s] < largest[s] for s in m.index if (s,) not in found)
    texts = dict(zip(d.doc_id, d.text))
    assert all(tokens.counter()(texts[i]) == n for i, n in zip(mixed.doc_id, mixed.n_tokens))


def test_every_shard_gets_its_part_of_every_source():
    """1,000 shards: whole passes and shares reach each, whatever the source."""
    n = mixing.blocks_for(1000)
    own = {(s, b): 10 for s in "ab" for b in range(n)}
    plans = mixing.plan(own, 2 * 10 * n, [("a", 0.25, 1), ("b", 0.75, 2)])
    rows = mixing.draws(plans, own, 1000)
    by = {s: Counter(r[4] for r in rows if r[0] == s) for s in "ab"}
    assert all(len(c) == 1000 for c in by.values()) and len({(r[0], r[1], r[2]) for r in rows}) == len(rows)
    assert sum(r[3] for r in rows if r[0] == "a") == 5 * n and sum(r[3] for r in rows if r[0] == "b") == 15 * n


def test_mix_is_written_by_shard(spark, tmp_path):
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    df = docs(spark, *((i, f"text number {i} " * (1 + i % 7), "ab"[i % 2]) for i in range(400)))
    mixing.write_mix(df, targets, str(tmp_path / "mix"), shards=4)
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.select("shard").distinct().count() == 4 and back.filter("text is null").count() == 0
    one = [r.position for r in spark.read.parquet(str(tmp_path / "mix" / "shard=0")).collect()]
    assert one == sorted(one)


def test_splitting_tree_is_exact():
    counts = np.array([100, 7, 0, 33])
    table = mixing.split_tree(counts, 8, np.random.default_rng(1))
    assert (table.sum(axis=0) == counts).all() and table.shape == (8, 4) and abs(table.sum(axis=1) - 17.5).max() < 1


def test_mix_of_odd_rows(spark):
    targets = spark.createDataFrame([("a_b", 0.5, 1), ("c", 0.5, 3), ("none", 0.0, 2)], "source string, target_share double, max_repeats int")
    df = docs(spark, (1, "one two", " A-B "), (2, None, "c"), (3, "", "c"), (4, "three " * 50, None), (4, "three " * 50, "zz"))
    assert rows(mixing.p9_found(df, targets)) == [("a_b",), ("c",)]
    assert rows(mixing.p9_found(df.limit(0), targets)) == []
    assert [r[0] for r in rows(mixing.shares(df, targets).select("source"))] == ["a_b", "c", "none"]


def test_cut_copies_are_found_and_whole_ones_left(spark):
    """Held-out accuracy: texts that are whole by their own end, and the same cut at random inside a line."""
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    judged = {r.doc_id: r.truncated for r in truncation.judged(whole).collect()}
    text = dict(zip(read("documents").doc_id, read("documents").text))
    rng, cut, keep = random.Random(5), {}, [i for i, t in judged.items() if not t]
    for i in rng.sample(keep, 150):
        t = text[i]
        at = next((p for p in (rng.randrange(len(t) // 3, len(t) - 1) for _ in range(40)) if t[p].isalpha() and t[p - 1].isalpha() and t[p + 1].isalpha()), None)
        if at:
            cut[i] = t[: at + 1]
    mixed = [(i, cut.get(i, text[i]), "s") for i in judged]
    found = {r.doc_id for r in truncation.judged(docs(spark, *mixed)).filter("truncated").collect()}
    assert len(found & cut.keys()) / len(cut) > 0.95
    assert len(found & (set(keep) - cut.keys())) / (len(keep) - len(cut)) < 0.02


def test_limits_show_in_the_right_encoding(spark):
    base = "ü" * 30
    made = [(i, (base + f"{i:04d} word" * 40)[:200], "s") for i in range(30)] + [(100 + i, "q" * i, "s") for i in range(60)] + [(200 + i, f"{i}\n" * i + "\n" * 5, "t") for i in range(8)]
    found = truncation.hidden_limits(docs(spark, *made)).collect()
    assert [(r.source, r.encoding, r.at_length, r.n_texts) for r in found if r.source == "s"] == [("s", "characters", 200, 30)]
    assert truncation.lengths('a"\n\\é<𝄞')[:3] == [7, 11, 16]


def test_all_limits_of_a_source_are_found(spark):
    """A field that grew, with a byte limit besides, among many texts of other lengths; and texts of no source."""
    rng, made = random.Random(7), []
    text = lambda n, a="x": "".join(rng.choice("abc " + a) for _ in range(n - 1)) + "w"
    add = lambda t, s: made.append((len(made), t, s))
    for _ in range(3000):
        add(text(rng.randrange(20, 3000)), "s")
    for n, length in ((20, 300), (15, 800)):
        for _ in range(n):
            add(text(length), "s")
    for _ in range(15):
        t = text(2 * rng.randrange(100, 200), "é")
        add(t + "w" * (501 - len(t.encode())), "s")
    for _ in range(9):
        add(text(250), None)
    df = docs(spark, *made)
    found = {(r.source, r.encoding, r.at_length) for r in truncation.hidden_limits(df).collect()}
    assert found == {("s", "characters", 300), ("s", "characters", 800), ("s", "utf8", 501), (None, "characters", 250)}
    at = {r.doc_id for r in truncation.judged(df).filter("at_limit").collect()}
    assert at >= set(range(3000, 3059)) and len(at) < 3059 + 25
    assert truncation.distinct_limits([([(0, 9), (1, 9)], 8), ([(1, 9)], 3), ([(0, 9)], 6)], {(0, 9): 4, (1, 9): 4}) == [(0, 9)]


def test_a_byte_limit_inside_a_character(spark):
    """Texts cut at 400 bytes, some of them inside a character of which nothing is left."""
    rng, made = random.Random(3), []
    for i in range(60):
        text = "".join(rng.choice("ab é€𝄞") for _ in range(300)).encode()[:400].decode("utf-8", "ignore")
        made.append((i, text, "s"))
    made += [(100 + i, "ab " * (i + 20), "s") for i in range(60)]
    at = {r.doc_id for r in truncation.judged(docs(spark, *made)).filter("at_limit").collect()}
    assert {len(t.encode()) for _, t, _ in made[:60]} >= {399, 400} and at >= set(range(60))


def test_long_closing_lines_are_known(spark):
    line = "This notebook was exported by the archive of the project and may be used by everyone who names its authors"
    df = docs(spark, *((i, f"{'we ' * (i + 3)}use it\n\n{line}:)", "s") for i in range(6)))
    assert {r.truncated for r in truncation.judged(df).collect()} == {False}


def test_endings_of_odd_texts(spark):
    df = docs(spark, (1, None, "s"), (2, "", "s"), (3, "A whole sentence.", None), (4, "```python\nx = 1", "s"), (5, '{"cell": "code", "n": 1, "body": "x"}\n', "s"), (6, '{"cell": "code", "n": 1, "bo', "s"), (7, "word " * 50_000 + "end.", "s"))
    got = {r.doc_id: r.truncated for r in truncation.judged(df).collect()}
    assert got == {2: False, 3: False, 4: True, 5: False, 6: True, 7: False}
    assert rows(truncation.p10_found(df.limit(0))) == []


def test_long_last_words_are_known(spark):
    df = docs(spark, *((i, f"{'we ' * i}use RandomForestClassifier\n\nthen import RandomForestClassifier", "s") for i in range(4)), (9, "we use it\n\nthen import RandomForestClassifie", "s"))
    assert {r.doc_id: r.truncated for r in truncation.judged(df).collect()} == {0: False, 1: False, 2: False, 3: False, 9: True}


def plans(spark, since=-1):
    """Ids and plans, as they ran, of the queries after the given one."""
    spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    ran = spark._jsparkSession.sharedState().statusStore().executionsList()
    return {e.executionId(): e.physicalPlanDescription() for e in (ran.apply(k) for k in range(ran.size())) if e.executionId() > since}


def test_sides_that_grow_with_the_corpus_are_not_broadcast(spark, monkeypatch):
    """Of the compressed sizes that Spark broadcasts by itself a driver's heap may hold too few."""
    rng = random.Random(11)
    df = docs(spark, *((i, "".join(rng.choice("abé \n") for _ in range(rng.choice((50, 90, rng.randrange(20, 400))))) + rng.choice((".", " word", "\n\n- a list\n")), rng.choice("st")) for i in range(600)))
    whole = rows(truncation.judged(df))
    monkeypatch.setattr(truncation, "BESIDE_BYTES", 0, raising=False)
    last = max(plans(spark))
    assert rows(truncation.judged(df)) == whole and any(r[3] for r in whole)
    ran = plans(spark, last)
    assert ran and not [p for p in ran.values() if "BroadcastExchange" in p]


@pytest.mark.parametrize("block", [16, 40, 4096])
def test_neighbours_of_lengths_over_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(truncation, "LENGTH_BLOCK", block)
    rng, utf16 = random.Random(block), truncation.ENCODINGS.index("utf16")
    counts = {(s, e, n * (1 + (e == utf16))): rng.randrange(1, 9) for s in "st" for e in (0, utf16) for n in rng.sample(range(300), 150)}
    want = []
    for (s, e, at), n in counts.items():
        near = [counts.get((s, e, at + d * (1 + (e == utf16))), 0) for d in range(-truncation.NEAR, truncation.NEAR + 1) if d]
        want.append((s, e, at, n, sum(near) - max(near)))
    df = spark.createDataFrame([(*k, n) for k, n in counts.items()], "source string, encoding int, at_length long, n_texts long")
    assert rows(truncation.surrounded(df).drop("place")) == sorted(want)
