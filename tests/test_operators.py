import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from voxloom.operators import (analyze, corpus, dedup, degradation, features, joins, labeling,
                               language, metrics, models, ranking, shaping, variants)
from voxloom.schema import LABEL_IDS, OVERALL


def h(i, seed=42):
    return hashlib.md5(f"{seed}-{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """900 rows; group 'hot' holds two thirds of them."""
    rows = [(i, "hot" if i % 3 else f"g{i % 7}", i * 7 % 101) for i in range(900)]
    return spark.createDataFrame(rows, "id long, g string, v long"), rows


# --- ranking ------------------------------------------------------------------

def test_seeded_rank_matches_sorting(skewed):
    df, rows = skewed
    got = {r.id: r.shuffle_pos for r in ranking.seeded_rank(df, "id").collect()}
    want = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: h(r[0])))}
    assert got == want


def test_seeded_rank_by_group(skewed):
    df, rows = skewed
    got = {r.id: r.shuffle_pos for r in ranking.seeded_rank(df, "id", ["g"]).collect()}
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: h(r[0])):
        groups[r[1]].append(r[0])
    assert got == {i: k + 1 for ids in groups.values() for k, i in enumerate(ids)}


@pytest.mark.parametrize("cap", [0, 1, 17, 43, 10_000])
def test_balanced_sample(skewed, cap):
    df, rows = skewed
    groups = defaultdict(list)
    for r in sorted(rows, key=lambda r: h(r[0])):
        groups[r[1]].append(r[0])
    want = {i for ids in groups.values() for i in ids[:cap]}
    assert {r.id for r in ranking.balanced_sample(df, "id", "g", cap).collect()} == want


def test_quota_in_one_bucket(spark, monkeypatch):
    """With one bucket per group everything is decided by the boundary rank."""
    monkeypatch.setattr(ranking, "HEX_DIGITS", 0)
    rows = [(i, "a" if i % 4 else "b") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, g string")
    got = {r.id for r in ranking.balanced_sample(df, "id", "g", 30).collect()}
    want = {i for g in "ab" for i in sorted((r[0] for r in rows if r[1] == g), key=h)[:30]}
    assert got == want


def test_many_groups(spark):
    df = spark.range(30_000).withColumn("g", F.col("id") % 12_000)
    assert ranking.balanced_sample(df, "id", "g", 2).count() == 24_000


def test_split_is_disjoint_complete_and_stratified(skewed):
    df, rows = skewed
    parts = ranking.stratified_split(df, "id", "g", 0.2).cache()
    assert parts.count() == len(rows)
    sizes = Counter(r[1] for r in rows)
    test = Counter(r.g for r in parts.filter("part = 'test'").collect())
    assert all(test[g] == math.floor(0.2 * n + 0.5) for g, n in sizes.items())
    row = joins.disjoint_check(parts.filter("part='train'"), parts.filter("part='test'"), "id").first()
    assert row.n_shared == 0 and row.n_train + row.n_test == len(rows)


def test_validation_carve(spark, skewed):
    """An integer size counts rows over all labels: four rows per label give one each."""
    smoke = spark.createDataFrame([(i, f"l{i % 3}") for i in range(12)], "id long, g string")
    carved = ranking.validation_carve(smoke, "id", "g", 3)
    assert Counter(r.g for r in carved.filter("part='validation'").collect()) == {
        "l0": 1, "l1": 1, "l2": 1}
    uneven = spark.createDataFrame([(i, "a" if i < 30 else "b" if i < 35 else "c") for i in range(40)], "id long, g string")
    for n in (1, 3, 7, 39):
        assert ranking.validation_carve(uneven, "id", "g", n).filter("part='validation'").count() == n
    df, rows = skewed
    sizes = Counter(r[1] for r in rows)
    share = Counter(r.g for r in ranking.validation_carve(df, "id", "g", 0.15)
                    .filter("part='validation'").collect())
    assert all(share[g] == math.floor(0.15 * n + 0.5) for g, n in sizes.items())


def test_head_per_group_limits_before_the_shuffle(skewed):
    df, rows = skewed
    out = ranking.head_per_group(df, ["g"], ["id"], 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert max(Counter(r.g for r in out.collect()).values()) == 4


def test_head_per_group_above_the_group_limit(skewed, monkeypatch):
    df, rows = skewed
    want = {g: sorted(r[0] for r in rows if r[1] == g)[:50] for g in {r[1] for r in rows}}
    monkeypatch.setattr(ranking, "GROUP_LIMIT", 10)
    got = defaultdict(list)
    for r in ranking.head_per_group(df, ["g"], ["id"], 50).collect():
        got[r.g].append(r.id)
    assert {g: sorted(v) for g, v in got.items()} == want


def test_running_total_and_cap(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.randint(0, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "ord long, n long").repartition(7)
    total, want = 0, {}
    for i, n in rows:
        want[i] = total
        total += n
    got = {r.ord: r.b for r in ranking.running_total(df, ["ord"], "n", "b").collect()}
    assert got == want
    kept = {r.ord for r in ranking.running_cap(df, ["ord"], "n", 250).collect()}
    assert kept == {i for i, t in want.items() if t < 250}


def test_page_cap(spark):
    rows = [("a", 0, 20), ("a", 1, 20), ("a", 2, 5), ("a", 3, 20),      # short page 2 is the last
            ("b", 0, 20), ("b", 2, 20),                                # page 1 is missing
            ("c", 0, 0), ("c", 1, 20),                                 # empty first page
            *[("d", p, 20) for p in range(12)], ("d", 0, 20)]          # above the cap, refetched
    df = spark.createDataFrame(rows, "t string, p int, n int")
    got = sorted((r.t, r.p) for r in ranking.page_cap(df, "t", "p", "n", 8, 20).collect())
    assert got == [("a", 0), ("a", 1), ("a", 2), ("b", 0)] + [("d", p) for p in range(8)]


def test_ordered_distinct(spark):
    rows = [("f", k, i) for i, k in enumerate("cabcaed")]
    df = spark.createDataFrame(rows, "f string, k string, pos int")
    got = ranking.ordered_distinct_topn(df, "f", "k", "pos", 3).orderBy("first_pos").collect()
    assert [r.k for r in got] == ["c", "a", "b"]


# --- dedupe and joins ---------------------------------------------------------

def test_keep_first_with_hot_and_null_keys(spark):
    rows = [(i, "copy" if i % 3 == 0 else None if i % 3 == 1 else f"t{i % 10}", "s") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string, source string")
    got = {r.text: r.id for r in dedup.keep_first(df, ["text"], ["source", "id"]).collect()}
    want = {}
    for i, t, _ in rows:
        want.setdefault(t, i)
    assert got == want
    plan = dedup.keep_first(df, ["text"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert dedup.keep_any(df, ["text"]).count() == len(want)


def test_keep_first_keeps_columns(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "a", "y")], "id int, k string, v string")
    assert dedup.keep_first(df, ["k"], ["id"]).collect()[0] == (1, "a", "y")


def test_salted_lookup_with_a_hot_key(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(1500)]
    left = spark.createDataFrame(rows, "id long, k string")
    right = spark.createDataFrame([("hot", 1)] + [(f"k{j}", j) for j in range(0, 50, 2)],
                                  "k string, v int")
    assert joins.hot_keys(left, ["k"]).count() >= 1
    got = joins.salted_lookup(left, right, ["k"], "left", ["id"])
    want = left.join(right, "k", "left").select("id", "k", "v")
    assert sorted(map(tuple, got.select("id", "k", "v").collect()), key=str) == sorted(
        map(tuple, want.collect()), key=str)


def test_salted_lookup_as_a_shuffled_join(spark):
    """Without any automatic broadcast the hot key is spread over many partitions."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("k"), F.col("id") % 500)).alias("k"))
        right = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
        right = right.unionByName(spark.createDataFrame([("hot", -1)], "k string, v long"))
        got = joins.salted_lookup(left, right, ["k"], "inner", ["id"])
        assert "SortMergeJoin" in got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 6000 and got.filter("v = -1").count() == 2000
        assert got.filter("v >= 0 and k <> concat('k', v)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lookup_fallback(spark):
    texts = spark.createDataFrame([(1, " hola "), (2, "hi"), (3, ""), (4, None), (5, "hola")],
                                  "id int, text string")
    table = spark.createDataFrame([("hola", "hello"), ("hola ", "hello")], "text string, translated string")
    got = {r.id: (r.translated, r.failed) for r in
           joins.lookup_fallback(texts, "text", table).collect()}
    assert got == {1: ("hello", False), 2: ("hi", True), 3: ("", False), 4: ("", False),
                   5: ("hello", False)}


def test_enrich(spark):
    ref = spark.createDataFrame([("1", 5.0, "s1", "c"), ("1", 1.0, "s0", "b"), ("2", 2.0, "s", "d")],
                                "id string, rating double, source string, cleaned_text string")
    blind = spark.createDataFrame([("1", "x"), ("9", "y")], "id string, label_1 string")
    got = {r.id: r for r in joins.enrich(blind, ref, ["rating", "cleaned_text"]).collect()}
    assert (got["1"].rating, got["1"].cleaned_text, got["9"].rating) == (1.0, "b", None)
    assert joins.enrich(ref, ref, ["rating"]) is ref


def test_search_terms(spark):
    df = spark.createDataFrame([(1, "Fibre and 5G"), (2, "none"), (3, None)], "id int, text string")
    got = sorted((r.id, r.term) for r in joins.search_terms(df, "text", ["5g", "fibre"]).collect())
    assert got == [(1, "5g"), (1, "fibre")]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, c int")
    assert sorted(map(tuple, shaping.union_by_name([a, b]).collect()), key=str) == [
        (1, "x", None), (None, "y", 2)]


# --- metrics ------------------------------------------------------------------

def brute_macro(pairs):
    classes = {c for p in pairs for c in p}
    total = 0.0
    for c in classes:
        tp = sum(1 for y, p in pairs if y == c == p)
        both = sum(1 for y, _ in pairs if y == c) + sum(1 for _, p in pairs if p == c)
        total += 2 * tp / both
    return total / len(classes)


@pytest.mark.parametrize("pairs", [
    [(0, 0), (0, 0), (0, 2), (2, 2)],            # two classes only
    [(0, 0), (0, 1), (0, 0)],                    # a class that is only predicted
    [(0, 0), (1, 0), (2, 0)],                    # classes that are only true
    [(0, 1), (1, 2), (2, 0)],
])
def test_macro_f1_uses_the_union_of_classes(spark, pairs):
    df = spark.createDataFrame([(y, p) for y, p in pairs], "label_id int, pred_id int")
    got = metrics.scores(df, []).first()
    assert math.isclose(got.macro_f1, brute_macro(pairs))
    assert math.isclose(got.accuracy, sum(y == p for y, p in pairs) / len(pairs))


def test_kappa(spark):
    rows = [("negative", "negative")] * 55 + [("negative", "neutral")] + [("positive", "positive")] * 4
    df = spark.createDataFrame(rows, "human string, proxy string")
    got = metrics.agreement(df, [], "human", "proxy").first()
    assert round(got.kappa, 5) == 0.88095 and round(got.agreement, 3) == 0.983 and got.n == 60
    same = spark.createDataFrame([("a", "a")] * 3, "human string, proxy string")
    assert metrics.agreement(same, [], "human", "proxy").first().kappa is None


def test_class_report_and_confusion(spark):
    rows = [("m", 0, 0)] * 5 + [("m", 0, 1)] * 3 + [("m", 1, 1)] * 2
    df = spark.createDataFrame(rows, "model string, label_id int, pred_id int")
    report = {r.label: r for r in metrics.class_report(df, ["model"]).collect()}
    assert report["negative"].precision == 1.0 and report["negative"].recall == 0.625
    assert report["neutral"].precision == 0.4 and report["neutral"].support == 2
    assert math.isclose(report["accuracy"].f1, 0.7) and report["accuracy"].precision is None
    assert math.isclose(report["macro avg"].precision, 0.7)
    assert math.isclose(report["weighted avg"].precision, (8 * 1.0 + 2 * 0.4) / 10)
    matrix = {r.label_id: (r.pred_negative, r.pred_neutral, r.pred_positive)
              for r in metrics.confusion_matrix(df, ["model"]).collect()}
    assert matrix == {0: (5, 3, 0), 1: (0, 2, 0)}


def test_pivot_and_delta(spark):
    df = spark.createDataFrame([("raw", "t1", 0.5), ("strip", "t1", 0.4), ("raw", "t2", 0.3),
                                ("strip", "t2", 0.35)], "mode string, tier string, f double")
    wide = metrics.pivot_wide(df, "mode", "tier", "f", ["t1", "t2", "t3"], 4)
    assert {r.mode: (r.t1, r.t2, r.t3) for r in wide.collect()} == {
        "raw": (0.5, 0.3, None), "strip": (0.4, 0.35, None)}
    delta = metrics.delta_vs_reference(df, "mode", "raw", ["tier"], "f")
    assert {(r.mode, r.tier): round(r.delta, 6) for r in delta.collect()} == {
        ("strip", "t1"): -0.1, ("strip", "t2"): 0.05}


def test_value_counts_ties(spark):
    df = spark.createDataFrame([(x,) for x in "bbaac"], "x string")
    assert [(r.x, r.n) for r in metrics.value_counts(df, "x", 2).collect()] == [("a", 2), ("b", 2)]


TAX = {"speed": ["slow", "fast"], "billing": ["bill"], "void": ["absentword"]}


def test_degradation_keeps_empty_slices(spark):
    rows = [("m", "t", 0, 0, ["speed"]), ("m", "t", 0, 1, ["speed", "billing"]), ("m", "t", 2, 2, [])]
    df = spark.createDataFrame(
        rows, "model string, tier string, label_id int, pred_id int, aspects array<string>")
    table = degradation.aspect_degradation(df, TAX)
    got = {r.aspect: r for r in table.collect()}
    assert set(got) == {OVERALL, "speed", "billing", "void"}
    assert (got["void"].n, got["void"].accuracy, got["void"].ci_low) == (0, None, None)
    assert got["speed"].n == 2 and got["speed"].accuracy == 0.5 and got["speed"].macro_f1 is None
    assert math.isclose(got[OVERALL].macro_f1, brute_macro([(0, 0), (0, 1), (2, 2)]))
    assert all(r.low_support for r in got.values())
    cells = {r.aspect: r.note for r in degradation.degradation_cells(table, TAX, ["t"]).collect()}
    assert cells == {"speed": "n/a\nn=2", "billing": "n/a\nn=1", "void": "n/a\nn=0"}
    grid = spark.createDataFrame([("m", "t"), ("m", "empty")], "model string, tier string")
    full = degradation.aspect_degradation(df, TAX, grid=grid)
    assert full.filter("tier = 'empty' and n = 0").count() == 4
    strong = degradation.aspect_degradation(df, TAX, min_support=2)
    matrix = degradation.degradation_matrix(strong, TAX, ["t"], ["tt"]).collect()
    assert [(r.aspect, r.tt) for r in matrix] == [("speed", 0.5), ("billing", None), ("void", None)]


def test_variant_comparison_without_changes(spark):
    df = spark.createDataFrame([("t", 0, 0, 0, False, True), ("t", 1, 1, 0, False, False)],
                               "tier string, label_id int, pred_original int, pred_variant int, "
                               "changed boolean, failed boolean")
    r = variants.variant_comparison(df).first()
    assert (r.n, r.n_translation_failed, r.n_nonenglish_translated) == (2, 1, 0)
    assert r.macro_f1_original == 1.0 and r.macro_f1_original_sub is None
    assert r.macro_f1_delta_sub is None and r.macro_f1_delta < 0


# --- labelling ----------------------------------------------------------------

def pool_frame(spark, n_good, n_bad):
    rows = [(str(i), f"text {i}", 5.0 if i < n_good else 1.0, "src", "en", f"text {i}")
            for i in range(n_good + n_bad)]
    return spark.createDataFrame(
        rows, "id string, text string, rating double, source string, language string, cleaned_text string")


@pytest.mark.parametrize("good, bad, want", [(5, 200, 60), (70, 30, 70), (5, 10, 15), (60, 9, 60)])
def test_scarce_pool(spark, good, bad, want):
    pool = labeling.scarce_pool(pool_frame(spark, good, bad), "src").collect()
    assert len(pool) == want
    assert sum(r.star_label == "positive" for r in pool) == good
    negatives = sorted((str(i) for i in range(good, good + bad)), key=h)[:max(0, 60 - good)]
    assert {r.id for r in pool if r.star_label == "negative"} == set(negatives)


def test_sheets_and_finalisation(spark):
    frame = pool_frame(spark, 3, 4)
    wide = labeling.scarce_sheet(frame, "src")
    assert len(wide.columns) == 14 and wide.filter("assigned_to_1 = 'annotator'").count() == 7
    blind = labeling.scarce_sheet(frame, "src", blind=True)
    assert blind.columns == ["id", "text", "label_1", "notes"]
    assert labeling.random_sheet(frame, "src").filter("pre_label <> ''").count() == 0
    marked = blind.withColumn("label_1", F.when(F.col("id") < "3", " Positive").otherwise("?"))
    done = labeling.finalize_sheet(marked, frame)
    assert done.columns == ["id", "source", "language", "cleaned_text", "sentiment_label"]
    assert {r.sentiment_label for r in done.collect()} == {"positive"} and done.count() == 3


def test_agreement_report_without_labels(spark):
    df = spark.createDataFrame([("t", "", 5.0)], "tier string, sentiment_label string, rating double")
    got = {r.metric: r.value for r in labeling.agreement_report(df, ["t"]).collect()}
    assert got["rows"] == 1 and got["labelled"] == 0 and got["status_labelled"] == 0
    assert "kappa" not in got


def test_labels_from_stars(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 3.0)], "id int, rating double")
    assert {r.id: r.label_id for r in corpus.label_from_stars(df).collect()} == {
        1: LABEL_IDS["positive"], 3: LABEL_IDS["neutral"]}


def test_preprocess(spark):
    rows = [("2", "one two  three four five", "s"), ("1", "one two three four five", "s"),
            ("3", "too short", "s"), ("4", None, "s")]
    got = corpus.preprocess(spark.createDataFrame(rows, "id string, text string, source string"))
    assert [(r.id, r.cleaned_text, r.word_count) for r in got.collect()] == [
        ("1", "one two three four five", 5)]


# --- features and models ------------------------------------------------------

def test_tfidf_brute_force(spark):
    docs = {1: "aa bb aa cc", 2: "aa dd", 3: "bb aa bb", 4: "zz"}
    df = spark.createDataFrame(list(docs.items()), "id int, text string")

    def grams(t):
        w = t.split()
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    tf = {i: Counter(grams(t)) for i, t in docs.items()}
    dfs = Counter(g for c in tf.values() for g in c)
    vocab = {g for g, n in dfs.items() if n >= 2}
    want = {}
    for i, c in tf.items():
        w = {g: n * (math.log(5 / (dfs[g] + 1)) + 1) for g, n in c.items() if g in vocab}
        norm = math.sqrt(sum(x * x for x in w.values()))
        want.update({(i, g): x / norm for g, x in w.items()})
    got = {(r.id, r.term): r.weight for r in features.tfidf(df, "id", "text").collect()}
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12) for k in want)
    # The ML vectors hold the same weights.
    stages = features.tfidf_stages(df, "id", "text")
    terms = stages[1].vocabulary
    vectors = {r.id: r.features for r in features.featurize(stages, df).collect()}
    flat = {(i, terms[j]): float(x) for i, v in vectors.items() for j, x in zip(v.indices, v.values)}
    assert flat.keys() == want.keys()
    assert all(math.isclose(flat[k], want[k], rel_tol=1e-12) for k in want)


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_vocabulary_floor_is_exact(spark, size):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(rnd.choices(words, weights=[1 / (j + 1) for j in range(60)], k=30)))
            for i in range(80)]
    terms = features.document_terms(spark.createDataFrame(docs, "id int, text string"), "id", "text")
    got = [(r.term, r.df, r.tf) for r in features.vocabulary(terms, 2, size).collect()]
    tf, df = Counter(), Counter()
    for _, t in docs:
        w = t.split()
        c = Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])
        tf.update(c)
        df.update(c.keys())
    want = sorted(((g, df[g], tf[g]) for g in tf if df[g] >= 2), key=lambda x: (-x[2], x[0]))[:size]
    assert got == want


@pytest.mark.parametrize("n_max", [1, 2, 3])
def test_frequencies_are_those_of_the_documents(spark, monkeypatch, n_max):
    monkeypatch.setattr(features, "SLICE_TOKENS", 40)
    rnd = random.Random(9)
    texts = [" ".join(rnd.choices(["aa", "Bb", "été", "日本", "x", "_9", "c1"], k=rnd.randrange(30))) for _ in range(90)]
    docs = spark.createDataFrame(list(enumerate([*texts, None, "", "!", "aa " * 100])), "id int, text string")
    want = features.document_terms(docs, "id", "text", n_max).groupBy("term").agg(F.count("*"), F.sum("tf"))
    got = features.frequencies(docs, "text", n_max).collect()
    assert len(got) > 5 and sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))


def test_tfidf_of_repeated_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(features, "SLICE_TOKENS", 12)
    rows = [(i % 7 or None, " ".join(["aa", "bb", "cc", "dd"][: 1 + i % 4]) * (1 + i % 2)) for i in range(40)] + [(9, None), (9, "aa"), (10, "")]
    df = spark.createDataFrame(rows, "id int, text string")
    few, joined = ([tuple(r) for r in features.tfidf(df, "id", "text", max_features=n).collect()] for n in (1000, features.BROADCAST_FEATURES + 1))
    few, joined = (sorted(x, key=lambda r: (r[0] or 0, r[1], r[2])) for x in (few, joined))
    assert [r[:2] for r in few] == [r[:2] for r in joined] and len(few) > 40
    assert [r[2] for r in few] == pytest.approx([r[2] for r in joined], rel=1e-12)


def test_a_split_leaves_the_rows_where_they_are(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("label")).repartition(8)
    parts = ranking.stratified_split(df, "id", "label")
    assert parts.groupBy(F.spark_partition_id()).count().count() == 8
    assert {r.label: r["count"] for r in parts.filter("part = 'test'").groupBy("label").count().collect()} == {"0": 133, "1": 133, "2": 133}


@pytest.fixture(scope="module")
def sentiment(spark):
    rnd = random.Random(11)
    words = {0: ["awful", "slow", "rude"], 1: ["okay", "average", "plain"], 2: ["great", "fast", "love"]}
    rows = []
    for i in range(240):
        y = i % 3
        noise = rnd.choices(["the", "app", "line", "today", "bill"], k=4)
        rows.append((i, " ".join(rnd.choices(words[y], k=3) + noise), y, "t1" if i % 2 else "t2"))
    return spark.createDataFrame(rows, "id int, cleaned_text string, label_id int, tier string")


@pytest.mark.parametrize("kind", ["logreg", "svm"])
def test_classifiers_beat_the_majority(sentiment, kind, tmp_path):
    parts = ranking.stratified_split(sentiment, "id", "label_id")
    model = models.fit_classifier(parts.filter("part='train'"), kind, max_iter=20)
    test = parts.filter("part='test'")
    pairs = models.predict(model, test, kind, ["id", "label_id"])
    assert metrics.scores(pairs, []).first().accuracy > 0.8
    path = models.save_model(model, str(tmp_path / kind))
    again = models.load_available({"there": path, "absent": str(tmp_path / "no")})
    assert list(again) == ["there"]
    back = models.predict(again["there"], test, kind, ["id", "label_id"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pairs.collect()))


def test_unknown_classifier(sentiment):
    with pytest.raises(ValueError):
        models.fit_classifier(sentiment, "tree")


def test_ablation_shape(sentiment):
    table = variants.ablation_stemming(sentiment, sentiment, max_iter=5)
    got = {(r["mode"], r.tier) for r in table.collect()}
    assert got == {(m, t) for m in ("unstemmed", "stemmed") for t in ("t1", "t2")}


def test_score_metrics(spark):
    df = spark.createDataFrame([([0.9, 0.1, 0.0], 0), ([0.1, 0.2, 0.7], 2), ([0.4, 0.3, 0.3], 1)],
                               "scores array<double>, label_id int")
    r = models.score_metrics(df).first()
    assert math.isclose(r.accuracy, 2 / 3) and math.isclose(r.macro_f1, brute_macro([(0, 0), (2, 2), (1, 0)]))


def test_language(spark):
    text = {"en": "the quick thing that they were thinking", "de": "der schnelle und das ich nicht",
            "fr": "les choses que nous avons dans la maison"}
    learn = spark.createDataFrame([(t, l) for l, t in text.items()], "cleaned_text string, language string")
    profiles = language.learn_profiles(learn)
    df = spark.createDataFrame([(1, "that thing"), (2, "und nicht"), (3, "12345 !!"), (4, None),
                                (5, "nous avons"), (6, "ΩΩΩ")], "id int, text string")
    got = {r.id: r.language for r in
           language.identify_language(df, "id", "text", profiles, ["de", "en", "fr"]).collect()}
    assert got == {1: "en", 2: "de", 3: "unknown", 4: "unknown", 5: "fr", 6: "unknown"}


def test_analyze(sentiment, spark):
    model = models.fit_classifier(sentiment, max_iter=20)
    df = spark.createDataFrame([(1, "The bill is awful. I love it, so fast and great!", "en"),
                                (2, "nothing", "id"), (3, "  ", "en"), (4, None, "en")],
                               "id int, text string, language string")
    rows = analyze.analyze(df, model, {"speed": ["fast"], "app_bill": ["bill"]}).collect()
    got = {(r.id, r.aspect): r for r in rows}
    assert set(got) == {(1, OVERALL), (1, "speed"), (1, "app bill"), (2, OVERALL),
                        (2, "(no aspect keywords detected)")}
    assert got[1, "speed"].sentiment == "positive" and got[1, "app bill"].sentiment == "negative"
    assert got[1, "speed"].confidence.endswith("%") and got[1, "speed"].scores is None
    assert math.isclose(sum(got[1, OVERALL].scores.values()), 1.0, rel_tol=1e-9)
    assert got[2, "(no aspect keywords detected)"].sentiment == "—"
    assert got[2, OVERALL].language.startswith("Indonesian")


def test_lookups_without_translation_say_nothing(spark):
    texts = spark.createDataFrame([(1, "hola"), (2, " abcdef tail"), (3, "none"), (4, None)], "id long, text string")
    lookup = spark.createDataFrame([("hola", None), ("hola", "hello"), ("abcdef", "cut"), ("none", None)],
                                   "text string, translated string")
    got = {r.id: (r.translated, r.failed) for r in joins.lookup_fallback(texts, "text", lookup, max_chars=6).collect()}
    assert got == {1: ("hello", False), 2: ("cut", False), 3: ("none", True), 4: ("", False)}


def test_salted_lookup_takes_left_and_inner_only(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError, match="left or inner"):
        joins.salted_lookup(df, df, ["id"], "right")


def test_seeded_sample_of_any_size(skewed):
    df, rows = skewed
    for n in (0, 1, len(rows) // 2, len(rows) + 5):
        got = {r.id for r in ranking.seeded_sample(df, "id", n).collect()}
        assert got == set(sorted((r[0] for r in rows), key=h)[:n])


def test_running_totals_of_any_key(spark, monkeypatch):
    import random

    monkeypatch.setattr(ranking, "CUTS", 5)
    rng = random.Random(9)
    rows = [(rng.choice([None, "a", "b", "b", "b", "ç", "dd"]), rng.choice([1, 1, 1, None, 7, 2]), i, rng.randrange(4)) for i in range(200)]
    df = spark.createDataFrame(rows, "name string, k int, id int, n int").repartition(6)
    for order in (["name", "k", "id"], ["k", "name", "id"], ["id"]):
        places = [("name", "k", "id").index(c) for c in order]
        want, total = {}, 0
        for r in sorted(rows, key=lambda r: [(r[p] is not None, r[p] if r[p] is not None else 0) for p in places]):
            want[r[2]] = total
            total += r[3]
        got = ranking.running_total(df, order, "n", "before").collect()
        assert {r.id: r.before for r in got} == want and len(got) == 200
    assert ranking.running_total(df.limit(0), ["id"], "n", "before").count() == 0


def test_running_totals_start_no_job(spark):
    status = spark.sparkContext.statusTracker()
    before = len(status.getJobIdsForGroup())
    ranking.running_cap(spark.range(1000).withColumn("n", F.lit(1)), ["id"], "n", 10)
    assert len(status.getJobIdsForGroup()) == before


def test_null_ids_have_no_seeded_order(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 2)], "id string, g int")
    for made in (lambda: ranking.seeded_rank(df, "id"), lambda: ranking.mark_quota(df, "id", ["g"], F.lit(1)),
                 lambda: ranking.seeded_sample(df, "id", 2)):
        with pytest.raises(Exception, match="id on every row"):
            made().collect()


def test_exact_median(spark):
    for values in ([], [3], [1, 2], [5, 1, 1, 9], [2] * 50 + [7] * 49, list(range(101)) + [None]):
        df = spark.createDataFrame([(v,) for v in values], "v int")
        known = sorted(v for v in values if v is not None)
        want = (known[(len(known) - 1) // 2] + known[len(known) // 2]) / 2 if known else None
        assert metrics.exact_median(df, "v").first().median == want


def test_worklist_asks_each_text_once(spark, tmp_path):
    from voxloom.sources import sinks

    path = str(tmp_path / "cache")
    texts = spark.createDataFrame([(t,) for t in [" a ", "a", "bb", "", None, "long one", "long two"]], "text string")
    assert sinks.read_cache(spark, path).count() == 0
    first = sorted(r.text for r in joins.worklist(texts, "text", sinks.read_cache(spark, path), 4).collect())
    assert first == ["a", "bb", "long"]
    assert sinks.add_to_cache(spark.createDataFrame([("a", "A"), ("bb", None), ("long", "L")], "text string, translated string"), path) == 1
    assert joins.worklist(texts, "text", sinks.read_cache(spark, path), 4).count() == 0
    assert sinks.add_to_cache(spark.createDataFrame([("bb", "B"), ("new", "N")], "text string, translated string"), path) == 2
    assert {r.text: r.translated for r in sinks.read_cache(spark, path).collect()} == {"a": "A", "bb": "B", "long": "L", "new": "N"}
    found = joins.lookup_fallback(texts.withColumn("id", F.monotonically_increasing_id()), "text", sinks.read_cache(spark, path), max_chars=4)
    assert sorted(r.translated for r in found.collect()) == ["", "", "A", "A", "B", "L", "L"]


def test_partitions_and_sheets_that_stay(spark, tmp_path):
    import os

    from voxloom.sources import sinks

    def files(folder):
        return {os.path.join(r, f): os.stat(os.path.join(r, f)).st_mtime_ns for r, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}

    rows = spark.createDataFrame([("a", "s 1/2"), ("b", "t"), ("c", "t")], "id string, sheet string")
    path = str(tmp_path / "t")
    sinks.write_table(rows, path, ["sheet"])
    before = files(path)
    sinks.write_table(rows.filter("sheet = 't'").withColumn("id", F.lit("new")), path, ["sheet"], replace="partitions")
    after = files(path)
    assert {f: m for f, m in before.items() if "sheet=t" not in f} == {f: m for f, m in after.items() if "sheet=t" not in f}
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == ["a", "new", "new"]
    with pytest.raises(ValueError):
        sinks.write_table(rows, path, replace="partitions")
    sheets = str(tmp_path / "sheets")
    assert sinks.write_new_sheets(rows.filter("id = 'a'"), sheets, "sheet") == []
    held = files(sheets)
    assert sinks.write_new_sheets(rows.withColumn("id", F.lit("z")), sheets, "sheet") == ["s 1/2"]
    assert held.items() <= files(sheets).items()
    assert sorted((r.id, r.sheet) for r in spark.read.parquet(sheets).collect()) == [("a", "s 1/2"), ("z", "t"), ("z", "t")]
