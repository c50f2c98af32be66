import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from voxloom.functions.lookup import InlineTable, bound
from voxloom.operators import corpus, language, models, svm


def plain_newton(x, y, c):
    """Dense weights of one class against the rest, squared hinge, the last feature constant."""
    w = np.zeros(x.shape[1])

    def loss(w):
        return w @ w / 2 + c * (np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    for _ in range(200):
        lack = np.maximum(0, 1 - y * (x @ w))
        slope = w - 2 * c * x.T @ (y * lack)
        if np.abs(slope).max() < 1e-10:
            break
        active = x[lack > 0]
        step = np.linalg.solve(np.eye(len(w)) + 2 * c * active.T @ active, -slope)
        reach = 1.0
        while loss(w + reach * step) > loss(w) + 1e-4 * reach * slope @ step and reach > 1e-12:
            reach /= 2
        w = w + reach * step
    return w


def test_squared_hinge_matches_a_plain_solver(spark):
    rng = np.random.default_rng(2)
    x = np.where(rng.random((300, 12)) < 0.4, rng.normal(size=(300, 12)), 0.0)
    y = (x[:, :3] + rng.normal(scale=0.7, size=(300, 3))).argmax(1)
    rows = [(float(k), Vectors.sparse(12, [(j, v) for j, v in enumerate(r) if v]) if i % 2 else Vectors.dense(r))
            for i, (r, k) in enumerate(zip(x, y, strict=True))]
    featured = spark.createDataFrame(rows, ["label_id", "features"]).repartition(9)
    packed = svm.blocks(featured).cache()
    got = svm.solve(packed, 12, 3, c=0.7, tolerance=1e-7)
    with_one = np.hstack([x, np.ones((300, 1))])
    for k in range(3):
        assert got[:, k] == pytest.approx(plain_newton(with_one, np.where(y == k, 1.0, -1.0), 0.7), abs=1e-3)
    model = svm.fit(featured, c=0.7)
    predicted = [r.prediction for r in model.transform(spark.createDataFrame(rows, ["label_id", "features"])).collect()]
    assert predicted == (with_one @ got).argmax(1).tolist()


def test_sums_as_a_tree(spark):
    featured = spark.createDataFrame([(float(i % 2), Vectors.dense([float(i)])) for i in range(100)], ["label_id", "features"]).repartition(11)
    total = svm.summed(svm.blocks(featured), lambda b: np.array([b.weights.sum(), len(b.sizes)], float), tree=3)
    assert total.tolist() == [4950.0 + 100, 100.0]


@pytest.mark.parametrize("kind", ["logreg", "svm"])
def test_saved_models_predict_the_same_and_beat_the_majority(spark, tmp_path, kind):
    rng = random.Random(4)
    words = {0: "bad slow poor", 1: "plain table thing", 2: "great fast good"}
    rows = [(i, " ".join(rng.choices(words[k].split() + "the of and it was".split(), k=9)), k) for i in range(240) for k in [rng.choice([0, 1, 1, 2])]]
    df = spark.createDataFrame(rows, "id long, cleaned_text string, label_id int")
    model = models.fit_classifier(df.filter("id < 180"), kind)
    test = df.filter("id >= 180")
    pairs = models.predict(model, test, kind, ["id", "label_id"]).collect()
    share = sum(p.pred_id == p.label_id for p in pairs) / len(pairs)
    most = max(sum(p.label_id == k for p in pairs) for k in range(3)) / len(pairs)
    assert share > most + 0.2
    loaded = models.load_model(models.save_model(model, str(tmp_path / kind)))
    assert sorted(models.predict(loaded, test, kind, ["id", "label_id"]).collect()) == sorted(pairs)


def test_inline_table_finds_every_key(spark):
    rows = [(f"k{i}é", i, f"v{i}") for i in range(3000)] + [(" ", -1, "blank")]
    table = InlineTable(spark.createDataFrame(rows, "key string, n long, v string"), "key", ["n", "v"])
    asked = spark.createDataFrame([(k,) for k, _, _ in rows] + [("absent",), (None,), ("",)], "key string")
    got = asked.select("key", bound(table.find(F.col("key")), lambda p: F.struct(table.value(p, "n").alias("n"), table.value(p, "v").alias("v"))).alias("x"))
    assert {r.key: (r.x.n, r.x.v) for r in got.collect()} == {**{k: (n, v) for k, n, v in rows}, "absent": (None, None), None: (None, None), "": (None, None)}
    empty = InlineTable(spark.createDataFrame([], "key string, n long"), "key", ["n"])
    assert asked.filter(empty.find(F.col("key")).isNotNull()).count() == 0
    with pytest.raises(ValueError, match="more than 10"):
        InlineTable(spark.createDataFrame(rows, "key string, n long, v string"), "key", limit=10)


LINES = {"en": "the cat and the dog were there", "fr": "le chat et la maison sont dans la rue", "de": "der hund und die katze sind nicht da"}


def profiles(spark):
    rows = [(k, t) for k, t in LINES.items()]
    return language.learn_profiles(spark.createDataFrame(rows, "language string, cleaned_text string"))


def test_language_model_is_the_join_within_the_row(spark, tmp_path):
    rng = random.Random(6)
    every = [w for t in LINES.values() for w in t.split()]
    texts = [" ".join(rng.choices([*every, "zzz", "12", "É"], k=rng.randrange(6))) for _ in range(80)] + [None, "", "12 !", "qqq", *LINES.values()]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, cleaned_text string")
    learnt = profiles(spark)
    model = language.LanguageModel(profiles=learnt, languages=sorted(LINES))
    want = {r.id: r.language for r in language.identify_language(df, "id", "cleaned_text", learnt, sorted(LINES)).collect()}
    found = model.transform(df)
    assert {r.id: r.language for r in found.collect()} == want
    assert [want[len(texts) - 3 + i] for i in range(3)] == list(LINES) and want[80] == "unknown"
    for limit in (2, 100):
        known = language.LanguageModel(profiles=learnt, languages=sorted(LINES), words=language.frequent_words(df, "cleaned_text", limit))
        assert {r.id: r.language for r in known.transform(df).collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow"))
    model = known
    PipelineModel([model]).write().save(str(tmp_path / "language"))
    again = PipelineModel.load(str(tmp_path / "language"))
    assert {r.id: r.language for r in again.transform(df).collect()} == want and again.stages[0].uid == model.uid


def test_language_is_the_last_step_of_preprocessing(spark):
    rows = [("1", "a", LINES["fr"]), ("2", "a", LINES["fr"] + "  "), ("3", "b", "<b>" + LINES["de"] + "</b>"), ("4", "b", "too short")]
    df = spark.createDataFrame(rows, "id string, source string, text string")
    model = language.LanguageModel(profiles=profiles(spark), languages=sorted(LINES))
    assert {r.id: r.language for r in corpus.preprocess(df, language=model).collect()} == {"1": "fr", "3": "de"}


def test_blocks_hold_each_row_and_fit_a_cache(spark, monkeypatch):
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", 50)
    rng = np.random.default_rng(8)
    x = np.where(rng.random((200, 9)) < 0.3, rng.normal(size=(200, 9)), 0.0)
    x[[0, 7, 199]] = 0
    rows = [(float(i), Vectors.sparse(9, [(j, v) for j, v in enumerate(r) if v]) if i % 3 else Vectors.dense(r)) for i, r in enumerate(x)]
    kept = [b for part in svm.blocks(spark.createDataFrame(rows, ["label_id", "features"]).coalesce(1)).collect()
            for b in [svm.Block(*(np.frombuffer(v, k) for v, k in zip(part, (np.int32, np.int32, np.float64, np.int32), strict=True)))]]
    assert len(kept) > 20 and all(len(b.indices) <= 50 for b in kept)
    got = np.zeros((200, 10))
    for b in kept:
        got[np.repeat(b.labels, b.sizes), b.indices] = b.weights
    assert (got == np.hstack([x, np.ones((200, 1))])).all()
    w = rng.normal(size=(10, 3))
    assert np.vstack([b.times(w) for b in kept]) == pytest.approx(got @ w)
    c = rng.normal(size=(200, 3))
    assert sum(b.transposed(c[b.labels], 10) for b in kept) == pytest.approx(got.T @ c)


def test_profiles_read_each_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        read.add(1)
        return text

    rows = [(k, t) for k, t in LINES.items()] * 5
    df = spark.createDataFrame(rows, "language string, cleaned_text string").withColumn("cleaned_text", counted("cleaned_text"))
    learnt = language.learn_profiles(df)
    assert read.value == len(rows)
    assert sorted(map(tuple, learnt.collect())) == sorted(map(tuple, language.learn_profiles(
        spark.createDataFrame(rows, "language string, cleaned_text string")).collect()))


def test_passes_have_as_many_tasks_as_entries_are_worth(spark, monkeypatch):
    """A small set in many partitions goes through each pass of a fit in one task, rows unchanged."""
    rng = np.random.default_rng(5)
    rows = [(float(i % 3), Vectors.dense(r)) for i, r in enumerate(rng.normal(size=(90, 4)))]
    packed = svm.blocks(spark.createDataFrame(rows, ["label_id", "features"]).repartition(20))
    assert svm._extent(packed) == (90 * 5, 2)
    assert svm.dealt(packed, 90 * 5).rdd.getNumPartitions() == 1
    monkeypatch.setattr(svm, "TASK_ENTRIES", 100)
    few = svm.dealt(packed, 90 * 5)
    assert 5 <= few.rdd.getNumPartitions() < 20
    assert svm.dealt(packed, 10**6) is packed
    own = lambda b: b.transposed(b.signs(np.arange(3)), 5).ravel()
    assert svm.summed(few, own) == pytest.approx(svm.summed(packed, own))
    widths, summed = [], svm.summed
    monkeypatch.setattr(svm, "TASK_ENTRIES", 1 << 23)
    monkeypatch.setattr(svm, "summed", lambda rows, *a, **k: widths.append(rows.getNumPartitions()) or summed(rows, *a, **k))
    svm.fit(spark.createDataFrame(rows, ["label_id", "features"]).repartition(20))
    assert set(widths) == {1}


def test_products_read_only_rows_with_a_loss():
    rng = np.random.default_rng(6)
    x = np.where(rng.random((60, 7)) < 0.5, rng.normal(size=(60, 7)), 0.0)
    x[:, -1] = 1
    row, at = np.nonzero(x)
    block = svm.Block(np.bincount(row).astype(np.int32), at, x[row, at], rng.integers(0, 3, 60).astype(np.int32))
    w, these = rng.normal(size=(7, 2)), np.array([0, 2])
    w[-1] = -2
    lack = np.where(block.labels[:, None] == these, 1.0, -1.0) * (x @ w) < 1
    left = block.lacking(w, these)
    assert 0 < len(left.sizes) < 60 and (left.active == lack[lack.any(1)]).all()
    assert (left.labels == block.labels[lack.any(1)]).all() and len(left.indices) == (x[lack.any(1)] != 0).sum()
    d = rng.normal(size=(7, 2))
    assert left.transposed(left.active * left.times(d), 7) == pytest.approx(x.T @ (lack * (x @ d)))
    nothing = block.lacking(np.where(np.arange(7)[:, None] == 6, -9.0, 0.0), np.array([7]))
    assert len(nothing.sizes) == 0


def test_a_fit_goes_on_when_no_row_has_a_loss_left(spark):
    """Rows far on their sides: the Hessian is then the penalty alone."""
    rows = [(float(i % 2), Vectors.dense([(2 * (i % 2) - 1) * 1e3])) for i in range(20)]
    got = svm.solve(svm.blocks(spark.createDataFrame(rows, ["label_id", "features"])).cache(), 1, 2, tolerance=1e-7)
    x = np.array([[v[0], 1.0] for _, v in rows])
    for k in range(2):
        assert got[:, k] == pytest.approx(plain_newton(x, np.where(np.arange(20) % 2 == k, 1.0, -1.0), 1.0), abs=1e-6)
