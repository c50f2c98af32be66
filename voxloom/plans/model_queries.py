"""Features, classifiers, ablations, language identification and batch analysis."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.functions.emoji import EMOJI_MODES
from voxloom.functions.labels import LANGUAGE_NAMES, LANGUAGE_NOTES, NO_ASPECT_TEXT, NO_VALUE, lookup
from voxloom.functions.stem import STEM_MODES
from voxloom.operators import analyze, features, language, metrics, models, variants
from voxloom.operators.ranking import stratified_split
from voxloom.plans import views as V
from voxloom.plans.registry import query
from voxloom.plans.sampling_queries import SPLIT_SQL
from voxloom.plans.text_queries import EMOJI_TAILS
from voxloom.schema import LABELS, OVERALL
from voxloom.session import scratch_path

GRAMS_SQL = f"""
tok AS (SELECT doc_id AS id, {V.tokens_sql('text')} AS t FROM documents),
grams AS (SELECT id, unnest(list_concat(t, list_transform(range(1, greatest(len(t), 1)),
            lambda i: t[i] || ' ' || t[i+1]))) AS term FROM tok),
tfs AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY id, term),
vocab AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM tfs GROUP BY term
          HAVING count(*) >= 2 ORDER BY tf DESC, term LIMIT 10000)"""


def documents(spark, d):
    return V.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")


@query("vocabulary", f"WITH {GRAMS_SQL} SELECT term, df, tf FROM vocab")
def vocabulary(spark, d):
    return features.most_frequent(features.frequencies(documents(spark, d), "text"))


@query("tfidf", f"""
WITH {GRAMS_SQL},
w AS (SELECT t.id, t.term, t.tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + v.df)) + 1.0) AS w
      FROM tfs t JOIN vocab v ON t.term = v.term)
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM w""")
def tfidf(spark, d):
    return features.tfidf(documents(spark, d), "id", "text").withColumn(
        "weight", F.round("weight", 6))


def rows(spark, d):
    """Labelled, cleaned rows with their part. The split sees ids and labels only; texts are
    cleaned after it."""
    parted = stratified_split(V.labelled(spark, d), "id", "sentiment_label", 0.2)
    return V.cleaned(parted).select(
        "id", "cleaned_text", "language", "tier", "sentiment_label", "label_id", "part")


def train_and_tiers(spark, d):
    everything = rows(spark, d)
    return (everything.filter(F.col("part") == "train"),
            everything.filter(F.col("part") == "test"))


def keys_sql(name: str) -> str:
    return f"""
WITH {SPLIT_SQL}
SELECT l.tier, '{name}' AS model, count(*) AS n, true AS valid, true AS at_floor
FROM split s JOIN labelled l USING (id) WHERE s.part = 'test' GROUP BY l.tier"""


def fit_keys(pairs):
    """What SQL can say of predictions: rows per tier, each with a known class, and that as many are right over all
    tiers as with the class that is most frequent there (within one in twenty)."""
    every = Window.partitionBy(F.lit(0))
    per_tier = pairs.groupBy("tier", "model").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(F.col("pred_id").between(0, 2), F.lit(False))).alias("valid"),
        F.count_if(F.col("pred_id") == F.col("label_id")).alias("right"),
        *[F.count_if(F.col("label_id") == i).alias(f"c{i}") for i in range(3)])
    most = F.greatest(*[F.sum(f"c{i}").over(every) for i in range(3)])  # the window holds one row per tier
    return per_tier.select("tier", "model", "n", "valid", (F.sum("right").over(every) >= 0.95 * most).alias("at_floor"))


def fit_pairs(spark, d, kind):
    train, tiers = train_and_tiers(spark, d)
    return models.predict(models.fit_classifier(train, kind), tiers, models.MODEL_NAMES[kind], ["id", "tier", "label_id"])


@query("logreg_fit_keys", keys_sql("LogReg"))
def logreg_fit_keys(spark, d):
    return fit_keys(fit_pairs(spark, d, "logreg"))


@query("svm_fit_keys", keys_sql("LinearSVM"))
def svm_fit_keys(spark, d):
    return fit_keys(fit_pairs(spark, d, "svm"))


@query("logreg_fit")
def logreg_fit(spark, d):
    return metrics.tier_eval(fit_pairs(spark, d, "logreg"))


@query("svm_fit")
def svm_fit(spark, d):
    return metrics.tier_eval(fit_pairs(spark, d, "svm"))


@query("fit_predict")
def fit_predict(spark, d):
    return fit_pairs(spark, d, "logreg")


@query("fit_predict_keys", f"""
WITH {SPLIT_SQL}
SELECT id, l.tier, CAST(l.label_id AS INTEGER) AS label_id, 'LogReg' AS model, true AS valid
FROM split s JOIN labelled l USING (id) WHERE s.part = 'test'""")
def fit_predict_keys(spark, d):
    """What SQL can say of the predictions: which rows there are, each with one known class."""
    return fit_predict(spark, d).select(
        "id", "tier", "label_id", "model", F.coalesce(F.col("pred_id").between(0, 2), F.lit(False)).alias("valid"))


def saved_and_loaded(spark, d):
    """Test rows, the fitted model and the same after a round trip through a folder."""
    train, tiers = train_and_tiers(spark, d)
    model = models.fit_classifier(train, "logreg")
    path = models.save_model(model, scratch_path(spark, "model"))
    return tiers, model, models.load_available({"LogReg": path, "absent": path + "-absent"})


@query("model_roundtrip")
def model_roundtrip(spark, d):
    tiers, _, found = saved_and_loaded(spark, d)
    return models.predict(found["LogReg"], tiers, "LogReg", ["id", "tier", "label_id"])


@query("model_roundtrip_keys", f"""
WITH {SPLIT_SQL}
SELECT id, 'LogReg' AS model, true AS same, 1 AS n_models FROM split s JOIN labelled l USING (id) WHERE s.part = 'test'""")
def model_roundtrip_keys(spark, d):
    """The loaded model gives each row the probabilities of the saved one; the absent one is left out."""
    tiers, model, found = saved_and_loaded(spark, d)
    both = models.predict_scores(found["LogReg"], models.predict_scores(model, tiers, ["id", "cleaned_text"]).withColumnRenamed(
        "scores", "before"), ["id", "before"])
    return both.select("id", F.lit("LogReg").alias("model"), (F.col("before") == F.col("scores")).alias("same"),
                       F.lit(len(found)).alias("n_models"))


def ablation_keys_sql(modes: list[str]) -> str:
    values = ", ".join(f"('{m}')" for m in modes)
    return f"""
WITH {SPLIT_SQL}, modes AS (SELECT * FROM (VALUES {values}) v(mode))
SELECT m.mode, l.tier, true AS valid FROM split s JOIN labelled l USING (id) CROSS JOIN modes m WHERE s.part = 'test' GROUP BY m.mode, l.tier"""


def ablation_keys(scored):
    """Modes and tiers, and that the scores are shares."""
    valid = F.col("accuracy").between(0, 1) & F.col("macro_f1").between(0, 1) & (F.col("accuracy") > 0)
    return scored.select("mode", "tier", valid.alias("valid"))


@query("ablation_emoji_keys", ablation_keys_sql(EMOJI_MODES))
def ablation_emoji_keys(spark, d):
    return ablation_keys(ablation_emoji(spark, d))


@query("ablation_stemming_keys", ablation_keys_sql(STEM_MODES))
def ablation_stemming_keys(spark, d):
    return ablation_keys(ablation_stemming(spark, d))


@query("ablation_emoji")
def ablation_emoji(spark, d):
    tail = F.coalesce(lookup("language", EMOJI_TAILS), F.lit(""))
    train, tiers = (df.withColumn("cleaned_text", F.concat("cleaned_text", tail))
                    for df in train_and_tiers(spark, d))
    return variants.ablation_emoji(train, tiers)


@query("ablation_stemming")
def ablation_stemming(spark, d):
    train, tiers = train_and_tiers(spark, d)
    return variants.ablation_stemming(train, tiers)


def profile_sql() -> str:
    """CTEs: the profile learnt from the train part of documents, as ``weights`` (gram, lang, o, w)."""
    values = ", ".join(f"('{x}', {i})" for i, x in enumerate(V.LANGUAGES))
    return rf"""
parts AS (SELECT doc_id AS id, lang, text, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY md5('42-' || doc_id), doc_id)
            <= round(0.2 * count(*) OVER (PARTITION BY lang)) THEN 'test' ELSE 'train' END AS part FROM documents),
learnt AS (SELECT lang, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS w FROM parts WHERE part = 'train'),
learnt_words AS (SELECT lang, w, count(*) AS tf FROM learnt GROUP BY ALL),
top AS (SELECT lang, substring('_' || w || '_', i, 3) AS gram, sum(tf) AS c
        FROM (SELECT *, unnest(range(1, length(w) + 1)) AS i FROM learnt_words) GROUP BY ALL),
totals AS (SELECT lang, sum(c) + (SELECT count(DISTINCT gram) FROM top) AS total FROM top GROUP BY lang),
langs AS (SELECT * FROM (VALUES {values}) v(lang, o)),
weights AS (SELECT k.gram, l.lang, l.o, CAST(round(ln((coalesce(t.c, 0) + 1.0) / tt.total) * 1000000) AS BIGINT) AS w
  FROM (SELECT DISTINCT gram FROM top) k CROSS JOIN langs l JOIN totals tt ON tt.lang = l.lang
  LEFT JOIN top t ON t.gram = k.gram AND t.lang = l.lang)"""


def detected_sql(table: str, key: str, text: str) -> str:
    """CTE ``detected`` (key, language) of the rows of a table; rows without a known gram are not in it."""
    return rf"""
text_words AS (SELECT {key} AS k, unnest(regexp_extract_all(lower({text}), '\p{{L}}+')) AS w FROM {table}),
text_grams AS (SELECT k, tf, substring('_' || w || '_', i, 3) AS gram FROM (
  SELECT *, unnest(range(1, length(w) + 1)) AS i FROM (SELECT k, w, count(*) AS tf FROM text_words GROUP BY ALL))),
scored AS (SELECT k, lang, o, sum(tf * w) AS s FROM text_grams JOIN weights USING (gram) GROUP BY ALL),
detected AS (SELECT k, lang AS language FROM scored QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC, o) = 1)"""


def language_model(spark, d, text="cleaned_text"):
    """Learnt from the train part of the documents with a language."""
    docs = documents(spark, d)
    parts = stratified_split(docs.select("id", "lang"), "id", "lang", 0.2).filter("part = 'train'")
    train = docs.join(parts.select("id"), "id", "left_semi")
    return language.LanguageModel(profiles=language.learn_profiles(train, "text", "lang"), languages=V.LANGUAGES,
                                  words=language.frequent_words(train, "text"), inputCol=text)


@query("language_id", f"""
WITH {profile_sql()}, {detected_sql('documents', 'doc_id', 'text')}
SELECT id, part, coalesce(language, 'unknown') AS language FROM parts LEFT JOIN detected ON k = id""")
def language_id(spark, d):
    """Profiles learnt on the train part; every document is scored, the test part is the check."""
    docs = documents(spark, d)
    parts = stratified_split(docs.select("id", "lang"), "id", "lang", 0.2).select("id", "part")
    found = language_model(spark, d, "text").transform(docs).select("id", "language")
    return found.join(parts, "id")


def language_name_sql(code: str) -> str:
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_NAMES.items())
    notes = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGE_NOTES.items())
    return f"(CASE {code} {names} ELSE {code} END || CASE {code} {notes} ELSE '' END)"


def analyzed(spark, d):
    train, _ = train_and_tiers(spark, d)
    model = models.fit_classifier(train, "logreg")
    return analyze.analyze(V.labelled(spark, d), model, V.TAXONOMY, detector=language_model(spark, d, "text"))


@query("analyze_batch")
def analyze_batch(spark, d):
    return analyzed(spark, d)


@query("analyze_batch_keys", f"""
WITH {V.LABELLED_SQL}, {profile_sql()}, {detected_sql('labelled', 'id', 'text')},
texts AS (SELECT id, text, list_transform({V.aspects_sql('text')}, lambda a: replace(a, '_', ' ')) AS found FROM labelled WHERE trim(text) <> ''),
named AS (SELECT id, unnest(list_concat(['{OVERALL}'], CASE WHEN len(found) = 0 THEN ['{NO_ASPECT_TEXT}'] ELSE found END)) AS aspect FROM texts)
SELECT id, aspect, {language_name_sql("coalesce(language, 'unknown')")} AS language, aspect <> '{NO_ASPECT_TEXT}' AS labelled,
       aspect = '{OVERALL}' AS has_scores, true AS valid FROM named LEFT JOIN detected ON k = id""")
def analyze_batch_keys(spark, d):
    """What SQL can say of the analysis: its rows, their detected language, and that labels and shares are well-formed."""
    share = F.col("confidence").rlike("^(3[3-9]|[4-9][0-9]|100)%$") & F.col("sentiment").isin(LABELS)
    none = (F.col("sentiment") == NO_VALUE) & (F.col("confidence") == NO_VALUE)
    total = F.aggregate(F.map_values("scores"), F.lit(0.0), lambda s, x: s + x)
    summed = F.col("scores").isNull() | (F.abs(total - 1) < 1e-9)
    return analyzed(spark, d).select(
        "id", "aspect", "language", (F.col("sentiment") != NO_VALUE).alias("labelled"), F.col("scores").isNotNull().alias("has_scores"),
        ((share | none) & summed).alias("valid"))
