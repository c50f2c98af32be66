"""Joins, metrics, degradation tables, comparisons and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import text as X
from voxloom.functions.labels import is_label, star_label
from voxloom.functions.stats import wilson_ci as wilson
from voxloom.operators import degradation, joins, labeling, metrics, variants
from voxloom.operators.models import score_metrics as score_table
from voxloom.operators.shaping import fan_out
from voxloom.operators.shaping import union_by_name as union_all
from voxloom.plans import views as V
from voxloom.plans.registry import query
from voxloom.plans.text_queries import SHEET_SQL, STAR_SQL, sheets
from voxloom.schema import EXPORT_COLS, OVERALL
from voxloom.session import scratch_path
from voxloom.sources import sinks

BY = ["model", "tier"]
G = "model, tier"


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- joins --------------------------------------------------------------------

@query("enrich_left_join", f"""
WITH {V.CLEANED_SQL}, {V.LABELLED_SQL}
SELECT l.id, l.sentiment_label, c.rating, c.word_count FROM labelled l
LEFT JOIN cleaned c ON CAST(l.id AS VARCHAR) = c.id""")
def enrich_left_join(spark, d):
    corpus = V.cleaned(V.reviews(spark, d)).select(
        F.col("id").cast("long").alias("id"), "rating", "word_count", "source")
    sheet = V.labelled(spark, d, text=False).select("id", "sentiment_label")
    return joins.enrich(sheet, corpus, ["rating", "word_count"])


@query("enrich_missing", f"""
WITH {V.REVIEWS_SQL}, {V.LABELLED_SQL}
SELECT l.id, l.source, l.text, r.rating, r.app FROM labelled l
LEFT JOIN reviews r ON CAST(l.id AS VARCHAR) = r.id""")
def enrich_missing(spark, d):
    corpus = V.reviews(spark, d).withColumn("id", F.col("id").cast("long"))
    sheet = V.labelled(spark, d).select("id", "source", "text")
    return joins.enrich(sheet, corpus, ["source", "text", "rating", "app"])


ASKED_CHARS = 400
LOOKUP_SQL = f"""
own AS (SELECT doc_id AS id, regexp_replace(coalesce(text, ''),
          '^{V.SPACE_SQL}+|{V.SPACE_SQL}+$', '', 'g') AS t, lang FROM documents),
lookup AS (SELECT t, min(CASE WHEN lang = 'es' THEN t ELSE 'en: ' || t END) AS found FROM own
           WHERE lang <> 'en' GROUP BY t),
translated AS (
  SELECT o.id, o.t AS original, CASE WHEN o.t = '' THEN '' ELSE coalesce(l.found, o.t) END AS translated,
         l.found IS NULL AND o.t <> '' AS failed
  FROM own o LEFT JOIN lookup l ON o.t = l.t)"""


def lookup_table(spark, d):
    docs = V.table(spark, d, "documents").filter(F.col("lang") != "en")
    own = X.strip_space("text")
    return docs.select(own.alias("text"), F.when(F.col("lang") == "es", own)
                       .otherwise(F.concat(F.lit("en: "), own)).alias("translated"))


@query("lookup_fallback", f"WITH {LOOKUP_SQL} SELECT id, translated, failed FROM translated")
def lookup_fallback(spark, d):
    texts = V.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return joins.lookup_fallback(texts, "text", lookup_table(spark, d)).select(
        "id", "translated", "failed")


@query("translation_cache", f"""
WITH {LOOKUP_SQL},
cut AS (SELECT lang, regexp_replace(left(t, {ASKED_CHARS}), '{V.SPACE_SQL}+$', '') AS t FROM own),
asked AS (SELECT DISTINCT t FROM cut WHERE t <> ''),
start AS (SELECT DISTINCT t FROM cut WHERE lang = 'es' AND t <> ''),
first AS (SELECT t, length(t) % 5 = 0 AS vain FROM asked WHERE t NOT IN (SELECT t FROM start))
SELECT 1 AS run, count(*) AS n_asked, count(*) FILTER (WHERE vain) AS n_vain, (SELECT count(*) FROM asked) AS n_cached FROM first
UNION ALL SELECT 2, 0, 0, (SELECT count(*) FROM asked)""")
def translation_cache(spark, d):
    """Two runs over a cache that starts with the Spanish texts: the second has nothing to ask."""
    path = scratch_path(spark, "cache")
    docs = V.table(spark, d, "documents")
    start = docs.filter("lang = 'es'").select(joins.asked_text("text", ASKED_CHARS).alias("text")).filter("text <> ''").distinct()
    sinks.add_to_cache(start.withColumn("translated", F.col("text")), path)
    runs = []
    for run in (1, 2):
        todo = joins.worklist(docs, "text", sinks.read_cache(spark, path), ASKED_CHARS)
        # Stands in for the service: some texts get no answer.
        answers = todo.withColumn("translated", F.when(F.length("text") % 5 != 0, F.concat(F.lit("en: "), "text")))
        number = sinks.add_to_cache(answers, path)
        told = spark.read.parquet(path).filter(F.col("run") == number).agg(
            F.lit(run).alias("run"), F.count(F.lit(1)).alias("n_asked"), F.count_if(F.col("translated").isNull()).alias("n_vain"))
        runs.append(told.withColumn("n_cached", sinks.read_cache(spark, path).agg(F.count(F.lit(1))).scalar()))
    return union_all(runs)


@query("changed_rows", f"""
WITH {LOOKUP_SQL} SELECT id FROM translated WHERE trim(original) <> trim(translated)""")
def changed_rows(spark, d):
    texts = V.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return (joins.lookup_fallback(texts, "text", lookup_table(spark, d))
            .filter(joins.changed_text("text", "translated")).select("id"))


@query("grid_cross", f"""
WITH {V.PREDS_SQL} SELECT m.model, t.tier FROM (SELECT DISTINCT model FROM preds) m
CROSS JOIN (SELECT DISTINCT tier FROM labelled) t""")
def grid_cross(spark, d):
    return degradation.score_grid(
        V.predictions(spark, d).select("model").distinct(), V.TIERS)


@query("keyword_theta_join", f"""
WITH {V.REVIEWS_SQL}, kws AS (SELECT unnest(['a','a','b','b','c','c','d','e']) AS aspect,
  unnest(['the','of the','la','le','der','und','tion','absentword']) AS keyword)
SELECT aspect, keyword, count(*) AS n FROM reviews JOIN kws
  ON regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])' || keyword || '($|[^\\p{{L}}\\p{{N}}_])')
GROUP BY aspect, keyword""")
def keyword_theta_join(spark, d):
    found = V.reviews(spark, d).select(X.matched_keywords("text", V.TAXONOMY).alias("found"))
    return (fan_out(found, "found", "hit").select("hit.*")
            .groupBy("aspect", "keyword").agg(F.count(F.lit(1)).alias("n")))


@query("truth_pred_join", f"WITH {V.PREDS_SQL} SELECT model, tier, id, label_id, pred_id FROM pairs")
def truth_pred_join(spark, d):
    truth = V.labelled(spark, d, text=False).select("id", "tier", "label_id")
    return metrics.pair_truth(V.predictions(spark, d), truth).select(
        "model", "tier", "id", "label_id", "pred_id")


# --- metrics ------------------------------------------------------------------

@query("class_balance", f"""
WITH {V.LABELLED_SQL} SELECT sentiment_label, count(*) AS n FROM labelled GROUP BY sentiment_label""")
def class_balance(spark, d):
    return metrics.value_counts(V.labelled(spark, d, text=False), "sentiment_label")


@query("aspect_distribution", f"""
WITH {V.CLEANED_SQL}
SELECT aspect, count(*) AS n FROM (SELECT unnest({V.aspects_sql('cleaned_text')}) AS aspect FROM cleaned)
GROUP BY aspect""")
def aspect_distribution(spark, d):
    return degradation.aspect_distribution(
        degradation.tag_aspects(V.cleaned(V.reviews(spark, d)), V.TAXONOMY))


@query("accuracy", f"""
WITH {V.PREDS_SQL}
SELECT {G}, round(avg(CASE WHEN label_id = pred_id THEN 1.0 ELSE 0 END), 6) AS accuracy
FROM pairs GROUP BY {G}""")
def accuracy(spark, d):
    return rounded(metrics.accuracy(V.pairs(spark, d), BY), "accuracy")


@query("macro_f1", f"""
WITH {V.PREDS_SQL}, {V.class_sql('pairs', G)}
SELECT {G}, round(avg(f1), 6) AS macro_f1 FROM classes GROUP BY {G}""")
def macro_f1(spark, d):
    return rounded(metrics.macro_f1(V.pairs(spark, d), BY), "macro_f1")


@query("tier_eval", f"""
WITH {V.PREDS_SQL}, {V.class_sql('pairs', G)}
SELECT tier, model, round(CAST(sum(tp) AS DOUBLE) / sum(nt), 6) AS accuracy,
       round(avg(f1), 6) AS macro_f1 FROM classes GROUP BY tier, model""")
def tier_eval(spark, d):
    return rounded(metrics.tier_eval(V.pairs(spark, d)), "accuracy", "macro_f1")


@query("class_report", f"""
WITH {V.PREDS_SQL}, {V.class_sql('pairs', G)},
per AS (SELECT {G}, CASE class WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS label,
  tp, nt, CASE WHEN np > 0 THEN CAST(tp AS DOUBLE) / np ELSE 0 END AS p,
  CASE WHEN nt > 0 THEN CAST(tp AS DOUBLE) / nt ELSE 0 END AS r, f1 FROM classes)
SELECT {G}, label, round(p, 6) AS precision, round(r, 6) AS recall, round(f1, 6) AS f1, nt AS support FROM per
UNION ALL SELECT {G}, 'accuracy', NULL, NULL, round(CAST(sum(tp) AS DOUBLE) / sum(nt), 6),
  CAST(sum(nt) AS BIGINT) FROM per GROUP BY {G}
UNION ALL SELECT {G}, 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6),
  CAST(sum(nt) AS BIGINT) FROM per GROUP BY {G}
UNION ALL SELECT {G}, 'weighted avg', round(sum(p * nt) / sum(nt), 6), round(sum(r * nt) / sum(nt), 6),
  round(sum(f1 * nt) / sum(nt), 6), CAST(sum(nt) AS BIGINT) FROM per GROUP BY {G}""")
def class_report(spark, d):
    return rounded(metrics.class_report(V.pairs(spark, d), BY), "precision", "recall", "f1")


@query("confusion_matrix", f"""
WITH {V.PREDS_SQL} SELECT {G}, CAST(label_id AS INTEGER) AS label_id,
  count(*) FILTER (WHERE pred_id = 0) AS pred_negative,
  count(*) FILTER (WHERE pred_id = 1) AS pred_neutral,
  count(*) FILTER (WHERE pred_id = 2) AS pred_positive
FROM pairs GROUP BY {G}, label_id""")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(V.pairs(spark, d), BY)


PROXY_SQL = f"""
proxied AS (SELECT tier, sentiment_label AS human, {STAR_SQL} AS proxy FROM finals
            WHERE sentiment_label IN {V.label_list_sql()}),
duo AS (SELECT * FROM proxied WHERE proxy <> '')"""


def proxied(spark, d):
    done = labeling.with_final_label(sheets(spark, d))
    return (done.filter(is_label("sentiment_label")).withColumn("proxy", star_label("rating"))
            .filter(is_label("proxy")).select("tier", F.col("sentiment_label").alias("human"), "proxy"))


@query("agreement", f"""
WITH {SHEET_SQL}, {PROXY_SQL}
SELECT tier, count(*) AS n, round(avg(CASE WHEN human = proxy THEN 1.0 ELSE 0 END), 6) AS agreement
FROM duo GROUP BY tier""")
def agreement(spark, d):
    return rounded(metrics.agreement(proxied(spark, d), ["tier"], "human", "proxy")
                   .select("tier", "n", "agreement"), "agreement")


KAPPA_SQL = f"""
{V.class_sql('duo', 'tier', 'human', 'proxy')},
kappas AS (SELECT tier, CAST(sum(tp) AS DOUBLE) / sum(nt) AS po,
                  sum(CAST(nt AS DOUBLE) * np) / (CAST(sum(nt) AS DOUBLE) * sum(nt)) AS pe,
                  CAST(sum(nt) AS BIGINT) AS n FROM classes GROUP BY tier)"""


@query("cohen_kappa", f"""
WITH {SHEET_SQL}, {PROXY_SQL}, {KAPPA_SQL}
SELECT tier, n, round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 6) AS kappa FROM kappas""")
def cohen_kappa(spark, d):
    return rounded(metrics.agreement(proxied(spark, d), ["tier"], "human", "proxy")
                   .select("tier", "n", "kappa"), "kappa")


WILSON_SQL = """
  CASE WHEN n > 0 THEN round(greatest(0.0, ((k / n + 1.9207999999999998 / n) -
    1.96 * sqrt((k / n * (1 - k / n) + 0.9603999999999999 / n) / n)) / (1 + 3.8415999999999997 / n)), 6) END AS ci_low,
  CASE WHEN n > 0 THEN round(least(1.0, ((k / n + 1.9207999999999998 / n) +
    1.96 * sqrt((k / n * (1 - k / n) + 0.9603999999999999 / n) / n)) / (1 + 3.8415999999999997 / n)), 6) END AS ci_high"""


@query("wilson_ci", f"""
WITH {V.PREDS_SQL},
c AS (SELECT {G}, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (WHERE label_id = pred_id) AS DOUBLE) AS k
      FROM pairs GROUP BY {G})
SELECT {G}, {WILSON_SQL} FROM c""")
def wilson_ci(spark, d):
    low, high = wilson("correct", "n")
    return rounded(metrics.scores(V.pairs(spark, d), BY).select(
        *BY, low.alias("ci_low"), high.alias("ci_high")), "ci_low", "ci_high")


DEGRADATION_SQL = f"""
{V.CLEANED_SQL}, {V.PREDS_SQL},
tagged AS (SELECT p.*, {V.aspects_sql('c.cleaned_text')} AS aspects FROM pairs p
           JOIN cleaned c ON CAST(p.id AS VARCHAR) = c.id),
grid AS (SELECT model, tier, aspect FROM (SELECT DISTINCT model, tier FROM pairs)
         CROSS JOIN (SELECT unnest(['{OVERALL}', 'a', 'b', 'c', 'd', 'e']) AS aspect)),
sliced AS (SELECT model, tier, label_id, pred_id, unnest(list_prepend('{OVERALL}', aspects)) AS aspect
           FROM tagged),
counted AS (SELECT g.model, g.tier, g.aspect, count(s.label_id) AS cnt,
                   count(*) FILTER (WHERE s.label_id = s.pred_id) AS ok
            FROM grid g LEFT JOIN sliced s USING (model, tier, aspect) GROUP BY ALL),
{V.class_sql('pairs', G)},
f1s AS (SELECT {G}, avg(f1) AS mf1 FROM classes GROUP BY {G}),
degradation AS (
  SELECT c.model, c.tier, c.aspect, CAST(cnt AS DOUBLE) AS n, CAST(ok AS DOUBLE) AS k,
         CASE WHEN cnt > 0 THEN CAST(ok AS DOUBLE) / cnt END AS accuracy,
         CASE WHEN c.aspect = '{OVERALL}' THEN mf1 END AS macro_f1, cnt < 8 AS low_support
  FROM counted c JOIN f1s f ON c.model = f.model AND c.tier = f.tier)"""


def degradation_table(spark, d):
    """Texts are tagged before the join, so only the tags travel with the predictions."""
    docs = V.labelled(spark, d)
    truth = degradation.tag_aspects(V.cleaned(docs), V.TAXONOMY).select(
        "id", "tier", "label_id", "aspects")
    return degradation.aspect_degradation(V.predictions(spark, d).join(truth, "id"), V.TAXONOMY)


@query("aspect_degradation", f"""
WITH {DEGRADATION_SQL}
SELECT model, tier, aspect, CAST(n AS BIGINT) AS n, round(accuracy, 6) AS accuracy,
       round(macro_f1, 6) AS macro_f1, low_support, {WILSON_SQL} FROM degradation""")
def aspect_degradation(spark, d):
    return rounded(degradation_table(spark, d), "accuracy", "ci_low", "ci_high", "macro_f1")


@query("degradation_cells", f"""
WITH {DEGRADATION_SQL}
SELECT model, aspect, tier,
  CASE WHEN low_support OR accuracy IS NULL THEN 'n/a' || chr(10) || 'n=' || CAST(n AS BIGINT)
       ELSE printf('%.2f', accuracy) || chr(10) || 'n=' || CAST(n AS BIGINT) END AS note
FROM degradation WHERE aspect <> '{OVERALL}'""")
def degradation_cells(spark, d):
    return degradation.degradation_cells(
        degradation_table(spark, d), V.TAXONOMY, V.TIERS).select("model", "aspect", "tier", "note")


@query("degradation_matrix", f"""
WITH {DEGRADATION_SQL}
SELECT model, aspect, CAST(ascii(aspect) - 97 AS INTEGER) AS aspect_ord,
  round(max(CASE WHEN tier = '{V.TIERS[0]}' AND NOT low_support THEN accuracy END), 6) AS in_domain,
  round(max(CASE WHEN tier = '{V.TIERS[1]}' AND NOT low_support THEN accuracy END), 6) AS cross_platform,
  round(max(CASE WHEN tier = '{V.TIERS[2]}' AND NOT low_support THEN accuracy END), 6) AS cross_domain
FROM degradation WHERE aspect <> '{OVERALL}' GROUP BY model, aspect""")
def degradation_matrix(spark, d):
    wide = degradation.degradation_matrix(
        degradation_table(spark, d), V.TAXONOMY, V.TIERS, V.TIER_SHORT)
    return rounded(wide, *V.TIER_SHORT)


@query("pivot_f1", f"""
WITH {V.PREDS_SQL}, {V.class_sql('pairs', G)},
f AS (SELECT {G}, avg(f1) AS mf1 FROM classes GROUP BY {G})
SELECT model, round(max(CASE WHEN tier = '{V.TIERS[0]}' THEN mf1 END), 4) AS in_domain,
  round(max(CASE WHEN tier = '{V.TIERS[1]}' THEN mf1 END), 4) AS cross_platform,
  round(max(CASE WHEN tier = '{V.TIERS[2]}' THEN mf1 END), 4) AS cross_domain
FROM f GROUP BY model""")
def pivot_f1(spark, d):
    return metrics.pivot_wide(metrics.tier_eval(V.pairs(spark, d)), "model", "tier", "macro_f1",
                              V.TIERS, 4, V.TIER_SHORT)


@query("delta_vs_reference", f"""
WITH {V.PREDS_SQL}, {V.class_sql('pairs', G)},
f AS (SELECT {G}, avg(f1) AS mf1 FROM classes GROUP BY {G})
SELECT v.model, v.tier, round(v.mf1 - r.mf1, 6) AS delta FROM f v
JOIN f r ON v.tier = r.tier AND r.model = 'm0' WHERE v.model <> 'm0'""")
def delta_vs_reference(spark, d):
    table = metrics.tier_eval(V.pairs(spark, d))
    return rounded(metrics.delta_vs_reference(table, "model", "m0", ["tier"], "macro_f1"), "delta")


COMPARE_SQL = f"""
{V.LABELLED_SQL}, {LOOKUP_SQL},
wide AS (
  SELECT l.tier, l.label_id, t.failed, t.original <> t.translated AS changed,
         CAST(CASE WHEN l.id % 2 = 0 THEN l.label_id ELSE l.id % 3 END AS INTEGER) AS po,
         CAST(CASE WHEN (l.id + 1) % 3 = 0 THEN l.label_id ELSE (l.id + 1) % 3 END AS INTEGER) AS pv
  FROM labelled l JOIN translated t ON l.id = t.id),
slices AS (
  SELECT tier, 'all' AS subset, 'o' AS which, label_id, po AS pred_id FROM wide
  UNION ALL SELECT tier, 'all', 'v', label_id, pv FROM wide
  UNION ALL SELECT tier, 'changed', 'o', label_id, po FROM wide WHERE changed
  UNION ALL SELECT tier, 'changed', 'v', label_id, pv FROM wide WHERE changed),
{V.class_sql('slices', 'tier, subset, which')},
f AS (SELECT tier, subset, which, avg(f1) AS mf1 FROM classes GROUP BY ALL),
w AS (SELECT tier, max(CASE WHEN subset = 'all' AND which = 'o' THEN mf1 END) AS fo,
  max(CASE WHEN subset = 'all' AND which = 'v' THEN mf1 END) AS fv,
  max(CASE WHEN subset = 'changed' AND which = 'o' THEN mf1 END) AS so,
  max(CASE WHEN subset = 'changed' AND which = 'v' THEN mf1 END) AS sv FROM f GROUP BY tier),
ns AS (SELECT tier, count(*) AS n, count(*) FILTER (WHERE failed) AS nf,
              count(*) FILTER (WHERE changed) AS nc FROM wide GROUP BY tier)"""


@query("variant_comparison", f"""
WITH {COMPARE_SQL}
SELECT w.tier, n, nf AS n_translation_failed, round(fo, 6) AS macro_f1_original,
  round(fv, 6) AS macro_f1_translated, round(fv - fo, 6) AS macro_f1_delta,
  nc AS n_nonenglish_translated, round(so, 6) AS macro_f1_original_sub,
  round(sv, 6) AS macro_f1_translated_sub, round(sv - so, 6) AS macro_f1_delta_sub
FROM w JOIN ns ON w.tier = ns.tier""")
def variant_comparison(spark, d):
    rows = V.labelled(spark, d).select("id", "tier", "label_id", "text")
    looked = joins.lookup_fallback(rows, "text", lookup_table(spark, d))
    i, y = F.col("id"), F.col("label_id")
    pairs = looked.select(
        "tier", "label_id", "failed", joins.changed_text("text", "translated").alias("changed"),
        F.when(i % 2 == 0, y).otherwise((i % 3).cast("int")).alias("pred_original"),
        F.when((i + 1) % 3 == 0, y).otherwise(((i + 1) % 3).cast("int")).alias("pred_variant"))
    table = variants.variant_comparison(pairs)
    return rounded(table, *[c for c in table.columns if c.startswith("macro_f1")])


@query("score_metrics", f"""
WITH scored AS (
  SELECT vec_id % 4 AS epoch, label % 3 AS label_id,
         CASE WHEN embedding[1] >= embedding[2] AND embedding[1] >= embedding[3] THEN 0
              WHEN embedding[2] >= embedding[3] THEN 1 ELSE 2 END AS pred_id FROM embeddings),
{V.class_sql('scored', 'epoch')}
SELECT epoch, round(CAST(sum(tp) AS DOUBLE) / sum(nt), 6) AS accuracy, round(avg(f1), 6) AS macro_f1
FROM classes GROUP BY epoch""")
def score_metrics(spark, d):
    rows = V.table(spark, d, "embeddings").select(
        (F.col("vec_id") % 4).alias("epoch"), (F.col("label") % 3).cast("int").alias("label_id"),
        F.slice("embedding", 1, 3).alias("scores"))
    return rounded(score_table(rows, "scores", ["epoch"]), "accuracy", "macro_f1")


# --- sheets and reports -------------------------------------------------------

@query("finalize_sheet", f"""
WITH {V.CLEANED_SQL}, {SHEET_SQL}
SELECT f.id, c.source, c.language, c.cleaned_text, f.sentiment_label FROM finals f
LEFT JOIN cleaned c ON CAST(f.id AS VARCHAR) = c.id
WHERE f.sentiment_label IN {V.label_list_sql()}""")
def finalize_sheet(spark, d):
    corpus = V.cleaned(V.reviews(spark, d)).withColumn("id", F.col("id").cast("long"))
    blind = sheets(spark, d).select("id", "text", "label_1", "final_label")
    return labeling.finalize_sheet(blind, corpus)


@query("export_labelled", f"""
WITH {V.CLEANED_SQL}, {V.LABELLED_SQL}
SELECT l.id, l.source, l.language, c.cleaned_text, l.sentiment_label FROM labelled l
JOIN cleaned c ON CAST(l.id AS VARCHAR) = c.id""")
def export_labelled(spark, d):
    return V.cleaned(V.labelled(spark, d)).select(*EXPORT_COLS)


@query("agreement_report", f"""
WITH {SHEET_SQL}, {PROXY_SQL}, {KAPPA_SQL},
base AS (SELECT tier, count(*) AS n, count(*) FILTER (WHERE ok) AS lab,
   count(*) FILTER (WHERE s = 'negative') AS neg, count(*) FILTER (WHERE s = 'neutral') AS neu,
   count(*) FILTER (WHERE s = 'positive') AS pos
 FROM (SELECT tier, sentiment_label AS s, sentiment_label IN {V.label_list_sql()} AS ok FROM finals)
 GROUP BY tier),
long AS (
  SELECT tier, 'rows' AS metric, CAST(n AS DOUBLE) AS value FROM base
  UNION ALL SELECT tier, 'labelled', lab FROM base UNION ALL SELECT tier, 'negative', neg FROM base
  UNION ALL SELECT tier, 'neutral', neu FROM base UNION ALL SELECT tier, 'positive', pos FROM base
  UNION ALL SELECT tier, 'non_negative', neu + pos FROM base
  UNION ALL SELECT tier, 'status_labelled', CASE WHEN lab > 0 THEN 1 ELSE 0 END FROM base
  UNION ALL SELECT tier, 'proxy_rows', n FROM kappas WHERE tier <> '{V.TIERS[2]}'
  UNION ALL SELECT tier, 'agreement', po FROM kappas WHERE tier <> '{V.TIERS[2]}'
  UNION ALL SELECT tier, 'kappa', CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END FROM kappas
            WHERE tier <> '{V.TIERS[2]}'
  UNION ALL SELECT tier, 'kappa', NULL FROM base WHERE tier = '{V.TIERS[2]}'
  UNION ALL SELECT t.tier, 'status_sheet_found', CASE WHEN b.tier IS NULL THEN 0 ELSE 1 END
    FROM (SELECT unnest(['{V.TIERS[0]}', '{V.TIERS[1]}', '{V.TIERS[2]}', 'Absent sheet']) AS tier) t LEFT JOIN base b USING (tier))
SELECT tier, metric, round(value, 6) AS value FROM long""")
def agreement_report(spark, d):
    done = labeling.with_final_label(sheets(spark, d))
    return rounded(labeling.agreement_report(done, V.TIERS[:2], [*V.TIERS, "Absent sheet"]), "value")
