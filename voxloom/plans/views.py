"""Standard inputs of the registered queries, derived from the given tables.

Each view exists twice: as a DataFrame and as the SQL text of the same definition.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.labels import label_id
from voxloom.functions.text import clean_text, word_count
from voxloom.operators.shaping import computed_once
from voxloom.schema import LABELS

# A taxonomy whose keywords occur in the invented prose of the given tables: words,
# a phrase, accents, a suffix that is rarely a whole word, and one without support.
TAXONOMY = {
    "a": ["the", "of the"], "b": ["la", "le"], "c": ["der", "und"], "d": ["tion"],
    "e": ["absentword"],
}
TIERS = ["App store (in-domain)", "Review site (cross-platform)", "Forum (cross-domain)"]
TIER_SHORT = ["in_domain", "cross_platform", "cross_domain"]
LANGUAGES = ["de", "en", "es", "fr"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as reviews; a star is missing on every eleventh row."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        doc.cast("string").alias("id"), "text",
        F.when(doc % 11 != 0, (doc % 5 + 1).cast("double")).alias("rating"),
        F.timestamp_seconds(F.lit(1_600_000_000) + doc * 3600).alias("date"),
        "source", F.col("lang").alias("app"), F.col("lang").alias("language"))


REVIEWS_SQL = """
reviews AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, text,
         CASE WHEN doc_id % 11 <> 0 THEN CAST(doc_id % 5 + 1 AS DOUBLE) END AS rating,
         1600000000 + doc_id * 3600 AS epoch,
         source, lang AS app, lang AS language
  FROM documents)"""


def cleaned(df: DataFrame) -> DataFrame:
    return (computed_once(df, cleaned_text=clean_text("text"))
            .withColumn("word_count", word_count("cleaned_text")))


# Back-references do not exist in the SQL engine's regular expressions, hence the lists.
SPACE_SQL = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{1c}-\x{1f}]"
NONSPACE_SQL = SPACE_SQL.replace("[", "[^", 1)


def urls_sql(c: str) -> str:
    return rf"regexp_replace({c}, 'https?://{NONSPACE_SQL}+|www\.{NONSPACE_SQL}+', ' ', 'g')"


def tags_sql(c: str) -> str:
    return f"regexp_replace({c}, '<[^>]+>', ' ', 'g')"


def squeeze_sql(chars: str) -> str:
    return (f"array_to_string(list_filter({chars}, lambda ch, i: NOT (i > 2 AND ch <> chr(10) "
            f"AND ch = {chars}[i-1] AND ch = {chars}[i-2])), '')")


def space_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SPACE_SQL}+', ' ', 'g'))"


def words_sql(c: str) -> str:
    return f"(CASE WHEN {c} = '' THEN 0 ELSE len(string_split({c}, ' ')) END)"


CLEANED_SQL = REVIEWS_SQL + f""",
chars AS (
  SELECT *, string_split({tags_sql(urls_sql("coalesce(text, '')"))}, '') AS s FROM reviews),
cleaned0 AS (
  SELECT * EXCLUDE (s), {space_sql(squeeze_sql('s'))} AS cleaned_text FROM chars),
cleaned AS (SELECT *, CAST({words_sql('cleaned_text')} AS INTEGER) AS word_count FROM cleaned0)"""


def sentiment() -> F.Column:
    return (F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
            .otherwise("neutral"))


def tier() -> F.Column:
    return (F.when(F.col("lang") == "en", TIERS[0]).when(F.col("lang") == "fr", TIERS[1])
            .otherwise(TIERS[2]))


def labelled(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """documents with a label, three classes, and their evaluation tier."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", sentiment().alias("sentiment_label"))
    joined = docs.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), *(["text"] if text else []), "source",
        F.col("lang").alias("language"), tier().alias("tier"), "sentiment_label")
    return joined.withColumn("label_id", label_id("sentiment_label"))


LABELLED_SQL = f"""
labelled AS (
  SELECT d.doc_id AS id, d.text, d.source, d.lang AS language,
         CASE d.lang WHEN 'en' THEN '{TIERS[0]}' WHEN 'fr' THEN '{TIERS[1]}'
              ELSE '{TIERS[2]}' END AS tier,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
              ELSE 'neutral' END AS sentiment_label,
         CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 ELSE 1 END AS label_id
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic predictions of two models for every labelled row: (id, model, pred_id)."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", label_id(sentiment()).alias("truth"))
    model = F.explode(F.array(F.lit(0), F.lit(1))).alias("m")
    rows = labels.select("doc_id", "truth", model)
    guess = ((F.col("doc_id") + F.col("m")) % 3).cast("int")
    hit = (F.col("doc_id") + F.col("m")) % (F.col("m") + 2) == 0
    return rows.select(F.col("doc_id").alias("id"),
                       F.concat(F.lit("m"), F.col("m").cast("string")).alias("model"),
                       F.when(hit, F.col("truth")).otherwise(guess).alias("pred_id"))


PREDS_SQL = LABELLED_SQL + """,
preds AS (
  SELECT id, 'm' || m AS model,
         CASE WHEN (id + m) % (m + 2) = 0 THEN label_id ELSE CAST((id + m) % 3 AS INTEGER) END
           AS pred_id
  FROM labelled CROSS JOIN (SELECT unnest([0, 1]) AS m)),
pairs AS (
  SELECT p.model, l.tier, l.id, l.label_id, p.pred_id, l.text FROM preds p JOIN labelled l USING (id))"""


def pairs(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Truth and prediction per (model, tier); texts stay behind unless asked for."""
    truth = labelled(spark, sf_dir, text="text" in extra).select("id", "tier", "label_id", *extra)
    return predictions(spark, sf_dir).join(truth, "id")


def class_sql(source: str, groups: str, truth: str = "label_id", pred: str = "pred_id") -> str:
    """Per-class counts over the union of true and predicted classes, and their F1."""
    g = f"{groups}, " if groups else ""
    by = f"GROUP BY {g}class" if g else "GROUP BY class"
    return f"""
sides AS (
  SELECT {g}{truth} AS class, 1 AS nt, 0 AS np, CASE WHEN {truth} = {pred} THEN 1 ELSE 0 END AS tp
  FROM {source}
  UNION ALL SELECT {g}{pred}, 0, 1, 0 FROM {source}),
classes AS (
  SELECT {g}class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(nt) AS BIGINT) AS nt,
         CAST(sum(np) AS BIGINT) AS np, 2.0 * sum(tp) / (sum(nt) + sum(np)) AS f1
  FROM sides {by})"""


def keyword_sql(text: str, keywords: list[str]) -> str:
    alternation = "|".join(keywords)
    return (rf"regexp_matches(lower({text}), '(^|[^\p{{L}}\p{{N}}_])({alternation})"
            rf"($|[^\p{{L}}\p{{N}}_])')")


def aspects_sql(text: str) -> str:
    """List of matched aspects in taxonomy order."""
    items = ", ".join(f"CASE WHEN {keyword_sql(text, k)} THEN '{a}' END"
                      for a, k in TAXONOMY.items())
    return f"list_filter([{items}], lambda x: x IS NOT NULL)"


TOKENS_SQL = r"regexp_extract_all(lower(coalesce({}, '')), '[\p{{L}}\p{{N}}_]{{2,}}')"


def tokens_sql(text: str) -> str:
    return TOKENS_SQL.format(text)


def label_list_sql() -> str:
    return "(" + ", ".join(f"'{x}'" for x in LABELS) + ")"
