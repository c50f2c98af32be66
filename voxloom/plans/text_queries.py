"""Text, label and date expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import dates as D
from voxloom.functions import emoji as E
from voxloom.functions import labels as L
from voxloom.functions import stem as S
from voxloom.functions import text as X
from voxloom.operators import corpus, degradation, labeling
from voxloom.plans import views as V
from voxloom.plans.registry import query
from voxloom.schema import LABELS, TRANSLATION_CHARS

KEYWORDS = ["the", "la", "und", "of the"]


def documents(spark, d):
    return V.table(spark, d, "documents")


@query("null_text", """
SELECT doc_id AS id, coalesce(CASE WHEN lang <> 'es' THEN text END, '') AS text FROM documents""")
def null_text(spark, d):
    maybe = F.when(F.col("lang") != "es", F.col("text"))
    return documents(spark, d).select(F.col("doc_id").alias("id"), X.null_text(maybe).alias("text"))


@query("strip_urls", f"""
SELECT page_id AS id, {V.urls_sql("'see ' || url || ' ' || html")} AS text FROM pages""")
def strip_urls(spark, d):
    text = F.concat(F.lit("see "), "url", F.lit(" "), "html")
    return V.table(spark, d, "pages").select(
        F.col("page_id").alias("id"), X.strip_urls(text).alias("text"))


@query("strip_tags", f"SELECT page_id AS id, {V.tags_sql('html')} AS text FROM pages")
def strip_tags(spark, d):
    return V.table(spark, d, "pages").select(
        F.col("page_id").alias("id"), X.strip_tags("html").alias("text"))


@query("squeeze_repeats", f"""
WITH chars AS (SELECT doc_id AS id, string_split(text, '') AS s FROM documents)
SELECT id, {V.squeeze_sql('s')} AS text FROM chars""")
def squeeze_repeats(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), X.squeeze_repeats("text").alias("text"))


@query("collapse_space", f"SELECT doc_id AS id, {V.space_sql('text')} AS text FROM documents")
def collapse_space(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), X.collapse_space("text").alias("text"))


@query("clean_text", f"WITH {V.CLEANED_SQL} SELECT id, cleaned_text FROM cleaned")
def clean_text(spark, d):
    return V.cleaned(V.reviews(spark, d)).select("id", "cleaned_text")


@query("word_count", f"WITH {V.CLEANED_SQL} SELECT id, word_count FROM cleaned")
def word_count(spark, d):
    return V.cleaned(V.reviews(spark, d)).select("id", "word_count")


@query("min_words", f"WITH {V.CLEANED_SQL} SELECT id, word_count FROM cleaned WHERE word_count >= 5")
def min_words(spark, d):
    return V.cleaned(V.reviews(spark, d)).filter(F.col("word_count") >= 5).select(
        "id", "word_count")


@query("keyword_match", f"""
SELECT doc_id AS id, {V.keyword_sql('text', KEYWORDS)} AS found FROM documents""")
def keyword_match(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), X.keyword_match("text", KEYWORDS).alias("found"))


@query("extract_aspects", f"""
WITH {V.CLEANED_SQL}
SELECT id, array_to_string({V.aspects_sql('cleaned_text')}, '|') AS aspects FROM cleaned""")
def extract_aspects(spark, d):
    return V.cleaned(V.reviews(spark, d)).select(
        "id", F.array_join(X.extract_aspects("cleaned_text", V.TAXONOMY), "|").alias("aspects"))


@query("has_aspect", f"""
WITH {V.CLEANED_SQL}
SELECT id, list_contains({V.aspects_sql('cleaned_text')}, 'b') AS has_b FROM cleaned""")
def has_aspect(spark, d):
    tags = X.extract_aspects("cleaned_text", V.TAXONOMY)
    return V.cleaned(V.reviews(spark, d)).select("id", F.array_contains(tags, "b").alias("has_b"))


SENTENCES_SQL = rf"string_split(regexp_replace(text, '([.!?]){V.SPACE_SQL}+|\n+', '\1' || chr(1), 'g'), chr(1))"


@query("split_sentences", rf"""
WITH parts AS (SELECT doc_id AS id, {SENTENCES_SQL} AS p FROM documents)
SELECT id, CAST(i - 1 AS INTEGER) AS pos, p[i] AS sentence
FROM (SELECT id, p, unnest(range(1, len(p) + 1)) AS i FROM parts)""")
def split_sentences(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"),
        F.posexplode_outer(X.split_sentences("text")).alias("pos", "sentence"))


@query("aspect_sentences", rf"""
WITH parts AS (SELECT doc_id AS id, text, {SENTENCES_SQL} AS p FROM documents),
hits AS (SELECT id, text, array_to_string(
           list_filter(p, lambda s: {V.keyword_sql('s', V.TAXONOMY['b'])}), ' ') AS j FROM parts)
SELECT id, coalesce(nullif(regexp_replace(j, '^{V.SPACE_SQL}+|{V.SPACE_SQL}+$', '', 'g'), ''), text)
  AS snippet FROM hits""")
def aspect_sentences(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"),
        X.aspect_sentences("text", V.TAXONOMY["b"]).alias("snippet"))


@query("tokenize", f"""
WITH t AS (SELECT doc_id AS id, {V.tokens_sql('text')} AS tok FROM documents)
SELECT id, CAST(len(tok) AS INTEGER) AS n_tokens, array_to_string(tok, ' ') AS tokens FROM t""")
def tokenize(spark, d):
    tokens = X.tokenize("text")
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), F.size(tokens).alias("n_tokens"),
        F.array_join(tokens, " ").alias("tokens"))


@query("ngrams", f"""
WITH t AS (SELECT doc_id AS id, {V.tokens_sql('text')} AS tok FROM documents),
g AS (SELECT id, list_concat(tok, list_transform(range(1, greatest(len(tok), 1)),
              lambda i: tok[i] || ' ' || tok[i+1])) AS gr FROM t)
SELECT id, CAST(len(gr) AS INTEGER) AS n_grams, md5(array_to_string(gr, '|')) AS grams_md5 FROM g""")
def ngrams(spark, d):
    grams = X.ngrams(F.col("tok"), 2)
    return (documents(spark, d)
            .select(F.col("doc_id").alias("id"), X.tokenize("text").alias("tok"))
            .select("id", grams.alias("gr"))
            .select("id", F.size("gr").alias("n_grams"),
                    F.md5(F.array_join("gr", "|")).alias("grams_md5")))


@query("stem_text")
def stem_text(spark, d):
    docs = documents(spark, d)
    known = S.learn_stems(docs, "text")
    return docs.select(F.col("doc_id").alias("id"), S.stem_text("text", known).alias("stemmed"))


# An emoji tail by language: thumbs up with skin tone, heart with variation selector, a flag.
EMOJI_TAILS = {"en": " \U0001F44D\U0001F3FD ok", "fr": " ❤️", "de": " \U0001F1E9\U0001F1EA"}


# Tails of the texts by doc_id, and literally what is expected of each: whether it holds an emoji,
# what is left of it, and how it is described.
TAILS = [
    (" \U0001F44D\U0001F3FD ok", True, "  ok", "  thumbs up medium skin tone  ok"),
    (" \u2764\uFE0F", True, " ", "  heavy black heart "),
    (" \U0001F1E9\U0001F1EA", True, " ", "  flag de "),
    (" \u2B50a", True, " a", "  white medium star a"),
    (" \u23F0", True, " ", "  alarm clock "),
    (" \u2713", False, " \u2713", " \u2713"),
    (" 1\uFE0F\u20E3 1", True, "  1", "  keycap 1  1"),
    (" a\u200Db", False, " a\u200Db", " a\u200Db"),
    (" \U0001F468\u200D\U0001F469\u200D\U0001F467!", True, " !", "  family man woman girl !"),
    (" \U0001F1F2\U0001F1FE\U0001F1F8\U0001F1EC", True, " ", "  flag my  flag sg "),
    (" \U0001F469\U0001F3FE\u200D\U0001F4BBx", True, " x", "  woman medium-dark skin tone personal computer x"),
    (" \U0001F3F3\uFE0F\u200D\U0001F308 #\uFE0F\u20E3", True, "  ", "  waving white flag rainbow   keycap # "),
    (" \U0001F600\U0001F600", True, " ", "  grinning face  grinning face "),
]


def _tail_sql(field: int) -> str:
    cases = " ".join(f"WHEN {i} THEN " + (f"'{t[field]}'" if field != 1 else str(t[1])) for i, t in enumerate(TAILS))
    return f"CASE doc_id % {len(TAILS)} {cases} END"


def with_emoji():
    tails = F.array(*[F.lit(t[0]) for t in TAILS])
    return F.concat("text", F.get(tails, (F.col("doc_id") % len(TAILS)).cast("int")))


@query("has_emoji", f"SELECT doc_id AS id, {_tail_sql(1)} AS has_emoji FROM documents")
def has_emoji(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), E.has_emoji(with_emoji()).alias("has_emoji"))


@query("emoji_strip", f"SELECT doc_id AS id, text || {_tail_sql(2)} AS text FROM documents")
def emoji_strip(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), E.emoji_strip(with_emoji()).alias("text"))


@query("emoji_demojize", f"""
SELECT doc_id AS id, replace(text, '_', ' ') || {_tail_sql(3)} AS text FROM documents""")
def emoji_demojize(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), E.emoji_demojize(with_emoji()).alias("text"))


@query("emoji_prevalence", f"""
SELECT lang, round(avg(CASE WHEN {_tail_sql(1)} THEN 100.0 ELSE 0 END), 6)
         AS emoji_percent, count(*) AS n
FROM documents GROUP BY lang""")
def emoji_prevalence(spark, d):
    marked = documents(spark, d).select("lang", with_emoji().alias("text"))
    return degradation.emoji_prevalence(marked, "lang", "text").withColumn(
        "emoji_percent", F.round("emoji_percent", 6))


@query("display_aspect", """
SELECT doc_id AS id, replace(lang || '_' || source || '_x', '_', ' ') AS shown FROM documents""")
def display_aspect(spark, d):
    name = F.concat("lang", F.lit("_"), "source", F.lit("_x"))
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), X.display_aspect(name).alias("shown"))


@query("slug", """
SELECT doc_id AS id, translate('M-' || lang || '/' || source || ' v1', '-/ ', '___') AS slug
FROM documents""")
def slug(spark, d):
    name = F.concat(F.lit("M-"), "lang", F.lit("/"), "source", F.lit(" v1"))
    return documents(spark, d).select(F.col("doc_id").alias("id"), X.slug(name).alias("slug"))


@query("tier_short", f"""
WITH {V.LABELLED_SQL} SELECT id, string_split(tier, ' (')[1] AS tier_short FROM labelled""")
def tier_short(spark, d):
    return V.labelled(spark, d, text=False).select(
        "id", X.tier_short("tier").alias("tier_short"))


@query("concat_title_body", f"""
SELECT conv_id, turn, regexp_replace(role || chr(10) || chr(10) ||
         coalesce(CASE WHEN role <> 'system' THEN text END, ''),
         '^{V.SPACE_SQL}+|{V.SPACE_SQL}+$', '', 'g') AS text FROM conversations""")
def concat_title_body(spark, d):
    body = F.when(F.col("role") != "system", F.col("text"))
    return V.table(spark, d, "conversations").select(
        "conv_id", "turn", X.concat_title_body("role", body).alias("text"))


@query("post_id", """
SELECT conv_id, turn, 'forum_' || conv_id || '_' || (turn * 20 + 3) AS post_id FROM conversations""")
def post_id(spark, d):
    return V.table(spark, d, "conversations").select(
        "conv_id", "turn", X.post_id("forum", "conv_id", "turn", F.lit(3), 20).alias("post_id"))


@query("id_fallback", """
SELECT doc_id, CASE WHEN lang = 'es' OR lang = 'de' THEN source || '_1_' || doc_id
                    ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents""")
def id_fallback(spark, d):
    given = F.when(F.col("lang") == "es", F.lit("")).when(
        F.col("lang") != "de", F.col("doc_id").cast("string"))
    return documents(spark, d).select(
        "doc_id", X.id_fallback(given, "source", F.lit(1), "doc_id").alias("id"))


@query("extract_topic_id", """
SELECT page_id, nullif(regexp_extract(url || '/topic/' || page_id || '?x', '/topic/(\\d+)', 1), '')
         AS topic_id FROM pages""")
def extract_topic_id(spark, d):
    url = F.concat("url", F.lit("/topic/"), F.col("page_id").cast("string"), F.lit("?x"))
    return V.table(spark, d, "pages").select(
        "page_id", X.extract_topic_id(url).alias("topic_id"))


@query("truncate_text", f"""
SELECT doc_id AS id, substring(text, 1, {TRANSLATION_CHARS}) AS text FROM documents""")
def truncate_text(spark, d):
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), X.truncate_text("text", TRANSLATION_CHARS).alias("text"))


@query("page_url", """
SELECT conv_id, turn, 'https://forum.example/topic/' || conv_id ||
         CASE WHEN turn > 0 THEN '?st=' || (turn * 20) ELSE '' END AS url FROM conversations""")
def page_url(spark, d):
    return V.table(spark, d, "conversations").select(
        "conv_id", "turn",
        X.page_url("https://forum.example", "conv_id", F.col("turn") * 20).alias("url"))


# --- labels -------------------------------------------------------------------

STAR_SQL = ("CASE WHEN rating IS NULL THEN '' WHEN rating < 3 THEN 'negative' "
            "WHEN rating < 4 THEN 'neutral' ELSE 'positive' END")


@query("star_label", f"""
WITH {V.REVIEWS_SQL} SELECT id, {STAR_SQL.replace('rating', '(rating - 0.1)')} AS label FROM reviews""")
def star_label(spark, d):
    return V.reviews(spark, d).select("id", L.star_label(F.col("rating") - 0.1).alias("label"))


@query("label_map", f"""
WITH {V.LABELLED_SQL} SELECT id, CAST(label_id AS INTEGER) AS label_id, sentiment_label AS label
FROM labelled""")
def label_map(spark, d):
    rows = V.labelled(spark, d, text=False)
    return rows.select("id", L.label_id("sentiment_label").alias("label_id")).withColumn(
        "label", L.id_label("label_id"))


SHEET_SQL = V.LABELLED_SQL + f""",
sheets AS (
  SELECT id, text, source, language, tier,
         CASE WHEN source = 'src3' THEN 'n/a' WHEN language = 'fr' THEN upper(sentiment_label)
              WHEN language = 'de' THEN '  ' || sentiment_label || ' ' ELSE sentiment_label END
           AS label_1,
         CASE WHEN source = 'src7' THEN ' Neutral' WHEN source = 'src8' THEN 'unsure' END
           AS final_label,
         CASE WHEN id % 11 <> 0 THEN CAST(id % 5 + 1 AS DOUBLE) END AS rating
  FROM labelled),
finals AS (
  SELECT *, CASE WHEN trim(lower(coalesce(final_label, ''))) IN {V.label_list_sql()}
                 THEN trim(lower(final_label)) ELSE trim(lower(coalesce(label_1, ''))) END
              AS sentiment_label
  FROM sheets)"""


def sheets(spark, d):
    """Annotated sheets: upper case, padding, invalid labels, few final decisions."""
    rows = V.labelled(spark, d)
    lab, src, lang = F.col("sentiment_label"), F.col("source"), F.col("language")
    label_1 = (F.when(src == "src3", "n/a").when(lang == "fr", F.upper(lab))
               .when(lang == "de", F.concat(F.lit("  "), lab, F.lit(" "))).otherwise(lab))
    final = F.when(src == "src7", " Neutral").when(src == "src8", "unsure")
    rating = F.when(F.col("id") % 11 != 0, (F.col("id") % 5 + 1).cast("double"))
    return rows.select("id", "text", "source", "language", "tier", label_1.alias("label_1"),
                       final.alias("final_label"), rating.alias("rating"))


@query("norm_label", f"WITH {SHEET_SQL} SELECT id, trim(lower(label_1)) AS label FROM sheets")
def norm_label(spark, d):
    return sheets(spark, d).select("id", L.norm_label("label_1").alias("label"))


@query("final_label", f"WITH {SHEET_SQL} SELECT id, sentiment_label AS label FROM finals")
def final_label(spark, d):
    return sheets(spark, d).select("id", L.final_label("final_label", "label_1").alias("label"))


@query("label_isin", f"""
WITH {V.REVIEWS_SQL}, stars AS (SELECT id, {STAR_SQL} AS label FROM reviews)
SELECT id, label FROM stars WHERE label IN ('neutral', 'positive')""")
def label_isin(spark, d):
    return V.reviews(spark, d).select("id", L.star_label("rating").alias("label")).filter(
        F.col("label").isin("neutral", "positive"))


@query("valid_labels", f"""
WITH {SHEET_SQL}
SELECT id, sentiment_label, CAST(CASE sentiment_label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1
         ELSE 2 END AS INTEGER) AS label_id
FROM finals WHERE sentiment_label IN {V.label_list_sql()}""")
def valid_labels(spark, d):
    return corpus.valid_labels(labeling.with_final_label(sheets(spark, d))).select("id", "sentiment_label", "label_id")


@query("language_name", """
SELECT doc_id AS id, CASE lang WHEN 'en' THEN 'English' WHEN 'es' THEN
  'Indonesian — note: likely Bahasa Melayu (langdetect conflates BM with Indonesian)'
  ELSE lang END AS name FROM documents""")
def language_name(spark, d):
    code = F.when(F.col("lang") == "es", "id").otherwise(F.col("lang"))
    return documents(spark, d).select(
        F.col("doc_id").alias("id"), L.language_name(code).alias("name"))


@query("argmax_label", """
SELECT vec_id, CASE WHEN embedding[1] >= embedding[2] AND embedding[1] >= embedding[3] THEN 'negative'
                    WHEN embedding[2] >= embedding[3] THEN 'neutral' ELSE 'positive' END AS label
FROM embeddings""")
def argmax_label(spark, d):
    scores = F.slice("embedding", 1, 3)
    return V.table(spark, d, "embeddings").select(
        "vec_id", L.argmax_label(scores, LABELS).alias("label"))


# --- dates --------------------------------------------------------------------

@query("epoch_to_ts", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_seconds,
       CAST(year(ts) AS INTEGER) AS year, CAST(hour(ts) AS INTEGER) AS hour FROM events""")
def epoch_to_ts(spark, d):
    ts = D.epoch_to_ts(F.unix_seconds(F.col("ts").cast("timestamp")))
    return V.table(spark, d, "events").select("event_id", ts.alias("t")).select(
        "event_id", F.unix_seconds("t").alias("epoch_seconds"), F.year("t").alias("year"),
        F.hour("t").alias("hour"))


@query("iso_to_ts", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch_seconds FROM events""")
def iso_to_ts(spark, d):
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return V.table(spark, d, "events").select(
        "event_id", F.unix_seconds(D.iso_to_ts(iso)).alias("epoch_seconds"))
