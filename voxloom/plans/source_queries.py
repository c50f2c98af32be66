"""Scans, sinks, adapters, page and thread operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions.dates import aligned_dates, find_post_dates, post_date_to_ts
from voxloom.operators import corpus, dedup, metrics, ranking
from voxloom.operators.degradation import aspect_distribution, tag_aspects
from voxloom.operators.shaping import fan_out
from voxloom.operators.shaping import union_by_name as union_all
from voxloom.plans import views as V
from voxloom.plans.model_queries import detected_sql, language_model, profile_sql
from voxloom.plans.registry import query
from voxloom.schema import (LABELLED_SCHEMA, POSTS_PER_PAGE, REVIEW_COLS, REVIEW_SCHEMA,
                            THREADS_PER_FORUM, TIER_EVAL_SCHEMA, with_declared_schema)
from voxloom.session import scratch_path
from voxloom.sources import adapters, html, readers, sinks

ROWS_SQL = """SELECT id, text, rating, epoch, source, app FROM reviews"""


def _rows(df):
    return df.select("id", "text", "rating", F.unix_seconds("date").alias("epoch"), "source", "app")


def reviews(spark, d):
    return V.reviews(spark, d).select(*REVIEW_COLS)


# --- scans and sinks ----------------------------------------------------------

@query("scan_csv_glob", f"""
WITH {V.REVIEWS_SQL} SELECT id, text, rating, source, app,
  CASE WHEN app IN ('en', 'fr') THEN epoch ELSE epoch // 60 * 60 END AS epoch FROM reviews""")
def scan_csv_glob(spark, d):
    """Files of different column orders, further columns and three ways to write a date.

    Forum dates are written to the minute.
    """
    folder = scratch_path(spark, "raw")
    rows = reviews(spark, d)
    iso = F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    forum = F.date_format("date", "MMM d yyyy, h:mm a")
    epoch = F.unix_seconds("date").cast("string")
    sinks.write_csv(rows.filter("app = 'en'").withColumn("date", iso), f"{folder}/store")
    sinks.write_csv(rows.filter("app = 'fr'").withColumn("date", epoch).select(
        "app", "id", "text", "rating", "source", "date"), f"{folder}/site")
    sinks.write_csv(rows.filter("app not in ('en', 'fr')").withColumn("date", forum).select(
        "date", F.lit(1).alias("likes"), "source", "text", "id", "app", "rating"), f"{folder}/forum")
    return _rows(readers.read_reviews(spark, f"{folder}/*/*.csv"))


@query("scan_optional", f"WITH {V.REVIEWS_SQL} {ROWS_SQL}")
def scan_optional(spark, d):
    folder = scratch_path(spark, "optional")
    there = sinks.write_csv(reviews(spark, d), f"{folder}/there")
    return _rows(readers.read_optional(spark, [f"{folder}/absent", there], REVIEW_SCHEMA))


FILE_ROWS, BROKEN_AT = 200, 12   # documents of a file, and the row of a file whose quote is never closed


@query("csv_quarantine", f"""
WITH lines AS (SELECT doc_id, source, lang, doc_id % 10 AS kind FROM documents)
SELECT 'whole' AS part, CAST(doc_id AS VARCHAR) AS id, CASE kind WHEN 3 THEN source || chr(10) || 'x, y' WHEN 4 THEN '"' || source ELSE source END AS text
FROM lines WHERE kind NOT IN (1, 2)
UNION ALL SELECT 'whole', 'b' || doc_id, source FROM lines WHERE doc_id % {FILE_ROWS} < {BROKEN_AT}
UNION ALL SELECT CASE kind WHEN 1 THEN 'missing fields' ELSE 'extra fields' END, NULL,
  CASE kind WHEN 1 THEN doc_id || ',' || source ELSE doc_id || ',' || source || ',' || lang || ',more' END FROM lines WHERE kind IN (1, 2)
UNION ALL SELECT 'broken quote', NULL,
  string_agg('b' || doc_id || ',' || CASE WHEN doc_id % {FILE_ROWS} = {BROKEN_AT} THEN '"' ELSE '' END || source || ',' || lang, chr(10) ORDER BY doc_id)
FROM lines WHERE doc_id % {FILE_ROWS} >= {BROKEN_AT} GROUP BY doc_id // {FILE_ROWS}""")
def csv_quarantine(spark, d):
    """Files with blanks in their names; records with too few or too many fields, one with an open quote.

    The well-formed rows, as a tolerant scan reads them, and the quarantined records by reason.
    """
    folder = scratch_path(spark, "raw data")
    doc, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 10
    docs = V.table(spark, d, "documents")
    line = (F.when(kind == 1, F.concat_ws(",", doc, "source"))
            .when(kind == 2, F.concat_ws(",", doc, "source", "lang", F.lit("more")))
            .when(kind == 3, F.concat(doc, F.lit(',"'), "source", F.lit('\nx, y",'), "lang"))
            .when(kind == 4, F.concat(doc, F.lit(',"""'), "source", F.lit('",'), "lang")).otherwise(F.concat_ws(",", doc, "source", "lang")))
    broken = F.concat(F.lit("b"), doc, F.lit(","), F.when(F.col("doc_id") % FILE_ROWS == BROKEN_AT, '"').otherwise(""), "source", F.lit(","), "lang")
    file = F.floor(F.col("doc_id") / FILE_ROWS).alias("file")

    def write(name, value):
        # Files of some rows, each behind its header, as people send them.
        header = docs.select(file).distinct().select("file", F.lit(-1).cast("long").alias("doc_id"), F.lit("id,text,app").alias("value"))
        rows = header.unionByName(docs.select(file, "doc_id", value.alias("value")))
        (rows.repartition("file").sortWithinPartitions("file", "doc_id").select("file", "value")
         .write.partitionBy("file").text(f"{folder}/{name}"))

    write("all rows", line)
    write("open quote", broken)
    glob = f"{folder}/*"
    good = readers.read_csv(spark, glob, REVIEW_SCHEMA, True).select(F.lit("whole").alias("part"), "id", "text")
    kept = sinks.write_quarantine(readers.malformed_records(spark, glob), scratch_path(spark, "quarantine"))
    bad = spark.read.parquet(kept).select(F.col("reason").alias("part"), F.lit(None).cast("string").alias("id"), F.rtrim("record").alias("text"))
    return good.unionByName(bad)


@query("scan_pruned", "SELECT doc_id AS id, lang FROM documents")
def scan_pruned(spark, d):
    return V.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang")


@query("scan_labelled", f"""
WITH {V.LABELLED_SQL} SELECT CAST(id AS VARCHAR) AS id, sentiment_label,
  CAST(label_id AS INTEGER) AS label_id FROM labelled""")
def scan_labelled(spark, d):
    path = scratch_path(spark, "labelled")
    sinks.write_table(with_declared_schema(V.labelled(spark, d), LABELLED_SCHEMA), path)
    return readers.read_labelled(spark, path).select("id", "sentiment_label", "label_id")


@query("sink_roundtrip", f"WITH {V.REVIEWS_SQL} {ROWS_SQL}")
def sink_roundtrip(spark, d):
    path = scratch_path(spark, "corpus")
    sinks.write_table(reviews(spark, d), path, ["app"])
    return _rows(spark.read.schema(REVIEW_SCHEMA).parquet(path))


@query("sink_ignore_existing", f"WITH {V.REVIEWS_SQL} {ROWS_SQL}")
def sink_ignore_existing(spark, d):
    path = scratch_path(spark, "sheet")
    sinks.write_new(reviews(spark, d), path, "parquet")
    later = reviews(spark, d).withColumn("text", F.lit("changed"))
    sinks.write_new(later, path, "parquet")
    return _rows(spark.read.schema(REVIEW_SCHEMA).parquet(path))


@query("sink_partitions", f"""
WITH {V.REVIEWS_SQL} SELECT id, CASE WHEN app = 'fr' THEN 'changed' ELSE text END AS text, rating, epoch, source, app FROM reviews
WHERE app <> 'fr' OR rating IS NOT NULL""")
def sink_partitions(spark, d):
    """A second run of one partition; the files of the others stay."""
    path = scratch_path(spark, "partitions")
    rows = reviews(spark, d)
    sinks.write_table(rows, path, ["app"])
    rerun = rows.filter("app = 'fr' and rating is not null").withColumn("text", F.lit("changed"))
    sinks.write_table(rerun, path, ["app"], replace="partitions")
    return _rows(spark.read.schema(REVIEW_SCHEMA).parquet(path))


@query("sink_new_sheets", f"""
WITH {V.REVIEWS_SQL} SELECT id, CASE WHEN app = 'de' THEN 'later' ELSE text END AS text, app FROM reviews WHERE app IN ('en', 'fr', 'de')""")
def sink_new_sheets(spark, d):
    """A new sheet joins those that are there; these keep their rows."""
    path = scratch_path(spark, "sheets")
    rows = reviews(spark, d).select("id", "text", "app")
    sinks.write_new_sheets(rows.filter("app in ('en', 'fr')"), path, "app")
    sinks.write_new_sheets(rows.filter("app in ('fr', 'de')").withColumn("text", F.lit("later")), path, "app")
    return spark.read.parquet(path).select("id", "text", "app")


@query("empty_result_schema", """
SELECT '' AS tier, '' AS model, 0.0::DOUBLE AS accuracy, 0.0::DOUBLE AS macro_f1 FROM documents WHERE false""")
def empty_result_schema(spark, d):
    """No prediction at all: the header-only result, of the declared columns."""
    scored = metrics.tier_eval(V.pairs(spark, d).filter(F.col("pred_id") < 0))
    return sinks.results_or_empty(spark, [scored], TIER_EVAL_SCHEMA).select(
        "tier", "model", "accuracy", "macro_f1")


# --- adapters -----------------------------------------------------------------

@query("adapt_flat_source", """
SELECT CAST(doc_id AS VARCHAR) AS id, text, doc_id % 5 + 1 AS rating, 1600000000 + doc_id AS epoch,
       'play_store' AS source, 'App-' || lang AS app FROM documents""")
def adapt_flat_source(spark, d):
    doc = F.col("doc_id")
    raw = V.table(spark, d, "documents").select(
        doc.cast("string").alias("reviewId"), F.col("text").alias("content"),
        (doc % 5 + 1).alias("score"), F.timestamp_seconds(doc + 1_600_000_000).alias("at"),
        "lang", "n_chars")
    return _rows(adapters.adapt_flat_source(
        raw, "play_store", F.concat(F.lit("App-"), F.col("lang"))))


EMPTY_EVERY = 50


def feed(spark, d):
    """One JSON page per document: its text under a content id, and a row without an id.

    Every fiftieth page is empty.
    """
    doc = F.col("doc_id")
    day = F.date_format(F.timestamp_seconds(doc * 3600 + 1_600_000_000),
                        "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    own = F.struct(F.md5("text").alias("id"), F.concat(F.lit(" "), "text", F.lit("\n")).alias("text"),
                   (doc % 5 + 1).cast("double").alias("rating"),
                   F.struct(day.alias("publishedDate")).alias("dates"))
    none = F.struct(F.lit(None).cast("string").alias("id"), F.col("source").alias("text"),
                    F.lit(3.0).alias("rating"),
                    F.struct(F.lit(None).cast("string").alias("publishedDate")).alias("dates"))
    listed = F.when(doc % EMPTY_EVERY != EMPTY_EVERY - 1, F.array(own, none)).otherwise(F.array())
    page = F.struct(F.struct(F.struct(listed.alias("reviews")).alias("pageProps"))
                    .alias("props"))
    return V.table(spark, d, "documents").select(
        F.col("lang").alias("brand"), doc.alias("page"), F.to_json(page).alias("json"))


FEED_SQL = f"""
feed AS (
  SELECT md5(text) AS id, regexp_replace(text, '^{V.SPACE_SQL}+|{V.SPACE_SQL}+$', '', 'g') AS text,
         CAST(doc_id % 5 + 1 AS DOUBLE) AS rating, 1600000000 + doc_id * 3600 AS epoch,
         lang AS app, doc_id AS page, 0 AS pos FROM documents WHERE doc_id % {EMPTY_EVERY} <> {EMPTY_EVERY - 1}
  UNION ALL SELECT NULL, source, 3.0, NULL, lang, doc_id, 1 FROM documents
  WHERE doc_id % {EMPTY_EVERY} <> {EMPTY_EVERY - 1})"""


@query("json_reviews", f"WITH {FEED_SQL} SELECT id, text, rating, epoch, app, page, pos FROM feed")
def json_reviews(spark, d):
    return adapters.feed_reviews(feed(spark, d), "trustpilot").select(
        "id", "text", "rating", F.unix_seconds("date").alias("epoch"), "app", "page", "pos")


@query("json_reviews_dedup", f"""
WITH {FEED_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY app, id ORDER BY page, pos) AS rn FROM feed),
kept AS (SELECT *, row_number() OVER (PARTITION BY app ORDER BY page, pos) - 1 AS n
         FROM ranked WHERE rn = 1)
SELECT coalesce(id, app || '_' || page || '_' || n) AS id, text, rating, epoch, app, page FROM kept""")
def json_reviews_dedup(spark, d):
    rows = adapters.feed_reviews(feed(spark, d), "trustpilot")
    return adapters.dedup_feed(rows).select(
        "id", "text", "rating", F.unix_seconds("date").alias("epoch"), "app", "page")


PAGES_SQL = FEED_SQL + """,
firsts AS (SELECT app, id, min(page) AS page FROM feed GROUP BY app, id),
counts AS (SELECT f.app, f.page, count(x.page) AS new_ids FROM (SELECT lang AS app, doc_id AS page FROM documents) f
           LEFT JOIN firsts x ON x.app = f.app AND x.page = f.page GROUP BY f.app, f.page),
ends AS (SELECT app, min(page) AS stop FROM counts WHERE new_ids = 0 GROUP BY app),
readable AS (SELECT c.app, c.page, c.new_ids FROM counts c LEFT JOIN ends e ON c.app = e.app
             WHERE e.stop IS NULL OR c.page < e.stop)"""


@query("new_ids_per_page", f"WITH {PAGES_SQL} SELECT app, page, new_ids FROM readable")
def new_ids_per_page(spark, d):
    pages = feed(spark, d)
    return adapters.readable_pages(pages, adapters.feed_reviews(pages, "trustpilot"))


@query("feed_corpus", f"""
WITH {PAGES_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY app, id ORDER BY page, pos) AS rn FROM feed SEMI JOIN readable USING (app, page)),
kept AS (SELECT *, row_number() OVER (PARTITION BY app ORDER BY page, pos) - 1 AS n FROM ranked WHERE rn = 1)
SELECT coalesce(id, app || '_' || page || '_' || n) AS id, text, rating, epoch, app, page FROM kept""")
def feed_corpus(spark, d):
    return adapters.feed_corpus(feed(spark, d), "trustpilot").select(
        "id", "text", "rating", F.unix_seconds("date").alias("epoch"), "app", "page")


def forum_pages(spark, d):
    """A forum page per message: each line is a post after a quoted block; user pages carry
    one date per post, other pages a single date."""
    def escaped(c):
        for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            c = F.replace(c, F.lit(raw), F.lit(entity))
        return c

    date = F.date_format(F.timestamp_seconds(F.lit(1_600_000_000) + F.col("conv_id") * 3600),
                         "MMM d yyyy, h:mm a")
    stamp = F.concat(F.lit("<span>"), date, F.lit("</span>"))
    each = F.when(F.col("role") == "user", stamp).otherwise(F.lit(""))
    blocks = F.transform(F.split("text", "\n", -1), lambda line: F.concat(
        each, F.lit('<div class="post postcolor"><div class="quotemain">said <div>before</div></div>'),
        escaped(line), F.lit("<!-- end --></div>")))
    head = F.when(F.col("role") == "user", F.lit("")).otherwise(stamp)
    return V.table(spark, d, "conversations").select(
        F.col("conv_id").alias("thread_id"), F.col("turn").alias("page"),
        F.col("role").alias("forum"),
        F.concat(F.lit("<html><body><script>var x = '<div>';</script>"), head,
                 F.array_join(blocks, "\n"), F.lit("</body></html>")).alias("html"))


POSTS_SQL = f"""
lines AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS ls FROM conversations),
posts AS (
  SELECT conv_id, turn, role, i - 1 AS pos, len(ls) AS n_posts,
         regexp_replace(ls[i], '^{V.SPACE_SQL}+|{V.SPACE_SQL}+$', '', 'g') AS text
  FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM lines)),
dated AS (SELECT *, CASE WHEN role = 'user' OR n_posts = 1
                    THEN (1600000000 + conv_id * 3600) // 60 * 60 END AS epoch FROM posts)"""


@query("html_posts", f"""
WITH {POSTS_SQL}
SELECT 'lowyat_' || conv_id || '_' || (turn * 20 + pos) AS id, text, CAST(NULL AS DOUBLE) AS rating,
       epoch, 'lowyat' AS source, 'lowyat/' || role AS app
FROM dated WHERE text <> ''""")
def html_posts(spark, d):
    return _rows(html.posts_from_pages(forum_pages(spark, d), "lowyat"))


@query("aligned_dates", f"""
WITH {POSTS_SQL} SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, epoch FROM dated""")
def aligned_dates_(spark, d):
    found = find_post_dates(html.page_text("html"))
    lines = F.regexp_extract_all("html", F.lit("postcolor"), F.lit(0))
    return forum_pages(spark, d).select(
        F.col("thread_id").alias("conv_id"), F.col("page").alias("turn"),
        F.posexplode(F.coalesce(aligned_dates(found, lines),
                                F.transform(lines, lambda x: F.lit(None).cast("string"))))
        .alias("pos", "raw")).select(
        "conv_id", "turn", "pos", F.unix_seconds(post_date_to_ts("raw")).alias("epoch"))


@query("page_blocks", """
WITH ads AS (SELECT page_id, unnest(regexp_extract_all(html, '<div class="ad">([^<]*)</div>', 1)) AS t
             FROM pages)
SELECT page_id, count(*) AS n_blocks, CAST(sum(length(trim(replace(replace(replace(replace(t,
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')))) AS BIGINT) AS n_chars
FROM ads GROUP BY page_id""")
def page_blocks(spark, d):
    blocks = html.post_blocks("html", "div", "ad", [])
    found = V.table(spark, d, "pages").select("page_id", blocks.alias("_blocks"))
    return (fan_out(found, "_blocks", "t").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_blocks"),
                                    F.sum(F.length("t")).cast("long").alias("n_chars")))


LINKS_SQL = """
anchors AS (SELECT page_id, regexp_extract(url, '/(de|en|es|fr)/', 1) AS forum,
                   regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS a FROM pages),
links AS (SELECT page_id, forum, i - 1 AS pos, regexp_extract(a[i], 'href="/([^"]*)"', 1) AS topic_id,
                 regexp_extract(a[i], '>([^<]*)<', 1) AS shown
          FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM anchors)),
seen AS (SELECT page_id, forum, pos, topic_id FROM links WHERE trim(shown) <> '' AND topic_id <> '')"""
HREF = r"^/(.+)$"


def links(spark, d):
    pages = V.table(spark, d, "pages").withColumn(
        "forum", F.regexp_extract("url", "/(de|en|es|fr)/", 1))
    return html.link_ids(pages, "page_id", "html", HREF, ["forum"])


@query("link_ids", f"""
WITH {LINKS_SQL} SELECT page_id, CAST(pos AS INTEGER) AS pos, topic_id FROM seen""")
def link_ids(spark, d):
    return links(spark, d).select("page_id", "pos", "topic_id")


@query("ordered_distinct_topn", f"""
WITH {LINKS_SQL},
firsts AS (SELECT forum, topic_id, min({{'page': page_id, 'pos': pos}}) AS first_pos FROM seen GROUP BY ALL)
SELECT forum, topic_id, first_pos.page AS page_id, CAST(first_pos.pos AS INTEGER) AS pos FROM firsts
QUALIFY row_number() OVER (PARTITION BY forum ORDER BY first_pos, topic_id) <= {THREADS_PER_FORUM}""")
def ordered_distinct_topn(spark, d):
    ordered = links(spark, d).withColumn("at", F.struct("page_id", "pos"))
    return ranking.ordered_distinct_topn(ordered, "forum", "topic_id", "at", THREADS_PER_FORUM).select(
        "forum", "topic_id", "first_pos.*")


# --- threads ------------------------------------------------------------------

def roots_and_replies(spark, d):
    msgs = V.table(spark, d, "conversations")
    created = F.lit(1_600_000_000) + F.col("conv_id") * 3600 + F.col("turn") * 60
    base = msgs.select(
        F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("conv_id").alias("thread_id"), F.col("turn").alias("ord"),
        F.concat(F.lit("About "), F.col("conv_id").cast("string")).alias("title"),
        F.when(F.col("role") != "system", F.col("text")).alias("body"), created.alias("created"),
        F.lit("r/all").alias("app"))
    return base.filter(F.col("ord") == 0), base.filter(F.col("ord") > 0)


THREADS_SQL = f"""
msgs AS (
  SELECT conv_id || '_' || turn AS id, conv_id, turn,
         CASE WHEN turn = 0 THEN regexp_replace('About ' || conv_id || chr(10) || chr(10) ||
                coalesce(CASE WHEN role <> 'system' THEN text END, ''), '{V.SPACE_SQL}+$', '')
              ELSE CASE WHEN role <> 'system' THEN text END END AS text,
         1600000000 + conv_id * 3600 + turn * 60 AS epoch,
         row_number() OVER (PARTITION BY conv_id, turn = 0 ORDER BY turn, conv_id || '_' || turn) AS rn
  FROM conversations),
flat AS (SELECT id, text, CAST(NULL AS DOUBLE) AS rating, epoch, 'reddit' AS source, 'r/all' AS app,
                turn FROM msgs WHERE turn = 0 OR rn <= 3)"""


@query("flatten_threads", f"WITH {THREADS_SQL} SELECT * EXCLUDE (turn) FROM flat")
def flatten_threads(spark, d):
    return _rows(adapters.flatten_threads(*roots_and_replies(spark, d), "reddit", 3))


@query("topn_replies", """
SELECT conv_id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 3""")
def topn_replies(spark, d):
    return ranking.head_per_group(V.table(spark, d, "conversations"), ["conv_id"], ["turn"], 3).select(
        "conv_id", "turn", "role")


TERMS = ["the", "que", "und", "la ", "absentword"]


@query("search_terms_join", """
WITH terms AS (SELECT unnest(['the', 'que', 'und', 'la ', 'absentword']) AS term,
                      unnest([0, 1, 2, 3, 4]) AS o)
SELECT conv_id || '_' || turn AS id, arg_min(term, o) AS term
FROM conversations JOIN terms ON contains(lower(text), term) GROUP BY conv_id, turn""")
def search_terms_join(spark, d):
    msgs = V.table(spark, d, "conversations").select(
        F.concat_ws("_", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        "text")
    return adapters.search_threads(msgs, "text", TERMS).select("id", "term")


@query("running_cap", """
WITH threads AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id),
run AS (SELECT conv_id, n, coalesce(sum(n) OVER (ORDER BY conv_id ROWS BETWEEN UNBOUNDED PRECEDING
               AND 1 PRECEDING), 0) AS total_before FROM threads)
SELECT conv_id, n, CAST(total_before AS BIGINT) AS total_before FROM run WHERE total_before < 300""")
def running_cap(spark, d):
    threads = V.table(spark, d, "conversations").groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n"))
    return ranking.running_cap(threads, ["conv_id"], "n", 300)


@query("page_cap", f"""
WITH sizes AS (SELECT conv_id, turn, max(len(string_split(text, chr(10)))) AS n_posts FROM conversations
               WHERE turn < 8 GROUP BY ALL),
run AS (SELECT *, count(*) FILTER (WHERE n_posts >= {POSTS_PER_PAGE}) OVER (PARTITION BY conv_id
          ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_full FROM sizes)
SELECT conv_id, turn, CAST(n_posts AS INTEGER) AS n_posts FROM run WHERE coalesce(n_full, 0) = turn""")
def page_cap(spark, d):
    pages = html.page_sizes(forum_pages(spark, d)).select(
        F.col("thread_id").alias("conv_id"), F.col("page").alias("turn"), "n_posts")
    return ranking.page_cap(pages, "conv_id", "turn", "n_posts", 8, POSTS_PER_PAGE)


FORUM_TARGET = 60


@query("forum_corpus", f"""
WITH {POSTS_SQL},
listing AS (SELECT DISTINCT 'f' || conv_id % 3 AS forum, conv_id, conv_id % 7 AS k FROM conversations),
chosen AS (SELECT * FROM listing QUALIFY row_number() OVER (PARTITION BY forum ORDER BY k, conv_id) <= {THREADS_PER_FORUM}),
sizes AS (SELECT conv_id, turn, max(len(string_split(text, chr(10)))) AS n_posts FROM conversations WHERE turn < 8 GROUP BY ALL),
filled AS (SELECT *, count(*) FILTER (WHERE n_posts >= {POSTS_PER_PAGE}) OVER (PARTITION BY conv_id
             ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS n_full FROM sizes),
visited AS (SELECT conv_id, turn FROM filled WHERE coalesce(n_full, 0) = turn),
said AS (SELECT * FROM dated SEMI JOIN visited USING (conv_id, turn) WHERE text <> ''),
counted AS (SELECT c.forum, c.k, c.conv_id, count(s.conv_id) AS n FROM chosen c LEFT JOIN said s ON s.conv_id = c.conv_id GROUP BY ALL),
run AS (SELECT *, coalesce(sum(n) OVER (ORDER BY forum, k, conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM counted)
SELECT 'lowyat_' || conv_id || '_' || (turn * {POSTS_PER_PAGE} + pos) AS id, text, CAST(NULL AS DOUBLE) AS rating, epoch,
       'lowyat' AS source, 'lowyat/' || forum AS app
FROM said JOIN run USING (conv_id) WHERE before < {FORUM_TARGET}
QUALIFY row_number() OVER (PARTITION BY text ORDER BY forum, k, conv_id, turn, pos) = 1""")
def forum_corpus(spark, d):
    """Three forums; each message is a page of its conversation, listed by conversation."""
    forum = F.concat(F.lit("f"), (F.col("thread_id") % 3).cast("string"))
    pages = forum_pages(spark, d).withColumn("forum", forum)
    links = pages.select("forum", "thread_id", F.struct((F.col("thread_id") % 7).alias("k"), "thread_id", "page").alias("at"))
    return _rows(html.forum_corpus(links, pages, "lowyat", target=FORUM_TARGET))


@query("thread_corpus", f"""
WITH {THREADS_SQL.replace("rn <= 3", "rn <= 20")},
found AS (
  SELECT DISTINCT conv_id FROM (
    SELECT m.conv_id, t.term, row_number() OVER (PARTITION BY t.term ORDER BY m.epoch DESC, m.id) AS place
    FROM msgs m JOIN (SELECT unnest(['the', 'que', 'und', 'la ', 'absentword']) AS term) t ON contains(lower(m.text), t.term)
    WHERE m.turn = 0) WHERE place <= 5)
SELECT id, text, rating, epoch, source, app FROM flat
WHERE text IS NOT NULL AND CAST(split_part(id, '_', 1) AS BIGINT) IN (SELECT conv_id FROM found)""")
def thread_corpus(spark, d):
    roots, replies = roots_and_replies(spark, d)
    answers = replies.withColumn("thread_id", F.concat(F.col("thread_id").cast("string"), F.lit("_0")))
    return _rows(adapters.thread_corpus(roots, answers, TERMS, "reddit", per_search=5))


# --- corpus -------------------------------------------------------------------

@query("union_by_name", f"""
WITH {V.REVIEWS_SQL}, {THREADS_SQL}
SELECT id, text, rating, epoch, source, app, language FROM reviews
UNION ALL SELECT id, text, rating, epoch, source, app, NULL FROM flat""")
def union_by_name(spark, d):
    threads = adapters.flatten_threads(*roots_and_replies(spark, d), "reddit", 3)
    both = union_all([V.reviews(spark, d), threads])
    return both.select("id", "text", "rating", F.unix_seconds("date").alias("epoch"), "source",
                       "app", "language")


@query("by_source", f"WITH {V.REVIEWS_SQL} SELECT id, source, rating FROM reviews WHERE source = 'src3'")
def by_source(spark, d):
    return reviews(spark, d).filter(F.col("source") == "src3").select("id", "source", "rating")


@query("nonempty_text", """
SELECT conv_id, turn, text FROM conversations WHERE role <> 'system' AND length(text) > 0""")
def nonempty_text(spark, d):
    msgs = V.table(spark, d, "conversations").select(
        "conv_id", "turn", F.when(F.col("role") != "system", F.col("text")).alias("text"))
    return adapters.nonempty_text(msgs)


CORPUS_SQL = V.CLEANED_SQL + """,
corpus AS (
  SELECT *, row_number() OVER (PARTITION BY cleaned_text ORDER BY source, id) AS rn
  FROM cleaned WHERE word_count >= 5 QUALIFY rn = 1)"""


@query("dedup_text", f"WITH {CORPUS_SQL} SELECT id, cleaned_text, source FROM corpus")
def dedup_text(spark, d):
    rows = corpus.clean(V.reviews(spark, d)).select("id", "cleaned_text", "source")
    return dedup.keep_first(rows, ["cleaned_text"], ["source", "id"])


@query("dedup_id", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) = 1""")
def dedup_id(spark, d):
    items = V.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return dedup.keep_first(items, ["l_orderkey"], ["l_linenumber"])


DETECTED_SQL = f"""{CORPUS_SQL}, {profile_sql()}, {detected_sql('corpus', 'id', 'cleaned_text')}"""


@query("preprocess", f"""
WITH {DETECTED_SQL}
SELECT id, text, rating, epoch, source, app, cleaned_text, word_count, coalesce(d.language, 'unknown') AS language
FROM corpus LEFT JOIN detected d ON k = id""")
def preprocess(spark, d):
    """The whole job with the detected language, not the one that comes with the documents."""
    done = corpus.preprocess(reviews(spark, d), language=language_model(spark, d))
    return done.select("id", "text", "rating", F.unix_seconds("date").alias("epoch"), "source",
                       "app", "cleaned_text", "word_count", "language")


@query("count_by_source", f"WITH {CORPUS_SQL} SELECT source, count(*) AS n FROM corpus GROUP BY source")
def count_by_source(spark, d):
    return metrics.value_counts(corpus.preprocess(slim(spark, d)), "source")


def slim(spark, d):
    """The columns the counts need."""
    return V.reviews(spark, d).select("id", "text", "source")


@query("top_languages", f"""
WITH {DETECTED_SQL} SELECT coalesce(d.language, 'unknown') AS language, count(*) AS n FROM corpus LEFT JOIN detected d ON k = id
GROUP BY ALL ORDER BY n DESC, language LIMIT 5""")
def top_languages(spark, d):
    done = corpus.preprocess(slim(spark, d), language=language_model(spark, d))
    return metrics.value_counts(done, "language", 5)


@query("clean_totals", f"""
WITH {CORPUS_SQL} SELECT 'raw' AS stage, count(*) AS n FROM reviews
UNION ALL SELECT 'clean', count(*) FROM corpus""")
def clean_totals(spark, d):
    rows = slim(spark, d)
    return metrics.corpus_totals(rows, corpus.preprocess(rows))


@query("corpus_span", f"""
WITH {CORPUS_SQL} SELECT min(epoch) AS first_epoch, max(epoch) AS last_epoch,
  median(word_count) AS median_words FROM corpus""")
def corpus_span(spark, d):
    rows = V.reviews(spark, d).select("id", "text", "source", "date")
    span = metrics.corpus_span(corpus.preprocess(rows), "date", "word_count")
    return span.select(F.unix_seconds("first_date").alias("first_epoch"),
                       F.unix_seconds("last_date").alias("last_epoch"), "median_words")


@query("corpus_aspects", f"""
WITH {CORPUS_SQL}
SELECT aspect, count(*) AS n FROM (SELECT unnest({V.aspects_sql('cleaned_text')}) AS aspect FROM corpus)
GROUP BY aspect""")
def corpus_aspects(spark, d):
    return aspect_distribution(tag_aspects(corpus.preprocess(slim(spark, d)), V.TAXONOMY))
