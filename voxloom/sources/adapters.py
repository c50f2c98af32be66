"""Adapters from source layouts to the unified review columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.dates import epoch_to_ts, iso_to_ts
from voxloom.functions.text import concat_title_body, id_fallback, null_text, strip_space
from voxloom.operators.dedup import keep_first
from voxloom.operators.joins import search_terms
from voxloom.operators.ranking import head_per_group
from voxloom.operators.shaping import fan_out
from voxloom.schema import FEED_SCHEMA, REPLIES_PER_THREAD, REVIEW_COLS, THREADS_PER_SEARCH, require_columns

# --- fixed values: field names of the app-store source ------------------------
STORE_FIELDS = {"reviewId": "id", "content": "text", "score": "rating", "at": "date"}
# ----------------------------------------------------------------------------


def adapt_flat_source(df: DataFrame, source: str, app: str | Column,
                      renames: Mapping[str, str] = STORE_FIELDS) -> DataFrame:
    """Rename source fields, add constant source and app, project the unified columns."""
    require_columns(df, renames)
    named = df.withColumnsRenamed(dict(renames))
    return named.withColumns({
        "source": F.lit(source), "app": F.lit(app) if isinstance(app, str) else app,
    }).select(*REVIEW_COLS)


def feed_reviews(feed: DataFrame, source: str, brand: str = "brand", page: str = "page",
                 body: str = "json") -> DataFrame:
    """Embedded page JSON -> one row per review, with its page and position."""
    parsed = F.from_json(F.col(body), FEED_SCHEMA)["props"]["pageProps"]["reviews"]
    rows = fan_out(feed.select(brand, page, parsed.alias("_reviews")), "_reviews", "pos", "rv",
                   position=True)
    return rows.select(
        F.col("rv.id").alias("id"), strip_space(null_text("rv.text")).alias("text"),
        F.col("rv.rating").alias("rating"), iso_to_ts("rv.dates.publishedDate").alias("date"),
        F.lit(source).alias("source"), F.col(brand).alias("app"), page, "pos")


def readable_pages(feed: DataFrame, reviews: DataFrame, brand: str = "brand", page: str = "page",
                   first_page: int | None = None) -> DataFrame:
    """(app, page, new_ids) of the pages before the first one without a new id.

    The pages are those of the feed, so an empty page ends a brand like a stale one. With
    ``first_page`` the numbers must run on from there: a missing page ends a brand as well. An
    id is new where it is first seen; the first review without an id counts as new. All steps
    are aggregations and joins unique on both sides, so a brand or an id with very many rows
    never meets in one task.
    """
    first = reviews.groupBy("app", "id").agg(F.min(page).alias("first_page"))
    pages = feed.select(F.col(brand).alias("app"), page, F.lit(0).cast("long").alias("new"))
    fresh = first.select("app", F.col("first_page").alias(page), F.lit(1).cast("long").alias("new"))
    counts = pages.unionByName(fresh).groupBy("app", page).agg(F.sum("new").alias("new_ids"))
    stops = F.col("new_ids") == 0
    if first_page is not None:
        before = counts.select("app", (F.col(page) + 1).alias(page), F.lit(True).alias("_run"))
        counts = counts.filter(F.col(page) >= first_page).join(before, ["app", page], "left")
        stops = stops | ((F.col(page) > first_page) & F.col("_run").isNull())
    ends = counts.filter(stops).groupBy("app").agg(F.min(page).alias("_end"))
    if first_page is not None:  # without its first page a brand has none
        started = counts.filter(F.col(page) == first_page).select("app").distinct()
        counts = counts.join(started, "app", "left_semi")
    return (counts.join(ends, "app", "left")
            .filter(F.col("_end").isNull() | (F.col(page) < F.col("_end")))
            .select("app", page, "new_ids"))


def feed_corpus(feed: DataFrame, source: str, first_page: int | None = None) -> DataFrame:
    """The whole feed job: rows of the readable pages, each id once, made ids where none is."""
    reviews = feed_reviews(feed, source)
    pages = readable_pages(feed, reviews, first_page=first_page).select("app", "page")
    return dedup_feed(reviews.join(pages, ["app", "page"], "left_semi"))


def dedup_feed(reviews: DataFrame, page: str = "page") -> DataFrame:
    """First row per (app, id) by page and position; a missing id gets a made one.

    The made id counts the rows kept before it. A brand keeps at most two such rows (one
    null and one empty id). Rows are counted per page first, so whole pages, not rows, meet
    by brand; only the page of the nameless row itself is compared row by row.
    """
    kept = keep_first(reviews, ["app", "id"], [page, "pos"])
    no_id = F.coalesce("id", F.lit("")) == ""
    nameless = kept.filter(no_id).select(
        "app", F.col(page).alias("_page"), F.col("pos").alias("_pos"))
    per_page = kept.groupBy("app", page).agg(F.count(F.lit(1)).alias("_n"))
    earlier = (per_page.join(nameless, "app").filter(F.col(page) < F.col("_page"))
               .select("app", "_page", "_pos", "_n"))
    same = (kept.select("app", F.col(page).alias("_page"), "pos")
            .join(nameless, ["app", "_page"]).filter(F.col("pos") < F.col("_pos"))
            .select("app", "_page", "_pos", F.lit(1).cast("long").alias("_n")))
    before = earlier.unionByName(same).groupBy(
        "app", F.col("_page").alias(page), F.col("_pos").alias("pos")).agg(
        F.sum("_n").alias("_before"))
    named = kept.filter(~no_id)
    made = (kept.filter(no_id).join(before, ["app", page, "pos"], "left")
            .withColumn("id", id_fallback("id", "app", page, F.coalesce("_before", F.lit(0)))))
    return named.unionByName(made.select(*named.columns)).select(*reviews.columns)


def flatten_threads(roots: DataFrame, replies: DataFrame, source: str,
                    max_replies: int = REPLIES_PER_THREAD) -> DataFrame:
    """Title + blank line + body as one row per thread, then its first replies as rows.

    ``roots``: id, title, body, created, app. ``replies``: id, thread_id, ord, body,
    created, app. The first-n filter trims every task before the shuffle by thread.
    """
    none = F.lit(None).cast("double").alias("rating")
    top = roots.select(F.col("id").cast("string").alias("id"),
                       concat_title_body("title", "body").alias("text"), none,
                       epoch_to_ts("created").alias("date"), F.lit(source).alias("source"), "app")
    first = head_per_group(replies, ["thread_id"], ["ord", "id"], max_replies)
    rest = first.select(F.col("id").cast("string").alias("id"), F.col("body").alias("text"), none,
                        epoch_to_ts("created").alias("date"), F.lit(source).alias("source"),
                        "app")
    return top.unionByName(rest)


def search_threads(threads: DataFrame, text: str, terms: list[str], id_col: str = "id",
                   ) -> DataFrame:
    """Rows found by any search term, once each, with the first term that found them.

    The first term of a row is an expression of the row; only then are ids made unique.
    """
    low = F.lower(null_text(text))
    first = F.coalesce(*[F.when(low.contains(t.lower()), F.lit(i)) for i, t in enumerate(terms)])
    found = threads.withColumn("term_ord", first).filter(F.col("term_ord").isNotNull())
    kept = keep_first(found, [id_col], ["term_ord"])
    return kept.withColumn("term", F.get(F.array(*map(F.lit, terms)), F.col("term_ord"))).drop("term_ord")


def thread_corpus(roots: DataFrame, replies: DataFrame, terms: list[str], source: str, per_search: int = THREADS_PER_SEARCH,
                  max_replies: int = REPLIES_PER_THREAD) -> DataFrame:
    """The whole thread job: every group is searched for every term, newest threads first; each found
    thread is flattened, rows without text go and each id stays once.

    ``roots`` and ``replies`` are those of ``flatten_threads``. A thread found by several terms is
    read once: its rows are the same each time.
    """
    text = roots.select("id", "app", "created", concat_title_body("title", "body").alias("_text"))
    hits = search_terms(text, "_text", terms).select("id", "app", "created", "term")
    found = head_per_group(hits, ["app", "term"], [F.desc("created"), "id"], per_search).select("id").distinct()
    own = roots.join(found, "id", "left_semi")
    answers = replies.join(found.withColumnRenamed("id", "thread_id"), "thread_id", "left_semi")
    rows = flatten_threads(own, answers, source, max_replies).dropna(subset=["text"])
    return keep_first(rows, ["id"], ["app", "date", "text"]).select(*REVIEW_COLS)


def nonempty_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.dropna(subset=[text]).filter(F.length(text) > 0)
