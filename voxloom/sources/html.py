"""Forum pages: container blocks -> posts, links -> thread ids, all in expressions.

Selecting a nested block needs balanced tags, which a regular expression cannot match. A page is cut
into tags and texts, and a fold over these pieces keeps a stack of the open blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.dates import aligned_dates, find_post_dates, post_date_to_ts
from voxloom.functions.lookup import bound
from voxloom.functions.text import _c, post_id, strip_space
from voxloom.operators.dedup import keep_first
from voxloom.operators.ranking import ordered_distinct_topn, page_cap, running_cap
from voxloom.operators.shaping import computed_once, fan_out
from voxloom.schema import MAX_PAGES_PER_THREAD, POSTS_PER_PAGE, REVIEW_COLS, TARGET_POSTS, THREADS_PER_FORUM

# --- fixed values: class names of post and quote blocks -----------------------
POST_CLASS = "postcolor"
QUOTE_CLASSES = ("quotetop", "quotemain")
# ----------------------------------------------------------------------------

_INVISIBLE = r"(?is)<!--.*?-->|<(script|style|template)\b[^>]*>.*?</\1\s*>|<![^>]*>"
_TAG = r"""<(/?)([a-zA-Z][\w:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_PIECE = rf"{_TAG}|[^<]+|<"
_CLASS = r"""(?i)\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""
_ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});?"
#: What stands on the stack for an open block that is no post: a plain one, one whose text does not count.
PLAIN, MUTE = -1, -2
_REPLACEMENT = "\ufffd"


def unescaped(text: Column) -> Column:
    """Character references of HTML as characters, unknown ones as they are.

    Numbers that are no character become the replacement character; 128 to 159 mean the letters that
    old pages intend. A name counts with its semicolon, or without where HTML knows it so.
    """
    names = F.str_to_map(F.lit("\1".join(f"{k}\2{v}" for k, v in html5.items())), F.lit("\1"), F.lit("\2"))
    old = bytes(range(0x80, 0xA0)).decode("cp1252", errors="replace")

    def character(code: Column) -> Column:
        wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return (F.when((code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), F.lit(_REPLACEMENT))
                .when(code.between(0x80, 0x9F), F.translate(wide, "".join(map(chr, range(0x80, 0xA0))), old)).otherwise(wide))

    def decoded(entity: Column) -> Column:
        digits = F.regexp_extract(entity, "([0-9a-fA-F]+);?$", 1)
        return (F.when(entity.rlike("^&#[xX]"), character(F.conv(digits, 16, 10).cast("int")))
                .when(entity.startswith("&#"), character(F.conv(digits, 10, 10).cast("int")))
                .otherwise(F.coalesce(F.try_element_at(names, F.substr(entity, F.lit(2))), entity)))

    found = F.transform(F.regexp_extract_all(text, F.lit(_ENTITY), F.lit(0)), decoded)
    pieces = F.zip_with(F.split(text, _ENTITY, -1), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def visible_markup(page: Column | str) -> Column:
    """The page without comments, scripts and styles; tags stay."""
    return F.regexp_replace(_c(page), _INVISIBLE, "")


def page_text(page: Column | str) -> Column:
    return F.regexp_replace(visible_markup(page), r"<[^>]+>", " ")


def _events(page: Column, tag: str, wanted: str, dropped: Sequence[str]) -> Column:
    """The pieces of a page that matter, in order, as (kind, text)."""
    def event(piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, "^</?([a-zA-Z][\\w:-]*)", 1))
        classes = F.split(F.concat(*[F.regexp_extract(piece, _CLASS, i) for i in (1, 2, 3)]), r"\s+")
        opening = (F.when(F.array_contains(classes, wanted) if wanted else F.lit(True), F.lit("post"))
                   .when(F.arrays_overlap(classes, F.array(*map(F.lit, dropped)).cast("array<string>")), F.lit("drop"))
                   .otherwise(F.lit("open")))
        kind = (F.when(~piece.startswith("<") | (piece == "<"), F.lit("text"))
                .when((name != tag) | piece.endswith("/>"), F.lit("other"))
                .when(piece.startswith("</"), F.lit("close")).otherwise(opening))
        return F.struct(kind.alias("kind"), F.when(kind == "text", strip_space(unescaped(piece))).alias("text"))

    events = F.transform(F.regexp_extract_all(page, F.lit(_PIECE), F.lit(0)), event)
    return F.filter(events, lambda e: (e["kind"] != "other") & ((e["kind"] != "text") | (e["text"] != "")))


def post_blocks(page: Column | str, tag: str = "div", wanted: str = POST_CLASS,
                dropped: Sequence[str] = QUOTE_CLASSES) -> Column:
    """Texts of the ``tag`` blocks of class ``wanted``, '' kept so that positions count empty posts.

    Text inside a nested block of a ``dropped`` class does not count; text of a nested post counts
    for the outer one too. Text pieces are trimmed and joined by one blank. A null page has none.
    """
    def step(state: Column, event: Column) -> Column:
        n, opened, texts = state["n"], state["opened"], state["texts"]
        live = F.filter(opened, lambda b: b >= 0)
        on_top = (F.when(event["kind"] == "post", n)
                  .when((event["kind"] == "drop") & (F.size(live) > 0), F.lit(MUTE)).otherwise(F.lit(PLAIN)))
        stack = (F.when(event["kind"] == "text", opened)
                 .when(event["kind"] == "close", F.slice(opened, 1, F.greatest(F.size(opened) - 1, F.lit(0))))
                 .otherwise(F.concat(opened, F.array(on_top))))
        heard = (event["kind"] == "text") & ~F.array_contains(opened, MUTE)
        said = F.transform(live, lambda b: F.struct(b.alias("post"), event["text"].alias("text")))
        return F.struct((n + (event["kind"] == "post").cast("int")).alias("n"), stack.alias("opened"),
                        F.when(heard, F.concat(texts, said)).otherwise(texts).alias("texts"))

    def posts(state: Column) -> Column:
        one = F.transform(F.sequence(F.lit(0), state["n"] - 1), lambda i: F.array_join(
            F.transform(F.filter(state["texts"], lambda t: t["post"] == i), lambda t: t["text"]), " "))
        return F.when(state["n"] > 0, one).otherwise(F.array().cast("array<string>"))

    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<int>").alias("opened"),
                     F.array().cast("array<struct<post:int,text:string>>").alias("texts"))
    pieces = _events(F.coalesce(visible_markup(page), F.lit("")), tag, wanted, dropped)
    return bound(F.aggregate(pieces, start, step), posts)


def posts_from_pages(pages: DataFrame, source: str, thread: str = "thread_id",
                     page: str = "page", forum: str = "forum", html: str = "html",
                     page_size: int = POSTS_PER_PAGE, place: bool = False, **select) -> DataFrame:
    """Pages -> unified review rows. Dates count only if there is one per post.

    With ``place`` the thread, page and position of each post stay in front.
    """
    scanned = (pages.select(thread, page, forum,
                            post_blocks(html, **select).alias("_posts"),
                            find_post_dates(page_text(html)).alias("_dates"))
               .withColumn("_dates", aligned_dates("_dates", "_posts")))
    rows = fan_out(scanned, "_posts", "pos", "text", position=True)
    return (rows.filter(F.length("text") > 0).select(
        *([thread, page, forum, "pos"] if place else []), post_id(source, thread, page, "pos", page_size).alias("id"), "text",
        F.lit(None).cast("double").alias("rating"),
        post_date_to_ts(F.get("_dates", F.col("pos"))).alias("date"),
        F.lit(source).alias("source"),
        F.concat(F.lit(f"{source}/"), F.col(forum)).alias("app")))


def page_sizes(pages: DataFrame, thread: str = "thread_id", page: str = "page",
               html: str = "html", **select) -> DataFrame:
    """Posts per page, for the page cap."""
    return pages.select(thread, page, F.size(post_blocks(html, **select)).alias("n_posts"))


def forum_corpus(links: DataFrame, pages: DataFrame, source: str, threads_per_forum: int = THREADS_PER_FORUM,
                 max_pages: int = MAX_PAGES_PER_THREAD, page_size: int = POSTS_PER_PAGE, target: int = TARGET_POSTS,
                 **select) -> DataFrame:
    """The whole forum job: listed threads -> pages a reader would visit -> posts, each text once.

    ``links`` has forum, thread_id and ``at``, an orderable place in the listing; ``pages`` has forum,
    thread_id, page and html. Forums are read in the order of their names, threads in the order of
    their first link; a thread is read whole while fewer than ``target`` posts were read before it.
    """
    listed = ordered_distinct_topn(links, "forum", "thread_id", "at", threads_per_forum)
    own = pages.join(listed.select("forum", "thread_id"), ["forum", "thread_id"], "left_semi")
    keyed = own.select(F.struct("forum", "thread_id").alias("_thread"), "page", F.size(post_blocks("html", **select)).alias("_size"))
    visited = page_cap(keyed, "_thread", "page", "_size", max_pages, page_size).select("_thread.*", "page")
    # A page that was fetched more than once counts once.
    read = keep_first(own.select("forum", "thread_id", "page", "html").join(visited, ["forum", "thread_id", "page"], "left_semi"),
                      ["forum", "thread_id", "page"], ["html"])
    posts = posts_from_pages(read, source, page_size=page_size, place=True, **select)
    counts = posts.groupBy("forum", "thread_id").agg(F.count(F.lit(1)).alias("_n"))
    threads = listed.join(counts, ["forum", "thread_id"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    kept = running_cap(threads, ["forum", "first_pos", "thread_id"], "_n", target).select("forum", "thread_id", "first_pos")
    return keep_first(posts.join(kept, ["forum", "thread_id"]), ["text"], ["forum", "first_pos", "thread_id", "page", "pos"]).select(*REVIEW_COLS)


def link_ids(pages: DataFrame, page_id: str, html: str, href: str = r"/topic/(\d+)",
             keep: Sequence[str] = ()) -> DataFrame:
    """(page, pos, topic id) of links whose target matches and whose text is visible."""
    anchors = F.regexp_extract_all(visible_markup(html), F.lit(r"(?is)<a\b[^>]*>.*?</a\s*>"),
                                   F.lit(0))
    target = F.regexp_extract("anchor", r"""(?is)^<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]*)""", 1)
    shown = strip_space(F.regexp_replace("anchor", r"<[^>]+>", ""))
    found = pages.select(page_id, *keep, anchors.alias("_anchors"))
    links = computed_once(fan_out(found, "_anchors", "pos", "anchor", position=True),
                          _target=target, _shown=shown)
    return (links.filter(F.col("_target").rlike(href) & (F.col("_shown") != ""))
            .select(page_id, *keep, "pos", F.regexp_extract("_target", href, 1).alias("topic_id")))
