"""Text expressions. All stay on the JVM and inside whole-stage codegen where Spark can."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.taxonomy import Taxonomy, aspect_regex, keyword_regex

# White space in the wide sense: Unicode White_Space plus the four information separators.
SPACE = r"\s\x{1c}-\x{1f}"
# --- fixed values: what cleaning takes for addresses, tags and repeats ----------
URL_RE = rf"(?U)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
TAG_RE = r"<[^>]+>"
# UNIX_LINES: only a line feed is exempt from squeezing.
REPEAT_RE = r"(?d)(.)\1{2,}"
# ----------------------------------------------------------------------------
SPACE_RE = rf"(?U)[{SPACE}]+"
EDGE_SPACE_RE = rf"(?U)^[{SPACE}]+|[{SPACE}]+$"
SENTENCE_RE = rf"(?U)(?<=[.!?])[{SPACE}]+|\n+"
TOKEN_RE = r"[\p{L}\p{N}_]{2,}"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_text(c: Column | str) -> Column:
    return F.coalesce(_c(c).cast("string"), F.lit(""))


def strip_urls(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), URL_RE, " ")


def strip_tags(c: Column | str) -> Column:
    return F.regexp_replace(_c(c), TAG_RE, " ")


def squeeze_repeats(c: Column | str) -> Column:
    """A character repeated three or more times is cut to two (digits and dots too)."""
    return F.regexp_replace(_c(c), REPEAT_RE, "$1$1")


def collapse_space(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_c(c), SPACE_RE, " "))


def strip_space(c: Column | str) -> Column:
    """Trim any Unicode white space, not only blanks."""
    return F.regexp_replace(_c(c), EDGE_SPACE_RE, "")


def clean_text(c: Column | str) -> Column:
    return collapse_space(squeeze_repeats(strip_tags(strip_urls(null_text(c)))))


def word_count(cleaned: Column | str) -> Column:
    """Words of a cleaned text: blanks + 1, without building the word array."""
    c = _c(cleaned)
    blanks = F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    return F.when(F.coalesce(c, F.lit("")) == "", F.lit(0)).otherwise(blanks + 1).cast("int")


def keyword_match(c: Column | str, keywords: list[str]) -> Column:
    return F.lower(null_text(c)).rlike(aspect_regex(keywords))


def present(cases: list[tuple[Column, Column]], item_type: str) -> Column:
    """Array of the values whose condition holds, in order.

    A concatenation of small arrays: unlike a higher-order filter it stays in generated
    code, where parts shared by the conditions (the lower-cased text) are evaluated once.
    """
    none = F.array().cast(f"array<{item_type}>")
    if not cases:
        return none
    return F.concat(none, *[F.when(cond, F.array(value)).otherwise(none) for cond, value in cases])


def extract_aspects(c: Column | str, taxonomy: Taxonomy) -> Column:
    """Matched aspects in taxonomy order; an empty array for null text."""
    return present([(keyword_match(c, kws), F.lit(aspect)) for aspect, kws in taxonomy.items()],
                   "string")


def matched_keywords(c: Column | str, taxonomy: Taxonomy) -> Column:
    """Every (aspect, keyword) pair found, row-local: no join against the keyword list."""
    low = F.lower(null_text(c))
    return present(
        [(low.rlike(keyword_regex(kw)),
          F.struct(F.lit(aspect).alias("aspect"), F.lit(kw).alias("keyword")))
         for aspect, kws in taxonomy.items() for kw in kws],
        "struct<aspect:string,keyword:string>")


def split_sentences(c: Column | str) -> Column:
    return F.split(_c(c), SENTENCE_RE, -1)


def aspect_sentences(c: Column | str, keywords: list[str]) -> Column:
    """Sentences that mention a keyword, joined by a blank; the whole text if none does."""
    c = _c(c)
    pattern = aspect_regex(keywords)
    hits = F.filter(split_sentences(c), lambda s: F.lower(s).rlike(pattern))
    joined = strip_space(F.array_join(hits, " "))
    return F.coalesce(F.nullif(joined, F.lit("")), c)


def tokenize(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(null_text(c)), F.lit(TOKEN_RE), F.lit(0))


def ngrams(tokens: Column | str, n_max: int = 2) -> Column:
    """All word n-grams up to ``n_max`` of a token array, built row by row.

    Pass a token column: a token expression would be evaluated at each of its uses.
    """
    t = _c(tokens)
    out, grams = t, t
    for n in range(2, n_max + 1):
        count = F.greatest(F.size(t) - (n - 1), F.lit(0))
        grams = F.zip_with(F.slice(grams, 1, count), F.slice(t, n, count),
                           lambda a, b: F.concat(a, F.lit(" "), b))
        out = F.concat(out, grams)
    return out


def term_counts(terms: Column | str) -> Column:
    """Array of (term, tf) for one row: run lengths of the sorted term array.

    Counting inside the row keeps term frequencies free of any (document, term) shuffle.
    """
    return _run_lengths(F.sort_array(_c(terms)))


def _run_lengths(sorted_terms: Column) -> Column:
    def with_sorted(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.transform(s, lambda x, i: F.when(
                (i == 0) | (x != F.get(s, i - 1)), i)),
            lambda i: i.isNotNull())

        def with_starts(st: Column) -> Column:
            return F.transform(st, lambda i, j: F.struct(
                F.get(s, i).alias("term"),
                (F.coalesce(F.get(st, j + 1), n) - i).cast("long").alias("tf")))

        return _let(starts, with_starts)

    return _let(sorted_terms, with_sorted)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times in ``body`` (one-element transform)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def display_aspect(c: Column | str) -> Column:
    return F.replace(_c(c), F.lit("_"), F.lit(" "))


def percent(c: Column | str) -> Column:
    return F.format_string("%.0f%%", _c(c) * 100)


def slug(c: Column | str) -> Column:
    return F.translate(_c(c), "-/ ", "___")


def tier_short(c: Column | str) -> Column:
    return F.substring_index(_c(c), " (", 1)


def concat_title_body(title: Column | str, body: Column | str) -> Column:
    return strip_space(F.concat(null_text(title), F.lit("\n\n"), null_text(body)))


def post_id(source: str, thread: Column | str, page: Column | str, pos: Column | str,
            page_size: int) -> Column:
    """``<source>_<thread>_<running offset>``."""
    offset = _c(page).cast("long") * page_size + _c(pos).cast("long")
    return F.concat(F.lit(f"{source}_"), _c(thread).cast("string"), F.lit("_"),
                    offset.cast("string"))


def id_fallback(given: Column | str, prefix: Column | str, page: Column | str,
                n_before: Column | str) -> Column:
    made = F.concat_ws("_", _c(prefix), _c(page).cast("string"), _c(n_before).cast("string"))
    return F.coalesce(F.nullif(_c(given), F.lit("")), made)


def extract_topic_id(url: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_c(url), r"/topic/(\d+)", 1), F.lit(""))


def truncate_text(c: Column | str, n: int) -> Column:
    return F.substring(_c(c), 1, n)


def page_url(base: str, thread: Column | str, offset: Column | str) -> Column:
    suffix = F.when(_c(offset) > 0, F.concat(F.lit("?st="), _c(offset).cast("string")))
    return F.concat(F.lit(f"{base}/topic/"), _c(thread).cast("string"),
                    F.coalesce(suffix, F.lit("")))


def page_number_url(base: Column | str, page: Column | str) -> Column:
    suffix = F.when(_c(page) > 1, F.concat(F.lit("?page="), _c(page).cast("string")))
    return F.concat(_c(base), F.coalesce(suffix, F.lit("")))
