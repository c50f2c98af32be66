"""Date expressions. The session time zone is expected to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions.text import _c

# --- fixed values: how forum pages write dates --------------------------------
POST_DATE_RE = r"[A-Z][a-z]{2} \d{1,2} \d{4}, \d{1,2}:\d{2} [AP]M"
POST_DATE_FORMAT = "MMM d yyyy, h:mm a"
# ----------------------------------------------------------------------------


def epoch_to_ts(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_c(seconds))


def iso_to_ts(text: Column | str) -> Column:
    return F.try_to_timestamp(_c(text))


def post_date_to_ts(text: Column | str) -> Column:
    return F.try_to_timestamp(_c(text), F.lit(POST_DATE_FORMAT))


def find_post_dates(page_text: Column | str) -> Column:
    return F.regexp_extract_all(_c(page_text), F.lit(POST_DATE_RE), F.lit(0))


def aligned_dates(dates: Column | str, posts: Column | str) -> Column:
    """The page's dates if there is exactly one per post, else null for the whole page."""
    return F.when(F.size(_c(dates)) == F.size(_c(posts)), _c(dates))
