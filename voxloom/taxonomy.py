"""Aspect taxonomy: ordered aspect -> keyword list. Always passed as a parameter."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

Taxonomy = Mapping[str, Sequence[str]]

# --- fixed values: the five service aspects and their keywords ---------------
SERVICE_ASPECTS: dict[str, list[str]] = {
    "coverage": [
        "coverage", "signal", "reception", "no service", "no signal", "dropped call",
        "area", "indoor signal", "outdoor signal", "liputan", "kawasan",
    ],
    "speed": [
        "speed", "slow", "fast", "lag", "lagging", "buffer", "buffering", "ping",
        "latency", "mbps", "kbps", "bandwidth", "throughput", "download speed",
        "upload speed", "laju", "lembab",
    ],
    "billing": [
        "bill", "invoice", "price", "plan", "cost", "charge", "charged", "expensive",
        "cheap", "overcharge", "refund", "promotion", "promo", "discount", "rm",
        "mahal", "murah", "bayar",
    ],
    "customer_support": [
        "support", "customer service", "cs", "agent", "helpline", "ticket",
        "complaint", "representative", "call center", "live chat", "rude", "helpful",
        "responsive", "unresponsive",
    ],
    "app_usability": [
        "app", "interface", "ui", "ux", "bug", "crash", "crashes", "login", "update",
        "dashboard", "menu", "navigation", "glitch", "freeze", "freezes", "error",
    ],
}
# ----------------------------------------------------------------------------

WORD = r"[\p{L}\p{N}_]"
_JAVA_META = re.compile(r"([\\.\[\]{}()*+?^$|#&~\-])")


def _quote(keyword: str) -> str:
    return _JAVA_META.sub(r"\\\1", keyword)


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def _boundary_before(keyword: str) -> str:
    return f"(?<!{WORD})" if _is_word(keyword[0]) else f"(?<={WORD})"


def _boundary_after(keyword: str) -> str:
    return f"(?!{WORD})" if _is_word(keyword[-1]) else f"(?={WORD})"


def keyword_regex(keyword: str) -> str:
    """Whole-word pattern for one keyword; matched against lower-cased text."""
    return _boundary_before(keyword) + _quote(keyword) + _boundary_after(keyword)


def minimal_keywords(keywords: Sequence[str]) -> list[str]:
    """Drop phrases that hold another keyword as whole words: they add no match."""
    def covered(kw: str) -> bool:
        return any(
            other != kw and re.search(rf"(?<!\w){re.escape(other)}(?!\w)", kw)
            and _is_word(other[0]) and _is_word(other[-1])
            for other in keywords
        )
    return [kw for kw in keywords if not covered(kw)]


def aspect_regex(keywords: Sequence[str]) -> str:
    """One alternation per aspect, so a match stops at the first hit."""
    kept = minimal_keywords(list(dict.fromkeys(keywords)))
    plain = [k for k in kept if _is_word(k[0]) and _is_word(k[-1])]
    odd = [k for k in kept if k not in plain]
    parts = []
    if plain:
        parts.append(f"(?<!{WORD})(?:" + "|".join(_quote(k) for k in plain) + f")(?!{WORD})")
    parts.extend(keyword_regex(k) for k in odd)
    # An aspect without keywords never matches.
    return "|".join(parts) if parts else "(?!)"


def taxonomy_frame(spark: SparkSession, taxonomy: Taxonomy) -> DataFrame:
    rows = [(i, a, list(k)) for i, (a, k) in enumerate(taxonomy.items())]
    return spark.createDataFrame(rows, "ord int, aspect string, keywords array<string>")
