"""Joins against a table with unique keys, safe against hot keys on the large side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import null_text, present, strip_space, truncate_text
from voxloom.operators.dedup import keep_first
from voxloom.operators.shaping import fan_out
from voxloom.schema import TRANSLATION_CHARS

HOT_SHARE = 1000   # a key is hot from 1/1000 of all rows, hence at most 1000 hot keys
SALTS = 64


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hashes of keys that hold at least 1/HOT_SHARE of the rows (at most HOT_SHARE rows)."""
    counts = df.groupBy(F.xxhash64(*keys).alias("_kh")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
    return (counts.filter((F.col("_n") * HOT_SHARE >= total) & (F.col("_n") > SALTS))
            .select("_kh"))


def salted_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  how: str = "left", salt_by: Sequence[str] | None = None) -> DataFrame:
    """Left or inner join of ``left`` to a keyed table, hot keys spread over SALTS partitions.

    Other joins would return the copies of the table's hot rows. Only rows of the table with a hot
    key are copied, SALTS times each. The broadcast hot list has at most HOT_SHARE rows by construction.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"salted_lookup joins left or inner, not {how!r}")
    keys = list(keys)
    hot = F.broadcast(hot_keys(left.select(*keys), keys).withColumn("_hot", F.lit(True)))
    spread = F.pmod(F.xxhash64(*(salt_by or left.columns)), F.lit(SALTS)).cast("int")
    salted_left = (left.withColumn("_kh", F.xxhash64(*keys)).join(hot, "_kh", "left")
                   .withColumn("_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0)))
                   .drop("_hot", "_kh"))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(
        F.array(F.lit(0)))
    salted_right = (right.withColumn("_kh", F.xxhash64(*keys)).join(hot, "_kh", "left")
                    .withColumn("_salt", F.explode(copies)).drop("_hot", "_kh"))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")


def enrich(sheet: DataFrame, corpus: DataFrame, needed: Sequence[str], key: str = "id",
           order: Sequence[str] = ("source",)) -> DataFrame:
    """Left join of the columns the sheet lacks, after the corpus is unique on ``key``.

    A sheet is small next to the corpus, so the corpus is cut to the sheet's keys first.
    """
    missing = [c for c in needed if c not in sheet.columns]
    if not missing:
        return sheet
    order = [c for c in order if c in corpus.columns]
    pulled = corpus.select(key, *dict.fromkeys([*order, *missing])).join(
        sheet.select(key).distinct(), key, "left_semi")
    unique = keep_first(pulled, [key], order or missing[:1]).select(key, *missing)
    return sheet.join(unique, key, "left")


def lookup_fallback(texts: DataFrame, text: str, lookup: DataFrame, id_col: str = "id",
                    max_chars: int | None = None) -> DataFrame:
    """Translated text by lookup; own (trimmed) text if there is none, '' for empty text.

    Adds ``translated`` and ``failed``. ``lookup`` has ``text`` and ``translated``; rows without
    a translation say nothing. With ``max_chars`` the lookup was asked with that much of a text
    (a request limit), so both sides are cut to it; the own text stays whole.
    """
    own = strip_space(null_text(text))
    table = keep_first(
        lookup.filter(F.col("translated").isNotNull()).select(
            asked_text("text", max_chars).alias("_asked"),
            F.col("translated").alias("_found")),
        ["_asked"], ["_found"])
    keyed = texts.withColumns({"_own": own, "_asked": asked_text(text, max_chars)})
    joined = salted_lookup(keyed, table, ["_asked"], "left", [id_col])
    empty = F.col("_own") == ""
    return (joined
            .withColumn("translated", F.when(empty, F.lit("")).otherwise(
                F.coalesce("_found", "_own")))
            .withColumn("failed", F.col("_found").isNull() & ~empty)
            .drop("_own", "_asked", "_found"))


def asked_text(text: Column | str, max_chars: int | None = None) -> Column:
    """What a translation service is asked for a text: trimmed and cut to the limit of a request."""
    own = strip_space(null_text(text))
    return own if max_chars is None else strip_space(truncate_text(own, max_chars))


def worklist(texts: DataFrame, text: str, cache: DataFrame, max_chars: int | None = TRANSLATION_CHARS) -> DataFrame:
    """(text): the different texts that are still to be asked, each once.

    What stands in ``cache`` is not asked again, with a translation or without (null: it failed).
    Copies collapse on the map side; texts meet the cache by hash first, so that long ones are
    rarely compared.
    """
    def hashed(c: str) -> tuple[Column, Column]:
        asked = asked_text(c, max_chars)
        return F.xxhash64(asked).alias("_hash"), asked.alias("text")

    new = texts.select(*hashed(text)).filter(F.col("text") != "").distinct()
    return new.join(cache.select(*hashed("text")).distinct(), ["_hash", "text"], "left_anti").select("text")


def changed_text(original: Column | str, variant: Column | str) -> Column:
    """Rows whose text differs after trimming both sides."""
    return strip_space(null_text(original)) != strip_space(null_text(variant))


def search_terms(df: DataFrame, text: str, terms: Sequence[str]) -> DataFrame:
    """One row per (row, contained term). Terms are literals of the expression, so the text
    never meets a term table in a join."""
    low = F.lower(null_text(text))
    found = present([(low.contains(t.lower()), F.lit(t)) for t in terms], "string")
    return fan_out(df.withColumn("_terms", found), "_terms", "term")


def disjoint_check(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Sizes of both parts and the number of keys they share (must be 0)."""
    parts = (train.select(key, F.lit("train").alias("_part"))
             .unionByName(test.select(key, F.lit("test").alias("_part"))))
    per_key = parts.groupBy(key).agg(
        F.count_if(F.col("_part") == "train").alias("_in_train"),
        F.count_if(F.col("_part") == "test").alias("_in_test"))
    return per_key.agg(
        F.coalesce(F.sum("_in_train"), F.lit(0)).alias("n_train"),
        F.coalesce(F.sum("_in_test"), F.lit(0)).alias("n_test"),
        F.count_if((F.col("_in_train") > 0) & (F.col("_in_test") > 0)).alias("n_shared"))
