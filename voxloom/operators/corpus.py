"""The whole cleaning job: one shuffle, by the hash of the cleaned text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.labels import label_id, star_label
from voxloom.functions.text import clean_text, null_text, word_count
from voxloom.operators.dedup import keep_first
from voxloom.operators.shaping import computed_once
from voxloom.schema import MIN_WORDS


def clean(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """cleaned_text and word_count; rows below the word minimum are dropped."""
    df = df.withColumn(text, null_text(text))
    return (computed_once(df, cleaned_text=clean_text(text))
            .withColumn("word_count", word_count("cleaned_text"))
            .filter(F.col("word_count") >= min_words))


def preprocess(df: DataFrame, min_words: int = MIN_WORDS, order: Sequence[str] = ("source", "id"),
               language: Transformer | None = None) -> DataFrame:
    """Clean, drop short rows, keep the first row per cleaned text, and detect its language.

    ``language`` is a fitted ``operators.language.LanguageModel``. It runs last: the language depends
    on the cleaned text only, so tagging the distinct texts gives the same result for less work.
    """
    unique = keep_first(clean(df, min_words=min_words), ["cleaned_text"], list(order))
    return unique if language is None else language.transform(unique)


def label_from_stars(df: DataFrame) -> DataFrame:
    """Rating -> sentiment_label and label_id; rows without a star are dropped."""
    return (df.withColumn("sentiment_label", star_label("rating"))
            .filter(F.col("sentiment_label") != "")
            .withColumn("label_id", label_id("sentiment_label")))


def valid_labels(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Map labels to ids; rows with an unknown label are dropped."""
    return df.withColumn("label_id", label_id(label)).filter(F.col("label_id").isNotNull())
