"""Declared schemas and the fixed label / sheet vocabularies."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
LABELS = ["negative", "neutral", "positive"]
LABEL_IDS = {"negative": 0, "neutral": 1, "positive": 2}
SEED = 42
MIN_WORDS = 5
MIN_SUPPORT = 8
POOL_SIZE = 60
OVERALL = "__overall__"
REPLIES_PER_THREAD = 20
THREADS_PER_SEARCH = 50
THREADS_PER_FORUM = 12
MAX_PAGES_PER_THREAD = 8
POSTS_PER_PAGE = 20
TARGET_POSTS = 1200
TRANSLATION_CHARS = 4900
TEMPLATE_COLS = [
    "id", "text", "source", "language", "pre_label",
    "assigned_to_1", "label_1", "assigned_to_2", "label_2",
    "final_label", "disagreement", "notes",
]
EXTRA_COLS = ["rating", "cleaned_text"]
BLIND_COLS = ["id", "text", "label_1", "notes"]
EXPORT_COLS = ["id", "source", "language", "cleaned_text", "sentiment_label"]
REVIEW_COLS = ["id", "text", "rating", "date", "source", "app"]
# ----------------------------------------------------------------------------

REVIEW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("source", T.StringType()),
    T.StructField("app", T.StringType()),
])

CLEANED_SCHEMA = T.StructType(REVIEW_SCHEMA.fields + [
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("language", T.StringType()),
])

LABELLED_SCHEMA = T.StructType(CLEANED_SCHEMA.fields + [
    T.StructField("sentiment_label", T.StringType()),
])

SHEET_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in TEMPLATE_COLS]
    + [T.StructField("rating", T.DoubleType()), T.StructField("cleaned_text", T.StringType())]
)

BLIND_SHEET_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in BLIND_COLS])

EXPORT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in EXPORT_COLS])

TIER_EVAL_SCHEMA = T.StructType([
    T.StructField("tier", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("macro_f1", T.DoubleType()),
])

DEGRADATION_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("tier", T.StringType()),
    T.StructField("aspect", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("ci_low", T.DoubleType()),
    T.StructField("ci_high", T.DoubleType()),
    T.StructField("macro_f1", T.DoubleType()),
    T.StructField("low_support", T.BooleanType()),
])

# One page of an embedded JSON review feed.
FEED_SCHEMA = T.StructType([
    T.StructField("props", T.StructType([
        T.StructField("pageProps", T.StructType([
            T.StructField("reviews", T.ArrayType(T.StructType([
                T.StructField("id", T.StringType()),
                T.StructField("text", T.StringType()),
                T.StructField("rating", T.DoubleType()),
                T.StructField("dates", T.StructType([
                    T.StructField("publishedDate", T.StringType()),
                ])),
            ]))),
        ])),
    ])),
])


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail at plan time when a needed column is absent; returns ``df`` unchanged."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed result with no rows (the header-only result)."""
    return spark.createDataFrame([], schema)


def with_declared_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to ``schema`` with declared types; absent columns become null."""
    return df.select([
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
