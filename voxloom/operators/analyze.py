"""Batch analysis: overall scores, language name and sentiment per mentioned aspect."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.labels import (NO_ASPECT_TEXT, NO_VALUE, argmax_label, language_name,
                                      score_map)
from voxloom.functions.text import (aspect_sentences, display_aspect, keyword_match, null_text,
                                    percent, present, strip_space)
from voxloom.operators.language import LanguageModel
from voxloom.operators.models import predict_scores
from voxloom.operators.shaping import computed_once
from voxloom.schema import LABELS, OVERALL
from voxloom.taxonomy import Taxonomy

SNIPPET = "cleaned_text"


def aspect_snippets(df: DataFrame, text: str, taxonomy: Taxonomy) -> DataFrame:
    """One row for the whole text and one per mentioned aspect with its sentences.

    Row-local fan-out, so the model later scores whole texts and snippets in one pass. Texts
    without any aspect get a placeholder row. Empty texts have no result.
    """
    trimmed = strip_space(null_text(text))
    base = df.withColumn(text, trimmed).filter(F.col(text) != "")

    def part(aspect: str, snippet: Column) -> Column:
        return F.struct(F.lit(aspect).alias("aspect"), snippet.alias("_snippet"))

    found = present(
        [(keyword_match(text, kws), part(aspect, aspect_sentences(text, kws)))
         for aspect, kws in taxonomy.items()], "struct<aspect:string,_snippet:string>")
    none = F.array(part(NO_ASPECT_TEXT, F.lit("")))
    parts = F.concat(F.array(part(OVERALL, F.col(text))),
                     F.when(F.size("_found") == 0, none).otherwise(F.col("_found")))
    return base.withColumn("_found", found).select(
        *df.columns, F.inline(parts)).drop(text).withColumnRenamed("_snippet", SNIPPET)


def analyze(df: DataFrame, model: PipelineModel, taxonomy: Taxonomy, id_col: str = "id",
            text: str = "text", language: str = "language", detector: LanguageModel | None = None) -> DataFrame:
    """(id, aspect, language, sentiment, confidence, scores); ``scores`` on the overall row.

    With a ``detector`` the language is that of the trimmed text, else it is given by the row.
    """
    rows = df if detector is None else computed_once(df.select(id_col, text), **{language: detector.detect(text)})
    parts = aspect_snippets(rows.select(id_col, text, language), text, taxonomy)
    scored = predict_scores(model, parts, [id_col, language, "aspect"])
    missing = F.col("aspect") == NO_ASPECT_TEXT
    top = F.array_max("scores")
    return scored.select(
        id_col,
        F.when(F.col("aspect") == OVERALL, F.col("aspect"))
        .otherwise(display_aspect("aspect")).alias("aspect"),
        language_name(language).alias("language"),
        F.when(missing, F.lit(NO_VALUE)).otherwise(argmax_label("scores", LABELS))
        .alias("sentiment"),
        F.when(missing, F.lit(NO_VALUE)).otherwise(percent(top)).alias("confidence"),
        F.when(F.col("aspect") == OVERALL, score_map(LABELS, "scores")).alias("scores"))
