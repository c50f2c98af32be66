"""Accuracy per model x tier x aspect, kept for aspects without support."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.emoji import has_emoji
from voxloom.functions.labels import cell_note
from voxloom.functions.stats import wilson_ci
from voxloom.functions.text import extract_aspects
from voxloom.operators.metrics import scores
from voxloom.operators.shaping import fan_out
from voxloom.schema import MIN_SUPPORT, OVERALL
from voxloom.taxonomy import Taxonomy


def tag_aspects(df: DataFrame, taxonomy: Taxonomy, text: str = "cleaned_text") -> DataFrame:
    """Always recomputed from the text; a column read from CSV is never trusted."""
    return df.withColumn("aspects", extract_aspects(text, taxonomy))


def aspect_distribution(df: DataFrame, aspects: str = "aspects") -> DataFrame:
    return (fan_out(df, aspects, "aspect", keep=[])
            .groupBy("aspect").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "aspect"))


def score_grid(models: DataFrame, tiers: Sequence[str]) -> DataFrame:
    """Every model with every tier: the tier list is an array literal, so no join."""
    return models.select("model", F.explode(F.array(*[F.lit(t) for t in tiers])).alias("tier"))


def aspect_degradation(pairs: DataFrame, taxonomy: Taxonomy, min_support: int = MIN_SUPPORT,
                       grid: DataFrame | None = None) -> DataFrame:
    """Overall row plus one row per aspect for each (model, tier).

    ``pairs`` has model, tier, label_id, pred_id and aspects. Slices overlap. Aspects
    nobody mentions are kept with n = 0: the scores of a (model, tier) pair fold into one
    map of at most aspects + 1 entries and the full aspect list is read out of it.
    """
    names = [OVERALL, *taxonomy]
    sliced = pairs.select(
        "model", "tier", "label_id", "pred_id",
        F.explode_outer(F.concat(F.array(F.lit(OVERALL)), "aspects")).alias("aspect"))
    per_slice = scores(sliced, ["model", "tier", "aspect"])
    folded = per_slice.groupBy("model", "tier").agg(F.map_from_entries(F.collect_list(F.struct(
        "aspect", F.struct("n", "correct", "macro_f1")))).alias("found"))
    if grid is not None:
        folded = grid.join(folded, ["model", "tier"], "left")
    every = folded.select("model", "tier", "found",
                          F.explode(F.array(*[F.lit(a) for a in names])).alias("aspect"))
    hit = F.try_element_at("found", F.col("aspect"))
    zero = F.lit(0).cast("long")
    flat = every.select("model", "tier", "aspect",
                        F.coalesce(hit["n"], zero).alias("n"),
                        F.coalesce(hit["correct"], zero).alias("correct"),
                        F.when(F.col("aspect") == OVERALL, hit["macro_f1"]).alias("macro_f1"))
    low, high = wilson_ci("correct", "n")
    return flat.select(
        "model", "tier", "aspect", "n",
        F.when(F.col("n") > 0, F.col("correct") / F.col("n")).alias("accuracy"),
        low.alias("ci_low"), high.alias("ci_high"), "macro_f1",
        (F.col("n") < min_support).alias("low_support"))


def degradation_cells(table: DataFrame, taxonomy: Taxonomy, tiers: Sequence[str]) -> DataFrame:
    """One cell per model x aspect x tier with its note; the value is masked when weak."""
    order = F.create_map(*[F.lit(x) for i, a in enumerate(taxonomy) for x in (a, i)])
    tier_order = F.create_map(*[F.lit(x) for i, t in enumerate(tiers) for x in (t, i)])
    masked = F.col("low_support") | F.col("accuracy").isNull()
    return (table.filter(F.col("aspect") != OVERALL)
            .select("model", "aspect", "tier",
                    F.try_element_at(order, F.col("aspect")).alias("aspect_ord"),
                    F.try_element_at(tier_order, F.col("tier")).alias("tier_ord"),
                    F.when(~masked, F.col("accuracy")).alias("value"),
                    cell_note("accuracy", "n", "low_support").alias("note")))


def degradation_matrix(table: DataFrame, taxonomy: Taxonomy, tiers: Sequence[str],
                       names: Sequence[str] | None = None) -> DataFrame:
    """Aspect x tier accuracy per model in fixed row and column order."""
    cells = degradation_cells(table, taxonomy, tiers)
    wide = (cells.groupBy("model", "aspect", "aspect_ord").pivot("tier", list(tiers))
            .agg(F.max("value")))
    return (wide.select("model", "aspect", "aspect_ord", *[
                F.col(f"`{t}`").alias(n) for t, n in zip(tiers, names or tiers)])
            .orderBy("model", "aspect_ord"))


def emoji_prevalence(df: DataFrame, group: str, text: str) -> DataFrame:
    """Share in percent of rows with at least one emoji."""
    return df.groupBy(group).agg(
        (F.avg(has_emoji(text).cast("double")) * 100).alias("emoji_percent"),
        F.count(F.lit(1)).alias("n"))
