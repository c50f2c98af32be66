"""Text-variant comparisons: retrained ablations and paired original/translated scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.emoji import EMOJI_MODES, emoji_variant
from voxloom.functions.stem import STEM_MODES, learn_stems, stem_variant
from voxloom.operators.metrics import scores
from voxloom.operators.models import fit_classifier, predict
from voxloom.operators.shaping import computed_once, union_by_name
from voxloom.session import checkpointed


def ablation(train: DataFrame, tiers: DataFrame, modes: Sequence[str],
             variant: Callable[[str, str], Column], text: str = "cleaned_text",
             id_col: str = "id", **fit) -> DataFrame:
    """(mode, tier, accuracy, macro_f1): retrain on each text variant, score all tiers.

    The loop runs over the few modes; training and scoring are Spark jobs over all rows.
    Training and tier rows are cut from their lineage once, since every mode reads them.
    """
    base = checkpointed(train.select(id_col, text, "label_id"))
    tested = checkpointed(tiers.select("tier", "label_id", text))
    scored = []
    for mode in modes:
        def varied(df: DataFrame, mode: str = mode) -> DataFrame:
            return computed_once(df, **{text: variant(text, mode)})

        model = fit_classifier(varied(base), id_col=id_col, text=text, **fit)
        pairs = predict(model, varied(tested), mode, ["tier", "label_id"])
        scored.append(pairs.withColumnRenamed("model", "mode"))
    return scores(union_by_name(scored), ["mode", "tier"]).select(
        "mode", "tier", "accuracy", "macro_f1")


def ablation_emoji(train: DataFrame, tiers: DataFrame, **kw) -> DataFrame:
    return ablation(train, tiers, EMOJI_MODES, emoji_variant, **kw)


def ablation_stemming(train: DataFrame, tiers: DataFrame, **kw) -> DataFrame:
    known = learn_stems(train, kw.get("text", "cleaned_text"))
    return ablation(train, tiers, STEM_MODES, lambda c, mode: stem_variant(c, mode, known), **kw)


def variant_comparison(pairs: DataFrame, group: str = "tier") -> DataFrame:
    """Original against variant predictions, on all rows and on the changed ones.

    ``pairs`` has label_id, pred_original, pred_variant, changed and failed. Each row goes
    to the slices it belongs to and one metric pass scores all slices.
    """
    def entry(subset: str, which: str, pred: str) -> Column:
        return F.struct(F.lit(subset).alias("subset"), F.lit(which).alias("which"),
                        F.col(pred).alias("pred_id"))

    slices = F.array_compact(F.array(
        entry("all", "o", "pred_original"), entry("all", "v", "pred_variant"),
        F.when(F.col("changed"), entry("changed", "o", "pred_original")),
        F.when(F.col("changed"), entry("changed", "v", "pred_variant")),
        F.when(F.col("failed"), entry("failed", "o", "pred_original"))))
    per_slice = scores(pairs.select(group, "label_id", F.inline(slices)),
                       [group, "subset", "which"])

    def pick(subset: str, which: str, value: str) -> Column:
        here = (F.col("subset") == subset) & (F.col("which") == which)
        return F.max(F.when(here, F.col(value)))

    zero = F.lit(0).cast("long")
    wide = per_slice.groupBy(group).agg(
        pick("all", "o", "n").alias("n"),
        F.coalesce(pick("failed", "o", "n"), zero).alias("n_translation_failed"),
        pick("all", "o", "macro_f1").alias("macro_f1_original"),
        pick("all", "v", "macro_f1").alias("macro_f1_translated"),
        F.coalesce(pick("changed", "o", "n"), zero).alias("n_nonenglish_translated"),
        pick("changed", "o", "macro_f1").alias("macro_f1_original_sub"),
        pick("changed", "v", "macro_f1").alias("macro_f1_translated_sub"))
    return wide.select(
        group, "n", "n_translation_failed", "macro_f1_original", "macro_f1_translated",
        (F.col("macro_f1_translated") - F.col("macro_f1_original")).alias("macro_f1_delta"),
        "n_nonenglish_translated", "macro_f1_original_sub", "macro_f1_translated_sub",
        (F.col("macro_f1_translated_sub") - F.col("macro_f1_original_sub"))
        .alias("macro_f1_delta_sub"))
