"""Labelling sheets: pools for annotators, finalisation and the agreement report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.labels import final_label, is_label, star_label
from voxloom.functions.text import _c
from voxloom.operators.joins import enrich
from voxloom.operators.metrics import agreement
from voxloom.operators.ranking import seeded_hash, seeded_sample
from voxloom.operators.shaping import union_by_name
from voxloom.schema import (BLIND_COLS, EXPORT_COLS, EXTRA_COLS, LABELS, POOL_SIZE, SEED,
                            TEMPLATE_COLS)

NEEDED = ["rating", "cleaned_text", "source", "language"]


def make_sheet(pool: DataFrame, pre_label: Column | str | None = None,
               annotator: str = "annotator", blind: bool = False) -> DataFrame:
    """The wide template with its two extra columns, or the four-column blind form."""
    pre = F.lit("") if pre_label is None else _c(pre_label)
    filled = {"pre_label": pre, "assigned_to_1": F.lit(annotator)}
    blank = {c for c in TEMPLATE_COLS if c not in ("id", "text", "source", "language")}
    wanted = BLIND_COLS if blind else TEMPLATE_COLS + EXTRA_COLS
    return pool.select([
        filled[c].alias(c) if c in filled else F.lit("").alias(c) if c in blank else F.col(c)
        for c in wanted])


def scarce_pool(df: DataFrame, source: str, pool_size: int = POOL_SIZE,
                seed: int = SEED) -> DataFrame:
    """All rows with a non-negative star label and seeded negatives up to the pool size.

    The non-negative rows are never capped. Negatives are a top-n of at most ``pool_size``
    rows, so ranking them afterwards is a bounded step.
    """
    of_source = df.filter(F.col("source") == source).withColumn("star_label", star_label("rating"))
    keep = of_source.filter(F.col("star_label").isin("neutral", "positive"))
    n_keep = keep.agg(F.count(F.lit(1)).alias("n")).scalar()
    negatives = seeded_sample(of_source.filter(F.col("star_label") == "negative"),
                              "id", pool_size, seed)
    order = Window.orderBy(seeded_hash("id", seed), "id")
    wanted = (negatives.withColumn("_rn", F.row_number().over(order))
              .filter(F.col("_rn") <= F.lit(pool_size) - n_keep).drop("_rn"))
    return keep.unionByName(wanted)


def scarce_sheet(df: DataFrame, source: str, blind: bool = False, seed: int = SEED) -> DataFrame:
    pool = scarce_pool(df, source, seed=seed).orderBy(seeded_hash("id", seed), "id")
    return make_sheet(pool, "star_label", blind=blind)


def random_sheet(df: DataFrame, source: str, blind: bool = False, pool_size: int = POOL_SIZE,
                 seed: int = SEED) -> DataFrame:
    """Plain seeded sample of one source; the pre-label stays blank."""
    return make_sheet(seeded_sample(df.filter(F.col("source") == source), "id", pool_size, seed),
                      blind=blind)


def with_final_label(sheet: DataFrame) -> DataFrame:
    final = F.col("final_label") if "final_label" in sheet.columns else F.lit("")
    return sheet.withColumn("sentiment_label", final_label(final, "label_1"))


def finalize_sheet(sheet: DataFrame, corpus: DataFrame) -> DataFrame:
    """Enrich, decide the label, keep valid rows, export five columns."""
    done = with_final_label(enrich(sheet, corpus, NEEDED))
    return done.filter(is_label("sentiment_label")).select(*EXPORT_COLS)


def agreement_report(sheets: DataFrame, proxy_tiers: list[str],
                     expected: list[str] | None = None) -> DataFrame:
    """Long (tier, metric, value) report over labelled sheets of several tiers.

    ``sheets`` has tier, sentiment_label and rating. Agreement and kappa exist only for
    tiers with a star proxy; others have a null kappa (not applicable). Each tier of
    ``expected`` has a row that tells whether its sheet was found.
    """
    ok = is_label("sentiment_label")
    base = sheets.groupBy("tier").agg(
        F.count(F.lit(1)).cast("double").alias("rows"),
        F.count_if(ok).cast("double").alias("labelled"),
        *[F.count_if(F.col("sentiment_label") == x).cast("double").alias(x) for x in LABELS],
        F.count_if(ok & (F.col("sentiment_label") != "negative")).cast("double")
        .alias("non_negative"))
    names = ["rows", "labelled", *LABELS, "non_negative"]
    counted = base.select("tier", F.explode(F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*names))).alias("metric", "value"))
    starred = (sheets.filter(F.col("tier").isin(proxy_tiers) & ok)
               .withColumn("proxy", star_label("rating")).filter(is_label("proxy")))
    agreed = agreement(starred, ["tier"], "sentiment_label", "proxy").select(
        "tier", F.explode(F.map_from_arrays(
            F.array(F.lit("proxy_rows"), F.lit("agreement"), F.lit("kappa")),
            F.array(F.col("n").cast("double"), F.col("agreement"), F.col("kappa"))))
        .alias("metric", "value"))
    status = base.select("tier", F.lit("status_labelled").alias("metric"),
                         (F.col("labelled") > 0).cast("double").alias("value"))
    without = base.filter(~F.col("tier").isin(proxy_tiers)).select(
        "tier", F.lit("kappa").alias("metric"), F.lit(None).cast("double").alias("value"))
    parts = [counted, agreed, status, without]
    if expected:
        listed = sheets.sparkSession.createDataFrame([(t,) for t in expected], "tier string")
        there = base.select("tier", F.lit(1.0).alias("value"))
        parts.append(listed.join(there, "tier", "left").select(
            "tier", F.lit("status_sheet_found").alias("metric"), F.coalesce("value", F.lit(0.0)).alias("value")))
    return union_by_name(parts)
