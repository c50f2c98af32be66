"""Classification metrics from one small table of confusion counts.

Every metric starts with ``confusion_counts``: a partial aggregation that leaves at most
groups x labels^2 rows. What follows works on that table only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions.labels import id_label
from voxloom.functions.stats import f1
from voxloom.operators.ranking import running_total
from voxloom.schema import LABEL_IDS

TRUTH, PRED = "label_id", "pred_id"


def pair_truth(preds: DataFrame, truth: DataFrame, key: str = "id") -> DataFrame:
    """Truth and prediction side by side, by key. Narrow ``truth`` first: texts need not move."""
    return preds.join(truth, key)


def confusion_counts(pairs: DataFrame, groups: Sequence[str], truth: str = TRUTH,
                     pred: str = PRED) -> DataFrame:
    return pairs.groupBy(*groups, truth, pred).agg(F.count(F.lit(1)).alias("n"))


def class_counts(pairs: DataFrame, groups: Sequence[str], truth: str = TRUTH,
                 pred: str = PRED) -> DataFrame:
    """(groups, class) -> tp, n_true, n_pred over the union of true and predicted classes."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col(truth).alias("class"), n.alias("n_true"), zero.alias("n_pred"),
                 F.when(F.col(truth) == F.col(pred), n).otherwise(zero).alias("tp")),
        F.struct(F.col(pred).alias("class"), zero.alias("n_true"), n.alias("n_pred"),
                 zero.alias("tp")))
    return (confusion_counts(pairs, groups, truth, pred)
            .select(*groups, F.inline(sides))
            .groupBy(*groups, "class")
            .agg(*[F.sum(c).alias(c) for c in ("tp", "n_true", "n_pred")]))


def scores(pairs: DataFrame, groups: Sequence[str], truth: str = TRUTH,
           pred: str = PRED) -> DataFrame:
    """n, correct, accuracy, macro-F1, chance agreement and kappa per group."""
    tp, nt, np_ = F.col("tp"), F.col("n_true"), F.col("n_pred")
    n = F.sum(nt)
    summed = class_counts(pairs, groups, truth, pred).groupBy(*groups).agg(
        n.alias("n"), F.sum(tp).alias("correct"), F.avg(f1(tp, nt, np_)).alias("macro_f1"),
        F.sum(nt.cast("double") * np_).alias("_cross"))
    po = F.col("correct") / F.col("n")
    pe = F.col("_cross") / (F.col("n").cast("double") * F.col("n"))
    return (summed
            .withColumn("accuracy", po)
            .withColumn("chance", pe)
            .withColumn("kappa", F.when(F.col("_cross") < F.col("n").cast("double") * F.col("n"),
                                        (po - pe) / (F.lit(1.0) - pe)))
            .drop("_cross"))


def accuracy(pairs: DataFrame, groups: Sequence[str], truth: str = TRUTH,
             pred: str = PRED) -> DataFrame:
    hit = (F.col(truth) == F.col(pred)).cast("double")
    return pairs.groupBy(*groups).agg(F.avg(hit).alias("accuracy"))


def macro_f1(pairs: DataFrame, groups: Sequence[str]) -> DataFrame:
    return scores(pairs, groups).select(*groups, "macro_f1")


def tier_eval(pairs: DataFrame) -> DataFrame:
    """One row per (tier, model). A model without predictions has no row."""
    return scores(pairs, ["tier", "model"]).select("tier", "model", "accuracy", "macro_f1")


def class_report(pairs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Per-class precision, recall, F1 and support, with accuracy, macro and weighted rows."""
    tp, nt, np_ = F.col("tp"), F.col("n_true"), F.col("n_pred")
    zero = F.lit(0.0)
    per_class = class_counts(pairs, groups).select(
        *groups, id_label("class").alias("label"), "tp", "n_true",
        F.when(np_ > 0, tp / np_).otherwise(zero).alias("precision"),
        F.when(nt > 0, tp / nt).otherwise(zero).alias("recall"),
        f1(tp, nt, np_).alias("f1"))
    one = F.lit(1).cast("long")
    rows = F.array(
        F.struct(F.col("label").alias("row"), one.alias("w")),
        F.struct(F.lit("accuracy").alias("row"), one.alias("w")),
        F.struct(F.lit("macro avg").alias("row"), one.alias("w")),
        F.struct(F.lit("weighted avg").alias("row"), F.col("n_true").alias("w")))
    w, is_acc = F.col("w"), F.col("row") == "accuracy"

    def mean(c: str) -> Column:
        return F.sum(F.col(c) * w) / F.sum(w)

    return (per_class.select("*", F.inline(rows)).groupBy(*groups, "row").agg(
                mean("precision").alias("_p"), mean("recall").alias("_r"), mean("f1").alias("_f"),
                F.sum("tp").alias("_tp"), F.sum("n_true").alias("support"))
            .select(*groups, F.col("row").alias("label"),
                    F.when(~is_acc, F.col("_p")).alias("precision"),
                    F.when(~is_acc, F.col("_r")).alias("recall"),
                    F.when(is_acc, F.col("_tp") / F.col("support")).otherwise(F.col("_f"))
                    .alias("f1"),
                    "support"))


def confusion_matrix(pairs: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows: true label; columns ``pred_<label>``."""
    counts = confusion_counts(pairs, groups)
    wide = counts.groupBy(*groups, TRUTH).pivot(PRED, list(LABEL_IDS.values())).agg(F.sum("n"))
    return wide.select(*groups, TRUTH, *[
        F.coalesce(F.col(str(i)), F.lit(0)).alias(f"pred_{label}")
        for label, i in LABEL_IDS.items()])


def agreement(frame: DataFrame, groups: Sequence[str], a: str, b: str) -> DataFrame:
    """Raw agreement and Cohen's kappa of two label columns (null when undefined)."""
    return scores(frame, groups, a, b).select(
        *groups, "n", F.col("accuracy").alias("agreement"), "kappa")


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Count per value, descending; name as tie-break."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ordered = counted.orderBy(F.desc("n"), F.asc(column))
    return ordered.limit(n) if n is not None else ordered


def pivot_wide(df: DataFrame, index: str, columns: str, values: str,
               column_values: Sequence[str], digits: int | None = None,
               names: Sequence[str] | None = None) -> DataFrame:
    """Long -> wide with explicit columns, so no extra job looks for them."""
    wide = df.groupBy(index).pivot(columns, list(column_values)).agg(F.max(values))
    return wide.select(index, *[
        (F.round(F.col(f"`{v}`"), digits) if digits is not None else F.col(f"`{v}`")).alias(name)
        for v, name in zip(column_values, names or column_values)])


def delta_vs_reference(df: DataFrame, variant: str, reference: str, groups: Sequence[str],
                       value: str, name: str = "delta") -> DataFrame:
    """Difference of each variant from the reference variant; the reference is dropped.

    A window over the metric table: it is computed once, not once per side of a join.
    """
    base = F.max(F.when(F.col(variant) == reference, F.col(value))).over(Window.partitionBy(*groups))
    return (df.withColumn("_base", base).filter(F.col(variant) != reference)
            .withColumn(name, F.col(value) - F.col("_base"))
            .select(variant, *groups, name))


def corpus_totals(raw: DataFrame, clean: DataFrame) -> DataFrame:
    one = [raw.select(F.lit("raw").alias("stage")), clean.select(F.lit("clean").alias("stage"))]
    return one[0].unionByName(one[1]).groupBy("stage").agg(F.count(F.lit(1)).alias("n"))


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row ``median``: the mean of the two values in the middle; null for no value.

    Rows are counted per value with partial sums, and ranks are running totals over that histogram:
    no task sees more than a slice of the distinct values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counts, [value], "_n", "_before")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
    # Of the values in the middle, the lower has rank (n - 1) div 2 and the upper n div 2, from 0.
    low, high = F.floor((total - 1) / 2), F.floor(total / 2)
    end = F.col("_before") + F.col("_n")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_before") <= rank) & (rank < end), F.col(value)))

    return placed.agg(((at(low) + at(high)) / 2).cast("double").alias("median"))


def corpus_span(df: DataFrame, date: str, words: str) -> DataFrame:
    """First and last date and the exact median length, as one row."""
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date")).withColumn(
        "median_words", exact_median(df, words).scalar())
