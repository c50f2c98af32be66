"""Samples, splits and labelling pools."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import joins, labeling, ranking
from voxloom.plans import views as V
from voxloom.plans.registry import query
from voxloom.plans.text_queries import STAR_SQL
from voxloom.schema import POOL_SIZE

KEY = "md5('42-' || id)"


def labelled(spark, d):
    return V.labelled(spark, d, text=False).select("id", "sentiment_label", "label_id")


@query("head_per_group", f"""
WITH {V.LABELLED_SQL} SELECT id, sentiment_label FROM labelled
QUALIFY row_number() OVER (PARTITION BY sentiment_label ORDER BY id) <= 4""")
def head_per_group(spark, d):
    return ranking.head_per_group(labelled(spark, d), ["sentiment_label"], ["id"], 4).select(
        "id", "sentiment_label")


@query("seeded_sample", f"""
WITH {V.REVIEWS_SQL} SELECT id, source FROM reviews ORDER BY {KEY}, id LIMIT {POOL_SIZE}""")
def seeded_sample(spark, d):
    return ranking.seeded_sample(V.reviews(spark, d).select("id", "source"), "id", POOL_SIZE)


@query("seeded_shuffle", f"""
WITH {V.REVIEWS_SQL} SELECT id, row_number() OVER (ORDER BY {KEY}, id) AS shuffle_pos FROM reviews""")
def seeded_shuffle(spark, d):
    return ranking.seeded_rank(V.reviews(spark, d).select("id"), "id")


@query("balanced_sample", f"""
WITH {V.LABELLED_SQL} SELECT id, sentiment_label FROM labelled
QUALIFY row_number() OVER (PARTITION BY sentiment_label ORDER BY {KEY}, id) <= 60""")
def balanced_sample(spark, d):
    return ranking.balanced_sample(labelled(spark, d), "id", "sentiment_label", 60).select(
        "id", "sentiment_label")


SPLIT_SQL = V.LABELLED_SQL + f""",
split AS (SELECT id, sentiment_label, CASE WHEN row_number() OVER (PARTITION BY sentiment_label
            ORDER BY {KEY}, id) <= round(0.2 * count(*) OVER (PARTITION BY sentiment_label))
            THEN 'test' ELSE 'train' END AS part FROM labelled)"""


def split(spark, d):
    return ranking.stratified_split(labelled(spark, d), "id", "sentiment_label", 0.2)


@query("stratified_split", f"WITH {SPLIT_SQL} SELECT id, sentiment_label, part FROM split")
def stratified_split(spark, d):
    return split(spark, d).select("id", "sentiment_label", "part")


@query("validation_carve", f"""
WITH {SPLIT_SQL}
SELECT id, sentiment_label, CASE WHEN row_number() OVER (PARTITION BY sentiment_label
  ORDER BY md5('43-' || id), id) <= round(0.15 * count(*) OVER (PARTITION BY sentiment_label))
  THEN 'validation' ELSE 'train' END AS part FROM split WHERE part = 'train'""")
def validation_carve(spark, d):
    train = split(spark, d).filter(F.col("part") == "train").drop("part")
    return ranking.validation_carve(train, "id", "sentiment_label", 0.15).select(
        "id", "sentiment_label", "part")


@query("split_disjoint", f"""
WITH {SPLIT_SQL}
SELECT count(*) FILTER (WHERE part = 'train') AS n_train, count(*) FILTER (WHERE part = 'test') AS n_test,
       CAST(0 AS BIGINT) AS n_shared FROM split""")
def split_disjoint(spark, d):
    parts = split(spark, d)
    return joins.disjoint_check(parts.filter(F.col("part") == "train"),
                                parts.filter(F.col("part") == "test"), "id")


def corpus(spark, d):
    return V.cleaned(V.reviews(spark, d))


SCARCE_SQL = V.CLEANED_SQL + f""",
src AS (SELECT *, {STAR_SQL} AS pre_label FROM cleaned WHERE source = 'src3'),
pool AS (
  SELECT * FROM src WHERE pre_label IN ('neutral', 'positive')
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY {KEY}, id) AS rn FROM src
    WHERE pre_label = 'negative')
  WHERE rn <= greatest(0, {POOL_SIZE} - (SELECT count(*) FROM src
                                         WHERE pre_label IN ('neutral', 'positive'))))"""

WIDE_SQL = """id, text, source, language, {pre} AS pre_label, 'annotator' AS assigned_to_1, '' AS label_1,
  '' AS assigned_to_2, '' AS label_2, '' AS final_label, '' AS disagreement, '' AS notes, rating,
  cleaned_text"""


@query("eval_pool_scarce", f"WITH {SCARCE_SQL} SELECT id, pre_label FROM pool")
def eval_pool_scarce(spark, d):
    return labeling.scarce_pool(corpus(spark, d), "src3").select(
        "id", F.col("star_label").alias("pre_label"))


@query("sheet_wide", f"WITH {SCARCE_SQL} SELECT {WIDE_SQL.format(pre='pre_label')} FROM pool")
def sheet_wide(spark, d):
    return labeling.scarce_sheet(corpus(spark, d), "src3")


@query("sheet_blind", f"WITH {SCARCE_SQL} SELECT id, text, '' AS label_1, '' AS notes FROM pool")
def sheet_blind(spark, d):
    return labeling.scarce_sheet(corpus(spark, d), "src3", blind=True)


@query("eval_pool_random", f"""
WITH {V.CLEANED_SQL} SELECT {WIDE_SQL.format(pre="''")} FROM cleaned WHERE source = 'src7'
ORDER BY {KEY}, id LIMIT {POOL_SIZE}""")
def eval_pool_random(spark, d):
    return labeling.random_sheet(corpus(spark, d), "src7")
