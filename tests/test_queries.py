"""Every registered query with SQL against DuckDB at the smallest scale, and plan checks."""

import pytest
from compare import compare, duck

from voxloom.plans import catalogue


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_matches_sql(spark, con, small, name):
    assert compare(spark, con, small, catalogue.QUERIES[name], catalogue.SQL[name]) is None


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


NATIVE = ["clean_text", "extract_aspects", "aspect_sentences", "emoji_demojize", "tokenize",
          "preprocess", "corpus_aspects", "keyword_theta_join", "vocabulary", "language_id", "stem_text"]


@pytest.mark.parametrize("name", NATIVE)
def test_text_plans_have_no_python_worker(spark, small, name):
    text = plan(catalogue.QUERIES[name](spark, small))
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["preprocess", "corpus_aspects", "aspect_distribution",
                                  "keyword_theta_join", "link_ids", "json_reviews"])
def test_costly_expressions_are_evaluated_once(spark, small, name):
    text = plan(catalogue.QUERIES[name](spark, small))
    filters = [line for line in text.splitlines() if "Filter" in line.split("(")[0]]
    # Links are filtered by a short target column; whole texts and pages never in a filter.
    costly = ["regexp_replace", "regexp_extract", "from_json", "RLIKE(lower", "RLIKE(html"]
    assert not any(c in f for f in filters for c in costly)


@pytest.mark.parametrize("name", ["preprocess", "tier_eval", "stratified_split", "macro_f1",
                                  "aspect_degradation", "search_terms_join", "keyword_theta_join",
                                  "grid_cross", "lookup_fallback"])
def test_no_cross_join(spark, small, name):
    text = plan(catalogue.QUERIES[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_two_columns(spark, small):
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan(
        catalogue.QUERIES["scan_pruned"](spark, small))


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["aspect", "n"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["logreg_fit", "svm_fit"])
def test_fits_beat_the_majority_class(spark, name):
    """At sf0.01 some 80 rows are scored; the majority class alone has accuracy 0.75."""
    sf = "/root/testdata/sf0.01"
    pairs = catalogue.QUERIES["fit_predict"](spark, sf) if name == "logreg_fit" else None
    quality = catalogue.QUERIES[name](spark, sf).collect()
    assert quality and all(0 <= r.macro_f1 <= 1 and 0 <= r.accuracy <= 1 for r in quality)
    if pairs is not None:
        rows = pairs.collect()
        right = sum(r.label_id == r.pred_id for r in rows) / len(rows)
        majority = max(sum(r.label_id == k for r in rows) for k in range(3)) / len(rows)
        assert right >= majority


def test_language_of_texts_not_learnt_from(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id as id", "lang")
    rows = catalogue.QUERIES["language_id"](spark, sf).filter("part = 'test'").join(docs, "id").collect()
    assert sum(r.lang == r.language for r in rows) / len(rows) >= 0.95


def test_stems_are_never_null(spark, small):
    assert catalogue.QUERIES["stem_text"](spark, small).filter("stemmed is null").count() == 0
