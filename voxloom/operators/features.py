"""n-gram TF-IDF: vocabulary, weights as rows, and the same weights as ML vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, SQLTransformer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from voxloom.functions.text import TOKEN_RE, ngrams, null_text, term_counts, tokenize
from voxloom.session import ship_package

MAX_FEATURES = 10_000
MIN_DF = 2
BROADCAST_FEATURES = 200_000
SLICE_TOKENS = 1 << 21    # tokens whose n-grams are counted at once


def document_terms(df: DataFrame, id_col: str, text: str, n_max: int = 2) -> DataFrame:
    """(id, term, tf). Counted inside each row: no shuffle on (document, term)."""
    tokens = df.select(id_col, tokenize(text).alias("_tokens"))
    return tokens.select(id_col, F.inline(term_counts(ngrams("_tokens", n_max))))


def token_slices(texts: pa.ListArray, groups: np.ndarray):
    """(first text, text after the last, offsets, tokens) of some texts at a time.

    ``groups`` has the number of texts of each group. A slice holds whole groups, of up to
    SLICE_TOKENS tokens where that is more than one group.
    """
    ends = np.concatenate(([0], np.cumsum(pc.list_value_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)))
    cuts, flat = np.concatenate(([0], np.cumsum(groups))), texts.flatten()
    at = 0
    while at < len(cuts) - 1:
        begin = ends[cuts[at]]
        after = max(int(np.searchsorted(ends[cuts], begin + SLICE_TOKENS, "right")) - 1, at + 1)
        first, last = int(cuts[at]), int(cuts[after])
        yield first, last, ends[first: last + 1] - begin, flat.slice(int(begin), int(ends[last] - begin))
        at = after


def coded_ngrams(offsets: np.ndarray, tokens: pa.Array, n_max: int = 2):
    """For each n: (row of each n-gram, its code, the n-grams by code as strings)."""
    encoded = tokens.dictionary_encode()
    words, token = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    code, terms = token, words
    for n in range(1, n_max + 1):
        if n > 1:
            inside = row[n - 1:] == row[: len(row) - n + 1]
            key = np.where(inside, code[: len(inside)] * len(words) + token[n - 1:], -1)
            some, code = np.unique(key, return_inverse=True)
            if len(some) and some[0] < 0:  # n tokens of more than one row; their codes go no further
                some, code = some[1:], code - 1
            left, right = (pa.array(x) for x in np.divmod(some, max(len(words), 1)))
            terms = pc.binary_join_element_wise(terms.take(left), words.take(right), " ")
        here = code >= 0
        yield row[: len(code)][here], code[here], terms


def frequencies(df: DataFrame, text: str, n_max: int = 2) -> DataFrame:
    """(term, df, tf) of the n-grams of a corpus, a row of the corpus being a document.

    A task counts the n-grams of many texts at once, as numbers; a term becomes a string once per
    slice, not once per document. One shuffle by term adds up the counts.
    """
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            texts = batch.column(0)
            for _, _, offsets, tokens in token_slices(texts, np.ones(len(texts), np.int64)):
                for row, code, terms in coded_ngrams(offsets, tokens, n_max):
                    once = np.unique(row * max(len(terms), 1) + code)
                    in_rows = np.bincount(once % max(len(terms), 1), minlength=len(terms))
                    yield pa.RecordBatch.from_arrays(
                        [terms, pa.array(in_rows, pa.int64()), pa.array(np.bincount(code, minlength=len(terms)), pa.int64())],
                        ["term", "df", "tf"])

    counted = df.select(tokenize(text).alias("_tokens")).mapInArrow(run, "term string, df long, tf long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf").alias("tf"))


def vocabulary(terms: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES,
               ) -> DataFrame:
    """Terms in at least ``min_df`` documents, the most frequent ones first; see ``most_frequent``.

    ``terms`` has a row per document and term, and takes one shuffle by term with map-side sums.
    """
    return most_frequent(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("tf")),
                         min_df, max_features)


def most_frequent(counted: DataFrame, min_df: int = MIN_DF, max_features: int = MAX_FEATURES) -> DataFrame:
    """The rows of (term, df, tf) with ``min_df`` documents and the highest ``tf``, ties to the smaller term.

    A histogram over powers of two gives a frequency floor that at least ``max_features`` terms
    reach, so the final top-n compares little more than the terms it returns, not the top terms of
    every partition.
    """
    counted = counted.filter(F.col("df") >= min_df)
    level = F.floor(F.log2("tf"))
    higher = Window.orderBy(F.desc("level")).rowsBetween(Window.unboundedPreceding, -1)
    floor = (counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("above", F.coalesce(F.sum("n").over(higher), F.lit(0)))
             .filter(F.col("above") < max_features).agg(F.min("level")).scalar())
    return (counted.filter(level >= floor)
            .orderBy(F.desc("tf"), "term").limit(max_features))


def smooth_idf(df_col: Column, n_docs: Column | int) -> Column:
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return F.log((n + 1.0) / (df_col + 1.0)) + 1.0


def tfidf(df: DataFrame, id_col: str, text: str, n_max: int = 2, min_df: int = MIN_DF,
          max_features: int = MAX_FEATURES) -> DataFrame:
    """(id, term, weight): tf x smooth idf, rows scaled to unit length.

    The weights of a text are made in its row. Up to BROADCAST_FEATURES terms of the vocabulary go to
    all tasks, more are joined as Spark sees fit. Texts of one id are brought together first (they are
    scaled as one document), so that no weight is shuffled.
    """
    n_docs = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = most_frequent(frequencies(df, text, n_max), min_df, max_features).select(
        "term", smooth_idf(F.col("df"), n_docs).alias("idf"))
    if max_features > BROADCAST_FEATURES:
        return _joined_tfidf(df, id_col, text, n_max, idf)
    known = idf.limit(max_features).collect()
    shared = df.sparkSession.sparkContext.broadcast(([r.term for r in known], np.array([r.idf for r in known], float)))
    schema = StructType([df.schema[id_col], StructField("term", StringType()), StructField("weight", DoubleType())])

    def run(batches):
        words, idfs = pa.array(shared.value[0], pa.string()), shared.value[1]
        width = max(len(words), 1)
        for batch in batches:
            groups = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            group = np.repeat(np.arange(len(groups)), groups)
            for first, _, offsets, tokens in token_slices(batch.column(1).flatten(), groups):
                found, counts = [], []
                for row, code, terms in coded_ngrams(offsets, tokens, n_max):
                    place = pc.fill_null(pc.index_in(terms, words.cast(terms.type)), -1).to_numpy(zero_copy_only=False)[code]
                    once, n = np.unique((row * width + place)[place >= 0], return_counts=True)
                    found.append(once)
                    counts.append(n)
                row, place = np.divmod(np.concatenate(found), width)
                weight, own = np.concatenate(counts) * idfs[place], group[row + first]
                norm = np.sqrt(np.bincount(own, weight * weight, len(groups)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), words.take(pa.array(place)), pa.array(weight / norm[own])], schema.names)

    # The texts of an id, most often one; tokens are made behind the shuffle.
    texts = df.groupBy(id_col).agg(F.collect_list(null_text(text)).alias("_texts"))
    ship_package(df.sparkSession)
    return texts.select(id_col, F.transform("_texts", tokenize)).mapInArrow(run, schema)


def _joined_tfidf(df: DataFrame, id_col: str, text: str, n_max: int, idf: DataFrame) -> DataFrame:
    """``tfidf`` with a vocabulary of any size, joined."""
    terms = document_terms(df.select(id_col, text).repartition(id_col), id_col, text, n_max)
    weighted = terms.join(idf, "term").select(
        id_col, F.struct("term", (F.col("tf") * F.col("idf")).alias("w")).alias("tw"))
    per_doc = weighted.groupBy(id_col).agg(F.collect_list("tw").alias("tws"))
    norm = F.sqrt(F.aggregate("tws", F.lit(0.0), lambda acc, x: acc + x["w"] * x["w"]))
    return (per_doc.withColumn("norm", norm)
            .select(id_col, "norm", F.inline("tws"))
            .select(id_col, "term", (F.col("w") / F.col("norm")).alias("weight")))


def _terms_sql(text: str) -> str:
    tokens = f"regexp_extract_all(lower(coalesce(`{text}`, '')), r'{TOKEN_RE}', 0)"
    n_pairs = "greatest(size(_tokens) - 1, 0)"
    pairs = (f"zip_with(slice(_tokens, 1, {n_pairs}), slice(_tokens, 2, {n_pairs}), "
             "(a, b) -> concat(a, ' ', b))")
    return (f"SELECT * EXCEPT (_tokens), concat(_tokens, {pairs}) AS terms "
            f"FROM (SELECT *, {tokens} AS _tokens FROM __THIS__)")


def tfidf_stages(train: DataFrame, id_col: str, text: str, min_df: int = MIN_DF,
                 max_features: int = MAX_FEATURES) -> list[Transformer]:
    """Fitted ML stages text -> unit-length TF-IDF vector ``features``.

    The vocabulary (at most ``max_features`` rows) is all that comes to the driver; the
    stages then work row by row on the executors.
    """
    n_docs = train.agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = (most_frequent(frequencies(train, text), min_df, max_features)
            .select("term", smooth_idf(F.col("df"), n_docs).alias("idf"))
            .limit(max_features).collect())
    if not rows:
        raise ValueError(f"no term occurs in {min_df} documents")
    counter = CountVectorizerModel.from_vocabulary(
        [r.term for r in rows], inputCol="terms", outputCol="term_counts")
    scale = ElementwiseProduct(scalingVec=Vectors.dense([r.idf for r in rows]),
                               inputCol="term_counts", outputCol="weighted")
    return [SQLTransformer(statement=_terms_sql(text)), counter, scale,
            Normalizer(p=2.0, inputCol="weighted", outputCol="features")]


def featurize(stages: list[Transformer], df: DataFrame) -> DataFrame:
    return (PipelineModel(stages).transform(df)
            .drop("terms", "term_counts", "weighted"))
