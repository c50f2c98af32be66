"""Language identification from character trigram profiles learnt on the corpus.

``LanguageModel`` is a savable transformer that scores a text inside its row: the profile is a
bounded table in the expression, and the sums over the grams of a text are a fold of an array. For
frequent words the sums are in a second such table, so that most words cost one look-up. Profiles
beyond the bound are joined by ``identify_language``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.lookup import LIMIT, InlineTable, bound
from voxloom.functions.text import _c, null_text, term_counts
from voxloom.operators.shaping import fan_out
from voxloom.session import checkpointed

GRAM = 3
BROADCAST_GRAMS = 1_000_000   # profile rows up to which the table is broadcast
SCALE = 1_000_000     # log-probabilities as integers: sums do not depend on row order
KNOWN_WORDS = 20_000
WORD_RE = r"\p{L}+"
UNKNOWN = "unknown"


def _words(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(null_text(text)), F.lit(WORD_RE), F.lit(0))


def _padded(word: Column | str) -> Column:
    return F.concat(F.lit("_"), _c(word), F.lit("_"))


def _grams(padded: str) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(padded) - (GRAM - 1)),
                       lambda i: F.substring(F.col(padded), i, F.lit(GRAM)))


def learn_profiles(labelled: DataFrame, text: str = "cleaned_text", language: str = "language",
                   ) -> DataFrame:
    """(language, gram, weight, missing): scaled log-probabilities of every gram seen.

    Words are counted per language first, so grams are cut from distinct words only. The counts are
    kept: grams, their totals and their number are read from them, not from the texts again.
    """
    counted = (fan_out(labelled.select(language, _words(text).alias("_words")), "_words", "term")
               .groupBy(language, "term").agg(F.count(F.lit(1)).alias("tf")))
    words = checkpointed(counted).withColumn("_w", _padded("term"))
    grams = (words.select(language, "tf", F.explode(_grams("_w")).alias("gram"))
             .groupBy(language, "gram").agg(F.sum("tf").alias("c")))
    totals = grams.groupBy(language).agg(F.sum("c").alias("total"))
    smoothed = F.col("total") + grams.agg(F.count_distinct("gram")).scalar()

    def scaled(p: Column) -> Column:
        return F.round(F.log(p) * SCALE).cast("long")

    # A learnt artefact: written once, read by every scoring.
    return checkpointed(grams.join(totals, language).select(
        F.col(language).alias("language"), "gram",
        scaled((F.col("c") + 1.0) / smoothed).alias("weight"),
        scaled(1.0 / smoothed).alias("missing")))


def frequent_words(df: DataFrame, text: str = "cleaned_text", limit: int = KNOWN_WORDS) -> DataFrame:
    """(word): the most frequent words of a corpus, ties to the smaller; a learnt artefact as well."""
    counted = fan_out(df.select(_words(text).alias("_words")), "_words", "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return checkpointed(counted.orderBy(F.desc("n"), "word").limit(limit).select("word"))


def gram_table(profiles: DataFrame, languages: Sequence[str]) -> DataFrame:
    """(gram, w0, w1, ..): the weight of every gram in each language."""
    def weight_of(i: int, column: str) -> Column:
        return F.max(F.when(F.col("language") == languages[i], F.col(column)))

    every = range(len(languages))
    floor = profiles.agg(F.struct(*[weight_of(i, "missing").alias(f"m{i}") for i in every])
                         .alias("m")).scalar()
    return (profiles.groupBy("gram").agg(*[weight_of(i, "weight").alias(f"w{i}") for i in every])
            .select("gram", *[F.coalesce(f"w{i}", floor[f"m{i}"]).alias(f"w{i}") for i in every]))


class LanguageModel(Transformer, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """The best profile for a text, ties to the first language; ``unknown`` without any known gram."""

    @keyword_only
    def __init__(self, profiles: DataFrame, languages: Sequence[str], words: DataFrame | None = None,
                 inputCol: str = "cleaned_text", outputCol: str = "language"):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.languages, self.profiles, self.words = list(languages), profiles, words
        self._weights = [f"w{i}" for i in range(len(self.languages))]
        self._grams = InlineTable(gram_table(profiles, self.languages), "gram", self._weights, LIMIT)
        self._known = None
        if words is not None and self._grams.size:
            # Sums of the grams of frequent words, by the same expressions as for any other word.
            limit = max(1, min(KNOWN_WORDS, LIMIT // len(self.languages)))
            found = words.select("word").limit(limit).select("word", self._gram_places(F.array("word")).alias("_at")).filter(F.size("_at") > 0)
            sums = found.select("word", *[self._total(F.col("_at"), self._grams, w).alias(w) for w in self._weights])
            self._known = InlineTable(sums, "word", self._weights, limit)

    def _gram_places(self, some: Column) -> Column:
        """Places of the known grams of an array of words."""
        def places(word: Column) -> Column:
            return F.transform(F.sequence(F.lit(1), F.length(word) - (GRAM - 1)),
                               lambda i: self._grams.find(F.substring(word, i, F.lit(GRAM))))

        return F.filter(F.flatten(F.transform(F.transform(some, _padded), places)), F.isnotnull)

    @staticmethod
    def _total(places: Column, table: InlineTable, weight: str) -> Column:
        return F.aggregate(places, F.lit(0).cast("long"), lambda s, p: s + table.value(p, weight))

    def detect(self, text: Column | str) -> Column:
        """The language of a text, from its row alone."""
        def best(grams: Column, known: Column | None = None) -> Column:
            sums = F.array(*[self._total(grams, self._grams, w) + (
                0 if known is None else self._total(known, self._known, w)) for w in self._weights])
            first = bound(sums, lambda s: F.array_position(s, F.array_max(s))).cast("int")
            found = F.size(grams) > 0 if known is None else F.size(grams) + F.size(known) > 0
            return F.when(found, F.get(F.array(*map(F.lit, self.languages)), first - 1)).otherwise(F.lit(UNKNOWN))

        def looked_up(words: Column, places: Column) -> Column:
            rare = F.filter(words, lambda w, i: F.get(places, i).isNull())
            return bound(self._gram_places(rare), lambda grams: bound(F.filter(places, F.isnotnull), lambda known: best(grams, known)))

        if not self._grams.size:
            return F.lit(UNKNOWN)
        if self._known is None or not self._known.size:
            return bound(self._gram_places(_words(text)), lambda grams: best(grams))
        return bound(_words(text), lambda words: bound(F.transform(words, self._known.find), lambda places: looked_up(words, places)))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), self.detect(F.col(self.getInputCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: LanguageModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.model.profiles.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={
            "languages": self.model.languages, "words": self.model.words is not None})
        self.model.profiles.write.parquet(f"{path}/profiles")
        if self.model.words is not None:
            self.model.words.write.parquet(f"{path}/words")


class _Reader(MLReader):
    def load(self, path: str) -> LanguageModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        words = spark.read.parquet(f"{path}/words") if metadata["words"] else None
        model = LanguageModel(profiles=spark.read.parquet(f"{path}/profiles"), languages=metadata["languages"], words=words)
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        return model


def identify_language(df: DataFrame, id_col: str, text: str, profiles: DataFrame,
                      languages: Sequence[str], name: str = "language") -> DataFrame:
    """(id, language): the best profile; ``unknown`` without any known gram.

    For profiles too large for a ``LanguageModel``. The table has one row per gram with a weight per
    language; it is broadcast if its counted rows are few, else joined by shuffle. Every document
    sums its grams before they are shuffled by id.
    """
    every, table = range(len(languages)), gram_table(profiles, languages)
    if profiles.count() <= BROADCAST_GRAMS:  # profiles are written, so this reads their size
        table = F.broadcast(table)
    # Outer fan-out keeps documents without a word, so no second join is needed.
    grams = (df.select(id_col, F.inline_outer(term_counts(_words(text))))
             .select(id_col, "tf", _padded("term").alias("_w"))
             .select(id_col, "tf", F.explode_outer(_grams("_w")).alias("gram")))
    summed = grams.join(table, "gram", "left").groupBy(id_col).agg(*[
        F.sum(F.col("tf") * F.col(f"w{i}")).alias(f"s{i}") for i in every])
    best = F.array_max(F.array(*[
        F.struct(F.col(f"s{i}").alias("s"), F.lit(-i).alias("o"), F.lit(x).alias("l"))
        for i, x in enumerate(languages)]))
    return summed.select(id_col, F.when(F.col("s0").isNotNull(), best["l"])
                         .otherwise(F.lit(UNKNOWN)).alias(name))
