"""TF-IDF over course texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, StopWordsRemover
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.vectors import most_similar, shared_profiles, to_members
from cohortlens.session import reliable_checkpoint

WORD = r"(?U)\b\w\w+\b"


def terms(text: Column, stop_words: Sequence[str]) -> Column:
    """Words of two letters or more without stop words, and their pairs."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    kept = F.filter(words, lambda w: ~w.isin(list(stop_words)))
    n = F.size(kept)
    pairs = F.when(
        n > 1,
        F.zip_with(F.slice(kept, 1, n - 1), F.slice(kept, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b)),
    ).otherwise(F.array().cast("array<string>"))
    return F.concat(kept, pairs)


def term_statistics(docs: DataFrame, stop_words: Sequence[str]) -> DataFrame:
    """(term, df, total) of documents (id, text), with one shuffle of partial counts.

    Each text's terms are sorted inside its row, so that the first of equal terms
    counts for the document frequency.
    """
    listed = docs.select(F.array_sort(terms(F.col("text"), stop_words)).alias("t"))
    rows = listed.select("t", F.posexplode("t").alias("at", "term"))
    first = (F.col("at") == 0) | (F.try_element_at("t", F.col("at")) != F.col("term"))
    return rows.select("term", first.cast("int").alias("first")).groupBy("term").agg(
        F.sum("first").alias("df"), F.count("*").alias("total")
    )


class TfIdf:
    """Vocabulary with smooth idf, learned on one set of texts.

    The vocabulary holds at most ``max_features`` terms, the most frequent of those
    in at least ``min_df`` texts and at most the share ``max_df``. Texts are turned
    into vectors row by row, without a shuffle.
    """

    def __init__(
        self,
        docs: DataFrame,
        max_features: int = 5000,
        min_df: int = 2,
        max_df: float = 0.95,
        stop_words: Sequence[str] | None = None,
    ):
        self.stop_words = stop_words or StopWordsRemover.loadDefaultStopWords("english")
        n = docs.count()
        stats = term_statistics(docs, self.stop_words)
        known = stats.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n))
        idf = F.ln((1 + F.lit(n)) / (1 + F.col("df"))) + 1
        # at most max_features rows
        top = known.orderBy(F.desc("total"), "term").limit(max_features).select("term", idf.alias("idf")).collect()
        if not top:
            raise ValueError("no term is frequent enough for the vocabulary")
        self.vocabulary = [r["term"] for r in top]
        self.dims = len(top)
        counter = CountVectorizerModel.from_vocabulary(self.vocabulary, inputCol="_terms", outputCol="_tf")
        weigher = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in top]), inputCol="_tf", outputCol="_tfidf")
        self.steps = [counter, weigher, Normalizer(p=2.0, inputCol="_tfidf", outputCol="_unit")]

    def vectors(self, docs: DataFrame) -> DataFrame:
        """(id, vector) as sparse ``struct<i, v>`` of unit length; a text without known terms is empty."""
        out = docs.select("id", terms(F.col("text"), self.stop_words).alias("_terms"))
        for step in self.steps:
            out = step.transform(out)
        raw = F.unwrap_udt("_unit")
        vector = F.struct(raw["indices"].alias("i"), raw["values"].alias("v"))
        return out.select("id", vector.alias("vector"))

    def weights(self, docs: DataFrame) -> DataFrame:
        """(id, term, weight) of the known terms."""
        cells = F.explode(F.arrays_zip("vector.i", "vector.v")).alias("cell")
        names = F.array(*[F.lit(t) for t in self.vocabulary])
        rows = self.vectors(docs).select("id", cells)
        return rows.select("id", F.element_at(names, F.col("cell.i") + 1).alias("term"), F.col("cell.v").alias("weight"))

    def most_similar(self, people: DataFrame, courses: DataFrame, k: int) -> DataFrame:
        """The ``k`` courses of nearest text for every student; both are (id, text).

        Students of equal text share one query.
        """
        profiles, members = shared_profiles(people, "text")
        queries = reliable_checkpoint(self.vectors(profiles))
        items = reliable_checkpoint(self.vectors(courses))
        return to_members(most_similar(queries, items, k, dims=self.dims), members)
