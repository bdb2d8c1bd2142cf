"""TF-IDF weights with unit rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmine.config import TFIDF_TEXT, TextSettings
from newsmine.operators.bow import pruned_terms, term_counts


def idf_table(terms: DataFrame, n_docs: int) -> DataFrame:
    """Smoothed inverse document frequency plus one."""
    ratio = F.lit(1.0 + n_docs) / (F.lit(1.0) + F.col("df"))
    return terms.withColumn("idf", F.log(ratio) + F.lit(1.0))


def weigh(tf: DataFrame, idf: DataFrame, normalise: bool = True) -> DataFrame:
    """(doc_id, term, w); terms outside ``idf`` drop, rows get unit length.

    The norm is a window over one document's own terms, so no group is bigger
    than a document; documents without known terms have no rows.
    """
    weights = tf.join(idf.select("term", "idf"), "term").select(
        "doc_id", "term", (F.col("n") * F.col("idf")).alias("w")
    )
    if not normalise:
        return weights
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy("doc_id")))
    return weights.withColumn("w", F.col("w") / norm)


def norms(weights: DataFrame) -> DataFrame:
    return weights.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def tfidf(
    docs: DataFrame, settings: TextSettings = TFIDF_TEXT, normalise: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(weights, idf table) of documents that carry ``terms``."""
    n_docs = docs.count()
    tf = term_counts(docs)
    idf = idf_table(pruned_terms(tf, n_docs, settings), n_docs)
    return weigh(tf, idf, normalise), idf
