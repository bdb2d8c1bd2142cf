"""Bag of words: counts, document frequency, vocabulary, class-wise selection."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmine.config import COUNT_TEXT, TextSettings
from newsmine.functions.text import analyse, bag
from newsmine.operators.ordering import running_by_range
from newsmine.session import cut

#: Largest vocabulary that is sent to every task.
LOOKUP_BYTES = 256 * 1024 * 1024

def with_terms(
    docs: DataFrame,
    stopwords: Iterable[str] = (),
    settings: TextSettings = COUNT_TEXT,
    tokenizer: Callable[[Column], Column] | None = None,
    out: str = "terms",
) -> DataFrame:
    """Replace ``text`` by its array of terms."""
    terms = analyse(
        F.col("text"), stopwords, settings.ngram_range, settings.token_pattern, tokenizer
    )
    return docs.withColumn(out, terms).drop("text")


def term_counts(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep…, term, n) from ``terms``; no shuffle."""
    return docs.select(*keep, F.inline(bag(F.col("terms"))))


def bags_of(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep…, bag): each document's distinct terms with their counts, from ``terms``."""
    return docs.select(*keep, bag(F.col("terms")).alias("bag"))


def found_terms(bags: DataFrame, keep: Sequence[str], words: pa.Array) -> DataFrame:
    """(keep…, idx, n): positions and counts of the terms that are in ``words``, looked up inside the task.

    ``words`` goes to every task: callers check its size.
    """
    shared = bags.sparkSession.sparkContext.broadcast(words)
    kept = bags.select(*keep)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema) + "idx array<long>, n array<long>"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(len(keep))
            sizes = listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            cells = listed.flatten()
            at = pc.index_in(cells.field("term"), value_set=shared.value)
            known = at.is_valid().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(sizes)), sizes)[known]
            idx = at.drop_null().to_numpy().astype(np.int64)
            n = cells.field("n").to_numpy()[known]
            order = np.lexsort([idx, row])
            bounds = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(sizes)))]), pa.int32())
            lists = [pa.ListArray.from_arrays(bounds, pa.array(v[order])) for v in (idx, n)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(len(keep))], *lists], names=[*keep, "idx", "n"])

    return bags.select(*keep, "bag").mapInArrow(find, schema)


def other_terms(bags: DataFrame, words: pa.Array, key: str = "_row") -> DataFrame:
    """(key, term, n): the cells whose term is not in ``words``, which goes to every task."""
    shared = bags.sparkSession.sparkContext.broadcast(words)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column("bag")
            cells = listed.flatten()
            other = pc.index_in(cells.field("term"), value_set=shared.value).is_null()
            row = np.repeat(batch.column(key).to_numpy(), listed.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            found = pa.RecordBatch.from_arrays([pa.array(row), cells.field("term"), cells.field("n")], names=[key, "term", "n"])
            yield found.filter(other)

    return bags.select(key, "bag").mapInArrow(find, f"{key} long, term string, n long")


def bag_positions(bags: DataFrame, terms: DataFrame, keep: Sequence[str] = ("doc_id",), limit: int = LOOKUP_BYTES) -> DataFrame:
    """(keep…, idx, n): the cells of each document by vocabulary position (``idx`` counts from 0 in ``terms``).

    A vocabulary of at most ``limit`` bytes is looked up inside the tasks. A larger
    one is joined, and each document's cells are gathered again.
    """
    size = terms.agg(F.sum(F.octet_length("term") + 8)).first()[0] or 0
    if size <= limit:
        words = terms.select("idx", "term").toArrow().sort_by("idx").column("term").combine_chunks()
        return found_terms(bags, keep, words)
    cells = bags.select(*keep, F.inline("bag")).join(terms.select("term", "idx"), "term")
    gathered = cells.groupBy(*keep).agg(F.array_sort(F.collect_list(F.struct("idx", "n"))).alias("cells"))
    return gathered.select(*keep, F.col("cells.idx").alias("idx"), F.col("cells.n").alias("n"))


def df_bounds(n_docs: int, settings: TextSettings, df: Column | None = None) -> Column:
    """Both bounds are inclusive; the upper one is a share of all documents."""
    df = F.col("df") if df is None else df
    return (df >= settings.min_df) & (df <= settings.max_df * n_docs)


def documents_in(tf: DataFrame) -> Column:
    """Documents that a row stands for: grouped counts say it, others stand for one."""
    return F.col("df") if "df" in tf.columns else F.lit(1).cast("long")


def document_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.sum(documents_in(tf)).alias("df"))


def pruned_terms(tf: DataFrame, n_docs: int, settings: TextSettings = COUNT_TEXT) -> DataFrame:
    """(term, df) inside the document-frequency bounds."""
    return document_frequency(tf).where(df_bounds(n_docs, settings))


def vocabulary(terms: DataFrame) -> DataFrame:
    """Number the terms alphabetically from 0, by ranges of whole terms."""
    terms = cut(terms)  # read twice: for bounds, then for the rows
    return running_by_range(terms, ["term"], {"idx": F.lit(1).cast("long")}, inclusive=False)


def require_terms(terms: DataFrame) -> DataFrame:
    """Fail clearly when pruning leaves nothing."""
    if terms.isEmpty():
        raise ValueError("no terms remain; lower min_df or raise max_df")
    return terms


def restrict(tf: DataFrame, terms: DataFrame) -> DataFrame:
    """Keep the counts of known terms; unseen terms drop."""
    return tf.join(terms.select("term"), "term", "left_semi")


def shape(terms: DataFrame, n_docs: int) -> DataFrame:
    """(n_docs, n_terms, nnz, density) of the pruned matrix, from its (term, df)."""
    sizes = terms.agg(
        F.count(F.lit(1)).alias("n_terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("nnz")
    )
    return sizes.select(
        F.lit(n_docs).cast("long").alias("n_docs"),
        "n_terms",
        "nnz",
        (F.col("nnz") / (F.col("n_terms") * F.lit(float(n_docs)))).alias("density"),
    )


# ── chi-squared ───────────────────────────────────────────────────────────────


def class_sizes(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return docs.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n_docs"))


def _observed(classes: Sequence[str]) -> list[Column]:
    return [
        F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"o{i}")
        for i, c in enumerate(classes)
    ]


def class_term_sums(tf: DataFrame, classes: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per term: document frequency and one total per class."""
    return tf.groupBy(*keys, "term").agg(F.sum(documents_in(tf)).alias("df"), *_observed(classes))


def chi2_score(shares: Sequence[float]) -> Column:
    """Sum over all classes of (observed - expected)² / expected."""
    total = sum((F.col(f"o{i}") for i in range(1, len(shares))), F.col("o0"))
    parts = []
    for i, share in enumerate(shares):
        expected = F.lit(share) * total
        gap = F.col(f"o{i}") - expected
        parts.append(gap * gap / expected)
    return sum(parts[1:], parts[0])


def chi2_scores(sums: DataFrame, sizes: dict[str, int]) -> DataFrame:
    """(term, df, score); ``sizes`` maps each class, in column order, to its documents."""
    n_docs = sum(sizes.values())
    shares = [n / n_docs for n in sizes.values()]
    return sums.select("term", "df", F.round(chi2_score(shares), 6).alias("score"))


def best_terms(scores: DataFrame, k: int) -> DataFrame:
    """Top k by score; among equal scores the alphabetically later term wins."""
    return scores.orderBy(F.desc("score"), F.desc("term")).limit(k)


def ranked_best_terms(scores: DataFrame, k: int) -> DataFrame:
    """Top k with its rank; the window only sees the k rows that are left."""
    order = W.orderBy(F.desc("score"), F.desc("term"))
    best = best_terms(scores, k)
    return best.withColumn("rank", F.row_number().over(order).cast("long"))


def sizes_by_class(docs: DataFrame) -> dict[str, int]:
    """Documents per class, classes in alphabetical order (a handful of rows)."""
    rows = class_sizes(docs).orderBy("label").collect()
    return {r["label"]: r["n_docs"] for r in rows}
