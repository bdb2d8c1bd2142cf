"""Chi-squared selection inside each fold, and count vectors of the selected terms."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmine.config import COUNT_TEXT, TextSettings
from newsmine.operators.bow import best_terms, chi2_score, df_bounds, documents_in, found_terms
from newsmine.operators.counting import Reading, chosen_counts
from newsmine.operators.svm import label_index
from newsmine.session import written


def fold_class_sizes(docs: DataFrame) -> dict[int, dict[str, int]]:
    """Documents per fold and class (a handful of rows)."""
    rows = docs.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    classes = sorted({r["label"] for r in rows})
    sizes = {f: dict.fromkeys(classes, 0) for f in sorted({r["fold"] for r in rows})}
    for r in rows:
        sizes[r["fold"]][r["label"]] = r["n"]
    return sizes


def select_per_fold(
    tf: DataFrame,
    sizes: dict[int, dict[str, int]],
    k: int,
    settings: TextSettings = COUNT_TEXT,
    fit_scope: str = "corpus",
) -> tuple[dict[int | None, list[str]], int]:
    """Selected terms when each fold is held out (``None``: all rows), and vocabulary size.

    The corpus is counted once, per fold, term and class; the training sums of a
    held-out fold are the total minus that fold's own. ``fit_scope`` says whether
    document frequency is bounded on all rows or on the training rows.
    """
    folds = list(sizes)
    classes = list(next(iter(sizes.values())))
    measures = ["df", *[f"o{i}" for i in range(len(classes))]]
    # Grouped counts are few rows a term already: they meet by term as they are.
    rows = tf.select("term", "fold", label_index(classes).alias("y"), "n", documents_in(tf).alias("df"))
    rows = rows.repartition("term") if "df" in tf.columns else rows
    own = []
    for f in folds:
        own.append(F.sum(F.when(F.col("fold") == f, F.col("df")).otherwise(0)).alias(f"df_{f}"))
        for i in range(len(classes)):
            own.append(F.sum(F.when((F.col("fold") == f) & (F.col("y") == i), F.col("n")).otherwise(0)).alias(f"o{i}_{f}"))
    total = [sum((F.col(f"{m}_{f}") for f in folds[1:]), F.col(f"{m}_{folds[0]}")).alias(m) for m in measures]
    n_docs = sum(sum(c.values()) for c in sizes.values())
    sums = rows.groupBy("term").agg(*own).select("*", *total)
    if fit_scope == "corpus":
        sums = sums.where(df_bounds(n_docs, settings))
    sums = written(sums, "sums")
    n_terms = sums.where(df_bounds(n_docs, settings)).count()

    ranked = None
    for held in [None, *folds]:
        left = {c: sum(s[c] for f, s in sizes.items() if f != held) for c in classes}
        n_left = sum(left.values())
        rest = sums.select(
            "term",
            *[(F.col(m) - F.col(f"{m}_{held}")).alias(m) if held is not None else F.col(m) for m in measures],
        )
        if fit_scope == "fold":
            rest = rest.where(df_bounds(n_left, settings))
        present = [i for i, c in enumerate(classes) if left[c]]
        kept = rest.select("term", *[F.col(f"o{i}").alias(f"o{at}") for at, i in enumerate(present)])
        used = sum((F.col(f"o{at}") for at in range(1, len(present))), F.col("o0"))
        score = F.round(chi2_score([left[classes[i]] / n_left for i in present]), 6)
        # Every task keeps its best k, so no fold's whole vocabulary is sorted in one place.
        best = best_terms(kept.where(used > 0).select("term", score.alias("score")), k)
        part = best.select(F.lit(-1 if held is None else held).alias("held"), "term")
        ranked = part if ranked is None else ranked.unionByName(part)
    chosen: dict[int | None, list[str]] = {h: [] for h in [None, *folds]}
    for row in ranked.collect():  # at most k rows per fold
        chosen[None if row["held"] < 0 else row["held"]].append(row["term"])
    return {h: sorted(t) for h, t in chosen.items()}, n_terms


def count_vectors(
    bags: DataFrame,
    chosen: dict[int | None, list[str]],
    keep: Sequence[str] = ("doc_id",),
    reading: Reading | None = None,
) -> tuple[DataFrame, dict[int | None, list[int]], list[str]]:
    """Sparse counts (keep…, idx, val) over all selected terms, and each held-out fold's columns.

    Counts are looked up row by row, without a shuffle; there are k terms per fold.
    With ``reading``, ``bags`` are ``words`` that have not been counted yet.
    """
    words = sorted({t for terms in chosen.values() for t in terms})
    position = {t: i for i, t in enumerate(words)}
    rows = chosen_counts(bags, reading, keep, words) if reading else found_terms(bags, keep, pa.array(words, pa.string()))
    rows = rows.select(*keep, "idx", F.col("n").cast("array<double>").alias("val"))
    columns = {held: [position[t] for t in terms] for held, terms in chosen.items()}
    return rows, columns, words
