"""The three train-and-evaluate jobs, their metrics records and bundles."""

from __future__ import annotations

import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import COUNT_TEXT, TFIDF_TEXT, ModelSettings, TextSettings
from newsmine.operators import embedding as M
from newsmine.operators import evaluate as V
from newsmine.operators import lsa as L
from newsmine.operators.bow import bags_of, with_terms
from newsmine.operators.counting import summed, with_words
from newsmine.operators.folds import class_bounds
from newsmine.operators.selection import count_vectors, fold_class_sizes, select_per_fold
from newsmine.operators.svm import LinearSvm, SvmTrainer, class_scores
from newsmine.session import cut, written

METRICS_SCHEMA = (
    "clasificador string, features_method string, n_folds int, n_docs long, n_features_orig long, "
    "n_features_sel long, clases array<string>, accuracy_folds array<double>, accuracy_mean double, "
    "accuracy_std double, auc_por_clase map<string,double>, confusion_matrix array<array<long>>, "
    "elapsed_s double, lsa_components int, lsa_var_explained double, embedding_model string"
)


@dataclass
class Experiment:
    """Held-out predictions and their metrics (if evaluated), the model of all rows (if asked for)."""

    predictions: DataFrame | None
    metrics: DataFrame | None
    model: LinearSvm | None = None
    terms: list[str] | None = None
    lsa: L.LsaModel | None = None
    # How its texts became words, so that a bundle can score raw texts alike.
    stopwords: tuple[str, ...] = ()
    text: TextSettings = TextSettings()


def metrics_record(
    predictions: DataFrame,
    classes: Sequence[str],
    name: str,
    method: str,
    n_folds: int,
    n_orig: int,
    n_sel: int,
    started: float,
    **extra,
) -> DataFrame:
    """One row in the fixed report format; only per-fold and per-class numbers are collected."""
    accuracy = {r["fold"]: r["accuracy"] for r in V.accuracy_by_fold(predictions).collect()}
    aucs = {r["class"]: r["auc"] for r in V.auc_mean(V.auc_ovr(class_scores(predictions))).collect()}
    cells = {(r["label"], r["pred"]): r["n"] for r in V.confusion(predictions).collect()}
    k = range(len(classes))
    values = [accuracy[f] for f in sorted(accuracy)]
    mean = sum(values) / len(values)
    spread = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    row = {
        "clasificador": name,
        "features_method": method,
        "n_folds": n_folds,
        "n_docs": sum(cells.values()),
        "n_features_orig": n_orig,
        "n_features_sel": n_sel,
        "clases": list(classes),
        "accuracy_folds": [round(v, 4) for v in values],
        "accuracy_mean": round(mean, 4),
        "accuracy_std": round(spread, 4),
        "auc_por_clase": {classes[i]: aucs.get(i, 0.0) for i in k},
        "confusion_matrix": [[cells.get((i, j), 0) for j in k] for i in k],
        "elapsed_s": round(time.time() - started, 1),
        "lsa_components": None,
        "lsa_var_explained": None,
        "embedding_model": None,
    }
    row.update(extra)
    return predictions.sparkSession.createDataFrame([tuple(row.values())], METRICS_SCHEMA)


def labelled(docs: DataFrame) -> DataFrame:
    """The rows that can be learned from; ``unlabelled`` are the others."""
    return docs.where(F.col("label").isNotNull())


def unlabelled(docs: DataFrame) -> DataFrame:
    """(doc_id) of rows without a label: no training job reads them, saved bundles can score them."""
    return docs.where(F.col("label").isNull()).select("doc_id")


def with_folds(docs: DataFrame, settings: ModelSettings) -> DataFrame:
    """Labelled documents with their ``fold``, computed in the row: nothing is joined or shuffled."""
    folds = class_bounds(labelled(docs).select("doc_id", "label"), settings.n_folds, settings.seed)
    return labelled(docs).withColumn("fold", folds.of(F.col("doc_id"), F.col("label")))


def _run(trainer: SvmTrainer, evaluate: bool, final: bool):
    try:
        return trainer.run(evaluate, final)
    finally:
        trainer.close()


def bow_experiment(
    docs: DataFrame,
    stopwords: Iterable[str] = (),
    settings: ModelSettings = ModelSettings(),
    text: TextSettings = COUNT_TEXT,
    evaluate: bool = True,
    final: bool = False,
) -> Experiment:
    """Counts of words and pairs, the best k by chi-squared inside each fold, linear SVM."""
    started = time.time()
    stopwords = tuple(stopwords)
    keep = ("doc_id", "label", "fold")
    # The texts are analysed once; what follows reads their words.
    read, reading = with_words(with_folds(docs, settings).select(*keep, "text"), stopwords, text)
    read = written(read, "words")
    sizes = fold_class_sizes(read.select("fold", "label"))
    classes = list(next(iter(sizes.values())))
    tf = summed(read, reading, ("fold", "label"))
    chosen, n_terms = select_per_fold(tf, sizes, settings.k_terms, text, settings.fit_scope)
    rows, columns, words = count_vectors(read, chosen, keep, reading)
    predictions, model = _run(SvmTrainer(cut(rows), classes, len(words), settings, columns), evaluate, final)
    metrics = None
    if predictions is not None:
        metrics = metrics_record(
            predictions, classes, "SVM (kernel lineal)", f"chi2 (k={settings.k_terms})",
            settings.n_folds, n_terms, settings.k_terms, started,
        )
    return Experiment(predictions, metrics, model, terms=words, stopwords=stopwords, text=text)


def lsa_experiment(
    docs: DataFrame,
    stopwords: Iterable[str] = (),
    settings: ModelSettings = ModelSettings(),
    text: TextSettings = TFIDF_TEXT,
    evaluate: bool = True,
    final: bool = False,
) -> Experiment:
    """TF-IDF, truncated SVD with unit rows, linear SVM.

    With ``fit_scope="fold"`` vocabulary, weights and SVD of a fold come from its
    training rows only; the model of all rows is the same in both scopes.
    """
    started = time.time()
    stopwords = tuple(stopwords)
    folded = with_folds(docs, settings)
    termed = with_terms(folded, stopwords, text).select("doc_id", "fold", "terms")
    narrow = folded.select("doc_id", "label", "fold")
    dims = settings.n_components
    classes = _classes(narrow)
    if settings.fit_scope == "fold" and evaluate:
        fit = L.fit_lsa(termed, dims, text, seed=settings.seed, folds=range(settings.n_folds))
        rows, columns = _fold_vectors(narrow, fit, dims)
        predictions, _ = _run(SvmTrainer(cut(rows), classes, dims * len(columns), settings, columns), True, False)
        last = None
        if final:
            last = lsa_experiment(docs, stopwords, replace(settings, fit_scope="corpus"), text, evaluate=False, final=True)
        n_terms, share = fit.models[0].n_terms, None
        machine, model = (last.model, last.lsa) if last else (None, None)
    else:
        fit = L.fit_lsa(termed.drop("fold"), dims, text, seed=settings.seed)
        model = fit.models[None]
        vectors = cut(L.lsa_vectors(narrow, model, fit.rows))
        share = round(L.explained_variance(vectors, model, fit.rows), 4)
        rows = cut(vectors.select("doc_id", "label", "fold", F.col("vec").alias("val")))
        predictions, machine = _run(SvmTrainer(rows, classes, dims, settings), evaluate, final)
        n_terms = model.n_terms
    metrics = None
    if predictions is not None:
        metrics = metrics_record(
            predictions, classes, "TF-IDF + LSA + SVM (kernel lineal)",
            f"TF-IDF → SVD ({dims} dims) — LSA",
            settings.n_folds, n_terms, dims, started,
            lsa_components=dims, lsa_var_explained=share,
        )
    return Experiment(predictions, metrics, machine, lsa=model, stopwords=stopwords, text=text)


def _fold_vectors(narrow: DataFrame, fit: L.Fit, dims: int) -> tuple[DataFrame, dict[int | None, list[int]]]:
    """``narrow`` with the unit vectors of all folds' models side by side, and each fold's columns."""
    placed = None
    for held, model in fit.models.items():
        own = L.project(model, fit.rows).select("doc_id", L.unit(F.col("vec")).alias(f"v{held}"))
        placed = cut(own) if placed is None else placed.join(cut(own), "doc_id")
    zeros = F.array_repeat(F.lit(0.0), dims)
    val = F.concat(*[F.coalesce(f"v{held}", zeros) for held in fit.models]).alias("val")
    columns = {held: list(range(n * dims, (n + 1) * dims)) for n, held in enumerate(fit.models)}
    return narrow.join(placed, "doc_id", "left").select("doc_id", "label", "fold", val), columns


def embedding_experiment(
    docs: DataFrame,
    vectors: DataFrame,
    stopwords: Iterable[str] = (),
    settings: ModelSettings = ModelSettings(),
    vectors_name: str = "word vectors",
    evaluate: bool = True,
    final: bool = False,
) -> Experiment:
    """Mean word vector per document, linear SVM."""
    started = time.time()
    size = M.vector_size(vectors)
    stopwords = tuple(stopwords)
    keep = ("doc_id", "label", "fold")
    bags = M.word_bags(with_folds(docs, settings), stopwords, keep=keep)
    rows = cut(M.document_vectors(bags, vectors, size, keep).select(*keep, F.col("vec").alias("val")))
    classes = _classes(rows)
    predictions, machine = _run(SvmTrainer(rows, classes, size, settings), evaluate, final)
    metrics = None
    if predictions is not None:
        metrics = metrics_record(
            predictions, classes, "Word2Vec + SVM (kernel lineal)", f"MeanEmbeddingVectorizer ({size} dims)",
            settings.n_folds, size, size, started, embedding_model=vectors_name,
        )
    return Experiment(predictions, metrics, machine, stopwords=stopwords)


def _classes(rows: DataFrame) -> list[str]:
    """Distinct labels in alphabetical order (one small row)."""
    return list(rows.agg(F.array_sort(F.collect_set("label"))).first()[0])


# ── bundles ───────────────────────────────────────────────────────────────────


_TEXT_SCHEMA = "token_pattern string, ngram_min int, ngram_max int, min_df int, max_df double, stopwords array<string>"


def _save_text(experiment: Experiment, path: str, spark: SparkSession) -> None:
    t = experiment.text
    row = (t.token_pattern, *t.ngram_range, t.min_df, t.max_df, list(experiment.stopwords))
    spark.createDataFrame([row], _TEXT_SCHEMA).write.mode("overwrite").parquet(f"{path}/text")


def _load_text(path: str, spark: SparkSession) -> tuple[tuple[str, ...], TextSettings]:
    row = spark.read.parquet(f"{path}/text").first()
    text = TextSettings(row["token_pattern"], (row["ngram_min"], row["ngram_max"]), row["min_df"], row["max_df"])
    return tuple(row["stopwords"]), text


def save_bow_bundle(experiment: Experiment, path: str, spark: SparkSession) -> None:
    """Machines, sigmoids, classes, selected terms and text settings, so raw text can be scored."""
    experiment.model.save(path, spark)
    _save_text(experiment, path, spark)
    terms = list(enumerate(experiment.terms))
    spark.createDataFrame(terms, "idx int, term string").write.mode("overwrite").parquet(f"{path}/terms")


def score_bow_bundle(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, predicted label, probs) of raw documents with a saved bundle."""
    spark = docs.sparkSession
    model = LinearSvm.load(path, spark)
    stopwords, text = _load_text(path, spark)
    terms = [r["term"] for r in spark.read.parquet(f"{path}/terms").orderBy("idx").collect()]
    words, reading = with_words(docs.select("doc_id", "text"), stopwords, text)
    rows, _, _ = count_vectors(words, {None: terms}, reading=reading)
    return _labelled(model, rows)


def _labelled(model: LinearSvm, rows: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(c) for c in model.classes])
    return model.transform(rows).select("doc_id", F.get(names, F.col("pred")).alias("label"), "probs")


def save_lsa_bundle(experiment: Experiment, path: str, spark: SparkSession) -> None:
    experiment.model.save(path, spark)
    _save_text(experiment, path, spark)
    experiment.lsa.terms.write.mode("overwrite").parquet(f"{path}/terms")
    experiment.lsa.components.write.mode("overwrite").parquet(f"{path}/components")


def score_lsa_bundle(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    model = LinearSvm.load(path, spark)
    stopwords, text = _load_text(path, spark)
    terms = spark.read.parquet(f"{path}/terms")
    components = spark.read.parquet(f"{path}/components")
    dims = components.select(F.size("vec")).first()[0]
    lsa = L.LsaModel(terms, components, terms.count(), dims)
    rows = L.counted_rows(bags_of(with_terms(docs, stopwords, text)), terms)
    placed = L.lsa_vectors(docs.select("doc_id"), lsa, rows)
    rows = placed.select("doc_id", F.col("vec").alias("val"))
    return _labelled(model, rows)


def save_embedding_bundle(experiment: Experiment, path: str, vectors: DataFrame, spark: SparkSession) -> None:
    """Machines, sigmoids, classes, stop-words and the word vectors."""
    experiment.model.save(path, spark)
    _save_text(experiment, path, spark)
    vectors.select("word", "vec").write.mode("overwrite").parquet(f"{path}/vectors")


def score_embedding_bundle(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    model = LinearSvm.load(path, spark)
    stopwords, _ = _load_text(path, spark)
    vectors = spark.read.parquet(f"{path}/vectors")
    placed = M.document_vectors(M.word_bags(docs, stopwords), vectors)
    rows = placed.select("doc_id", F.col("vec").alias("val"))
    return _labelled(model, rows)
