"""Embeddings, folds, evaluation, classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import TFIDF_TEXT, ModelSettings
from newsmine.functions import text as T
from newsmine.functions.stem import stemmed_counts
from newsmine.functions.stopwords import spanish_stopwords
from newsmine.operators import bow as B
from newsmine.operators import embedding as M
from newsmine.operators import evaluate as V
from newsmine.operators import experiments as P
from newsmine.operators import folds as D
from newsmine.operators import lsa as L
from newsmine.operators import sinks as K
from newsmine.operators import svm as M2
from newsmine.operators.counting import grouped_counts
from newsmine.operators.selection import fold_class_sizes, select_per_fold
from newsmine.plans import fixtures as X
from newsmine.plans.registry import query
from newsmine.plans.text_queries import _COUNTS, _TFIDF
from newsmine.session import cut, table, work_path
from newsmine.sources.words import read_vectors

STOP = spanish_stopwords()
_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"

# ── mean embedding ────────────────────────────────────────────────────────────

_WORD_TABLE = f"""
WITH raw AS (
  SELECT doc_id, lower(unnest(regexp_extract_all(text, '{T.TOKEN_PATTERN}'))) AS word FROM documents),
counts AS (SELECT doc_id, word, count(*) AS n FROM raw WHERE word NOT IN {_STOP_SQL} GROUP BY ALL),
numbered AS (
  SELECT word, row_number() OVER (ORDER BY word) - 1 AS idx FROM (SELECT DISTINCT word FROM counts)),
vectors AS (
  SELECT word, embedding AS vec FROM numbered JOIN embeddings
  ON vec_id = idx % (SELECT count(*) FROM embeddings) WHERE idx % 5 <> 0)
"""


def _bags(spark: SparkSession, sf: str) -> DataFrame:
    return M.word_bags(X.labelled(spark, sf), STOP)


def _word_vectors(spark: SparkSession, sf: str, bags: DataFrame) -> tuple[DataFrame, int]:
    """Every word of the corpus but each fifth gets one of the given vectors."""
    given = table(spark, sf, "embeddings")
    n_given = given.count()
    words = B.vocabulary(M.word_counts(bags).select(F.col("word").alias("term")).distinct())
    keyed = words.where(F.col("idx") % 5 != 0).select(
        F.col("term").alias("word"), (F.col("idx") % n_given).alias("vec_id")
    )
    named = keyed.join(given, "vec_id").select("word", F.col("embedding").alias("vec"))
    return cut(named), given.select(F.size("embedding")).first()[0]


_MEANS = (
    _WORD_TABLE
    + """, parts AS (
  SELECT doc_id, n, CAST(unnest(range(0, len(vec))) AS INTEGER) AS pos, unnest(vec)::DOUBLE AS v FROM counts JOIN vectors USING (word)),
means AS (SELECT doc_id, pos, sum(n * v) / sum(n) AS v FROM parts GROUP BY ALL)
SELECT d.doc_id, p.pos, CASE WHEN round(m.v, 6) <> 0 THEN round(m.v, 6) ELSE 0 END AS value FROM documents d
CROSS JOIN (SELECT CAST(unnest(range(0, 64)) AS INTEGER) AS pos) p LEFT JOIN means m ON m.doc_id = d.doc_id AND m.pos = p.pos"""
)


@query("mean_embedding", _MEANS)
def mean_embedding(spark: SparkSession, sf: str) -> DataFrame:
    bags = _bags(spark, sf)
    vectors, size = _word_vectors(spark, sf, bags)
    vecs = M.document_vectors(bags, vectors, size)
    return vecs.select("doc_id", F.posexplode("vec").alias("pos", "v")).select(
        "doc_id", "pos", F.round("v", 6).alias("value")
    )


@query("transformer_embedding", _MEANS)
def transformer_embedding(spark: SparkSession, sf: str) -> DataFrame:
    """The transformer inside a pipeline that was saved and loaded again."""
    vectors, _ = _word_vectors(spark, sf, _bags(spark, sf))
    path = work_path(spark, "pipeline")
    PipelineModel([M.MeanEmbedding(vectors=vectors, stopwords=STOP)]).save(path)
    placed = PipelineModel.load(path).transform(X.labelled(spark, sf))
    return placed.select("doc_id", F.posexplode("vec").alias("pos", "v")).select(
        "doc_id", "pos", F.round("v", 6).alias("value")
    )


@query(
    "embedding_coverage",
    _WORD_TABLE
    + """, per_doc AS (
  SELECT doc_id, sum(n)::BIGINT AS n_tokens, sum(CASE WHEN v.word IS NULL THEN 0 ELSE n END)::BIGINT AS n_known
  FROM counts c LEFT JOIN vectors v ON c.word = v.word GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_known, 0) AS n_known FROM documents d LEFT JOIN per_doc USING (doc_id)""",
)
def embedding_coverage(spark: SparkSession, sf: str) -> DataFrame:
    bags = _bags(spark, sf)
    vectors, size = _word_vectors(spark, sf, bags)
    return M.coverage(bags, vectors, size)


@query(
    "word_vector_scan",
    _WORD_TABLE
    + "SELECT word, CAST(unnest(range(0, len(vec))) AS INTEGER) AS pos, unnest(vec)::DOUBLE AS value FROM vectors",
)
def word_vector_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The word table as ``word f1 … fd`` lines, read back."""
    vectors, _ = _word_vectors(spark, sf, _bags(spark, sf))
    path = work_path(spark, "vectors")
    numbers = F.array_join(F.col("vec").cast("array<string>"), " ")
    vectors.select(F.concat_ws(" ", "word", numbers).alias("value")).write.text(path)
    found = read_vectors(spark, path)
    return found.select("word", F.posexplode(F.col("vec").cast("array<double>")).alias("pos", "value"))


# ── folds ─────────────────────────────────────────────────────────────────────

# Each class is cut in hash order where dealing in turn would have filled a fold.
_CUTS = """
starts AS (
  SELECT label, list_transform([0, 1, 2, 3], lambda f: len(list_filter(range(c), lambda i: (s + i) % 5 <= f))) AS cuts FROM (
    SELECT label, c, coalesce(sum(c) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s
    FROM (SELECT label, count(*) AS c FROM classed GROUP BY label)))
"""
_FOLDS = f"""
WITH classed AS (
  SELECT doc_id, lang AS label, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42')) AS n FROM documents),
{_CUTS},
folds AS (SELECT doc_id, label, len(list_filter(cuts, lambda c: n > c))::INTEGER AS fold FROM classed JOIN starts USING (label))
"""


def _doc_folds(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("label"))
    return D.stratified_folds(docs)


@query("stratified_folds", _FOLDS + "SELECT doc_id, label, fold FROM folds")
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    return _doc_folds(spark, sf)


@query("fold_sizes", _FOLDS + "SELECT fold, label, count(*) AS n FROM folds GROUP BY ALL")
def fold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return D.fold_sizes(_doc_folds(spark, sf))


# ── evaluation: every tenth coordinate, added up, serves as a class's score ────

_SCORED = f"""
WITH classed AS (
  SELECT vec_id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY md5(vec_id || ':42')) AS n FROM embeddings),
{_CUTS},
folds AS (SELECT vec_id, label, embedding, len(list_filter(cuts, lambda c: n > c))::INTEGER AS fold FROM classed JOIN starts USING (label)),
spread AS (SELECT fold, vec_id, label, embedding, CAST(unnest(range(0, 10)) AS INTEGER) AS class FROM folds),
scores AS (
  SELECT fold, vec_id, label, class, round(list_reduce(list_transform(range(class + 1, len(embedding) + 1, 10),
    lambda i: embedding[i]::DOUBLE), lambda a, b: a + b), 2) AS score FROM spread),
preds AS (SELECT fold, vec_id, label, arg_min(class, (-score, class)) AS pred FROM scores GROUP BY fold, vec_id, label),
acc AS (SELECT fold, avg(CASE WHEN pred = label THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM preds GROUP BY fold),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY fold, class ORDER BY score)
    + (count(*) OVER (PARTITION BY fold, class, score) - 1) / 2.0::DOUBLE AS r FROM scores),
aucs AS (
  SELECT fold, class, (sum(CASE WHEN label = class THEN r ELSE 0 END) - p * (p + 1) / 2.0::DOUBLE) / (p * q) AS auc
  FROM ranked JOIN (
    SELECT fold, class, sum((label = class)::INTEGER)::DOUBLE AS p, sum((label <> class)::INTEGER)::DOUBLE AS q
    FROM scores GROUP BY ALL) USING (fold, class) GROUP BY fold, class, p, q)
"""


def _scored(spark: SparkSession, sf: str, *more: str) -> tuple[DataFrame, DataFrame]:
    """(predictions, scores); scores are rounded so that ties occur."""
    rows = table(spark, sf, "embeddings").withColumnRenamed("vec_id", "doc_id")
    folds = D.class_bounds(rows.select("doc_id", "label"))
    numbers = F.transform("embedding", lambda x: x.cast("double"))

    def total(k: int):
        own = F.filter(numbers, lambda _, i: i % 10 == k)
        return F.round(F.aggregate(F.slice(own, 2, 1_000), F.get(own, F.lit(0)), lambda a, b: a + b), 2)

    score = F.array(*[total(k) for k in range(10)])
    rows = cut(rows.select(folds.of(F.col("doc_id"), F.col("label")).alias("fold"), "doc_id", "label", score.alias("s")))
    pred = (F.array_position("s", F.array_max("s")) - 1).cast("int")
    scores = rows.select("fold", "doc_id", "label", F.posexplode("s").alias("class", "score"))
    predictions = rows.withColumn("probs", F.col("s")).select("fold", "doc_id", "label", pred.alias("pred"), *more)
    return predictions, scores


@query("accuracy_by_fold", _SCORED + "SELECT fold, round(accuracy, 6) AS accuracy FROM acc")
def accuracy_by_fold(spark: SparkSession, sf: str) -> DataFrame:
    accuracy = V.accuracy_by_fold(_scored(spark, sf)[0])
    return accuracy.select("fold", F.round("accuracy", 6).alias("accuracy"))


@query(
    "confusion_matrix",
    _SCORED
    + """, classes AS (SELECT DISTINCT label AS c FROM preds UNION SELECT DISTINCT pred FROM preds)
SELECT a.c AS label, b.c AS pred, count(p.vec_id) AS n FROM classes a CROSS JOIN classes b
LEFT JOIN preds p ON p.label = a.c AND p.pred = b.c GROUP BY ALL""",
)
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return V.confusion(_scored(spark, sf)[0])


@query("auc_ovr", _SCORED + "SELECT fold, class, round(auc, 6) AS auc FROM aucs")
def auc_ovr(spark: SparkSession, sf: str) -> DataFrame:
    return V.auc_ovr(_scored(spark, sf)[1]).select("fold", "class", F.round("auc", 6).alias("auc"))


@query(
    "cv_summary",
    _SCORED
    + """SELECT 'accuracy_mean' AS metric, round(avg(accuracy), 4) AS value FROM acc
UNION ALL SELECT 'accuracy_std', round(stddev_pop(accuracy), 4) FROM acc
UNION ALL SELECT 'auc:' || class, round(avg(auc), 4) FROM aucs GROUP BY class""",
)
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    predictions, scores = _scored(spark, sf)
    return V.cv_summary(V.accuracy_by_fold(predictions), V.auc_ovr(scores))


@query(
    "metrics_fields",
    _SCORED
    + """, classes AS (SELECT DISTINCT label AS c FROM preds UNION SELECT DISTINCT pred FROM preds),
cells AS (SELECT a.c AS label, b.c AS pred, count(p.vec_id) AS n FROM classes a CROSS JOIN classes b
  LEFT JOIN preds p ON p.label = a.c AND p.pred = b.c GROUP BY ALL)
SELECT 'n_docs' AS field, '' AS key, count(*)::DOUBLE AS value FROM preds
UNION ALL SELECT 'accuracy_mean', '', round(avg(accuracy), 4) FROM acc
UNION ALL SELECT 'accuracy_std', '', round(stddev_pop(accuracy), 4) FROM acc
UNION ALL SELECT 'accuracy_folds', fold::VARCHAR, round(accuracy, 4) FROM acc
UNION ALL SELECT 'auc_por_clase', class::VARCHAR, round(avg(auc), 4) FROM aucs GROUP BY class
UNION ALL SELECT 'confusion_matrix', label || ':' || pred, n::DOUBLE FROM cells""",
)
def metrics_fields(spark: SparkSession, sf: str) -> DataFrame:
    """A metrics record of all folds, written as JSON, read back and taken apart."""
    predictions, _ = _scored(spark, sf, "probs")
    folder = work_path(spark, "metrics")
    names = [str(k) for k in range(10)]
    K.write_metrics(P.metrics_record(predictions, names, "tenths", "sums", 5, 64, 10, 0.0), folder, "svm")
    record = K.read_metrics(spark, folder, "svm")
    one = [
        F.struct(F.lit(f).alias("field"), F.lit("").alias("key"), F.col(f).cast("double").alias("value"))
        for f in ("n_docs", "accuracy_mean", "accuracy_std")
    ]
    number = lambda x: x.cast("string")
    folds = F.transform("accuracy_folds", lambda v, i: F.struct(F.lit("accuracy_folds").alias("field"), number(i).alias("key"), v.alias("value")))
    aucs = F.transform(F.map_entries("auc_por_clase"), lambda e: F.struct(F.lit("auc_por_clase").alias("field"), e["key"].alias("key"), e["value"].alias("value")))
    cells = F.flatten(F.transform("confusion_matrix", lambda row, i: F.transform(row, lambda n, j: F.struct(
        F.lit("confusion_matrix").alias("field"), F.concat(number(i), F.lit(":"), number(j)).alias("key"), n.cast("double").alias("value")))))
    return record.select(F.inline(F.concat(F.array(*one), folds, aucs, cells)))


_VOTE = """
WITH machines AS (
  SELECT p, i, j, list_transform(range(0, 64), lambda k: ((p + 2) * (k + 3) % 11 - 5) / 8.0::DOUBLE) AS w, (p - 2) / 16.0::DOUBLE AS b
  FROM (SELECT unnest([0, 1, 2, 3, 4, 5]) AS p, unnest([0, 0, 0, 1, 1, 2]) AS i, unnest([1, 2, 3, 2, 3, 3]) AS j)),
margins AS (
  SELECT vec_id, i, j, list_reduce(list_transform(range(1, 65), lambda k: embedding[k]::DOUBLE * w[k]), lambda a, x: a + x) + b AS m
  FROM embeddings CROSS JOIN machines),
votes AS (SELECT vec_id, CASE WHEN m > 0 THEN i ELSE j END AS class, count(*) AS n FROM margins GROUP BY ALL)
SELECT vec_id AS doc_id, arg_max(class, (n, -class))::INTEGER AS pred FROM votes GROUP BY vec_id
"""


@query("svm_vote", _VOTE)
def svm_vote(spark: SparkSession, sf: str) -> DataFrame:
    """Six machines of four classes, with stated weights, saved and loaded: every vector's majority vote."""
    pairs = M2.class_pairs(4)
    weights = np.array([[*(((p + 2) * (k + 3) % 11 - 5) / 8 for k in range(64)), (p - 2) / 16] for p in range(6)])
    path = work_path(spark, "machines")
    M2.LinearSvm(list("abcd"), pairs, weights, np.tile([-1.0, 0.0], (6, 1))).save(path, spark)
    rows = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("val"))
    return M2.LinearSvm.load(path, spark).transform(rows).select("doc_id", "pred")


_FOLD_CHI2 = (
    _COUNTS
    + f""",
classed AS (SELECT doc_id, lang AS label, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || ':42')) AS n FROM documents),
{_CUTS},
folds AS (SELECT doc_id, label, len(list_filter(cuts, lambda c: n > c))::INTEGER AS fold FROM classed JOIN starts USING (label)),
held AS (SELECT unnest([0, 1, 2, 3, 4])::INTEGER AS held),
prior AS (SELECT held, label, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY held) AS p FROM folds JOIN held ON fold <> held GROUP BY held, label),
placed AS (SELECT p.label, p.term, p.n, f.fold FROM pruned p JOIN folds f ON p.doc_id = f.doc_id),
seen AS (SELECT held, term, label, sum(n)::DOUBLE AS o FROM placed JOIN held ON fold <> held GROUP BY ALL),
totals AS (SELECT held, term, sum(o) AS t FROM seen GROUP BY ALL),
cells AS (
  SELECT t.held, t.term, coalesce(s.o, 0) AS o, p.p * t.t AS e FROM totals t JOIN prior p ON p.held = t.held
  LEFT JOIN seen s ON s.held = t.held AND s.term = t.term AND s.label = p.label),
scores AS (SELECT held, term, round(sum((o - e) * (o - e) / e), 6) AS score FROM cells GROUP BY held, term),
best AS (SELECT held, term, row_number() OVER (PARTITION BY held ORDER BY score DESC, term DESC) AS rank FROM scores)
SELECT held, term FROM best WHERE rank <= 150
"""
)


@query("fold_chi2_terms", _FOLD_CHI2)
def fold_chi2_terms(spark: SparkSession, sf: str) -> DataFrame:
    """The terms that are selected when each fold is held out."""
    folded = P.with_folds(X.labelled(spark, sf), ModelSettings())
    chosen, _ = select_per_fold(grouped_counts(folded, ("fold", "label"), STOP), fold_class_sizes(folded), 150)
    rows = [(held, term) for held, terms in chosen.items() if held is not None for term in terms]
    return spark.createDataFrame(rows, "held int, term string")


# ── classifiers ───────────────────────────────────────────────────────────────


def _predictions(experiment: P.Experiment) -> DataFrame:
    return experiment.predictions.select("fold", "doc_id", "label", "pred", "probs")


@query("svm_bow_cv")
def svm_bow_cv(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(P.bow_experiment(X.labelled(spark, sf), STOP))


@query("svm_lsa_cv")
def svm_lsa_cv(spark: SparkSession, sf: str) -> DataFrame:
    return _predictions(P.lsa_experiment(X.labelled(spark, sf), STOP))


@query("svm_embed_cv")
def svm_embed_cv(spark: SparkSession, sf: str) -> DataFrame:
    vectors, _ = _word_vectors(spark, sf, _bags(spark, sf))
    return _predictions(P.embedding_experiment(X.labelled(spark, sf), vectors, STOP))


def _lsa(spark: SparkSession, sf: str) -> tuple[DataFrame, L.LsaModel, L.Fit]:
    docs = X.labelled(spark, sf)
    fit = L.fit_lsa(B.with_terms(docs, STOP, TFIDF_TEXT).select("doc_id", "terms"), 100)
    model = fit.models[None]
    return cut(L.lsa_vectors(docs.select("doc_id"), model, fit.rows)), model, fit


@query("lsa_vectors")
def lsa_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _lsa(spark, sf)[0].select("doc_id", "vec")


@query("lsa_norms", _TFIDF + "SELECT doc_id, 1.0::DOUBLE AS norm, 100 AS dims FROM norms")
def lsa_norms(spark: SparkSession, sf: str) -> DataFrame:
    """Every document that holds a term of the vocabulary has a vector of unit length."""
    vectors = _lsa(spark, sf)[0]
    norm = F.round(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)), 9)
    return vectors.select("doc_id", norm.alias("norm"), F.size("vec").alias("dims")).where("norm > 0")


@query("lsa_variance")
def lsa_variance(spark: SparkSession, sf: str) -> DataFrame:
    vectors, model, fit = _lsa(spark, sf)
    share = L.explained_variance(vectors, model, fit.rows)
    return vectors.agg(F.count(F.lit(1)).alias("n_docs")).select(
        "n_docs", F.lit(model.dims).alias("dims"), F.lit(share).alias("share"), F.lit(model.residual).alias("residual")
    )


@query("svm_score")
def svm_score(spark: SparkSession, sf: str) -> DataFrame:
    """Train on all documents, save, load, and label every document's raw text."""
    docs = X.labelled(spark, sf)
    experiment = P.bow_experiment(docs, STOP, evaluate=False, final=True)
    path = work_path(spark, "bundle")
    P.save_bow_bundle(experiment, path, spark)
    return P.score_bow_bundle(docs.select("doc_id", "text"), path)


@query("model_compare")
def model_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Metric records of the three classifiers, written as JSON and read back."""
    docs = X.labelled(spark, sf)
    vectors, _ = _word_vectors(spark, sf, _bags(spark, sf))
    folder = work_path(spark, "metrics")
    K.write_metrics(P.bow_experiment(docs, STOP).metrics, folder, "svm")
    K.write_metrics(P.lsa_experiment(docs, STOP).metrics, folder, "w2v")
    K.write_metrics(P.embedding_experiment(docs, vectors, STOP).metrics, folder, "embed")
    return K.read_metrics(spark, folder).drop("elapsed_s")


@query("stem_term_df")
def stem_term_df(spark: SparkSession, sf: str) -> DataFrame:
    """Document frequency of Spanish stems."""
    docs = X.labelled(spark, sf).where(F.col("label") == "es").drop("label")
    words = docs.select("doc_id", T.tokens(F.lower("text")).alias("terms"))
    return B.document_frequency(stemmed_counts(B.term_counts(words)))
