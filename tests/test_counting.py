import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsmine.config import ModelSettings, TextSettings
from newsmine.functions import text as T
from newsmine.operators import bow as B
from newsmine.operators import counting as C
from newsmine.operators import experiments as P
from newsmine.operators import selection as S
from newsmine.operators import svm as M
from newsmine.plans import learn_queries as L
from newsmine.plans import text_queries as Q
from newsmine.session import checkpoint_dir

ODD = ["", None, "a", "12ab 3c", "Año año AÑO ª m² ﬁn", "x1 1x 11", "fin", "fin ab", "ab-cd.ef gh", "è é", "de la sol de mar", "sol  mar\nsol mar", "ÀB", "ab́c q"]


def rows_of(spark, n=60):
    rng = random.Random(3)
    pool = "sol mar ley gol rey uno dos él Ñu 4x de la".split()
    texts = ODD + [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    rows = [(i // 2, t, None if i % 7 == 3 else "ab"[i % 2]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, label string").repartition(3)


def totals(counts, df, *keys):
    found = counts.groupBy(*keys, "term").agg(F.sum(df).alias("df"), F.sum("n").alias("n"))
    return sorted(map(tuple, found.collect()), key=repr)


def test_words_are_the_matches_of_the_pattern(spark):
    docs = spark.createDataFrame([(t,) for t in ODD], "text string").coalesce(1)
    clean = docs.select(T.let(F.lower("text"), T.strip_accents).alias("c")).select("c", T.tokens(F.col("c")).alias("w")).collect()
    texts = pa.array(["?", *[r.c or "" for r in clean], "end"]).slice(1, len(clean))
    row, words = C.split_words(texts)
    found = [[w for r, w in zip(row, words.to_pylist(), strict=True) if r == i] for i in range(len(clean))]
    assert found == [r.w or [] for r in clean]
    assert len(C.split_words(pa.array([], pa.string()))[1]) == len(C.split_words(pa.array(["", ""]))[1]) == 0


@pytest.mark.parametrize("held, piece", [(2_000_000, 1 << 23), (5, 40)])
@pytest.mark.parametrize("text", [TextSettings(), TextSettings(ngram_range=(2, 2)), TextSettings(ngram_range=(1, 1)), TextSettings(ngram_range=(1, 3)), TextSettings("[a-z]+")])
def test_grouped_counts_are_those_of_documents(spark, monkeypatch, held, piece, text):
    monkeypatch.setattr(C, "HELD_SUMS", held)
    monkeypatch.setattr(C, "PIECE_BYTES", piece)
    docs = rows_of(spark)
    tf = B.term_counts(B.with_terms(docs, ("de", "la"), text), ("label",))
    counts = C.grouped_counts(docs, ("label",), ("de", "la"), text)
    assert totals(counts, "df", "label") == totals(tf, F.lit(1), "label")
    assert totals(C.grouped_counts(docs, (), ("de", "la"), text), "df") == totals(tf, F.lit(1))


@pytest.mark.parametrize("query", ["bow_vocab", "bow_shape", "preview_vocab", "chi2_scores", "chi2_top150"])
def test_term_sums_are_made_without_a_row_per_document_and_term(spark, query):
    """tasks add up before Spark groups; no array of terms is made (bow_vocab writes first, so its input counts)."""
    made = []
    grouped = C.grouped_counts
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(Q.C, "grouped_counts", lambda *a, **k: made.append(grouped(*a, **k)) or made[-1])
        getattr(Q, query)(spark, "/root/testdata/sf0.001")
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert len(made) == 1 and "MapInArrow" in plan and "Generate" not in plan
    assert plan.count("Exchange") <= 1  # a small input is spread over the cores


def bags_written(spark):
    return set(Path(checkpoint_dir(spark)).glob("work/*bags-*"))


@pytest.mark.parametrize("scope", ["corpus", "fold"])
def test_selection_from_grouped_counts(spark, scope):
    """the same terms as from counts of single documents, and no bag is written."""
    text, before = TextSettings(min_df=2, max_df=0.9), bags_written(spark)
    docs = P.with_folds(rows_of(spark), ModelSettings(n_folds=3)).persist()
    sizes = S.fold_class_sizes(docs)
    tf = B.term_counts(B.with_terms(docs, (), text), ("doc_id", "label", "fold"))
    expected = S.select_per_fold(tf, sizes, 7, text, scope)
    assert S.select_per_fold(C.grouped_counts(docs, ("fold", "label"), (), text), sizes, 7, text, scope) == expected
    assert L.fold_chi2_terms(spark, "/root/testdata/sf0.001").count() == 750
    assert bags_written(spark) == before


@pytest.mark.parametrize("text", [TextSettings(), TextSettings(ngram_range=(2, 2)), TextSettings(ngram_range=(1, 3))])
@pytest.mark.parametrize("terms", [["sol", "mar", "mar sol", "uno dos", "la", "fin ab", "not there"], []])
def test_chosen_counts_are_those_of_bags(spark, monkeypatch, text, terms):
    monkeypatch.setattr(C, "PIECE_BYTES", 100)
    docs = rows_of(spark).drop("label")
    bags = B.bags_of(B.with_terms(docs, ("de",), text))
    words, reading = C.with_words(docs, ("de",), text)
    found = [S.count_vectors(bags, {0: terms}), S.count_vectors(words, {0: terms}, reading=reading)]
    a, b = (sorted(map(tuple, rows.collect()), key=repr) for rows, _, _ in found)
    assert a == b and found[0][1:] == found[1][1:]


def test_bow_experiment_writes_words_not_bags(spark):
    """F16, F19: the texts' words are written, not a bag of words and pairs for each text."""
    before = bags_written(spark)
    docs = rows_of(spark).dropna()
    P.bow_experiment(docs, (), ModelSettings(k_terms=5, n_folds=3, max_iter=5), TextSettings(min_df=2), evaluate=False, final=True)
    assert bags_written(spark) == before


def test_machines_that_are_done_are_not_evaluated(monkeypatch):
    """F16, F19: a problem at its minimum costs nothing in later passes."""
    seen = []

    def evaluate(w, active):
        seen.append(active.copy())
        scale = np.array([[1.0], [30.0]])
        value, slope = (scale * (w - 3.0) ** 4).sum(axis=1), 4 * scale * (w - 3.0) ** 3
        return np.where(active, value, 0.0), np.where(active[:, None], slope, 0.0)

    w = M.minimise(evaluate, np.array([[3.0, 3.0], [0.0, 9.0]]), 60, 1e-9)
    assert np.allclose(w, 3.0, atol=0.05) and seen[0].all() and not seen[-1][0] and seen[-1][1]


@pytest.mark.parametrize("code_bytes", [C.CODE_BYTES, 24])
def test_counts_of_a_vocabulary_without_a_shuffle(spark, monkeypatch, code_bytes):
    """Equal to joining all counts, in one pass or several; words that are no terms themselves stand in pairs."""
    monkeypatch.setattr(C, "CODE_BYTES", code_bytes)
    texts = ["uno dos tres", "Dós tres cuatro dos", "tres de uno", None, "", "uno uno dos", "otra x9 dos tres"]
    rows = [(d % 5 if d else None, t, ["es", "fr", None][d % 3]) for d, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    terms = spark.createDataFrame([(t,) for t in ("dos", "dos tres", "tres uno", "uno dos", "uno uno", "nada")], "term string")
    found = C.vocabulary_counts(docs, terms, ("doc_id", "label"), ("de",))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("ReusedExchange", "Exchange")
    expected = B.restrict(B.term_counts(B.with_terms(docs, ("de",)), ("doc_id", "label")), terms)
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect())) and expected.count() > 10
    monkeypatch.setattr(C, "LOOKUP_BYTES", 8)
    assert C.vocabulary_counts(docs, terms, ("doc_id",), ("de",)) is None


def test_bow_tf_joins_no_counts(spark, tmp_path):
    rows = [(d, "sol dos tres" if d % 2 else "dos tres cuatro", "es") for d in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = Q.bow_tf(spark, str(tmp_path))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.term, r.n) for r in found.collect()} == {("sol", 1), ("sol tres", 1), ("cuatro", 1), ("tres cuatro", 1)}
