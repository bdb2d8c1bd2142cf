import math
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from newsmine.config import ModelSettings, TextSettings
from newsmine.operators import evaluate as V
from newsmine.operators import experiments as P
from newsmine.operators import folds as D
from newsmine.operators import lsa as L
from newsmine.operators import selection as S
from newsmine.operators import sinks as K
from newsmine.operators import svm as M
from newsmine.operators.bow import best_terms, chi2_scores, class_term_sums, term_counts
from newsmine.session import work_path


@pytest.mark.parametrize("sizes", [{"a": 7, "b": 23, "c": 2}, {"a": 100, "b": 5}])
def test_fold_sizes(spark, sizes):
    rows = [(i, c) for i, c in enumerate(c for c, n in sizes.items() for _ in range(n))]
    docs = spark.createDataFrame(rows, "doc_id long, label string")
    found = {(r.fold, r.label): r.n for r in D.fold_sizes(D.stratified_folds(docs)).collect()}
    labels = sorted(c for c, n in sizes.items() for _ in range(n))
    for fold in range(5):
        for c in sizes:
            assert found.get((fold, c), 0) == labels[fold::5].count(c)


def auc_of(spark, rows):
    scores = spark.createDataFrame([(0, i, y, 1, s) for i, (y, s) in enumerate(rows)], "fold int, doc_id int, label int, class int, score double")
    return V.auc_ovr(scores).first()["auc"]


def test_auc_edges(spark):
    assert auc_of(spark, [(1, 0.5), (0, 0.5), (1, 0.5)]) == 0.5
    assert auc_of(spark, [(1, 0.9), (0, 0.1)]) == 1.0
    assert auc_of(spark, [(1, 0.1), (0, 0.9)]) == 0.0
    assert math.isnan(auc_of(spark, [(0, 0.1), (0, 0.9)]))


def test_auc_against_all_pairs(spark):
    rng = random.Random(4)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 2)) for _ in range(500)]
    pos, neg = ([s for y, s in rows if y == k] for k in (1, 0))
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert auc_of(spark, rows) == pytest.approx(wins / (len(pos) * len(neg)))


def test_confusion_shows_zeros(spark):
    rows = spark.createDataFrame([(0, 1, 0, 0), (0, 2, 1, 0)], "fold int, doc_id int, label int, pred int")
    assert {(r.label, r.pred): r.n for r in V.confusion(rows).collect()} == {(0, 0): 1, (1, 0): 1, (0, 1): 0, (1, 1): 0}


def blobs(spark, n=240, noise=1.0, k=3):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((k, 6)) * 1.5
    rows = []
    for i in range(n):
        c = i % k
        rows.append((i, "abcdef"[c], i // k % 5, (centres[c] + noise * rng.standard_normal(6)).tolist()))
    return spark.createDataFrame(rows, "doc_id long, label string, fold int, val array<double>")


def objective(w, x, side):
    return 0.5 * (w[:-1] ** 2).sum() + np.maximum(0, 1 - side * (x @ w[:-1] + w[-1])).sum()


def test_machines_reach_the_objective_of_linear_svc(spark):
    rows = blobs(spark)
    trainer = M.SvmTrainer(rows, list("abc"), 6, ModelSettings(tol=1e-6))
    machines = [M.Machine(None, frozenset(), p) for p in trainer.pairs]
    sides = M._sides(machines, 3, trainer.folds)
    found = M.fit_machines(trainer.rows, 6, sides, np.ones((3, 7)), trainer.settings)
    trainer.close()
    pdf = rows.toPandas()
    x, y = np.array(pdf["val"].tolist()), pdf["label"].map("abc".index).to_numpy()
    for w, (i, j) in list(zip(found, trainer.pairs, strict=True))[:2]:
        on = (y == i) | (y == j)
        side = np.where(y[on] == i, 1.0, -1.0)
        data = [(Vectors.dense(v), float(s > 0)) for v, s in zip(x[on], side, strict=True)]
        frame = spark.createDataFrame(data, ["features", "label"]).coalesce(1)
        model = LinearSVC(regParam=1 / on.sum(), standardization=False, maxIter=100, tol=1e-6).fit(frame)
        reference = objective(np.r_[model.coefficients.toArray(), model.intercept], x[on], side)
        assert objective(w, x[on], side) <= reference * 1.01


def test_cross_validation_and_bundle(spark):
    rows = blobs(spark, noise=0.7)
    trainer = M.SvmTrainer(rows, list("abc"), 6, ModelSettings())
    predictions, model = trainer.run(final=True)
    trainer.close()
    assert predictions.count() == 240
    assert sum(r.n for r in V.confusion(predictions).collect()) == 240
    assert min(r.accuracy for r in V.accuracy_by_fold(predictions).collect()) > 0.8
    for row in predictions.collect():
        assert sum(row.probs) == pytest.approx(1.0, abs=1e-6)
    assert all(0.9 < r.auc <= 1 for r in V.auc_mean(V.auc_ovr(M.class_scores(predictions))).collect())
    path = work_path(spark, "bundle")
    model.save(path, spark)
    again = M.LinearSvm.load(path, spark)
    before, after = ({r.doc_id: (r.pred, r.probs) for r in m.transform(rows).collect()} for m in (model, again))
    assert before == after


def test_class_missing_from_a_training_set(spark):
    rows = blobs(spark, 60).withColumn("fold", F.when(F.col("label") == "c", 0).otherwise(F.col("fold")))
    trainer = M.SvmTrainer(rows, list("abc"), 6, ModelSettings())
    predictions, _ = trainer.run()
    trainer.close()
    assert predictions.count() == 60
    assert predictions.where("fold = 0 and pred = 2").count() == 0


def test_coupling_recovers_consistent_probabilities():
    p = np.array([[0.5, 0.3, 0.2], [0.1, 0.1, 0.8]])
    pairs = M.class_pairs(3)
    pairwise = np.stack([p[:, i] / (p[:, i] + p[:, j]) for i, j in pairs], axis=1)
    assert M.couple(pairwise, 3, pairs) == pytest.approx(p, abs=1e-9)


WORDS = {"a": "sol luna mar cielo", "b": "ley juez voto corte", "c": "gol pase red arco"}


def corpus(spark, n=90):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        c = "abc"[i % 3]
        pool = WORDS[c].split() * 3 + " ".join(WORDS.values()).split()
        rows.append((i, " ".join(rng.choice(pool) for _ in range(rng.randint(3, 15))), c))
    return spark.createDataFrame(rows, "doc_id long, text string, label string")


SMALL = ModelSettings(k_terms=20, n_components=5)


@pytest.mark.parametrize("scope", ["corpus", "fold"])
def test_selection_ignores_the_held_out_fold(spark, scope):
    text = TextSettings(min_df=2, max_df=0.9)
    docs = P.with_folds(corpus(spark), SMALL)
    tf = term_counts(P.with_terms(docs, (), text), ("doc_id", "label", "fold"))
    chosen, _ = S.select_per_fold(tf, S.fold_class_sizes(docs), 10, text, scope)
    total = {r.term for r in tf.groupBy("term").count().where("count >= 2 and count <= 81").collect()}
    for held in (0, 3):
        rest = tf.where(F.col("fold") != held)
        sizes = {r.label: r["count"] for r in docs.where(F.col("fold") != held).groupBy("label").count().orderBy("label").collect()}
        sums = class_term_sums(rest, list(sizes))
        n = sum(sizes.values())
        bounds = F.col("term").isin(sorted(total)) if scope == "corpus" else (F.col("df") >= 2) & (F.col("df") <= 0.9 * n)
        best = best_terms(chi2_scores(sums.where(bounds), sizes), 10)
        assert chosen[held] == sorted(r.term for r in best.collect())


def test_bow_experiment_scores_raw_text(spark):
    docs = corpus(spark)
    text = TextSettings(min_df=2, max_df=0.9)
    found = P.bow_experiment(docs, (), SMALL, text, final=True)
    record = found.metrics.first()
    assert record.n_docs == 90 and record.accuracy_mean > 0.8 and record.clases == ["a", "b", "c"]
    assert np.array(record.confusion_matrix).sum() == 90
    path = work_path(spark, "bow")
    P.save_bow_bundle(found, path, spark)
    labelled = P.score_bow_bundle(docs.drop("label"), path)
    hits = labelled.join(docs.select("doc_id", F.col("label").alias("truth")), "doc_id")
    assert hits.where("label = truth").count() >= 80
    folder = work_path(spark, "metrics")
    K.write_metrics(found.metrics, folder, "svm")
    assert K.read_metrics(spark, folder, "svm").first()["accuracy_mean"] == record.accuracy_mean
    with pytest.raises(ValueError):
        K.write_metrics(found.metrics, folder, "other")


def test_rows_without_label_are_kept(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "doc_id long, label string")
    found = D.stratified_folds(docs, 2)
    assert {(r.doc_id, r.label) for r in found.collect()} == {(1, "a"), (2, None), (3, "a"), (4, None)}
    assert sorted(r["count"] for r in found.groupBy("label", "fold").count().collect()) == [1, 1, 1, 1]


def test_folds_are_exact_over_several_passes(spark, monkeypatch):
    """Ranges of hashes are refined pass by pass; rows that repeat a doc_id share a fold."""
    import hashlib

    monkeypatch.setattr(D, "LISTED", 0)
    rows = [(i, "hot" if i % 3 else f"c{i % 9}") for i in range(4_000)] + [(7, "hot")] * 3 + [(None, "c0")]
    docs = spark.createDataFrame(rows, "doc_id long, label string")
    found = D.stratified_folds(docs, 4, 9).collect()
    marks = {}
    for i, c in rows:
        h = hashlib.md5(f"{'' if i is None else i}{'' if i is None else ':'}9".encode()).hexdigest()
        marks.setdefault(c, []).append((int(h[:15], 16), i))
    start, expected = 0, {}
    for c in sorted(marks):
        own = sorted(marks[c], key=lambda x: x[0])
        cuts, before = [], 0
        for n in D.shares(start, len(own), 4)[:-1]:
            before += n
            cuts.append(own[before][0] if before < len(own) else 1 << 60)
        for h, i in own:
            expected[i, c] = sum(cut <= h for cut in cuts)
        start = (start + len(own)) % 4
    assert {(r.doc_id, r.label): r.fold for r in found} == expected and len(found) == len(rows)
    monkeypatch.setattr(D, "LISTED", 1_000)
    assert {(r.doc_id, r.label): r.fold for r in D.stratified_folds(docs, 4, 9).collect()} == expected
    assert D.stratified_folds(docs.limit(0)).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_are_not_shuffled_for_folds(spark):
    folded = P.with_folds(corpus(spark).repartition(3).persist(), SMALL)
    bags = P.bags_of(P.with_terms(folded, (), TextSettings()), ("doc_id", "label", "fold"))
    for rows in (folded, bags, S.count_vectors(bags, {0: ["sol"]}, ("doc_id", "label", "fold"))[0]):
        above = plan_of(rows).split("InMemoryTableScan")[0]
        assert "Exchange" not in above and "Join" not in above


@pytest.mark.parametrize("job", ["bow", "lsa", "embed"])
def test_rows_without_label_are_no_training_rows(spark, job):
    docs = corpus(spark)
    mixed = docs.unionByName(docs.where("doc_id < 9").select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit(None).cast("string").alias("label")))
    assert P.unlabelled(mixed).count() == 9
    text = TextSettings(ngram_range=(1, 1), min_df=2, max_df=0.9)
    words = " ".join(WORDS.values()).split()
    vectors = spark.createDataFrame([(w, [float(i == j // 4) for i in range(3)]) for j, w in enumerate(words)], "word string, vec array<float>")
    run = {
        "bow": lambda d: P.bow_experiment(d, (), SMALL, text),
        "lsa": lambda d: P.lsa_experiment(d, (), SMALL, text),
        "embed": lambda d: P.embedding_experiment(d, vectors, (), SMALL),
    }[job]
    with_them, without = (run(d).predictions.select("doc_id", "fold", "pred").collect() for d in (mixed, docs))
    assert sorted(map(tuple, with_them)) == sorted(map(tuple, without)) and len(without) == 90


def test_lsa_and_embedding_experiments(spark):
    docs = corpus(spark)
    text = TextSettings(ngram_range=(1, 1), min_df=2, max_df=0.9)
    found = P.lsa_experiment(docs, (), SMALL, text, final=True)
    assert found.metrics.first()["accuracy_mean"] > 0.8
    path = work_path(spark, "lsa")
    P.save_lsa_bundle(found, path, spark)
    assert P.score_lsa_bundle(docs.drop("label"), path).count() == 90
    words = " ".join(WORDS.values()).split()
    vectors = spark.createDataFrame([(w, [float(i == j // 4) for i in range(3)]) for j, w in enumerate(words)], "word string, vec array<float>")
    found = P.embedding_experiment(docs, vectors, (), SMALL, final=True)
    assert found.metrics.first()["accuracy_mean"] > 0.8
    path = work_path(spark, "embed")
    P.save_embedding_bundle(found, path, vectors, spark)
    assert P.score_embedding_bundle(docs.drop("label"), path).count() == 90


def lsa_docs(spark):
    rng = random.Random(7)
    pool = [f"w{i}" for i in range(25)]
    rows = [(d, d % 3, [rng.choice(pool[d % 5 * 4 : d % 5 * 4 + 9]) for _ in range(12)]) for d in range(60)] + [(60, 0, ["zz"])]
    return spark.createDataFrame(rows, "doc_id long, fold int, terms array<string>")


ONE_GRAMS = TextSettings(ngram_range=(1, 1), min_df=2, max_df=1.0)


@pytest.mark.parametrize("slice_bytes", [L.SLICE_BYTES, 1_000, 0])
def test_lsa_against_dense_svd(spark, slice_bytes):
    """The block in one slice, in a few, and term by term: all agree with a dense decomposition."""
    docs = lsa_docs(spark).drop("fold")
    fit = L.fit_lsa(docs, 4, ONE_GRAMS, rounds=8, slice_bytes=slice_bytes)
    model, rows = fit.models[None], fit.rows
    assert model.residual < 1e-3
    placed = {r.doc_id: r.vec for r in L.project(model, rows, slice_bytes).collect()}
    dense = np.zeros((60, model.n_terms))
    for r in L.weighted(rows, fit.views[0]).collect():
        dense[r.doc_id, r.idx] = r.w
    u, s, vt = np.linalg.svd(dense, full_matrices=False)
    signs = np.sign(vt[np.arange(4), np.abs(vt[:4]).argmax(axis=1)])
    expected = u[:, :4] * s[:4] * signs
    assert np.array([placed[d] for d in range(60)]) == pytest.approx(expected, abs=1e-4)
    vectors = L.lsa_vectors(docs.select("doc_id"), model, rows, slice_bytes)
    norms = {r.doc_id: sum(x * x for x in r.vec) for r in vectors.collect()}
    assert norms.pop(60) == 0 and all(n == pytest.approx(1.0) for n in norms.values())
    full = np.vstack([dense, np.zeros(model.n_terms)])
    kept = np.vstack([expected, np.zeros(4)])
    assert L.term_spread(rows, fit.views[0], 61, max(16, slice_bytes)) == pytest.approx(full.var(axis=0).sum())
    share = L.explained_variance(vectors, model, rows)
    assert share == pytest.approx(kept.var(axis=0).sum() / full.var(axis=0).sum(), abs=1e-4)
    if slice_bytes:
        with pytest.raises(ValueError):
            L.fit_lsa(docs, 1000, ONE_GRAMS)


def test_lsa_does_not_depend_on_slices_or_partitions(spark):
    docs = lsa_docs(spark).drop("fold")
    found = []
    for slice_bytes, parts in ((L.SLICE_BYTES, 1), (2_000, 3), (500, 7)):
        fit = L.fit_lsa(docs.repartition(parts), 4, ONE_GRAMS, rounds=2, slice_bytes=slice_bytes)
        found.append(np.array([r.vec for r in L.project(fit.models[None], fit.rows, slice_bytes).orderBy("doc_id").collect()]))
    assert found[0] == pytest.approx(found[1], abs=1e-6) and found[0] == pytest.approx(found[2], abs=1e-6)


def test_lsa_passes_shuffle_no_cell(spark):
    fit = L.fit_lsa(lsa_docs(spark).drop("fold"), 4, ONE_GRAMS)
    for rows in (L.project(fit.models[None], fit.rows), L.project_all(fit.rows, fit.views, L._block_of(fit.models[None], 100), ["idx", "n"])):
        assert "Exchange" not in plan_of(rows)


@pytest.mark.parametrize("slice_bytes", [L.SLICE_BYTES, 3_000])
def test_folds_of_lsa_equal_separate_fits(spark, slice_bytes):
    docs = lsa_docs(spark)
    fit = L.fit_lsa(docs, 4, ONE_GRAMS, rounds=8, folds=range(3), slice_bytes=slice_bytes)
    for held in range(3):
        alone = L.fit_lsa(docs.where(F.col("fold") != held).drop("fold"), 4, ONE_GRAMS, rounds=8)
        rows = L.counted_rows(L.bags_of(docs), alone.models[None].terms)
        own, other = ({r.doc_id: r.vec for r in L.lsa_vectors(docs.select("doc_id"), m, x).collect()} for m, x in ((fit.models[held], fit.rows), (alone.models[None], rows)))
        assert own.keys() == other.keys()
        for d in own:
            assert own[d] == pytest.approx(other[d], abs=1e-6)
        idf = {r.term: r.idf for r in fit.models[held].terms.where("idf > 0").collect()}
        assert idf == pytest.approx({r.term: r.idf for r in alone.models[None].terms.collect()})


def test_lsa_experiment_with_fold_scope(spark):
    text = TextSettings(ngram_range=(1, 1), min_df=2, max_df=0.9)
    settings = ModelSettings(k_terms=20, n_components=5, fit_scope="fold")
    found = P.lsa_experiment(corpus(spark), (), settings, text, final=True)
    assert found.predictions.count() == 90 and found.metrics.first()["accuracy_mean"] > 0.8
    assert found.model.width == 5 and found.lsa.dims == 5


def test_lsa_block_of_many_slices_never_is_whole_on_the_driver(spark, monkeypatch):
    """The driver sees a slice at a time, and nothing that tasks add up has a row per term."""
    sizes, add, read = [], L.total_of, L.Block.get

    def total_of(rows, partial, shape):
        sizes.append(("sum", np.prod(shape)))
        return add(rows, partial, shape)

    def get(block, s):
        found = read(block, s)
        sizes.append(("slice", found.nbytes))
        return found

    monkeypatch.setattr(L, "total_of", total_of)
    monkeypatch.setattr(L.Block, "get", get)
    rng = random.Random(3)
    rows = [(d, [f"w{rng.randrange(300)}" for _ in range(40)]) for d in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, terms array<string>")
    fit = L.fit_lsa(docs, 2, ONE_GRAMS, rounds=1, oversample=1, slice_bytes=2_400)
    assert fit.models[None].n_terms > 250
    assert max(n for kind, n in sizes if kind == "slice") <= 2_400
    assert max(n for kind, n in sizes if kind == "sum") <= 9


def test_lsa_block_is_passed_on_in_bounded_parts(spark, monkeypatch):
    """The slices that the driver has sent and not yet taken back never exceed the bound, and the vectors do not depend on it."""
    live, most, send = {}, [], type(spark.sparkContext).broadcast

    def broadcast(sc, value):
        shared = send(sc, value)
        if isinstance(value, np.ndarray) and value.ndim == 2:
            live[id(shared)] = value.nbytes
            most.append(sum(live.values()))
            end = shared.destroy
            shared.destroy = lambda *a, **b: (live.pop(id(shared)), end(*a, **b))
        return shared

    docs = lsa_docs(spark).drop("fold")
    plain = L.fit_lsa(docs, 4, ONE_GRAMS, rounds=1, oversample=1, slice_bytes=80)
    expected = {r.doc_id: r.vec for r in L.project(plain.models[None], plain.rows).collect()}
    monkeypatch.setattr(L, "HELD_BYTES", 400)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    fit = L.fit_lsa(docs, 4, ONE_GRAMS, rounds=1, oversample=1, slice_bytes=80)
    assert max(most) <= 400 < 8 * 5 * fit.models[None].n_terms
    found = {r.doc_id: r.vec for r in L.project(fit.models[None], fit.rows, 32).collect()}
    assert found.keys() == expected.keys() and all(found[d] == pytest.approx(expected[d], abs=1e-9) for d in found)


def working_tables(spark, before=()):
    folder = Path(work_path(spark, "x")).parent
    return {p.name for p in folder.glob("lsa-*")} - set(before) if folder.exists() else set()


@pytest.mark.parametrize("by_tasks", [True, False])
def test_lsa_passes_leave_one_block(spark, monkeypatch, by_tasks):
    """Vectors are the same whether tasks read the slices or the driver passes on all; the first leaves only what models read."""
    docs = lsa_docs(spark).drop("fold")
    plain = L.fit_lsa(docs, 4, ONE_GRAMS, rounds=2)
    expected = {r.doc_id: r.vec for r in L.project(plain.models[None], plain.rows).collect()}
    if not by_tasks:
        monkeypatch.setattr(L, "opened", lambda path: None)
    monkeypatch.setattr(L, "HELD_BYTES", 500)
    before = working_tables(spark)
    fit = L.fit_lsa(docs, 4, ONE_GRAMS, rounds=2, slice_bytes=500)
    found = {r.doc_id: r.vec for r in L.project(fit.models[None], fit.rows, 500).collect()}
    assert found.keys() == expected.keys() and all(found[d] == pytest.approx(expected[d], abs=1e-9) for d in found)
    assert fit.models[None].residual == pytest.approx(plain.models[None].residual, abs=1e-6)
    if by_tasks:
        assert sorted(n.rsplit("-", 1)[0] for n in working_tables(spark, before)) == ["lsa-block", "lsa-rows"]
        assert "Exchange" not in plan_of(fit.models[None].components)
