import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from newsmine.config import TextSettings
from newsmine.operators import blocks as K
from newsmine.operators import bow as B
from newsmine.operators import embedding as M
from newsmine.operators import ordering as O
from newsmine.operators import tfidf as W
from newsmine.plans import text_queries as Q
from newsmine.session import work_path
from newsmine.sources.words import last_vectors, read_vectors, read_words


def test_document_frequency_bounds_are_inclusive(spark):
    docs = {"two": 2, "three": 3, "eight": 8, "nine": 9}
    rows = [(d, t, 1) for t, n in docs.items() for d in range(n)]
    tf = spark.createDataFrame(rows, "doc_id int, term string, n long")
    kept = B.pruned_terms(tf, 10, TextSettings(min_df=3, max_df=0.8))
    assert {r.term: r.df for r in kept.collect()} == {"three": 3, "eight": 8}
    with pytest.raises(ValueError):
        B.require_terms(B.pruned_terms(tf, 10, TextSettings(min_df=10)))


def test_vocabulary_is_alphabetical(spark):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abñz é") for _ in range(rng.randint(1, 12))) for _ in range(2000)})
    terms = spark.createDataFrame([(w, 1) for w in words], "term string, df long")
    found = {r.term: r.idx for r in B.vocabulary(terms).collect()}
    assert found == {w: i for i, w in enumerate(sorted(words))}


def test_running_total_with_a_dominant_key(spark):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.randint(0, 500), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    found = {r.i: r.n for r in O.numbered(df, ["k"], ["v", "i"], F.col("v"), "n").collect()}
    expected, seen = {}, {}
    for k, _, i in sorted(rows, key=lambda r: (r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        expected[i] = seen[k]
    assert found == expected


def test_chi2_against_brute_force(spark):
    rng = random.Random(3)
    labels = {d: rng.choice("abc") for d in range(60)}
    rows = [(d, labels[d], f"t{rng.randint(0, 9)}", rng.randint(1, 4)) for d in labels for _ in range(3)]
    merged = {}
    for d, c, t, n in rows:
        merged[d, c, t] = merged.get((d, c, t), 0) + n
    tf = spark.createDataFrame([(*k, n) for k, n in merged.items()], "doc_id int, label string, term string, n long")
    sizes = {c: sum(v == c for v in labels.values()) for c in "abc"}
    found = {r.term: r.score for r in B.chi2_scores(B.class_term_sums(tf, list(sizes)), sizes).collect()}
    for term, score in found.items():
        total = sum(n for (_, _, t), n in merged.items() if t == term)
        expected = 0.0
        for c in "abc":
            seen = sum(n for (_, k, t), n in merged.items() if t == term and k == c)
            share = total * sizes[c] / 60
            expected += (seen - share) ** 2 / share
        assert score == pytest.approx(expected, abs=1e-6)


def test_equal_scores_keep_the_later_term(spark):
    scores = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 1.0)], "term string, score double")
    assert [r.term for r in B.ranked_best_terms(scores, 2).orderBy("rank").collect()] == ["b", "c"]
    assert B.best_terms(scores, 150).count() == 3


def test_tfidf_rows_have_unit_length(spark):
    rows = [(d, [f"w{(d * k) % 7}" for k in range(1, 9)]) for d in range(20)]
    docs = spark.createDataFrame(rows, "doc_id int, terms array<string>")
    weights, _ = W.tfidf(docs, TextSettings(min_df=2, max_df=1.0))
    assert all(r.norm == pytest.approx(1.0) for r in W.norms(weights).collect())


@pytest.fixture
def vectors(spark):
    return spark.createDataFrame([("uno", [1.0, 0.0]), ("dos", [0.0, 4.0])], "word string, vec array<float>")


DOCS = [(1, "Uno dos UNO"), (2, "nada"), (3, ""), (4, "dos de dos desconocida")]


@pytest.mark.parametrize("limit", [M.BROADCAST_BYTES, 0])
def test_mean_embedding(spark, vectors, limit):
    docs = spark.createDataFrame([*DOCS, (4, "dos")], "doc_id int, text string")
    bags = M.word_bags(docs, ["de"])
    found = {(r.doc_id, r.known): r.vec for r in M.document_vectors(bags, vectors, limit=limit).collect()}
    assert found.pop((1, 3)) == pytest.approx([2 / 3, 4 / 3])
    assert found == {(2, 0): [0.0, 0.0], (3, 0): [0.0, 0.0], (4, 2): [0.0, 4.0], (4, 1): [0.0, 4.0]}
    cover = sorted(map(tuple, M.coverage(bags, vectors, 2).collect()))
    assert cover == [(1, 3, 3), (2, 1, 0), (3, 0, 0), (4, 1, 1), (4, 3, 2)]


def test_mean_embedding_in_pieces(spark, monkeypatch):
    """More cells and rows than are added up at a time; one aggregate at most in either plan."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(40)]
    table = {w: [rng.random() for _ in range(3)] for w in words}
    vectors = spark.createDataFrame(list(table.items()), "word string, vec array<float>")
    rows = [(d, [rng.choice([*words, "none"]) for _ in range(rng.choice([0, 1, 5, 300]))]) for d in range(50)]
    docs = spark.createDataFrame([(d, " ".join(w)) for d, w in rows], "doc_id int, text string").repartition(2)
    average = M.document_vectors

    expected = {}
    for d, own in rows:
        known = [w for w in own if w in table]
        expected[d] = [sum(table[w][k] for w in known) / max(1, len(known)) for k in range(3)]
    for limit in (M.BROADCAST_BYTES, 0):
        placed = average(M.word_bags(docs), vectors, limit=limit)
        found = {r.doc_id: r.vec for r in placed.collect()}
        assert all(found[d] == pytest.approx(v, abs=1e-5) for d, v in expected.items())
        plan = placed._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate") == (0 if limit else 1)


def test_mean_embedding_with_frequent_words_in_memory(spark):
    """Only cells of words that do not fit are joined; the means are those of all words."""
    docs = spark.createDataFrame([(d, "uno dos " * (d % 3) + f"solo{d} solo{d}") for d in range(30)], "doc_id int, text string")
    table = [("uno", [1.0, 0.0]), ("dos", [0.0, 4.0]), *[(f"solo{d}", [float(d), 1.0]) for d in range(0, 30, 2)]]
    vectors = spark.createDataFrame(table, "word string, vec array<float>")
    bags = M.word_bags(docs)
    whole, split = ({r.doc_id: (r.known, r.vec) for r in M.document_vectors(bags, vectors, limit=limit).collect()} for limit in (M.BROADCAST_BYTES, 5 * (4 * 2 + 64)))
    assert split.keys() == whole.keys() and all(split[d][0] == whole[d][0] and split[d][1] == pytest.approx(whole[d][1]) for d in whole)
    numbered = bags.withColumn("_row", F.col("doc_id").cast("long"))
    rest = B.other_terms(numbered, pa.array(["uno", "dos"])).collect()
    assert sorted((r._row, r.term, r.n) for r in rest) == sorted((d, f"solo{d}", 2) for d in range(30))


def test_mean_embedding_transformer(spark, vectors):
    docs = spark.createDataFrame([(1, "Uno dos UNO", "a"), (4, "dos de dos desconocida", "b"), (4, None, "c")], "doc_id int, text string, row string")
    stage = M.MeanEmbedding(vectors=vectors, stopwords=["de"])
    placed = stage.fit_transform(docs)
    assert placed.columns == ["doc_id", "text", "row", "vec"]
    assert {r.row: r.vec for r in placed.collect()}["b"] == [0.0, 4.0]
    path = work_path(spark, "pipeline")
    PipelineModel([stage]).write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].uid == stage.uid and again.stages[0].getOrDefault("stopwords") == ["de"]
    assert sorted(map(str, again.transform(docs).collect())) == sorted(map(str, placed.collect()))


def test_accented_stopword_survives(spark):
    docs = spark.createDataFrame([(1, "qué que")], "doc_id int, text string")
    assert [r.word for r in M.word_counts(M.word_bags(docs, ["que"])).collect()] == ["qué"]


@pytest.mark.parametrize("limit", [B.LOOKUP_BYTES, 0])
def test_vocabulary_positions(spark, limit):
    docs = spark.createDataFrame([(1, ["b", "a", "b", "z"]), (2, []), (3, ["c"])], "doc_id int, terms array<string>")
    terms = B.vocabulary(spark.createDataFrame([("a",), ("b",), ("c",)], "term string"))
    found = B.bag_positions(B.bags_of(docs), terms, limit=limit).where("size(idx) > 0")
    assert sorted(map(tuple, found.collect())) == [(1, [0, 1], [1, 2]), (3, [2], [1])]


def test_terms_with_a_long_common_beginning_are_spread(spark):
    terms = spark.range(4_000).select(F.concat(F.lit("https://www.example.com/"), F.lpad("id", 6, "0")).alias("term"), F.lit(1).alias("df"))
    parts = O.ranged(terms.repartition(4), ["term"])
    sizes = sorted(r["count"] for r in parts.groupBy(O.PART).count().collect())
    assert len(sizes) >= 8 and sizes[-1] < 1_500
    found = B.vocabulary(terms).orderBy("term").select("idx").collect()
    assert [r.idx for r in found] == list(range(4_000))


def test_vector_file(spark, tmp_path):
    (tmp_path / "v.txt").write_text("2 2\nuno 1 2\ndos 3 4\nuno 5 6\n")
    found = {r.word: r.vec for r in read_vectors(spark, str(tmp_path / "v.txt")).collect()}
    assert found["uno"] == [5.0, 6.0] and found["dos"] == [3.0, 4.0]
    (tmp_path / "one.txt").write_text("uno 1.5\ndos 2\n\n")
    assert {r.word: r.vec for r in read_vectors(spark, str(tmp_path / "one.txt")).collect()} == {"uno": [1.5], "dos": [2.0]}
    (tmp_path / "bad.txt").write_text("uno 1 2\ndos 3\n")
    with pytest.raises(Exception, match="a vector of 2 numbers"):
        read_vectors(spark, str(tmp_path / "bad.txt")).collect()
    (tmp_path / "none.txt").write_text("")
    assert read_vectors(spark, str(tmp_path / "none.txt")).count() == 0
    rows = spark.createDataFrame([("a", [1.0], 1), ("a", [2.0], 2)], "word string, vec array<float>, n int")
    assert last_vectors(rows, "n").first()["vec"] == [2.0]


def test_arrays_of_many_tasks_are_added_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(K, "FAN_IN", 3)
    monkeypatch.setattr(K, "DRIVER_BYTES", 8 * 6 * 2)
    rows = spark.range(0, 200, 1, 40)

    def partial(batches):
        total = np.zeros((2, 3))
        for batch in batches:
            for k in batch.column(0).to_pylist():
                total[k % 2, k % 3] += k
        return total

    expected = np.zeros((2, 3))
    for k in range(200):
        expected[k % 2, k % 3] += k
    assert (K.total_of(rows, partial, (2, 3)) == expected).all()


def test_texts_are_analysed_once_for_two_uses(spark, tmp_path):
    """What reads the counts twice reads them from a table: its plan holds no tokens."""
    rows = [(d, "uno dos tres" if d % 2 else "dos tres cuatro", "es" if d % 3 else "fr") for d in range(12)] + [(12, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for query in (Q.bow_tf, Q.selected_tf):
        found = query(spark, str(tmp_path))
        assert "regexp_extract_all" not in found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() > 0


def test_equal_lines_are_trimmed_once(spark, tmp_path):
    spark.createDataFrame([(" Sol ",), (" Sol ",), ("sol",), ("  ",), ("Mar",)], "value string").write.text(f"{tmp_path}/words")
    found = read_words(spark, f"{tmp_path}/words")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2
    assert sorted(r.word for r in found.collect()) == ["mar", "sol"]
