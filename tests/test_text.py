import unicodedata

from pyspark.sql import functions as F

from newsmine.functions import text as T
from newsmine.functions.stem import stem_map, stem_word
from newsmine.operators import bow as B


def column(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    found = rows.select("i", expression(F.col("text")).alias("x")).orderBy("i").collect()
    return [r["x"] for r in found]


def test_strip_accents_matches_decomposition(spark):
    words = ["año", "AÑO", "ª", "m²", "ﬁn", "über", "½", "plain", "é", "ĳ", "naïve ™", "№5", "日本"]
    plain = [
        "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))
        for w in words
    ]
    assert column(spark, words, T.strip_accents) == plain


def test_tokens(spark):
    texts = ["", "a", "1abc", "uno dos3", "mètre", "él y ella"]
    assert column(spark, texts, T.tokens) == [[], [], ["abc"], ["uno", "dos3"], ["tre"], ["él", "ella"]]


def test_strip_all_white_space(spark):
    assert column(spark, ["  x y　\n", " "], T.strip) == ["x y", ""]


def test_pairs_span_removed_stopwords(spark):
    texts = ["", "uno", "casa de campo", "casa campo sol"]
    found = column(spark, texts, lambda c: T.analyse(c, ["de"], (1, 2)))
    assert found == [
        [],
        ["uno"],
        ["casa", "campo", "casa campo"],
        ["casa", "campo", "sol", "casa campo", "campo sol"],
    ]


def test_trigrams(spark):
    assert column(spark, ["uno dos tres cuatro"], lambda c: T.analyse(c, (), (3, 3))) == [
        ["uno dos tres", "dos tres cuatro"]
    ]


def test_pluggable_tokenizer(spark):
    split = T.token_udf(lambda t: t.split("-"))
    assert column(spark, ["A-b", None], lambda c: T.analyse(c, (), (1, 1), tokenizer=split)) == [["a", "b"], []]
    assert column(spark, ["x1 y2"], lambda c: T.tokens(c, "[0-9]")) == [["1", "2"]]


def test_bag_counts_runs(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b", "b"]), (2, [])], "doc_id int, terms array<string>")
    found = {(r.doc_id, r.term): r.n for r in B.term_counts(rows).collect()}
    assert found == {(1, "a"): 1, (1, "b"): 3}


def test_stems():
    known = {
        "chicas": "chic", "torneos": "torne", "toreado": "tor", "tornado": "torn", "toquen": "toqu",
        "checar": "chec", "cheque": "chequ", "chihuahua": "chihuahu", "torcida": "torc",
        "rápidamente": "rapid", "lógicas": "logic", "haciéndola": "hac", "naciones": "nacion",
    }
    assert {w: stem_word(w) for w in known} == known


def test_stem_map_is_over_distinct_terms(spark):
    words = spark.createDataFrame([("chicas",), ("chicas",), ("toro",)], "term string")
    assert sorted(map(tuple, stem_map(words).collect())) == [("chicas", "chic"), ("toro", "tor")]
