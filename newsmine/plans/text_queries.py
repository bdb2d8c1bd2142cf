"""Tokens, counts, vocabulary, chi-squared, weights, previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import COUNT_TEXT, TFIDF_TEXT, TextSettings
from newsmine.functions import text as T
from newsmine.functions.stopwords import spanish_stopwords
from newsmine.operators import bow as B
from newsmine.operators import counting as C
from newsmine.operators import report as R
from newsmine.operators import sinks as K
from newsmine.operators import tfidf as W
from newsmine.plans import fixtures as X
from newsmine.plans.registry import query
from newsmine.session import cut, shuffles_deleted, work_path, written
from newsmine.sources.tables import labelled_pages, load_dataset, write_labelled_pages
from newsmine.sources.words import read_words

STOP = spanish_stopwords()
_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
_RE = T.TOKEN_PATTERN

_WORDS = f"""
WITH words AS (
  SELECT doc_id, lang AS label, regexp_extract_all(strip_accents(lower(text)), '{_RE}') AS raw FROM documents),
kept AS (SELECT doc_id, label, list_filter(raw, lambda w: w NOT IN {_STOP_SQL}) AS w FROM words)
"""

_COUNTS = (
    _WORDS
    + """,
terms AS (
  SELECT doc_id, label, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM kept),
tf AS (SELECT doc_id, label, term, count(*) AS n FROM terms GROUP BY ALL),
vocab AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
  HAVING count(*) >= 3 AND count(*) <= 0.8::DOUBLE * (SELECT count(*) FROM documents)),
pruned AS (SELECT doc_id, label, term, n FROM tf SEMI JOIN vocab USING (term))
"""
)

_CHI2 = (
    _COUNTS
    + """,
prior AS (SELECT lang AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS p FROM documents GROUP BY lang),
totals AS (SELECT term, sum(n)::DOUBLE AS t FROM pruned GROUP BY term),
seen AS (SELECT term, label, sum(n)::DOUBLE AS o FROM pruned GROUP BY ALL),
cells AS (
  SELECT t.term, coalesce(s.o, 0) AS o, p.p * t.t AS e FROM totals t CROSS JOIN prior p
  LEFT JOIN seen s ON s.term = t.term AND s.label = p.label),
scores AS (SELECT term, round(sum((o - e) * (o - e) / e), 6) AS score FROM cells GROUP BY term),
best AS (SELECT term, score, row_number() OVER (ORDER BY score DESC, term DESC) AS rank FROM scores)
"""
)

_TFIDF = (
    _WORDS
    + """,
tf AS (SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(w) AS term FROM kept) GROUP BY ALL),
vocab AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
  HAVING count(*) >= 2 AND count(*) <= 0.9::DOUBLE * (SELECT count(*) FROM documents)),
raw AS (
  SELECT doc_id, term, n * (ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS x
  FROM tf JOIN vocab USING (term)),
norms AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM raw GROUP BY doc_id)
"""
)


def _terms(spark: SparkSession, sf: str, settings=COUNT_TEXT) -> DataFrame:
    return B.with_terms(X.labelled(spark, sf), STOP, settings)


def _tf(spark: SparkSession, sf: str, once: bool = False) -> DataFrame:
    """Counts of all terms; ``once`` for callers that read them more than once: the texts are analysed once and their bags written."""
    keep = ("doc_id", "label")
    if not once:
        return B.term_counts(_terms(spark, sf), keep)
    return written(B.bags_of(_terms(spark, sf), keep), "bags").select(*keep, F.inline("bag"))


def _grouped(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    """Counts of all terms, added up inside the tasks by ``keys``."""
    return C.grouped_counts(X.labelled(spark, sf), keys, STOP)


def _vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return B.pruned_terms(_grouped(spark, sf), X.table(spark, sf, "documents").count())


def _pruned(spark: SparkSession, sf: str, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Counts of the vocabulary's terms, which are read ``once`` or more, and the vocabulary: no count per document is written or shuffled."""
    with shuffles_deleted(spark):
        terms = written(_vocabulary(spark, sf), "vocabulary")
    tf = C.vocabulary_counts(X.labelled(spark, sf), terms, ("doc_id", "label"), STOP, once=once)
    return B.restrict(_tf(spark, sf, once=True), terms) if tf is None else tf, terms


@query("tokens", _WORDS + "SELECT token, count(*) AS n FROM (SELECT unnest(raw) AS token FROM words) GROUP BY token")
def tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.labelled(spark, sf)
    words = T.tokens(T.let(F.lower("text"), T.strip_accents))
    return docs.select(F.explode(words).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query(
    "tokens_raw_case",
    f"""SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '{_RE}')) AS token FROM documents)
GROUP BY token""",
)
def tokens_raw_case(spark: SparkSession, sf: str) -> DataFrame:
    words = X.labelled(spark, sf).select(F.explode(T.tokens(F.col("text"))).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n"))


@query("stopword_filter", _WORDS + "SELECT doc_id, len(raw)::BIGINT AS before, len(w)::BIGINT AS after, array_to_string(w, ' ') AS kept FROM words JOIN kept USING (doc_id)")
def stopword_filter(spark: SparkSession, sf: str) -> DataFrame:
    words = X.labelled(spark, sf).select(
        "doc_id", T.tokens(T.let(F.lower("text"), T.strip_accents)).alias("raw")
    )
    kept = words.select("doc_id", "raw", T.without(F.col("raw"), STOP).alias("w"))
    return kept.select(
        "doc_id",
        F.size("raw").cast("long").alias("before"),
        F.size("w").cast("long").alias("after"),
        F.array_join("w", " ").alias("kept"),
    )


@query(
    "bigrams",
    _WORDS
    + """SELECT pair, count(*) AS n FROM (
  SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pair FROM kept) GROUP BY pair""",
)
def bigrams(spark: SparkSession, sf: str) -> DataFrame:
    words = T.analyse(F.col("text"), STOP, (2, 2))
    pairs = X.labelled(spark, sf).select(F.explode(words).alias("pair"))
    return pairs.groupBy("pair").agg(F.count("*").alias("n"))


@query("bow_tf", _COUNTS + "SELECT doc_id, label, term, n FROM pruned")
def bow_tf(spark: SparkSession, sf: str) -> DataFrame:
    return _pruned(spark, sf)[0]


@query("bow_vocab", _COUNTS + "SELECT term, df, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab")
def bow_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return B.vocabulary(_vocabulary(spark, sf))


@query(
    "bow_shape",
    _COUNTS
    + """SELECT (SELECT count(*) FROM documents) AS n_docs, count(DISTINCT term) AS n_terms, count(*) AS nnz,
count(*) / (count(DISTINCT term) * (SELECT count(*) FROM documents)::DOUBLE) AS density FROM pruned""",
)
def bow_shape(spark: SparkSession, sf: str) -> DataFrame:
    n_docs = X.table(spark, sf, "documents").count()
    return B.shape(B.pruned_terms(_grouped(spark, sf), n_docs), n_docs)


def _scores(spark: SparkSession, sf: str, tf: DataFrame | None = None) -> DataFrame:
    sizes = B.sizes_by_class(X.labelled(spark, sf))
    sums = B.class_term_sums(_grouped(spark, sf, "label") if tf is None else tf, list(sizes))
    return B.chi2_scores(sums.where(B.df_bounds(sum(sizes.values()), COUNT_TEXT)), sizes)


@query("chi2_scores", _CHI2 + "SELECT term, score FROM scores")
def chi2_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _scores(spark, sf).select("term", "score")


@query("chi2_top150", _CHI2 + "SELECT rank, term, score FROM best WHERE rank <= 150")
def chi2_top150(spark: SparkSession, sf: str) -> DataFrame:
    return B.ranked_best_terms(_scores(spark, sf), 150).select("rank", "term", "score")


@query("selected_tf", _CHI2 + "SELECT doc_id, label, term, n FROM tf SEMI JOIN (SELECT term FROM best WHERE rank <= 150) USING (term)")
def selected_tf(spark: SparkSession, sf: str) -> DataFrame:
    tf = _tf(spark, sf, once=True)
    best = B.best_terms(_scores(spark, sf, tf), 150)
    return B.restrict(tf, F.broadcast(best))


@query(
    "tfidf_weights",
    _TFIDF + "SELECT doc_id, term, round(x / norm, 6) AS w FROM raw JOIN norms USING (doc_id)",
)
def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = W.tfidf(_terms(spark, sf, TFIDF_TEXT), TFIDF_TEXT)[0]
    return weights.select("doc_id", "term", F.round("w", 6).alias("w"))


@query("tfidf_norms", _TFIDF + "SELECT doc_id, round(norm, 6) AS norm FROM norms")
def tfidf_norms(spark: SparkSession, sf: str) -> DataFrame:
    weights = W.tfidf(_terms(spark, sf, TFIDF_TEXT), TFIDF_TEXT, normalise=False)[0]
    return W.norms(weights).select("doc_id", F.round("norm", 6).alias("norm"))


@query("idf_table", _TFIDF + "SELECT term, df, round(ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE, 6) AS idf FROM vocab")
def idf_table(spark: SparkSession, sf: str) -> DataFrame:
    idf = W.tfidf(_terms(spark, sf, TFIDF_TEXT), TFIDF_TEXT)[1]
    return idf.select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "dataset_tables",
    _COUNTS
    + """SELECT 'docs' AS name, (SELECT count(*) FROM documents) AS n_rows, (SELECT sum(length(text))::BIGINT FROM documents) AS total
UNION ALL SELECT 'vocab', count(*), sum(df)::BIGINT FROM vocab UNION ALL SELECT 'tf', count(*), sum(n)::BIGINT FROM pruned""",
)
def dataset_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, vocabulary and counts, written and read back."""
    tf, terms = _pruned(spark, sf, once=True)
    folder = work_path(spark, "dataset")
    K.write_dataset(_dated(spark, sf), B.vocabulary(terms), tf, folder)
    tables = load_dataset(spark, folder, ("docs", "vocab", "tf"))
    measures = {"docs": F.length("text"), "vocab": F.col("df"), "tf": F.col("n")}
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("n_rows"), F.sum(m).alias("total")).select(
            F.lit(name).alias("name"), "n_rows", "total"
        )
        for name, m in measures.items()
    ]
    return R.compare_models(parts)


@query("label_totals", "SELECT lang AS label, count(*) AS n FROM documents GROUP BY lang")
def label_totals(spark: SparkSession, sf: str) -> DataFrame:
    return R.label_totals(X.table(spark, sf, "documents").select(F.col("lang").alias("label")))


@query("label_index", "SELECT label, (row_number() OVER (ORDER BY label) - 1)::INTEGER AS label_index FROM (SELECT DISTINCT lang AS label FROM documents)")
def label_index(spark: SparkSession, sf: str) -> DataFrame:
    return R.labels(X.table(spark, sf, "documents").select(F.col("lang").alias("label")))


@query(
    "section_counts_zero_filled",
    """SELECT f.section, count(d.doc_id) AS n FROM (SELECT unnest(['en','es','it','pt']) AS section) f
LEFT JOIN documents d ON d.lang = f.section GROUP BY f.section""",
)
def section_counts_zero_filled(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.table(spark, sf, "documents")
    return R.section_counts(docs, ("en", "es", "it", "pt"), "lang")


_DAY = "CASE WHEN doc_id % 4 = 0 THEN '' ELSE strftime(DATE '2026-01-01' + CAST(doc_id % 90 AS INTEGER), '%Y-%m-%d') || 'T10:00:00Z' END"


def _dated(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 90).cast("int"))
    stamp = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:00:00Z"))
    return X.labelled(spark, sf).withColumn(
        "pub_date", F.when(F.col("doc_id") % 4 == 0, "").otherwise(stamp)
    )


@query(
    "preview_docs",
    f"""SELECT doc_id, lang AS label, ({_DAY})[1:10] AS day, coalesce(nullif({_DAY}, ''), '(sin fecha)') AS published,
length(text) AS chars, text[1:150] AS opening, text AS full_text FROM documents ORDER BY doc_id LIMIT 10""",
)
def preview_docs(spark: SparkSession, sf: str) -> DataFrame:
    return R.preview_docs(_dated(spark, sf))


@query("preview_vocab", _COUNTS + "SELECT (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx, term FROM vocab ORDER BY term LIMIT 10")
def preview_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return R.preview_terms(_vocabulary(spark, sf))


@query(
    "preview_matrix",
    _COUNTS
    + """, rows AS (SELECT doc_id, lang AS label FROM documents ORDER BY doc_id LIMIT 10),
cols AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INTEGER AS idx FROM vocab ORDER BY term LIMIT 10)
SELECT r.doc_id, r.label, c.idx, c.term, coalesce(p.n, 0) AS n FROM rows r CROSS JOIN cols c
LEFT JOIN pruned p ON p.doc_id = r.doc_id AND p.term = c.term""",
)
def preview_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The wide preview, unpivoted so its columns do not depend on the data."""
    docs = X.labelled(spark, sf)
    terms = cut(_vocabulary(spark, sf))
    # Only the texts that are shown are analysed again.
    shown = docs.join(F.broadcast(R.first_docs(docs.select("doc_id"))), "doc_id", "left_semi")
    tf = B.restrict(B.term_counts(B.with_terms(shown, STOP), ("doc_id", "label")), terms)
    wide = R.preview_matrix(docs, tf, terms)
    names = [c for c in wide.columns if c not in ("doc_id", "label")]
    cells = F.array(
        *[
            F.struct(F.lit(i).alias("idx"), F.lit(c).alias("term"), F.col(f"`{c}`").alias("n"))
            for i, c in enumerate(names)
        ]
    )
    return wide.select("doc_id", "label", F.inline(cells))


@query(
    "custom_tokenizer",
    """WITH parts AS (SELECT doc_id, list_filter(string_split_regex(strip_accents(lower(text)), '[^0-9a-z]+'), lambda w: w <> '') AS w FROM documents)
SELECT term, count(*) AS n, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(w) AS term FROM parts) GROUP BY term""",
)
def custom_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    """Counts with a tokenizer of one's own: runs of ASCII letters and digits."""

    def ascii_words(text):
        return F.filter(F.split(text, "[^0-9a-z]+"), lambda w: w != "")

    docs = X.labelled(spark, sf).withColumn("text", F.lower("text"))
    single = TextSettings(ngram_range=(1, 1))
    tf = B.term_counts(B.with_terms(docs, (), single, ascii_words))
    return tf.groupBy("term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df"))


@query(
    "word_list_scan",
    f"SELECT DISTINCT lower(unnest(regexp_extract_all(text, '{_RE}'))) AS word FROM documents",
)
def word_list_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A word list of all documents' words, one per line, in any case and with blanks around, read back."""
    words = X.labelled(spark, sf).select(F.explode(T.tokens(F.col("text"))).alias("word"))
    path = work_path(spark, "words")
    lines = words.withColumn("line", F.concat(F.lit(" \t"), "word", F.lit("  ")))
    lines.select("line").unionByName(lines.select(F.lit("  ").alias("line")).limit(3)).write.text(path)
    return read_words(spark, path)


@query(
    "labelled_page_scan",
    """SELECT lang AS section, text || CASE WHEN doc_id % 31 = 4 THEN chr(65533) ELSE '' END || chr(10) AS html,
CAST(strlen(text) + 1 + CASE WHEN doc_id % 31 = 4 THEN 1 ELSE 0 END AS BIGINT) AS bytes FROM documents""",
)
def labelled_page_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a file of its class's folder, some with a broken byte, read back."""
    base = work_path(spark, "folders")
    broken = F.when(F.col("doc_id") % 31 == 4, F.concat("text", F.unhex(F.lit("C3")).cast("string"))).otherwise(F.col("text"))
    write_labelled_pages(X.labelled(spark, sf).select(broken.cast("binary").alias("value"), F.col("label").alias("section")), base)
    pages = labelled_pages(spark, base, "*.txt")
    return pages.select(F.substring("section", len("section=") + 1, 100).alias("section"), "html", "bytes")
