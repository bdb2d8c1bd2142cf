"""Islands, elements, visible text, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.functions import html as H
from newsmine.operators import extract as E
from newsmine.plans import fixtures as X
from newsmine.plans.registry import query

SITE = X.SITE
_WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _trim(text: str) -> str:
    return f"regexp_replace({text}, '^{_WS}+|{_WS}+$', '', 'g')"


# What the derived article pages hold, stated from the documents themselves.
_EXPECTED = f"""
WITH base AS (
  SELECT doc_id, lang AS label, text, list_transform(string_split(text, chr(10)), lambda p: {_trim('p')}) AS par,
    strftime(DATE '2026-01-01' + CAST(doc_id % 90 AS INTEGER), '%Y-%m-%d') || 'T10:00:00Z' AS stamp FROM documents),
elements AS (
  SELECT *, list_concat(['Titular ' || doc_id, ''], par, ['uno ' || doc_id || ' año €', '']) AS el FROM base),
texts AS (
  SELECT *, array_to_string(list_filter(el, lambda e: e <> ''), ' ') AS island,
    CASE WHEN doc_id % 2 = 0 THEN {_trim("repeat('relleno ', 25)")} || ' ' ELSE '' END || {_trim('text')} AS visible FROM elements),
docs AS (
  SELECT doc_id, label, CASE WHEN length(island) >= 200 THEN island WHEN length(visible) >= 200 THEN visible END AS text,
    CASE WHEN doc_id % 3 = 2 AND doc_id % 5 = 0 THEN '' ELSE stamp END AS pub_date, el, island FROM texts)
"""

# Visible text of the raw pages: the same steps in another engine's functions.
_BLOCK = "|".join(
    rf"<{t}[\s/>].*?</{t}\s*>" for t in ("script", "style", "nav", "aside", "header", "footer")
)
_VISIBLE = f"""
WITH bare AS (
  SELECT page_id, regexp_extract(url, '//[^/]+/([a-z]+)', 1) AS label,
    regexp_replace(regexp_replace(html, '(?is){_BLOCK}', '<br>', 'g'), '(?s)<!--.*?-->', '<br>', 'g') AS h FROM pages),
inner_html AS (
  SELECT page_id, label, regexp_extract(h, '(?is)<article[^>]*>(.*?)</article>', 1) AS a FROM bare),
nodes AS (
  SELECT page_id, label, list_transform(regexp_split_to_array(a, '<[a-zA-Z/!?][^>]*>'), lambda n:
    {_trim("replace(replace(replace(replace(n, '&middot;', chr(183)), '&copy;', chr(169)), '&quot;', chr(34)), '&amp;', '&')")}) AS l
  FROM inner_html),
visible AS (
  SELECT page_id, label, array_to_string(list_filter(l, lambda n: n <> ''), ' ') AS text FROM nodes)
"""


def _islands(spark: SparkSession, sf: str) -> DataFrame:
    pages = X.article_pages(spark, sf)
    return pages.select("doc_id", H.island(F.col("html"), SITE).alias("data"))


@query("json_island_text", _EXPECTED + "SELECT doc_id, island AS text FROM docs")
def json_island_text(spark: SparkSession, sf: str) -> DataFrame:
    return _islands(spark, sf).select("doc_id", H.island_text(F.col("data")).alias("text"))


@query("json_island_date", _EXPECTED + "SELECT doc_id, pub_date FROM docs")
def json_island_date(spark: SparkSession, sf: str) -> DataFrame:
    pages = X.article_pages(spark, sf)
    html = F.col("html")
    return pages.select(
        "doc_id", H.publication_date(html, H.island(html, SITE), SITE).alias("pub_date")
    )


@query(
    "element_text",
    _EXPECTED
    + "SELECT doc_id, CAST(unnest(range(0, len(el))) AS INTEGER) AS pos, unnest(el) AS text FROM docs",
)
def element_text(spark: SparkSession, sf: str) -> DataFrame:
    texts = F.transform(F.col("data")["content_elements"], H.element_text)
    return _islands(spark, sf).select("doc_id", F.posexplode(texts).alias("pos", "text"))


@query(
    "extract_docs",
    _EXPECTED + "SELECT doc_id, label, text, pub_date FROM docs WHERE text IS NOT NULL",
)
def extract_docs(spark: SparkSession, sf: str) -> DataFrame:
    return E.documents(X.article_pages(spark, sf), SITE)


@query("rejected_docs", _EXPECTED + "SELECT doc_id, label FROM docs WHERE text IS NULL")
def rejected_docs(spark: SparkSession, sf: str) -> DataFrame:
    return E.rejected(X.article_pages(spark, sf), SITE)


@query(
    "date_range",
    _EXPECTED
    + """SELECT min(pub_date)[1:10] AS first_day, max(pub_date)[1:10] AS last_day FROM docs
WHERE text IS NOT NULL AND pub_date <> ''""",
)
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    return E.date_range(E.documents(X.article_pages(spark, sf), SITE))


@query(
    "visible_text",
    _VISIBLE + "SELECT page_id, CASE WHEN length(text) >= 200 THEN text END AS text FROM visible",
)
def visible_text(spark: SparkSession, sf: str) -> DataFrame:
    return X.raw_pages(spark, sf).select("page_id", H.visible_text(F.col("html"), SITE).alias("text"))


@query(
    "long_documents",
    "SELECT doc_id, length(text) AS chars FROM documents WHERE length(text) >= 200",
)
def long_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.documents(spark, sf, "doc_id", "text")
    chars = F.length("text").cast("long")
    return docs.where(chars >= SITE.min_text_length).select("doc_id", chars.alias("chars"))


@query(
    "extraction_yield",
    _VISIBLE
    + "SELECT label, sum(CASE WHEN length(text) >= 200 THEN 1 ELSE 0 END)::BIGINT AS ok, count(*) AS total FROM visible GROUP BY label",
)
def extraction_yield(spark: SparkSession, sf: str) -> DataFrame:
    return E.extraction_yield(X.raw_pages(spark, sf), SITE)
