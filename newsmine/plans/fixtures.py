"""Sitemaps, responses and article pages derived from the ``documents`` table.

The test tables hold no crawl, so registered queries rebuild one from every
document: what a correct extraction must return is known without parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.session import spread, table

SITE = SiteSettings()
_SECTION_OF = {"es": "economia", "fr": "el-pais", "en": "el-mundo", "de": "sociedad"}


def _every(n: int, then: Column) -> Column:
    return F.when(F.col("doc_id") % n == 0, then)


def _id() -> Column:
    return F.col("doc_id").cast("string")


def _day_path(doc_id: Column) -> Column:
    day = F.date_add(F.lit("2026-01-01").cast("date"), (doc_id % 90).cast("int"))
    return F.date_format(day, "yyyy/MM/dd")


def _article_url(doc_id: Column, more: Column | None = None) -> Column:
    """``more`` lengthens the slug."""
    slug = F.when(doc_id % 5 == 0, "Nota-").otherwise("nota-")
    tail = F.when(doc_id % 4 == 0, "/").otherwise("")
    return F.concat(
        F.lit(f"https://www.{SITE.domain}/"), _day_path(doc_id), F.lit("/"), slug, doc_id.cast("string"),
        F.lit("") if more is None else more, tail,
    )


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    wanted = columns or ("doc_id", "text", "lang")
    return spread(table(spark, sf, "documents").select(*wanted), "doc_id")


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their language as the class."""
    docs = table(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("label"))
    return spread(docs, "doc_id")


def sitemaps(spark: SparkSession, sf: str) -> DataFrame:
    """One sitemap per document: the article and, by number, odd links."""
    docs = table(spark, sf, "documents").select("doc_id")
    url = _article_url(F.col("doc_id"))
    copy = F.concat(
        F.lit(f"https://ajena.example/r/https://www.{SITE.domain}/"),
        _day_path(F.col("doc_id")), F.lit("/copia-"), _id(),
    )
    links = F.array_compact(
        F.array(
            url,
            _every(7, F.concat(F.lit(f"https://www.{SITE.domain}/print/"), _day_path(F.col("doc_id")), F.lit("/nota-"), _id())),
            _every(11, F.concat(url, F.lit("?x=1"))),
            _every(13, url),
            _every(17, copy),
        )
    )
    entries = F.transform(
        links, lambda u: F.concat(F.lit("<url><loc>"), u, F.lit("</loc><lastmod>2026</lastmod></url>"))
    )
    body = F.concat(F.lit('<?xml version="1.0"?><urlset>'), F.array_join(entries, "\n"), F.lit("</urlset>"))
    return docs.select(F.col("doc_id").alias("sitemap_id"), body.alias("body"))


def _escaped(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def _section_value() -> Column:
    known = F.create_map(*[F.lit(x) for pair in _SECTION_OF.items() for x in pair])
    name = F.coalesce(_every(9, F.lit("deportes")), known[F.col("lang")])
    return F.coalesce(_every(3, F.concat(F.lit("  "), F.upper(name), F.lit(" "))), name)


def fetched(spark: SparkSession, sf: str) -> DataFrame:
    """Responses: (seq, url, status, body); some have names that are too long, or bodies of broken bytes."""
    value = _section_value()
    tag = F.when(
        F.col("doc_id") % 4 == 1,
        F.concat(F.lit("<META content='"), value, F.lit(f"' name='{SITE.section_tag}'/>")),
    ).otherwise(F.concat(F.lit(f'<meta name="{SITE.section_tag}" content="'), value, F.lit('">')))
    head = F.concat(F.lit('<html><head><meta charset="utf-8">'), F.coalesce(_every(10, F.lit("")), tag), F.lit("</head>"))
    body = F.concat(head, F.lit("<body><article>"), _escaped(F.col("text")), F.lit("</article></body></html>"))
    repeated = F.col("doc_id") - F.when(F.col("doc_id") % 19 == 0, 1).otherwise(0)
    body = F.when(F.col("doc_id") % 31 == 4, F.concat(body, F.unhex(F.lit("C3")).cast("string"))).otherwise(body)
    number = F.when(F.col("doc_id") > 0, repeated).otherwise(F.col("doc_id"))
    url = _article_url(number, F.when(number % 29 == 3, F.repeat(F.lit("-x"), 150)).otherwise(""))
    status = (
        F.when(F.col("doc_id") % 20 == 0, 404)
        .when(F.col("doc_id") % 20 == 1, 403)
        .when(F.col("doc_id") % 20 == 2, 500)
        .otherwise(200)
    )
    return documents(spark, sf).select(
        F.col("doc_id").alias("seq"),
        F.coalesce(_every(23, F.concat(url, F.lit("?x=1"))), url).alias("url"),
        status.alias("status"),
        body.alias("body"),
    )


def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, label, html) whose text and date sit in a JSON island or in the markup."""
    text_parts = F.split(F.col("text"), "\n", -1)

    def element(kind: str, content: Column, level: Column | None = None, items: Column | None = None) -> Column:
        no_items = F.lit(None).cast("array<struct<type:string,content:string>>")
        return F.struct(
            F.lit(kind).alias("type"),
            content.cast("string").alias("content"),
            (level if level is not None else F.lit(None)).cast("int").alias("level"),
            (items if items is not None else no_items).alias("items"),
        )

    def item(kind: str, content: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), content.cast("string").alias("content"))

    paragraphs = F.transform(
        text_parts, lambda p: element("text", F.concat(F.lit("<p><b>"), _escaped(p), F.lit("</b></p>")))
    )
    items = F.array(
        item("text", F.concat(F.lit("uno&nbsp;<i>"), _id(), F.lit("</i>"))),
        item("image", F.lit("foto")),
        item("text", F.lit(None)),
        item("text", F.lit("a&ntilde;o &#8364;")),
    )
    elements = F.concat(
        F.array(element("header", F.concat(F.lit("Titular "), _id()), F.lit(2)), element("header", F.lit("Relacionado"))),
        paragraphs,
        F.array(element("list", F.lit(None), items=items), element("image", F.lit("pie de foto"))),
    )
    third = F.col("doc_id") % 3
    stamp = F.concat(F.replace(_day_path(F.col("doc_id")), F.lit("/"), F.lit("-")), F.lit("T10:00:00Z"))
    data = F.struct(
        F.when(third == 0, stamp).otherwise("").alias("display_date"),
        F.when(third == 1, stamp).alias("first_publish_date"),
        elements.alias("content_elements"),
    )
    times = (
        F.when((third == 2) & (F.col("doc_id") % 5 == 0), "")
        .when(F.col("doc_id") % 2 == 0, F.concat(F.lit('<time datetime="'), stamp, F.lit('">hoy</time>')))
        .otherwise(F.concat(F.lit('<time>x</time><div class="a p12Date"><div><time> '), stamp, F.lit(" </time></div></div>")))
    )
    script = F.concat(
        F.lit(f'<script>var nav="<article>";{SITE.island_marker}'), F.to_json(data), F.lit(f';{SITE.island_marker}{{}};</script>')
    )
    article = F.concat(
        F.lit('<div class="article-wrapper"><div>corto</div></div><article><nav>menu</nav><div>'),
        F.when(F.col("doc_id") % 2 == 0, F.repeat(F.lit("relleno "), 25)).otherwise(""),
        F.lit("</div><p>"), _escaped(F.col("text")), F.lit("</p></article>"),
    )
    html = F.concat(F.lit("<html><body>"), times, script, article, F.lit("</body></html>"))
    return documents(spark, sf).select("doc_id", F.col("lang").alias("label"), html.alias("html"))


def raw_pages(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, label, html) of the ``pages`` table; the class is the first path part."""
    pages = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("url", "//[^/]+/([a-z]+)", 1).alias("label"), "html"
    )
    return spread(pages, "page_id")
