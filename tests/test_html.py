import time
import pytest
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.functions import html as H
from newsmine.operators import extract as E

SITE = SiteSettings()
MARK = SITE.island_marker


def one(spark, html, expression):
    row = spark.createDataFrame([(html,)], "html string").select(expression(F.col("html")).alias("x"))
    return row.first()["x"]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("a&amp;lt; &aacute;&#243;&#xF1;&#150;&zzz;", "a&lt; áóñ–&zzz;"),
        ("<p>a</p> \n<b> b  c </b><!-- <i>no</i> -->&nbsp;", "a b  c"),
        ("1 < 2 <br>3", "1 < 2 3"),
        ("&#0;&#xD800;&#1114112;", "���"),
        ("&#0000000000243;&#x00000000F3;&#99999999999999999999;&#xFFFFFFFFFFFFFFFFFFFF;", "óó��"),
        ("&period;&aacute &notit;&#243 &NotEqualTilde;", ".á ¬it;ó ≂̸"),
        ("", ""),
    ],
)
def test_fragment_text(spark, html, expected):
    assert one(spark, html, H.fragment_text) == expected


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>none</p>", None),
        ('<meta name="p12:section" content=""><meta name="p12:section" content="x">', None),
        ("<META content=' El-Pais ' name='p12:section'/>", "el-pais"),
        ('<meta name="other" content="a"><meta name="p12:section" content="a>b">', "a>b"),
        ('<!-- <meta name="p12:section" content="x"> -->', None),
        ('<script>s = \'<meta name="p12:section" content="x">\'</script><meta name="p12:section" content="y">', "y"),
    ],
)
def test_section(spark, html, expected):
    assert one(spark, html, lambda c: H.section(c, SITE)) == expected


@pytest.mark.parametrize("length, kept", [(199, False), (200, True)])
def test_visible_text_minimum(spark, length, kept):
    html = f"<nav>menu</nav><article><script>x</script>{'q' * length}</article>"
    assert one(spark, html, lambda c: H.visible_text(c, SITE)) == ("q" * length if kept else None)


def test_wrapper_wins_and_balances(spark):
    inner = "<div>a<div>b</div></div>" + "c" * 200
    html = f'<article>{"z" * 300}</article><div class="x article-wrapper y">{inner}</div>zz</div>'
    assert one(spark, html, lambda c: H.visible_text(c, SITE)) == "a b " + "c" * 200


@pytest.mark.parametrize(
    "html",
    [
        "no marker",
        f'{MARK} {{"display_date":"x"}}',
        f'{MARK}[{{"display_date":"x"}}]',
        f'{MARK}{{"display_date":"x","content_el',
        f"{MARK}{{}}",
    ],
)
def test_no_island(spark, html):
    assert one(spark, html, lambda c: H.island(c, SITE)) is None


def test_island_elements(spark):
    html = MARK + (
        '{"content_elements":[{"type":"text","content":"<p>uno &amp; dos</p>"},{"type":"text"},'
        '{"type":"header","content":"no"},{"type":"header","level":2,"content":"tres"},'
        '{"type":"list","items":[{"type":"text","content":"a"},{"type":"x","content":"b"},{"type":"text"}]},'
        '{"type":"image","content":"no"}]};' + MARK + '{"display_date":"2"}'
    )
    assert one(spark, html, lambda c: H.island_text(H.island(c, SITE))) == "uno & dos tres a"


def test_null_elements_give_no_text(spark):
    html = f'{MARK}{{"display_date":"d","content_elements":null}}<article>{"q" * 200}</article>'
    pages = spark.createDataFrame([(1, html)], "doc_id int, html string")
    assert E.documents(pages, SITE).collect() == [(1, "q" * 200, "d")]


@pytest.mark.parametrize(
    "html, expected",
    [
        (f'{MARK}{{"display_date":"a","first_publish_date":"b"}}', "a"),
        (f'{MARK}{{"display_date":"","first_publish_date":"b"}}', "b"),
        ('<time>n</time><time datetime="c">x</time>', "c"),
        ('<time>n</time><div class="p12Date"><time> 3 <b>mar</b></time></div><time datetime="c"/>', "3mar"),
        ('<time datetime="c">x</time><div class="p12Date"><time>d</time></div>', "c"),
        ("<time>n</time>", ""),
        ('<!-- <time datetime="1999"> --><script>"<time datetime=1998>"</script><time datetime="2026">', "2026"),
        ('<div class="p12Date">x</div><div class="p12Date"><time>e</time></div>', "e"),
        ('<div class="p12Date">x</div><time datetime="c"/><div class="p12Date"><time>e</time></div>', "c"),
    ],
)
def test_publication_date(spark, html, expected):
    found = one(spark, html, lambda c: H.publication_date(c, H.island(c, SITE), SITE))
    assert found == expected


def test_rejected_and_kept_cover_all(spark):
    pages = spark.createDataFrame([(1, "x"), (2, f"<article>{'q' * 200}</article>")], "doc_id int, html string")
    assert [r.doc_id for r in E.rejected(pages, SITE).collect()] == [1]
    assert [r.doc_id for r in E.documents(pages, SITE).collect()] == [2]


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<!-- <script> -->a<script>b</script>c", "a c"),
        ("<script>'<!--'</script>a<!-- b -->c", "a c"),
        ("<nav>a<nav>b</nav>TAIL</nav>c", "c"),
        ("<nav>a<aside>b<nav>c</nav></aside><nav>d</nav>e</NAV >f</nav>", "f"),
        ("<nav>a<header>b</header>c", "a c"),
        ("<nav>" + "x <b>y</b> " * 50000 + "</nav>z", "z"),
    ],
)
def test_blocks_without_article_text(spark, html, expected):
    assert one(spark, html, lambda c: H.fragment_text(H.without_layout(H.seen(c)))) == expected


def test_unclosed_layout_blocks_cost_one_idle_round(spark):
    """Hundreds of openings without an end: the page is rewritten as often as closed blocks nest, and once more."""
    page = "<nav>" * 600 + "<article><header><nav>menu</nav></header>" + "palabra " * 60 + "</article>" + "relleno " * 20_000
    docs = spark.createDataFrame([(page,)] * 4, "html string")
    started = time.time()
    (text,) = {r[0] for r in docs.select(H.visible_text(F.col("html"), SITE)).collect()}
    assert text == ("palabra " * 60).strip() and time.time() - started < 20
