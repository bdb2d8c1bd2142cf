"""Page to text, date and section, as column expressions.

No DOM is built: tags are located by pattern, and a container ends where its own
tag name balances. Unclosed elements are the known limit.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.functions.text import const_map, let, strip, substitute

_MARKUP = r"(?s)<!--.*?-->|<[a-zA-Z/!?][^>]*>"
# A comment or a block whose content is no markup, whichever starts first.
_UNSEEN = r"(?is)<!--.*?-->|<(script|style)(?=[\s/>]).*?</\1\s*>"
# Other blocks that never hold article text.
_LAYOUT = "nav|aside|header|footer"
_LAYOUT_MARK = rf"(?i)<(/?)(?:{_LAYOUT})(?=[\s/>])"
# A layout block that holds no block of its own name; possessive, so long pages need no deep stack.
_INNERMOST = rf"(?is)<({_LAYOUT})(?=[\s/>])[^>]*>[^<]*+(?:<(?!/?\1[\s/>])[^<]*+)*+</\1\s*>"
_ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{1,31};?)"

_ITEMS = "array<struct<type:string,content:string>>"
ISLAND = (
    "display_date string, first_publish_date string, content_elements "
    f"array<struct<type:string,content:string,level:string,items:{_ITEMS}>>"
)


# ── entities and visible text ─────────────────────────────────────────────────


def _legacy_code_points() -> dict[str, str]:
    """Numeric references 128-159 name Windows-1252 characters."""
    chars = {c: bytes([c]).decode("cp1252", errors="ignore") for c in range(0x80, 0xA0)}
    return {str(code): str(ord(char)) for code, char in chars.items() if char}


def _open_names() -> list[str]:
    """Names that also count without a semicolon, longest first."""
    return sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)


def _named_characters() -> dict[str, str]:
    """All HTML5 names; the common ones come first, as a map is searched in order."""
    rest = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    return {name: html5[name] for name in _open_names()} | rest


def _number_to_char(number: Column) -> Column:
    """``#243`` or ``#xF3`` to its character; impossible numbers to U+FFFD."""

    def value(digits: Column) -> Column:
        # More than seven digits are beyond the last code point in either base.
        known = (
            F.when(digits == "", F.lit("0"))
            .when(F.length(digits) > 7, F.lit(str(0x110000)))
            .when(number.rlike("^#[xX]"), F.conv(digits, 16, 10))
            .otherwise(digits)
        )
        return let(known, lambda k: F.coalesce(const_map(_legacy_code_points())[k], k).cast("long"))

    def char(c: Column) -> Column:
        broken = (c == 0) | c.between(0xD800, 0xDFFF) | (c > 0x10FFFF)
        valid = F.when(broken, F.lit(0xFFFD).cast("long")).otherwise(c)
        return F.decode(F.unhex(F.lpad(F.hex(valid), 8, "0")), "UTF-32")

    return let(let(F.regexp_replace(number, "^#[xX]?0*", ""), value), char)


def _decode_entity(hit: Column) -> Column:
    known = const_map(_named_characters())
    name = F.regexp_replace(F.substring(hit, F.lit(2), F.length(hit)), ";$", "")
    start = F.regexp_extract(hit, f"^&({'|'.join(_open_names())})", 1)
    shorter = let(
        start,
        lambda s: F.when(s != "", F.concat(known[s], F.substring(hit, F.length(s) + 2, F.length(hit)))),
    )
    whole = F.when(name.startswith("#"), _number_to_char(name)).when(hit.endswith(";"), known[name])
    return F.coalesce(whole, shorter, hit)


def unescape(text: Column) -> Column:
    """Character references to characters; unknown names stay as written.

    Without a semicolon the longest name counts that HTML allows to stand without one.
    """
    return F.when(text.contains("&"), substitute(text, _ENTITY, _decode_entity)).otherwise(text)


def text_pieces(fragment: Column) -> Column:
    """Text nodes, decoded and trimmed, empty ones dropped."""
    nodes = F.split(fragment, _MARKUP, -1)
    return F.filter(F.transform(nodes, lambda n: strip(unescape(n))), lambda n: n != "")


def fragment_text(fragment: Column) -> Column:
    """Text nodes joined by one blank; white space inside a node is kept."""
    return F.array_join(text_pieces(fragment), " ")


# ── tags and containers ───────────────────────────────────────────────────────


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in one opening tag; null when it is absent."""
    pattern = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    groups = [F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]
    return F.when(tag.rlike(pattern), unescape(F.concat(*groups)))


def _div_of_class(name: str) -> str:
    return (
        rf"""(?is)<div\s(?:[^>]*\s)?class\s*=\s*(?:"(?:[^"]*\s)?{name}(?:\s[^"]*)?\""""
        rf"""|'(?:[^']*\s)?{name}(?:\s[^']*)?'|{name}(?=[\s>]))[^>]*>"""
    )


def balanced(rest: Column, tag: str) -> Column:
    """What comes before the end of an element whose opening tag stood before ``rest``."""
    same_tag = rf"(?i)<(/?){tag}(?=[\s/>])[^>]*>"
    marks = F.regexp_extract_all(rest, F.lit(same_tag), F.lit(1))
    start = F.struct(F.lit(1).alias("depth"), F.lit(1).alias("kept"))

    def walk(state: Column, mark: Column) -> Column:
        depth = state["depth"] + F.when(mark == "/", -1).otherwise(1)
        inside = state["depth"] > 0
        return F.struct(
            F.when(inside, depth).otherwise(0).alias("depth"),
            (state["kept"] + F.when(inside & (depth > 0), 1).otherwise(0)).alias("kept"),
        )

    kept = F.aggregate(marks, start, walk)["kept"]
    return F.array_join(F.slice(F.split(rest, same_tag, -1), F.lit(1), kept), "<br>")


def container(html: Column, opening: str, tag: str) -> Column:
    """Inner HTML of the first element that matches ``opening``; null without one."""
    return let(F.get(F.split(html, opening, 2), F.lit(1)), lambda rest: balanced(rest, tag))


def seen(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, _UNSEEN, "<br>")


def without_layout(html: Column) -> Column:
    """The page without navigation and the like; innermost blocks go first, as often as blocks nest."""

    def deepest(page: Column) -> Column:
        marks = F.regexp_extract_all(page, F.lit(_LAYOUT_MARK), F.lit(1))
        start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("most"))

        def walk(state: Column, mark: Column) -> Column:
            depth = F.greatest(state["depth"] + F.when(mark == "/", -1).otherwise(1), F.lit(0))
            return F.struct(depth.alias("depth"), F.greatest(state["most"], depth).alias("most"))

        return F.aggregate(marks, start, walk)["most"]

    def removed(state: Column, _: Column) -> Column:
        # Openings that are never closed count as depth, but change nothing: the first idle round is the last.
        smaller = let(
            F.regexp_replace(state["page"], _INNERMOST, "<br>"),
            lambda page: F.struct(page.alias("page"), (page == state["page"]).alias("done")),
        )
        return F.when(state["done"], state).otherwise(smaller)

    rounds = F.array_repeat(F.lit(0), deepest(html))
    return F.aggregate(rounds, F.struct(html.alias("page"), F.lit(False).alias("done")), removed)["page"]


def visible_text(html: Column, site: SiteSettings) -> Column:
    """Text of the article container, null below the minimum length."""

    def accepted(opening: str, tag: str, bare: Column) -> Column:
        return let(
            fragment_text(container(bare, opening, tag)),
            lambda t: F.when(F.length(t) >= site.min_text_length, t),
        )

    return let(
        let(seen(html), without_layout),
        lambda b: F.coalesce(
            accepted(_div_of_class(site.wrapper_class), "div", b),
            accepted(r"(?i)<article(?=[\s/>])[^>]*>", "article", b),
        ),
    )


def section(html: Column, site: SiteSettings) -> Column:
    """Content of the first section tag, trimmed and lower-cased; null if absent or empty."""
    metas = F.regexp_extract_all(
        seen(html),
        F.lit(r"""(?i)(<meta(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>)"""),
        F.lit(1),
    )
    first = F.get(F.filter(metas, lambda m: attribute(m, "name") == site.section_tag), F.lit(0))
    content = let(first, lambda tag: attribute(tag, "content"))
    return let(content, lambda c: F.when(c != "", F.lower(strip(c))))


# ── JSON island ───────────────────────────────────────────────────────────────


def island(html: Column, site: SiteSettings) -> Column:
    """The object after the first marker; null without marker, object or content.

    Text after the object is ignored by ``from_json``; a blank before the brace
    is not accepted.
    """

    def parse(rest: Column) -> Column:
        parsed = F.from_json(rest, ISLAND)
        return let(
            parsed,
            lambda p: F.when(
                p["display_date"].isNotNull()
                | p["first_publish_date"].isNotNull()
                | p["content_elements"].isNotNull(),
                p,
            ),
        )

    at = F.locate(site.island_marker, html)
    rest = F.substring(html, at + len(site.island_marker), F.length(html))
    return F.when(at > 0, let(rest, lambda r: F.when(r.startswith("{"), parse(r))))


def element_text(element: Column) -> Column:
    """Text of one content element; kinds without text give ``''``."""
    plain = fragment_text(F.coalesce(element["content"], F.lit("")))
    items = F.filter(
        F.coalesce(element["items"], F.array().cast(_ITEMS)),
        lambda item: (item["type"] == "text") & (item["content"] != ""),
    )
    joined = F.array_join(F.transform(items, lambda item: fragment_text(item["content"])), " ")
    kind = element["type"]
    return (
        F.when(kind == "text", plain)
        .when((kind == "header") & element["level"].isNotNull(), plain)
        .when(kind == "list", joined)
        .otherwise("")
    )


def island_text(data: Column) -> Column:
    """Non-empty element texts joined by a blank."""
    texts = F.transform(data["content_elements"], element_text)
    return F.array_join(F.filter(texts, lambda t: t != ""), " ")


def body_text(html: Column, data: Column, site: SiteSettings) -> Column:
    """Island text if long enough, else visible text, else null."""
    return let(
        island_text(data),
        lambda t: F.when(F.length(t) >= site.min_text_length, t).otherwise(
            visible_text(html, site)
        ),
    )


def publication_date(html: Column, data: Column, site: SiteSettings) -> Column:
    """ISO string from the island, else from the first date element, else ``''``.

    A date element is a ``time`` with a datetime anywhere, or any ``time`` inside a
    ``div`` of the date class. Such a ``div`` is read up to the next one of its class.
    """
    dated = r"""(?is)<time\s(?:[^>]*[\s"'])?datetime\s*=[^>]*>"""
    any_time = r"(?is)<time(?=[\s/>])[^>]*>"

    def first_dated(page: Column) -> Column:
        return attribute(F.regexp_substr(page, F.lit(dated)), "datetime")

    def block_value(block: Column) -> Column:
        tag = F.regexp_substr(block, F.lit(any_time))
        text = F.array_join(text_pieces(container(block, any_time, "time")), "")
        return F.coalesce(attribute(tag, "datetime"), text)

    def from_pieces(pieces: Column) -> Column:
        # Each piece but the first follows the opening of a date block.
        blocks = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda p: balanced(p, "div"))
        timed = F.transform(blocks, lambda b: F.when(b.rlike(any_time), b))

        def chosen(timed: Column) -> Column:
            value = F.get(F.filter(timed, lambda b: b.isNotNull()), F.lit(0))
            at = F.array_position(F.transform(timed, lambda b: b.isNotNull()), True)
            ahead = F.array_join(F.slice(pieces, F.lit(1), F.when(at > 0, at).otherwise(F.size(pieces)).cast("int")), "<br>")
            return F.coalesce(first_dated(ahead), F.when(at > 0, block_value(value)))

        return let(timed, chosen)

    from_time = let(F.split(seen(html), _div_of_class(site.date_class), -1), from_pieces)
    return F.coalesce(
        F.nullif(data["display_date"], F.lit("")),
        F.nullif(data["first_publish_date"], F.lit("")),
        from_time,
        F.lit(""),
    )
