"""Text to terms, as column expressions.

Everything stays inside one row until the caller explodes it: tokens, stop-word
removal, pairs and even the per-document counts are array expressions, so the
only shuffle a vocabulary needs is the one that groups by term.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The letters a token may start with; digits may follow.
LETTERS = "a-zA-ZâáàãõáêéíóôõúüÁÉÍÓÚñÑçÇ"
TOKEN_PATTERN = f"[{LETTERS}][0-9{LETTERS}]+"

# Characters str.strip() removes, as a Java regex class.
_SPACE = (
    r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def const_map(entries: dict[str, str]) -> Column:
    """A constant string map as one folded literal (keeps plans small)."""
    joined = "\x01".join(f"{k}\x02{v}" for k, v in entries.items())
    return F.str_to_map(F.lit(joined), F.lit("\x01"), F.lit("\x02"))


def strip(text: Column) -> Column:
    """Trim all Unicode white space, not only blanks."""
    return F.regexp_replace(text, f"^{_SPACE}+|{_SPACE}+$", "")


def rstrip(text: Column) -> Column:
    return F.regexp_replace(text, f"{_SPACE}+$", "")


def substitute(text: Column, pattern: str, replacement: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by an expression of the matched text."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    joined = F.zip_with(
        gaps, hits, lambda gap, hit: F.when(hit.isNull(), gap).otherwise(F.concat(gap, replacement(hit)))
    )
    return F.array_join(joined, "")


# ── accents ───────────────────────────────────────────────────────────────────


@lru_cache(maxsize=1)
def _accent_rules() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition without combining marks, for all characters.

    Returns aligned from/to strings for ``translate`` (surplus ``from``
    characters are deleted) and the one-to-many forms that can be part of a
    token (ligatures, unit signs, fractions); other one-to-many forms separate
    tokens before and after, so they are left alone.
    """
    single, deleted, many = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        char = chr(code)
        plain = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)
        )
        if plain == char:
            continue
        if not plain:
            deleted.append(char)
        elif len(plain) == 1:
            single.append((char, plain))
        elif any(c.isascii() and c.isalnum() for c in plain):
            many[char] = plain
    source = "".join(c for c, _ in single) + "".join(deleted)
    target = "".join(p for _, p in single)
    return source, target, many


def _char_class(chars: Iterable[str]) -> str:
    """A regex class of code-point ranges (a list of single characters is slow to match)."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def strip_accents(text: Column) -> Column:
    """Remove accents; ASCII texts, and texts without ligatures, skip the work."""
    source, target, many = _accent_rules()
    below = sorted(c for c in many if c < "ı")
    # Cheap test first: outside basic Latin and common punctuation, or a fraction sign.
    rare = text.rlike(r"[^\x00-\x{131}\x{2010}-\x{2027}]")
    for char in below:
        rare = rare | text.contains(char)
    lookup = const_map(many)
    plain = F.translate(text, source, target)
    spelled = substitute(plain, _char_class(many), lambda hit: lookup[hit])
    return (
        F.when(~text.rlike(r"[^\x00-\x7f]"), text).when(rare, spelled).otherwise(plain)
    )


# ── tokens, stop-words, pairs ─────────────────────────────────────────────────


def tokens(text: Column, pattern: str | None = None) -> Column:
    """All matches of the token pattern, in order."""
    return F.regexp_extract_all(text, F.lit(f"({pattern or TOKEN_PATTERN})"), F.lit(1))


def token_udf(tokenizer: Callable[[str], list[str]]):
    """Wrap any ``str -> list[str]`` callable as an Arrow-batched tokenizer."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else list(tokenizer(t)))

    return run


def without(words: Column, stopwords: Iterable[str]) -> Column:
    """Drop stop-words, keeping order (pairs are built over the gap)."""
    stop = sorted(set(stopwords))
    if not stop:
        return words
    return F.filter(words, lambda w: ~w.isin(stop))


def pairs(words: Column) -> Column:
    """Neighbouring words joined by a blank."""
    heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.transform(heads, lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))


def _runs_of(words: Column, n: int) -> Column:
    """Every n neighbouring words joined by blanks."""
    heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(heads, lambda _, i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))


def ngrams(words: Column, low: int, high: int) -> Column:
    """Words, pairs and longer runs for every length in ``low..high``."""

    def parts(bound: Column) -> Column:
        made = [
            bound if n == 1 else pairs(bound) if n == 2 else _runs_of(bound, n)
            for n in range(low, high + 1)
        ]
        return made[0] if len(made) == 1 else F.concat(*made)

    return let(words, parts)


def analyse(
    text: Column,
    stopwords: Iterable[str] = (),
    ngram_range: tuple[int, int] = (1, 2),
    pattern: str | None = None,
    tokenizer: Callable[[Column], Column] | None = None,
) -> Column:
    """Lower-case, strip accents, tokenise, drop stop-words, build n-grams."""
    clean = let(F.lower(text), strip_accents)
    words = tokenizer(clean) if tokenizer else tokens(clean, pattern)
    return ngrams(without(words, stopwords), *ngram_range)


def bag(terms: Column) -> Column:
    """Distinct terms with their counts: ``array<struct<term, n>>``.

    Sorts the row's own terms and reads run lengths, so counting within a
    document costs no shuffle.
    """

    def run_lengths(ordered: Column) -> Column:
        firsts = F.array_compact(
            F.transform(ordered, lambda t, i: F.when(~t.eqNullSafe(F.get(ordered, i - 1)), i))
        )
        return let(
            firsts,
            lambda starts: F.transform(
                starts,
                lambda start, j: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - start)
                    .cast("long")
                    .alias("n"),
                ),
            ),
        )

    return let(F.sort_array(terms), run_lengths)
