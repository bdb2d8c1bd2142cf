"""Spanish stemming, applied to distinct words only.

Follows the published Snowball description of the Spanish stemmer.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

_VOWELS = "aeiouáéíóúü"
_PLAIN = str.maketrans("áéíóú", "aeiou")

# The suffix lists of the published algorithm.
_PRONOUNS = "me se sela selo selas selos la le lo las les los nos".split()
_GERUNDS_ACCENTED = "iéndo ándo ár ér ír".split()
_GERUNDS = "ando iendo ar er ir".split()
_DELETE_R2 = (
    "anza anzas ico ica icos icas ismo ismos able ables ible ibles ista istas oso osa osos osas "
    "amiento amientos imiento imientos"
).split()
_AFTER_IC = "adora ador ación adoras adores aciones ante antes ancia ancias".split()
_LOG = "logía logías".split()
_U = "ución uciones".split()
_ENTE = "encia encias".split()
_IDAD = "idad idades".split()
_IVO = "iva ivo ivas ivos".split()
_Y_VERBS = "ya ye yan yen yeron yendo yo yó yas yes yais yamos".split()
_EN_VERBS = "en es éis emos".split()
_VERBS = (
    "arían arías arán arás aríais aría aréis aríamos aremos ará aré erían erías erán erás eríais ería "
    "eréis eríamos eremos erá eré irían irías irán irás iríais iría iréis iríamos iremos irá iré aba ada "
    "ida ía ara iera ad ed id ase iese aste iste an aban ían aran ieran asen iesen aron ieron ado ido ando "
    "iendo ió ar er ir as abas adas idas ías aras ieras ases ieses ís áis abais íais arais ierais aseis "
    "ieseis asteis isteis ados idos amos ábamos íamos imos áramos iéramos iésemos ásemos"
).split()
_RESIDUAL = "os a o á í ó".split()
_STANDARD = ["amente", "mente", *_DELETE_R2, *_AFTER_IC, *_LOG, *_U, *_ENTE, *_IDAD, *_IVO]


def _after_next(word: str, start: int, vowel: bool) -> int:
    """Position after the next vowel (or non-vowel) from ``start``; word end if none."""
    for i in range(start, len(word)):
        if (word[i] in _VOWELS) == vowel:
            return i + 1
    return len(word)


def _regions(word: str) -> tuple[int, int, int]:
    """Starts of RV, R1 and R2."""
    r1 = _after_next(word, _after_next(word, 0, True), False)
    r2 = _after_next(word, _after_next(word, r1, True), False)
    if len(word) < 3:
        return len(word), r1, r2
    first, second = word[0] in _VOWELS, word[1] in _VOWELS
    if not second:
        rv = _after_next(word, 2, True)
    elif first:
        rv = _after_next(word, 2, False)
    else:
        rv = 3
    return rv, r1, r2


def _longest(word: str, suffixes: list[str], start: int = 0) -> str:
    """Longest suffix that lies wholly from ``start`` on; ``''`` if none."""
    found = [s for s in suffixes if word.endswith(s) and len(word) - len(s) >= start]
    return max(found, key=len, default="")


def _cut_pronoun(word: str, rv: int) -> str:
    pronoun = _longest(word, _PRONOUNS, rv)
    base = word[: len(word) - len(pronoun)]
    if not pronoun:
        return word
    accented = _longest(base, _GERUNDS_ACCENTED, rv)
    if accented:
        return base[: len(base) - len(accented)] + accented.translate(_PLAIN)
    if _longest(base, _GERUNDS, rv) or (_longest(base, ["yendo"], rv) and base.endswith("uyendo")):
        return base
    return word


def _cut_standard(word: str, r1: int, r2: int) -> str:
    suffix = _longest(word, _STANDARD)
    stem = word[: len(word) - len(suffix)]
    if not suffix or len(stem) < (r1 if suffix == "amente" else r2):
        return word

    def also(stem: str, *endings: str) -> str:
        return stem[: len(stem) - len(_longest(stem, list(endings), r2))]

    if suffix == "amente":
        shorter = also(stem, "iv")
        return also(shorter, "at") if shorter != stem else also(stem, "os", "ic", "ad")
    if suffix == "mente":
        return also(stem, "ante", "able", "ible")
    if suffix in _AFTER_IC:
        return also(stem, "ic")
    if suffix in _LOG:
        return stem + "log"
    if suffix in _U:
        return stem + "u"
    if suffix in _ENTE:
        return stem + "ente"
    if suffix in _IDAD:
        return also(stem, "abil", "ic", "iv")
    return also(stem, "at") if suffix in _IVO else stem


def _cut_verb(word: str, rv: int) -> str:
    suffix = _longest(word, _Y_VERBS, rv)
    stem = word[: len(word) - len(suffix)]
    if suffix and stem.endswith("u"):
        return stem
    suffix = _longest(word, _EN_VERBS + _VERBS, rv)
    stem = word[: len(word) - len(suffix)]
    return stem[:-1] if suffix in _EN_VERBS and stem.endswith("gu") else stem


def _cut_residual(word: str, rv: int) -> str:
    suffix = _longest(word, [*_RESIDUAL, "e", "é"], rv)
    stem = word[: len(word) - len(suffix)]
    if suffix in ("e", "é") and stem.endswith("gu") and len(stem) - 1 >= rv:
        return stem[:-1]
    return stem


def stem_word(word: str) -> str:
    """Stem of one word, lower-cased and without acute accents."""
    word = word.lower()
    rv, r1, r2 = _regions(word)
    word = _cut_pronoun(word, rv)
    shorter = _cut_standard(word, r1, r2)
    if shorter == word:
        shorter = _cut_verb(word, rv)
    return _cut_residual(shorter, rv).translate(_PLAIN)


def stem_map(words: DataFrame) -> DataFrame:
    """(term, stem) for the distinct terms of ``words``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(stem=pdf["term"].map(stem_word))

    return words.select("term").distinct().mapInPandas(run, "term string, stem string")


def stemmed_counts(tf: DataFrame) -> DataFrame:
    """(doc_id, term, n) with terms replaced by their stems and counts added up."""
    merged = tf.join(stem_map(tf), "term").groupBy("doc_id", "stem").sum("n")
    return merged.toDF("doc_id", "term", "n")
