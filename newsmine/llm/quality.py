"""Line-first cleaning: rules per line, failed lines go, then texts that lost too much go."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmine.llm import kernel as K
from newsmine.llm.common import narrow, original, per_batch


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the verdict on a text."""

    #: Punctuation: symbols per hundred visible characters, and !-marks likewise.
    max_symbols: int = 8
    max_marks: int = 10
    #: Punctuation: a line of at least so many words must contain sentence punctuation.
    unpunctuated_words: int = 30
    #: Navigation: at least so many separators, and one for each so many words.
    separators: int = 3
    words_per_separator: int = 4
    #: Boilerplate: a phrase below in a line of at most so many words, or a line seen before.
    boilerplate_words: int = 25
    #: Reject a text that loses more than so many hundredths of its visible characters.
    max_loss: int = 40
    #: Base rules.
    min_words: int = 20
    window: int = 8
    max_repeat: int = 30


#: Phrases of page furniture (plain ASCII, any case).
BOILERPLATE = re.compile(
    rb"cookie policy|accept (?:all )?cookies|uses cookies|all rights reserved|terms of (?:use|service)|privacy policy"
    rb"|javascript (?:is|must be)|enable javascript|sign up for|subscribe to|click here|read more|log ?in to"
    rb"|share (?:on|this)|skip to (?:main )?content|powered by|back to top",
    re.IGNORECASE,
)
# Marks that end or divide sentences, besides the ASCII ones. Greek, Armenian, Hebrew, Arabic,
# Devanagari, Tibetan, Myanmar, Ethiopic, Khmer, general, Chinese and Japanese, full-width.
SENTENCE_MARKS = "\u037e\u0387\u055c\u055d\u055e\u0589\u05c3\u060c\u061b\u061f\u06d4\u0964\u0965\u0f0d\u0f0e\u104a\u104b\u1362\u1363\u1364\u1365\u1367\u1368\u17d4\u17d5\u2026\u203c\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\uff61"
_FAR_STOPS = re.compile(b"|".join(re.escape(m.encode()) for m in SENTENCE_MARKS))
_FAR_LEADS = np.zeros(256, bool)
_FAR_LEADS[[m.encode()[0] for m in SENTENCE_MARKS]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?;:,")] = True
_BAR = np.zeros(256, bool)
_BAR[list(b"|>")] = True
FACTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars"]


def _repeated_words(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Words of each text inside windows of ``size`` words that the text holds twice or more."""
    texts = len(first) - 1
    n = len(hashes)
    if n < size:
        return np.zeros(texts, np.int64)
    text = np.repeat(np.arange(texts), np.diff(first))
    starts = np.flatnonzero(np.arange(n - size + 1) + size <= first[1:][text[: n - size + 1]])
    runs = K.run_hashes(K.prefix_sums(hashes), starts, size)
    key = K.mix(runs ^ K.mix(text[starts].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(starts), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts[again], 1)
    np.subtract.at(cover, starts[again] + size, 1)
    return _per_text(np.cumsum(cover[:-1]) > 0, first)


def _per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[first])


def judged(data: np.ndarray, offsets: np.ndarray, rules: LineRules) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Facts of each text in a block, and start, end and verdict (True: stays) of each line."""
    starts, ends, first = K.words(data, offsets)
    hashes = K.word_hashes(data, starts, ends)
    ink = ~K.SPACE[data] if len(data) else np.zeros(0, bool)
    lead = (data & 0xC0) != 0x80
    visible = ink & lead
    # Lines: cut at every line feed and at the ends of texts.
    feeds = np.flatnonzero(data == 10) + 1
    cuts = np.unique(np.concatenate([offsets, feeds]))
    low, high = cuts[:-1], cuts[1:]
    count = lambda flags: _per_text(flags, cuts)
    begun = np.zeros(len(data), bool)
    begun[starts] = True
    words, chars = count(begun), count(visible)
    symbols, marks, stops, bars = count(_SYMBOL[data]), count(_MARK[data]), count(_STOP[data]), count(_BAR[data])
    text = np.searchsorted(offsets, low, "right") - 1
    body = high - (data[high - 1] == 10) if len(high) else high
    keys = K.mix(K.run_hashes(K.prefix_sums(K.byte_units(data)), low, body - low) ^ K.mix(text.astype(np.uint64))) if len(low) else np.zeros(0, np.uint64)
    seen = np.ones(len(low), bool)
    seen[np.unique(keys, return_index=True)[1]] = False
    repeated = seen & (words > 0)
    phrase = np.zeros(len(low), bool)
    raw = data.tobytes()
    # Each text by itself: what stands behind its end belongs to another one.
    bounds = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
    hits = np.array([m.start() for start, end in bounds for m in BOILERPLATE.finditer(raw, start, end)], np.int64)
    phrase[np.searchsorted(cuts, hits, "right") - 1] = True
    if _FAR_LEADS[data].any():
        far = np.zeros(len(data), bool)
        far[[m.start() for m in _FAR_STOPS.finditer(raw)]] = True
        stops = stops + count(far)
    failed = (100 * symbols > rules.max_symbols * chars) | (100 * marks > rules.max_marks * chars)
    failed |= (stops == 0) & (words >= rules.unpunctuated_words)
    failed |= (bars >= rules.separators) & (bars * rules.words_per_separator >= words)
    failed |= phrase & (words <= rules.boilerplate_words)
    failed |= repeated
    failed &= words > 0
    lines = np.searchsorted(low, offsets)
    by_text = lambda values: np.diff(np.concatenate([[0], np.cumsum(values)])[lines])
    facts = {
        "n_words": np.diff(first),
        "word_chars": _per_text(visible, offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": by_text(repeated),
        "n_repeat_words": _repeated_words(hashes, first, rules.window),
        "lost_chars": by_text(np.where(failed, chars, 0)),
    }
    return facts, low, high, ~failed


def verdicts(facts: dict[str, np.ndarray], rules: LineRules) -> tuple[np.ndarray, np.ndarray]:
    """(base_failed, kept) of each text."""
    base = (facts["n_words"] < rules.min_words) | (100 * facts["n_repeat_words"] > rules.max_repeat * facts["n_words"])
    return base, ~base & (100 * facts["lost_chars"] <= rules.max_loss * facts["word_chars"])


def line_quality(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept.

    Lines fail by punctuation (too many symbols or exclamation marks, or a long
    line without any sentence punctuation), navigation (a list of separators) or
    boilerplate (a furniture phrase in a short line, or a line seen before in the
    text). A text is kept if it passes the base rules and its failed lines hold at
    most ``max_loss`` hundredths of its visible characters.

    A null text counts as empty: zero words, so base_failed. Repeated rows are
    judged one by one, and so is every row, whatever stands beside it; a null doc_id
    stays null; other columns are not read. An empty table gives an empty result.
    """

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in K.blocks(batch):
            facts, *_ = judged(data, offsets, rules)
            base, kept = verdicts(facts, rules)
            columns = [rows.column(0), *(pa.array(facts[k], pa.int64()) for k in FACTS), pa.array(base), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", *FACTS, "base_failed", "kept"])

    schema = "id long, " + ", ".join(f"{k} long" for k in FACTS) + ", base_failed boolean, kept boolean"
    found = narrow(docs).mapInArrow(per_batch(work), schema)
    return found.select(original(F.col("id")).alias("doc_id"), *FACTS, "base_failed", "kept")


def cleaned(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with all columns: failed lines cut out of the texts, rejected rows gone.

    ``n_chars`` follows the new text where the table has it.
    """
    at = docs.columns.index("text")
    names = docs.columns

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in K.blocks(batch):
            facts, low, high, stays = judged(data, offsets, rules)
            _, kept = verdicts(facts, rules)
            edges = np.zeros(len(data) + 1, np.int64)
            np.add.at(edges, low[stays], 1)
            np.subtract.at(edges, high[stays], 1)
            left = np.cumsum(edges[:-1]) > 0
            ends = np.concatenate([[0], np.cumsum(left)])[offsets]
            text = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), rows.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[left])]
            ).cast(pa.large_string())
            columns = [text.cast(rows.schema.field(i).type) if i == at else rows.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, schema=rows.schema).filter(pa.array(kept))

    typed = docs.withColumn("text", F.col("text").cast("string"))
    out = typed.mapInArrow(per_batch(work), typed.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
