"""Substring de-duplication by level-wise doubling over windows of words.

The first level looks at strings of a quarter of the wanted length, one (the anchor)
for each window. A window whose string occurs once is settled; the others go to the
next level, with strings of twice the length, until no candidate survives or the
string is the whole window. Longer repeats are covered by their windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmine.llm import kernel as K
from newsmine.llm import windows
from newsmine.llm.common import Batches, original, stored


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of each text's kept words, joined by one blank."""
    low, sizes = starts[kept], (ends - starts)[kept] + 1
    begin = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    source = np.arange(total) - np.repeat(begin - low, sizes)
    out = data[np.minimum(source, max(0, len(data) - 1))] if total else data[:0]
    out = out.copy()
    out[begin + sizes - 1] = 0x20
    number = np.concatenate([[0], np.cumsum(kept)])[first]  # kept words before each text
    bounds = np.append(begin, total)[number]
    last = bounds[1:] > bounds[:-1]  # the blank behind the last word goes
    drop = np.ones(total, bool)
    drop[(bounds[1:] - 1)[last]] = False
    return out[drop], np.concatenate([[0], np.cumsum(np.diff(bounds) - last)]).astype(np.int64)


def without_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of ``docs``.

    A word goes if a window of ``window`` words over it starts earlier as well (smaller
    doc_id, or same text and earlier start); ``kept`` holds the others, joined by
    one blank. Windows are judged on the input.

    A null or empty text has no words. Texts shorter than a window stay. Rows that
    repeat a doc_id with the same text are one document: equal places do not count
    against each other. Rows that share a doc_id with other texts are ordered by a
    fingerprint. A null doc_id sorts before all. Other columns are not read. An
    empty table gives an empty result.
    """
    shape = windows.Shape(windows.word_units, window, max(1, window // 4), keep_first=True)
    texts = windows.texts_of(docs)
    entries = windows.entries(texts, shape, windows.frequent_anchors(texts, shape))
    marks = stored(windows.marked(entries, shape), "substring-marks")
    covers = windows.refined(texts, marks, shape, "substring-level")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in K.blocks(batch):
                starts, ends, first = K.words(data, offsets)
                units = K.word_hashes(data, starts, ends)
                gone = windows.cover_mask(units, first, rows.column(rows.schema.get_field_index("covers")), window)
                out, bounds = joined_words(data, starts, ends, first, ~gone)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
                text = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(bounds), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(first)), pa.array(removed), text.cast(pa.large_string()).cast(pa.string())],
                    names=["id", "n_words", "n_removed", "kept"],
                )

    found = windows.with_covers(texts, covers).mapInArrow(run, "id long, n_words long, n_removed long, kept string")
    return found.select(original(F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept")
