"""Long repeated byte strings through a logarithmic family of suffix indexes.

Each batch of documents gets an index of its suffixes: those that begin at an
anchor, in order of the fingerprint of their first ``part`` bytes, then of all that
surrounds them. Every string of the wanted length holds an anchor, and suffixes
that agree for ``part`` bytes are neighbours. A new index is merge-joined with
the existing levels to find long matches on both sides; levels of equal size are
merged, so there are at most log2(batches) + 1 of them and a suffix is rewritten
at most log2(batches) times.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.llm import kernel as K
from newsmine.llm import windows
from newsmine.llm.common import Batches, original, stored


@dataclass
class IndexFamily:
    """Index levels as bucketed tables in the warehouse; buckets make every merge-join free of shuffles."""

    spark: SparkSession
    shape: windows.Shape
    buckets: int
    frequent: np.ndarray
    levels: list[tuple[int, str]] = field(default_factory=list)
    matched: list[DataFrame] = field(default_factory=list)

    def _write(self, rows: DataFrame) -> str:
        name = f"suffix_level_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, "key").sortBy("key", "around").saveAsTable(name)
        return name

    def _suffixes(self, name: str) -> DataFrame:
        return self.spark.table(name).where("not sure")

    def merge(self) -> None:
        """Join the two newest levels while they have equal sizes."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, a), (_, b) = self.levels[-2:]
            merged = self._write(self.spark.table(a).unionByName(self.spark.table(b)))
            self.levels[-2:] = [(2 * size, merged)]
            for old in (a, b):
                self.spark.sql(f"DROP TABLE {old}")

    def add(self, texts: DataFrame) -> None:
        """Index a batch and note the suffixes that match within it or in an older level."""
        self.merge()
        rows = windows.entries(texts, self.shape, self.frequent)
        # Rows that are known to be covered need no partner: they are dealt out evenly.
        key = F.when(F.col("salt") > 0, F.xxhash64("salt", "id", "at")).when(F.col("salt") < 0, F.xxhash64("salt", "anchor")).otherwise(F.col("anchor"))
        name = self._write(rows.withColumn("key", key).repartition(self.buckets, "key"))
        new = self._suffixes(name).select("key")
        found = [new.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")]
        # A frequent anchor has partners under its other salts.
        found.append(self._suffixes(name).where("salt < 0").select("key"))
        found += [new.join(self._suffixes(old).select("key"), "key", "left_semi") for _, old in self.levels]
        self.matched.append(stored(reduce(DataFrame.union, found).distinct(), "suffix-matches"))
        self.levels.append((1, name))

    def matches(self) -> DataFrame:
        """All suffixes whose anchor repeats, and the rows already known to be covered."""
        hits = reduce(DataFrame.union, self.matched).distinct()
        parts = []
        for _, name in self.levels:
            whole = self.spark.table(name)
            parts += [whole.where("not sure").join(hits, "key", "left_semi"), whole.where("sure")]
        return reduce(DataFrame.unionByName, parts)

    def close(self) -> None:
        for _, name in self.levels:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.levels = []


def repeated_spans(texts: DataFrame, window: int, part: int, batches: int) -> DataFrame:
    """(id, twin, first, last): starts of the ``window``-byte strings that also start elsewhere."""
    spark = texts.sparkSession
    shape = windows.Shape(windows.byte_units, window, part, keep_first=False)
    buckets = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    family = IndexFamily(spark, shape, buckets, windows.frequent_anchors(texts, shape))
    try:
        for k in range(batches):
            family.add(texts.where(F.pmod(F.xxhash64("id", "twin"), F.lit(batches)) == k))
        marks = stored(windows.marked(family.matches(), shape), "suffix-marks")
    finally:
        family.close()
    return windows.refined(texts, marks, shape, "suffix-level")


def longer_spans(texts: DataFrame, spans: DataFrame, passage: int, window: int) -> DataFrame:
    """(id, twin, first, last): starts of the ``window``-byte strings that also start elsewhere, from the ``spans`` of shorter strings that do.

    In a string that repeats, all strings of ``passage`` bytes repeat, so windows are dealt to
    anchors only where every string of ``passage`` bytes inside them is in ``spans``.
    """
    shape = windows.Shape(windows.byte_units, window, max(1, window // 4), keep_first=False)
    rows = windows.entries(texts, shape, windows.frequent_anchors(texts, shape), spans, window - passage + 1)
    marks = stored(windows.marked(rows, shape), "suffix-marks")
    return windows.refined(texts, marks, shape, "suffix-level")


def without_repeats(
    docs: DataFrame, window: int = 400, part: int | None = None, batches: int = 4, rest: bool = False, passage: int | None = None
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept[, n_passage][, rest]) of every row of ``docs``.

    A byte goes if a ``window``-byte string over it also starts anywhere else, in
    the same text or another; all copies go. ``kept`` (binary) holds the other
    bytes, ``n_spans`` counts the removed runs. Strings are judged on the input.
    ``rest`` adds a struct of all columns of the row (of the text, only whether there is
    one), and ``kept`` is a text then: characters that lose some of their bytes go with them.
    ``passage`` (2 to ``window`` bytes) adds ``n_passage``: bytes that a string of this length covers which also
    starts anywhere else. Such bytes stay unless a ``window`` covers them; the index holds the shorter strings then.

    A null or empty text has no bytes; texts shorter than a string stay. Rows that
    repeat a doc_id with the same text are one document, not copies of each
    other. Null doc_ids are one document only if their texts are equal too. Other
    columns are not read. An empty table gives an empty result.
    """
    if passage is not None and not 2 <= passage <= window:
        raise ValueError(f"passage must be 2 to {window} bytes, not {passage}")
    indexed = passage or window
    texts = windows.texts_of(docs)
    covers = repeated_spans(texts, indexed, part or max(1, indexed // 4), batches)
    whole = windows.texts_of(docs, rest)
    if passage:
        covers = stored(covers, "suffix-passages")
        whole = windows.with_covers(whole, covers, "passages")
        covers = longer_spans(texts, covers, passage, window) if passage < window else covers
    own = whole.schema["rest"].dataType.simpleString() if rest else ""

    def run(found: Batches) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for rows, data, offsets in K.blocks(batch, size=windows.BLOCK):
                field = lambda name: rows.column(rows.schema.get_field_index(name))  # noqa: B023,E731
                gone = windows.cover_mask(data, offsets, field("covers"), window)
                begun = gone.copy()
                begun[1:] &= ~gone[:-1]
                edges = offsets[:-1][offsets[:-1] < len(data)]
                begun[edges] = gone[edges]
                total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])  # noqa: B023,E731
                bounds = np.concatenate([[0], np.cumsum(~gone)])[offsets].astype(np.int64)
                kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows.num_rows, [None, pa.py_buffer(bounds), pa.py_buffer(data[~gone])])
                left = pa.array([k.as_py().decode("utf-8", "ignore") for k in kept], pa.string()) if rest else kept.cast(pa.binary())
                made = {"id": rows.column(0), "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(total(gone)), "n_spans": pa.array(total(begun)), "kept": left}
                if passage:
                    made["n_passage"] = pa.array(total(windows.cover_mask(data, offsets, field("passages"), passage)))
                if rest:
                    made["rest"] = field("rest")
                yield pa.RecordBatch.from_arrays([*made.values()], names=[*made])

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept " + ("string" if rest else "binary") + ", n_passage long" * bool(passage) + (f", rest {own}" if rest else "")
    found = windows.with_covers(whole, covers).mapInArrow(run, schema)
    return found.select(original(F.col("id")).alias("doc_id"), *found.columns[1:])


def deduplicated(docs: DataFrame, window: int = 400, batches: int = 4) -> DataFrame:
    """``docs`` with all columns and rows, repeated strings cut out of the texts.

    Characters that lose some of their bytes go with them; ``n_chars`` follows the
    new text where the table has it.
    """

    trimmed = without_repeats(docs, window, batches=batches, rest=True).select("kept", "rest")
    made = {"text": F.when(F.col("rest.text"), F.col("kept"))}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.length(made["text"]).cast("long")
    return trimmed.select(*[made.get(c, F.col("rest").getField(c)).alias(c) for c in docs.columns])
