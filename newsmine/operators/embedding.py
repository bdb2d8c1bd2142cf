"""Mean word vector per document."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReader,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmine.functions.text import bag, tokens, without
from newsmine.operators.bow import found_terms, other_terms
from newsmine.session import cut, written

#: Largest word table that the driver holds and sends to every task.
BROADCAST_BYTES = 64 * 1024 * 1024
_ROWS, _CELLS = 2_000, 50_000  # documents and word vectors added up at a time


def word_bags(
    docs: DataFrame,
    stopwords: Iterable[str] = (),
    pattern: str | None = None,
    tokenizer: Callable[[Column], Column] | None = None,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
) -> DataFrame:
    """(keep…, bag): raw text is tokenised first, then lower-cased and filtered.

    Accents are kept, so an accented form does not match an unaccented stop-word.
    """
    raw = tokenizer(F.col(text)) if tokenizer else tokens(F.col(text), pattern)
    words = without(F.transform(raw, lambda w: F.lower(w)), stopwords)
    return docs.select(*keep, bag(words).alias("bag"))


def word_counts(bags: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(keep…, word, n)"""
    return bags.select(*keep, F.inline("bag")).withColumnRenamed("term", "word")


def vector_size(vectors: DataFrame) -> int:
    """Length of the vectors (all rows agree)."""
    return vectors.select(F.size("vec")).first()[0]


def document_vectors(
    bags: DataFrame,
    vectors: DataFrame,
    size: int | None = None,
    keep: Sequence[str] = ("doc_id",),
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """(keep…, known, vec): mean vector of each document's known words; repeats count each time, none give zeros.

    A word table of at most ``limit`` bytes is one matrix in every task, and a row's
    vector is made in the row. Of a larger one so many frequent words are; the cells
    of all other words are joined by word and summed once per document.
    """
    size = size or vector_size(vectors)
    # float32 payload plus a generous allowance for the word and row overhead.
    most = limit // (4 * size + 64)
    if vectors.count() > most:
        return _joined_vectors(bags, vectors, size, keep, most)
    sums = _summed(bags, *_in_memory(vectors, size), keep)
    return sums.select(*keep, "known", _mean(F.col("vec"), F.col("known")).alias("vec"))


def _mean(sums: Column, known: Column) -> Column:
    return F.transform(sums, lambda x: x / F.when(known > 0, known).otherwise(1))


def _in_memory(vectors: DataFrame, size: int) -> tuple[pa.Array, np.ndarray]:
    table = vectors.select("word", F.col("vec").cast("array<float>").alias("vec")).toArrow()
    words = table.column("word").combine_chunks()
    return words, table.column("vec").combine_chunks().flatten().to_numpy().reshape(len(words), size)


def _summed(bags: DataFrame, words: pa.Array, matrix: np.ndarray, keep: Sequence[str]) -> DataFrame:
    """(keep…, known, vec): how many of each document's words are in ``words``, and the sum of their vectors."""
    size = matrix.shape[1]
    shared = bags.sparkSession.sparkContext.broadcast(matrix)
    rows = found_terms(bags, keep, words)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in bags.select(*keep).schema) + "known long, vec array<double>"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                idx, n = (batch.column(c) for c in ("idx", "n"))
                lengths = idx.value_lengths().to_numpy()
                columns, times = idx.flatten().to_numpy(), n.flatten().to_numpy()
                row = np.repeat(np.arange(len(lengths)), lengths)
                known = np.bincount(row, times, len(lengths))
                out = np.zeros((len(lengths), size))
                ends = np.cumsum(lengths)
                for low in range(0, len(columns), _CELLS):
                    high = min(low + _CELLS, len(columns))
                    first, last = np.searchsorted(ends, [low, high - 1], side="right")
                    inside = np.diff(np.clip(np.concatenate([[0], ends])[first : last + 2], low, high))
                    starts = (np.cumsum(inside) - inside)[inside > 0]
                    part = matrix_rows(shared.value, columns[low:high], times[low:high])
                    out[np.arange(first, last + 1)[inside > 0]] += np.add.reduceat(part, starts, axis=0)
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, size, dtype=np.int32), out.ravel())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in keep], pa.array(known.astype(np.int64)), lists], names=[*keep, "known", "vec"]
                )

    return rows.mapInArrow(add, schema)


def matrix_rows(matrix: np.ndarray, columns: np.ndarray, times: np.ndarray) -> np.ndarray:
    return matrix[columns].astype(np.float64) * times[:, None]


def _joined_vectors(bags: DataFrame, vectors: DataFrame, size: int, keep: Sequence[str], most: int) -> DataFrame:
    """The same with at most ``most`` words in memory, the most frequent ones. Bags are written once, as three passes read them."""
    bags = written(bags.select(*keep, "bag", F.monotonically_increasing_id().alias("_row")), "embedding-bags")
    df = bags.select(F.inline("bag")).groupBy(F.col("term").alias("word")).agg(F.count(F.lit(1)).alias("df"))
    # Steps of an eighth of a power of two: a few hundred numbers at most.
    ranked = cut(vectors.select("word", "vec").join(df, "word").select("word", "vec", F.floor(F.log2("df") * 8).alias("step")))
    least, room = 10_000, most
    for row in ranked.groupBy("step").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        room -= row["n"]
        if room < 0:
            break
        least = row["step"]
    words, matrix = _in_memory(ranked.where(F.col("step") >= least), size)
    frequent = _summed(bags, words, matrix, (*keep, "_row"))
    rare = ranked.where(F.col("step") < least).select(F.col("word").alias("term"), F.col("vec").cast("array<float>").alias("vec"))
    found = other_terms(bags, words).join(rare, "term").groupBy("_row").agg(F.sum("n").alias("more"), F.collect_list(F.struct("n", "vec")).alias("cells"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                lengths = batch.column("cells").value_lengths().to_numpy()
                cells = batch.column("cells").flatten()
                vecs = cells.field("vec").flatten().to_numpy().reshape(-1, size)
                sums = np.add.reduceat(vecs.astype(np.float64) * cells.field("n").to_numpy()[:, None], np.cumsum(lengths) - lengths, axis=0)
                lists = pa.ListArray.from_arrays(np.arange(0, sums.size + 1, size, dtype=np.int32), sums.ravel())
                yield pa.RecordBatch.from_arrays([batch.column("_row"), batch.column("more"), lists], names=["_row", "more", "sums"])

    others = found.mapInArrow(add, "_row long, more long, sums array<double>")
    both = F.when(F.col("sums").isNull(), F.col("vec")).otherwise(F.zip_with("vec", "sums", lambda a, b: a + b))
    total = frequent.join(others, "_row", "left").select(*keep, (F.col("known") + F.coalesce("more", F.lit(0))).alias("known"), both.alias("vec"))
    return total.select(*keep, "known", _mean(F.col("vec"), F.col("known")).alias("vec"))


def coverage(bags: DataFrame, vectors: DataFrame, size: int | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_known) for every document."""
    total = F.aggregate("bag", F.lit(0).cast("long"), lambda s, t: s + t["n"])
    counted = bags.select(F.struct("doc_id", total.alias("n_tokens")).alias("doc"), "bag")
    placed = document_vectors(counted, vectors, size, ("doc",))
    return placed.select("doc.doc_id", "doc.n_tokens", F.col("known").alias("n_known"))


class MeanEmbedding(Transformer, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """Text column to mean word vector, in the row: all other columns stay. Can be saved inside a pipeline."""

    stopwords = Param(Params._dummy(), "stopwords", "words that do not count", typeConverter=TypeConverters.toListString)
    pattern = Param(Params._dummy(), "pattern", "token pattern ('' for the usual one)", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, vectors=None, inputCol="text", outputCol="vec", stopwords=(), pattern=None):
        super().__init__()
        self.vectors = vectors
        self._setDefault(stopwords=[], pattern="")
        self._set(inputCol=inputCol, outputCol=outputCol, stopwords=list(stopwords), pattern=pattern or "")

    def fit(self, dataset: DataFrame | None = None) -> MeanEmbedding:
        """Nothing to learn."""
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        whole = F.struct(*[F.col(f"`{c}`") for c in dataset.columns]).alias("row")
        named = dataset.select(whole, F.col(f"`{self.getInputCol()}`").alias("_text"))
        stop, pattern = self.getOrDefault(self.stopwords), self.getOrDefault(self.pattern) or None
        bags = word_bags(named, stop, pattern, keep=("row",), text="_text")
        placed = document_vectors(bags, self.vectors, keep=("row",))
        kept = [c for c in dataset.columns if c != self.getOutputCol()]
        return placed.select(*[F.col("row").getField(c).alias(c) for c in kept], F.col("vec").alias(self.getOutputCol()))

    def fit_transform(self, dataset: DataFrame) -> DataFrame:
        return self.fit(dataset).transform(dataset)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, instance: MeanEmbedding) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.vectors.select("word", "vec").write.parquet(f"{path}/vectors")


class _Reader(MLReader):
    def load(self, path: str) -> MeanEmbedding:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        found = MeanEmbedding(vectors=self.sparkSession.read.parquet(f"{path}/vectors"))
        found._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(found, metadata)
        return found
