"""Latent semantic vectors: truncated, uncentred SVD of the TF-IDF matrix.

Randomised subspace iteration (Halko, Martinsson and Tropp 2011) on the term side.
Each round multiplies a term block V by AᵀA in passes over the documents; no matrix
cell is ever shuffled. A block of one slice (a checked size) stays on the driver: one
pass projects every document and adds up the products in the same task. A larger one
is a table of term rows that no process holds whole: the driver passes on a few slices at
a time (a checked size), and tasks read the others from the shared folder. The cells are kept
twice, by document and by term: one pass writes the documents' projections, one reads them slice by
slice and writes whole rows of the product, so neither shuffles anything. What no later pass
reads is deleted. Where Python tasks cannot open the shared folder, a pass for each few slices
adds to the documents' projections and writes them, and one more adds up each term's products,
which tasks first sum over their own documents.
The start block is a hash of term number and column, so neither the slices nor the
partitions change the result.

Several views (a fold held out, with its own document frequencies) are fitted
in the same passes, their blocks side by side.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import TFIDF_TEXT, TextSettings
from newsmine.functions.text import let
from newsmine.operators.blocks import total_of
from newsmine.operators.bow import bag_positions, bags_of, df_bounds, require_terms, vocabulary
from newsmine.session import cut, deleted, opened, shuffles_deleted, work_path, written

#: Largest slice of a term block that the driver holds and sends to every task.
SLICE_BYTES = 16 * 1024 * 1024
#: Largest part of a term block that is with the driver and the tasks at a time: it passes slices on from its own memory.
HELD_BYTES = 64 * 1024 * 1024
_CELLS_PER_TERM = 4
_CHUNK_CELLS = 65_536  # matrix cells multiplied at a time inside a task
_PIECE_CELLS = 2_000_000  # matrix cells ordered at a time inside a task
_PRODUCT_BYTES = 32 * 1024 * 1024  # products of cells that a task sums at a time
_GROUPS = 8  # groups of terms in a slice, each added up on its own
_SLICE_CELLS = 4_096  # cells multiplied by rows of a slice at a time: their products stay in the processor's cache
_JOINED_CELLS, _JOINED_BYTES = 4_000_000, 32 * 1024 * 1024  # cells, and bytes of results, for which a task reads a slice once
_GROUP_CELLS = 250_000, 2_000_000  # cells in a group of terms: at least (few groups), at most
_U = np.uint64


@dataclass
class LsaModel:
    """Everything needed to place new documents: (term, idf, idx) and (idx, vec)."""

    terms: DataFrame
    components: DataFrame
    n_terms: int
    dims: int
    #: Largest |AᵀA v - λ v| of all dimensions, as a share of the largest λ.
    residual: float = float("nan")
    #: The components as a table in slices, if the fit left one.
    block: Block | None = field(default=None, repr=False, compare=False)


@dataclass(frozen=True)
class View:
    """One fit: the fold it must not see (None: it sees all), and a weight per term (0: not in its vocabulary)."""

    held: int | None
    idf: np.ndarray


@dataclass
class Fit:
    """Models by held-out fold, and the counted rows (doc_id, [fold,] idx, n) they were fitted on."""

    models: dict[int | None, LsaModel]
    views: list[View]
    rows: DataFrame = field(repr=False)


# ── inside a task ─────────────────────────────────────────────────────────────


def _chunks(batch: pa.RecordBatch, cells_at_once: int = _CHUNK_CELLS) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(documents, cells per document, columns, counts) in memory-bounded pieces."""
    idx, n = batch.column("idx"), batch.column("n")
    offsets = idx.offsets.to_numpy()
    columns, counts = idx.values.to_numpy(), n.values.to_numpy()
    start, rows = 0, batch.num_rows
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + cells_at_once, side="right")) - 1
        stop = min(rows, max(stop, start + 1))
        cells = slice(offsets[start], offsets[stop])
        yield slice(start, stop), np.diff(offsets[start : stop + 1]), columns[cells], counts[cells].astype(float)
        start = stop


def _norms(lengths: np.ndarray, row: np.ndarray, x: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.bincount(row, x * x, len(lengths)))
    return np.where(norm > 0, norm, 1.0)


def _weights(view: View, lengths: np.ndarray, columns: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """TF-IDF weights with unit rows."""
    x = counts * view.idf[columns]
    row = np.repeat(np.arange(len(lengths)), lengths)
    return x / _norms(lengths, row, x)[row]


def _row_sums(lengths: np.ndarray, cells: np.ndarray) -> np.ndarray:
    out = np.zeros((len(lengths), cells.shape[1]))
    filled = lengths > 0
    if filled.any():
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])[filled]
        out[filled] = np.add.reduceat(cells, starts, axis=0)
    return out


def _projected(lengths, columns, weights, block, low) -> np.ndarray:  # noqa: ANN001
    """Document rows times one slice of a block, whose first term is ``low``."""
    inside = (columns >= low) & (columns < low + len(block))
    row = np.repeat(np.arange(len(lengths)), lengths)[inside]
    part = block[columns[inside] - low] * weights[inside, None]
    return _row_sums(np.bincount(row, minlength=len(lengths)), part)


def _add_back(total: np.ndarray, lengths, columns, weights, projected, low) -> None:  # noqa: ANN001
    """Add the documents' weights times their projections to the terms of one slice."""
    inside = (columns >= low) & (columns < low + len(total))
    if not inside.any():
        return
    own = columns[inside] - low
    back = np.repeat(projected, lengths, axis=0)[inside] * weights[inside, None]
    order = np.argsort(own, kind="stable")
    own = own[order]
    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    total[own[starts]] += np.add.reduceat(back[order], starts, axis=0)


def _seen(view: View, batch: pa.RecordBatch, docs: slice, lengths: np.ndarray) -> np.ndarray:
    """1 for cells of documents that the view may learn from."""
    if view.held is None:
        return np.ones(int(lengths.sum()))
    folds = batch.column("fold").to_numpy(zero_copy_only=False)[docs]
    return np.repeat((folds != view.held).astype(float), lengths)


def _loaded(shared) -> np.ndarray:  # noqa: ANN001
    """The value of a broadcast, not kept by the worker: slices are read one after the other."""
    value = shared.value
    shared.__dict__.pop("_value", None)
    return value


# ── a term block in slices ────────────────────────────────────────────────────


class Block:
    """A (terms x width) matrix: an array on the driver if it is one slice, else (idx, vec) rows in the shared folder.

    The rows of a table count as multiplied by ``turn``, so that turning a block writes nothing.
    """

    def __init__(self, spark: SparkSession, n_terms: int, width: int, height: int, table: bool = False) -> None:
        self.spark, self.n_terms, self.width, self.height, self.table = spark, n_terms, width, height, table
        self.starts = list(range(0, n_terms, height))
        self.ends = [*self.starts[1:], n_terms]
        self.turn = np.eye(width)
        self.held: np.ndarray | DataFrame | None = None
        self.path: str | None = None
        #: The table's files by slice, if tasks can read them themselves.
        self.files: dict[int, list[str]] | None = None

    @property
    def whole(self) -> bool:
        return len(self.starts) == 1 and not self.table

    def having(self, held: np.ndarray | DataFrame, turn: np.ndarray | None = None) -> Block:
        twin = Block.__new__(Block)
        turn = np.eye(len(self.turn)) if turn is None else turn
        twin.__dict__ |= self.__dict__ | {"held": held, "turn": turn}
        twin.width = held.shape[1] if self.whole else twin.turn.shape[1]
        return twin

    def keep(self, rows: DataFrame) -> Block:
        """``rows`` (idx, vec as bytes, …) as a table whose files hold one slice each, so that reading a slice skips the others."""
        path = work_path(self.spark, "lsa-block")
        rows.withColumn("slice", F.floor(F.col("idx") / self.height).cast("int")).write.partitionBy("slice").parquet(path)
        fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema)
        kept = self.having(self.spark.read.schema(f"{fields}slice int").parquet(path).drop("slice"))
        kept.path, kept.files = path, _files(path)
        return kept

    def delete(self) -> None:
        """Remove the table, which nothing will read again."""
        if self.path:
            deleted(self.spark, self.path)

    @property
    def stored(self) -> Block:
        """The table as it was written, before any turn."""
        return self.having(self.held)

    def get(self, s: int) -> np.ndarray:
        if self.whole:
            return self.held
        if self.files is not None:
            found = _reader(self)(s)
        else:
            rows = self.held.where(F.col("idx").between(self.starts[s], self.ends[s] - 1))
            found = _matrix(rows.select("idx", "vec").toArrow().sort_by("idx").column("vec"))
        return found if np.array_equal(self.turn, np.eye(self.width)) else found @ self.turn

    def times(self, matrix: np.ndarray) -> Block:
        return self.having(self.held @ matrix) if self.whole else self.having(self.held, self.turn @ matrix)

    def rows(self, columns: slice) -> DataFrame:
        """(idx, vec) of some columns."""
        if self.whole:
            return frame(self.spark, 0, self.held[:, columns])
        turn = self.turn[:, columns]

        def turned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column("idx"), _lists(_matrix(batch.column("vec")) @ turn)], names=["idx", "vec"])

        return self.held.select("idx", "vec").mapInArrow(turned, "idx long, vec array<double>")


def _files(path: str) -> dict[int, list[str]] | None:
    """The files of a table in slices as Python tasks open them, None if they cannot."""
    found = opened(path)
    if not found:
        return None
    by_slice: dict[int, list[str]] = {}
    try:
        for info in found[0].get_file_info(fs.FileSelector(found[1], recursive=True)):
            if at := re.search(r"/slice=(\d+)/[^/.][^/]*\.parquet$", info.path):
                by_slice.setdefault(int(at[1]), []).append(info.path)
    except OSError:
        return None
    return by_slice or None


def _reader(block: Block) -> Callable[[int], np.ndarray]:
    """How a task reads a slice of a table from the shared folder, before any turn."""
    path, files, starts, ends, width = block.path, block.files, block.starts, block.ends, len(block.turn)

    def read(s: int) -> np.ndarray:
        out = np.zeros((ends[s] - starts[s], width))
        for name in files.get(s, ()):
            with opened(path)[0].open_input_file(name) as file:
                found = pq.ParquetFile(file).read(["idx", "vec"], use_threads=False)
            if found.num_rows:
                out[found.column("idx").to_numpy() - starts[s]] = _matrix(found.column("vec"))
        return out

    return read


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if not pa.types.is_list(vectors.type):
        _, bounds, data = vectors.cast(pa.large_binary()).buffers()
        first, last = np.frombuffer(bounds, np.int64)[[vectors.offset, vectors.offset + len(vectors)]]
        return np.frombuffer(data, float, (last - first) // 8, first).reshape(len(vectors), -1)
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _packed(values: np.ndarray) -> pa.Array:
    """Rows as bytes."""
    offsets = np.arange(len(values) + 1, dtype=np.int32) * np.int32(8 * values.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, np.ascontiguousarray(values).ravel())


def frame(spark: SparkSession, first: int, values: np.ndarray) -> DataFrame:
    return spark.createDataFrame(pa.table({"idx": np.arange(first, first + len(values), dtype=np.int64), "vec": _lists(values)}))


def _noise(low: int, high: int, width: int, seed: int) -> np.ndarray:
    """Normal numbers from a hash of (term number, column, seed)."""
    cell = np.arange(low * width, high * width, dtype=np.uint64) * _U(2) + _U(seed) * _U(0x9E3779B97F4A7C15)
    uniform = []
    for add in (0, 1):
        x = (cell + _U(add)) * _U(0x9E3779B97F4A7C15)
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        uniform.append(((x ^ (x >> _U(31))) >> _U(11)).astype(float) * 2.0**-53)
    radius = np.sqrt(-2.0 * np.log(1.0 - uniform[0]))
    return (radius * np.cos(2.0 * np.pi * uniform[1])).reshape(high - low, width)


def _diagonal(views: int, width: int) -> np.ndarray:
    return np.kron(np.eye(views), np.ones((width, width)))


def _start(block: Block, views: int, seed: int) -> Block:
    """``block`` with the noise of each view, the same for all."""
    width = block.width // views
    if block.whole:
        return block.having(np.tile(_noise(0, block.n_terms, width, seed), views))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # numbers of a range come in order
            low, high = batch.column("idx")[0].as_py(), batch.column("idx")[-1].as_py() + 1
            yield pa.RecordBatch.from_arrays([batch.column("idx"), _packed(np.tile(_noise(low, high, width, seed), views))], names=["idx", "vec"])

    numbers = block.spark.range(0, block.n_terms, 1, len(block.starts)).toDF("idx")
    return block.keep(numbers.mapInArrow(fill, "idx long, vec binary"))


def _side_by_side(left: Block, right: Block) -> DataFrame | None:
    """(idx, vec, other) of two blocks that are tables."""
    if left.whole:
        return None
    return written(left.held.join(right.held.withColumnRenamed("vec", "other"), "idx"), "lsa-pair")


def _grams(left: Block, right: Block, views: int, pair: DataFrame | None = None) -> np.ndarray:
    """leftᵀ · right within each view, zero between views."""
    if left.whole:
        total = left.held.T @ right.held
    else:
        rows, shape, other = left.held if left is right else pair, (left.width, right.width), "vec" if left is right else "other"
        turns = left.turn, right.turn

        def inner(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            found = np.zeros(shape)
            for batch in batches:
                if not batch.num_rows:
                    continue
                one = _matrix(batch.column("vec")) @ turns[0]
                found += one.T @ (one if other == "vec" else _matrix(batch.column(other)) @ turns[1])
            return found

        total = total_of(rows, inner, shape)
    return total * _diagonal(views, left.width // views)


def _gaps(loadings: Block, images: Block, values: np.ndarray, pair: DataFrame | None) -> np.ndarray:
    """Squared length of (image - loading · value) by column."""
    if loadings.whole:
        return ((images.held - loadings.held * values) ** 2).sum(axis=0)
    turns = loadings.turn, images.turn

    def squares(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        found = np.zeros(len(values))
        for batch in batches:
            if not batch.num_rows:
                continue
            gap = _matrix(batch.column("other")) @ turns[1] - (_matrix(batch.column("vec")) @ turns[0]) * values
            found += (gap**2).sum(axis=0)
        return found

    return total_of(pair, squares, (len(values),))


def _orthonormal(block: Block, views: int) -> Block:
    """Cholesky QR within each view, twice for accuracy: only small matrices are inverted."""
    # The session was started by a fork, which ends OpenBLAS's threads. A product starts them again; an inverse that comes first waits for ever.
    _ = np.ones((256, 256)) @ np.ones((256, 256))
    for _ in range(2):
        upper = np.linalg.cholesky(_grams(block, block, views)).T
        block = block.times(np.linalg.inv(upper))
    return block


def _by_slice(views: Sequence[View], piece, height: int, first: int, last: int):  # noqa: ANN001, ANN202
    """A piece's cells in slices ``first`` to ``last``, slice after slice and by row in each: first document, rows, columns, weights by view, bounds of slices."""
    docs, lengths, columns, counts = piece
    here = np.flatnonzero((columns >= first * height) & (columns < (last + 1) * height))
    order = here[np.argsort(columns[here] // height, kind="stable")]
    row = np.repeat(np.arange(len(lengths)), lengths)[order]
    weights = [_weights(view, lengths, columns, counts)[order] for view in views]
    columns = columns[order]
    return docs.start, row, columns, weights, np.searchsorted(columns // height, np.arange(first, last + 2))


def _place_slice(out: np.ndarray, matrix: np.ndarray, low: int, s: int, piece, width: int) -> None:  # noqa: ANN001
    """Add the cells of a piece's ``s``-th slice to the projections of its documents."""
    first, row, columns, weights, bounds = piece
    for at in range(bounds[s], bounds[s + 1], _SLICE_CELLS):
        cells = slice(at, min(at + _SLICE_CELLS, bounds[s + 1]))
        own = row[cells]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        for v, weight in enumerate(weights):
            part = slice(v * width, (v + 1) * width)
            products = matrix[columns[cells] - low, part]
            products *= weight[cells, None]
            out[first + own[starts], part] += np.add.reduceat(products, starts, axis=0)


def project_all(rows: DataFrame, views: Sequence[View], block: Block, keep: Sequence[str] = ()) -> DataFrame:
    """``rows`` (``keep``) with ``p``: their projections under every view side by side."""
    if block.files is not None:
        return _placed_at_once(rows, views, block, keep)[0]
    return _projections(rows, views, block, keep)[0]


def _projections(rows: DataFrame, views: Sequence[View], block: Block, keep: Sequence[str]) -> tuple[DataFrame, list]:
    """The projections, and the broadcasts they read."""
    few = max(1, HELD_BYTES // (8 * block.width * block.height))
    carried = list(dict.fromkeys([*keep, "idx", "n"]))
    for first in range(0, len(block.starts), few):
        last = min(first + few, len(block.starts)) - 1
        if last == len(block.starts) - 1:
            return _placed(rows, views, block, keep, first, last)
        found, parts = _placed(rows, views, block, carried, first, last)
        rows = written(found, "lsa-projected")
        for part in parts:
            part.destroy()
    raise ValueError("a block has one slice at least")


def _placed(rows: DataFrame, views: Sequence[View], block: Block, keep: Sequence[str], first: int, last: int) -> tuple[DataFrame, list]:
    """``rows`` (``keep``) with ``p``, to which slices ``first`` to ``last`` are added, and the broadcasts they read."""
    sc = rows.sparkSession.sparkContext
    slices = [(block.starts[s], sc.broadcast(block.get(s))) for s in range(first, last + 1)]
    shared, width, height, whole = sc.broadcast(list(views)), block.width // len(views), block.height, block.whole
    before = ["p"] if first else []
    kept = rows.select(*dict.fromkeys([*keep, "idx", "n", *before]))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.select(*keep).schema) + "p array<double>"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros((batch.num_rows, block_width))
            if first:
                out += batch.column("p").flatten().to_numpy(zero_copy_only=False).reshape(out.shape)
            if whole:
                matrix = slices[0][1].value
                for docs, lengths, columns, counts in _chunks(batch):
                    for v, view in enumerate(shared.value):
                        own = slice(v * width, (v + 1) * width)
                        weights = _weights(view, lengths, columns, counts)
                        out[docs, own] += _projected(lengths, columns, weights, matrix[:, own], 0)
            else:
                # Every slice is read once for a batch.
                pieces = [_by_slice(shared.value, piece, height, first, last) for piece in _chunks(batch, _PIECE_CELLS)]
                for s, (low, part) in enumerate(slices):
                    matrix = _loaded(part)
                    for piece in pieces:
                        _place_slice(out, matrix, low, s, piece, width)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], _lists(out)], names=[*keep, "p"])

    block_width = block.width
    return kept.mapInArrow(place, schema), [shared, *[part for _, part in slices]]


# ── tables that tasks read themselves ─────────────────────────────────────────


def _sent(block: Block) -> list:
    """Broadcasts of the first slices: what the driver may hold. Tasks read the others."""
    few, table = max(1, HELD_BYTES // (8 * len(block.turn) * block.height)), block.stored
    return [block.spark.sparkContext.broadcast(table.get(s)) for s in range(min(few, len(block.starts)))]


def _add_slices(out: np.ndarray, pieces: list, sent: list, read: Callable[[int], np.ndarray], starts: Sequence[int], width: int) -> None:
    """Add the products of the pieces' cells with every slice that they need; each is read once."""
    for s, low in enumerate(starts):
        if any(bounds[s] < bounds[s + 1] for *_, bounds in pieces):
            matrix = _loaded(sent[s]) if s < len(sent) else read(s)
            for piece in pieces:
                _place_slice(out, matrix, low, s, piece, width)


def _joined(batches: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together, up to ``most_rows`` documents or some millions of cells, unless one alone has more."""
    kept: list[pa.RecordBatch] = []
    rows = cells = 0
    for batch in batches:
        for at in range(0, batch.num_rows, most_rows):
            kept.append(batch.slice(at, most_rows))
            rows, cells = rows + kept[-1].num_rows, cells + len(kept[-1].column("idx").flatten())
            if rows >= most_rows or cells >= _JOINED_CELLS:
                yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                kept, rows, cells = [], 0, 0
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _placed_at_once(rows: DataFrame, views: Sequence[View], block: Block, keep: Sequence[str], scaled: bool = False) -> tuple[DataFrame, list]:
    """``rows`` (``keep``) with ``p`` in one pass, and the broadcasts it reads.

    ``scaled``: (idx, vec, norm) by document number instead, for the way back to the
    terms. Vectors are divided by the documents' norms, and zero where a view may not learn.
    """
    sc = rows.sparkSession.sparkContext
    sent, shared = _sent(block), sc.broadcast(list(views))
    kept = rows.select(*dict.fromkeys([*keep, "idx", "n"]))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.select(*keep).schema) + "p array<double>"
    read, starts, turn, height = _reader(block), block.starts, block.turn, block.height
    width, own_width = len(turn) // len(views), turn.shape[1] // len(views)
    most_rows = max(1, _JOINED_BYTES // (8 * len(turn)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches, most_rows):
            out = np.zeros((batch.num_rows, len(turn)))
            pieces = [_by_slice(shared.value, piece, height, 0, len(starts) - 1) for piece in _chunks(batch, _PIECE_CELLS)]
            _add_slices(out, pieces, sent, read, starts, width)
            out = out @ turn
            if not scaled:
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], _lists(out)], names=[*keep, "p"])
                continue
            norms = np.ones((batch.num_rows, len(shared.value)))
            for docs, lengths, columns, counts in _chunks(batch, _PIECE_CELLS):
                row = np.repeat(np.arange(len(lengths)), lengths)
                for v, view in enumerate(shared.value):
                    norms[docs, v] = _norms(lengths, row, counts * view.idf[columns])
            for v, view in enumerate(shared.value):
                learns = 1.0 if view.held is None else (batch.column("fold").to_numpy(zero_copy_only=False) != view.held)[:, None]
                out[:, v * own_width : (v + 1) * own_width] *= learns / norms[:, v, None]
            yield pa.RecordBatch.from_arrays([batch.column("number"), _packed(out), _packed(norms)], names=["idx", "vec", "norm"])

    return kept.mapInArrow(place, "idx long, vec binary, norm binary" if scaled else schema), [shared, *sent]


@dataclass
class Sides:
    """The cells by document (number, [fold,] idx, n) and, a row for each group of terms, by term (terms, sizes, docs, n)."""

    by_doc: DataFrame
    by_term: DataFrame
    n_docs: int
    path: str

    def placed(self, views: Sequence[View], block: Block, slice_bytes: int) -> Block:
        """The documents' vectors, divided by their norms, as a table in slices."""
        fold = ["fold"] if any(v.held is not None for v in views) else []
        width = block.turn.shape[1]
        docs = Block(block.spark, self.n_docs, width, max(1, slice_bytes // (8 * width)), table=True)
        found, parts = _placed_at_once(self.by_doc, views, block, ["number", *fold], scaled=True)
        out = docs.keep(found)
        for part in parts:
            part.destroy()
        return out

    def back(self, views: Sequence[View], placed: Block) -> tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[np.ndarray, np.ndarray]]], list]:
        """How a task makes (terms, rows of AᵀA times the block) of its groups, and the broadcasts it reads."""
        sent, shared = _sent(placed), placed.spark.sparkContext.broadcast(list(views))
        read, starts, height, full = _reader(placed), placed.starts, placed.height, placed.width
        width = full // len(views)

        def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for at in range(batch.num_rows):
                    terms, sizes, docs, n = (batch.column(c)[at].values.to_numpy() for c in ("terms", "sizes", "docs", "n"))
                    order = np.argsort(docs // height, kind="stable")
                    row, docs, n = np.repeat(np.arange(len(terms)), sizes)[order], docs[order], n[order].astype(float)
                    out = np.zeros((len(terms), full))
                    _add_slices(out, [(0, row, docs, [n] * len(shared.value), np.searchsorted(docs // height, np.arange(len(starts) + 1)))], sent, read, starts, width)
                    for v, view in enumerate(shared.value):
                        out[:, v * width : (v + 1) * width] *= view.idf[terms][:, None]
                    yield terms, out

        return groups, [shared, *sent]

    def product(self, views: Sequence[View], block: Block, slice_bytes: int) -> Block:
        """AᵀA times a block, whose table is deleted."""
        placed = self.placed(views, block, slice_bytes)
        block.delete()
        groups, parts = self.back(views, placed)

        def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for terms, found in groups(batches):
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int64()), _packed(found)], names=["idx", "vec"])

        out = block.stored.keep(self.by_term.mapInArrow(back, "idx long, vec binary"))
        for part in parts:
            part.destroy()
        placed.delete()
        return out

    def products(self, views: Sequence[View], block: Block, slice_bytes: int) -> tuple[np.ndarray, np.ndarray]:
        """Vᵀ·AᵀA·V and the square of AᵀA·V within each view, for a block V that stays."""
        placed = self.placed(views, block, slice_bytes)
        width, shape = block.width // len(views), (block.width, block.width)

        def inner(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            found = np.zeros(shape)
            for batch in batches:
                if batch.num_rows:
                    rows = _matrix(batch.column("vec")) * np.repeat(_matrix(batch.column("norm")), width, axis=1)
                    found += rows.T @ rows
            return found

        groups, parts = self.back(views, placed)

        def squares(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            found = np.zeros(shape)
            for _, rows in groups(batches):
                found += rows.T @ rows
            return found

        out = [total_of(rows, add, shape) * _diagonal(len(views), width) for rows, add in ((placed.held, inner), (self.by_term, squares))]
        for part in parts:
            part.destroy()
        placed.delete()
        return out[0], out[1]


def _edges(cells: np.ndarray, width: int) -> np.ndarray:
    """The first terms of groups with similar numbers of ``cells``, whose rows of ``width`` numbers fit into a task."""
    least, most = _GROUP_CELLS
    some = min(most, max(least, int(cells.sum()) // 64))
    by_cells, by_terms = np.cumsum(cells) // some, np.arange(len(cells)) // max(1, _JOINED_BYTES // (16 * width))
    return np.flatnonzero(np.r_[True, (by_cells[1:] != by_cells[:-1]) | (by_terms[1:] != by_terms[:-1])])


def _sides(rows: DataFrame, cells: np.ndarray, width: int) -> Sides:
    """``rows`` ([fold,] idx, n, part, at) numbered, and turned round: one shuffle of all cells."""
    spark = rows.sparkSession
    sizes = {r["part"]: r["n"] for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = np.zeros(max(sizes, default=-1) + 2, np.int64)
    base[[p + 1 for p in sizes]] = list(sizes.values())
    base = np.cumsum(base)
    edges = _edges(cells, width)
    by_doc = rows.withColumn("number", F.element_at(F.lit(base), F.col("part") + 1) + F.col("at"))
    shared = spark.sparkContext.broadcast(np.r_[edges, len(cells)])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("number").to_numpy()
            for docs, lengths, columns, counts in _chunks(batch, _PIECE_CELLS):
                order = np.argsort(columns, kind="stable")
                bounds = np.searchsorted(columns[order], shared.value)
                groups = np.flatnonzero(np.diff(bounds))
                at = pa.array(np.r_[0, bounds[1:][groups]], pa.int32())
                found = (columns, pa.int32()), (np.repeat(numbers[docs], lengths), pa.int64()), (counts, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(v[order].astype(t.to_pandas_dtype()), t)) for v, t in found]
                yield pa.RecordBatch.from_arrays([pa.array(groups), *lists], names=["part", "idx", "docs", "n"])

    def turned(table: pa.Table) -> pa.Table:
        idx, docs, n = (np.concatenate([c.flatten().to_numpy() for c in table.column(name).chunks]) for name in ("idx", "docs", "n"))
        order = np.lexsort([docs, idx])
        terms, sizes = np.unique(idx, return_counts=True)
        values = (terms, pa.int32()), (sizes.astype(np.int32), pa.int32()), (docs[order], pa.int64()), (n[order], pa.int32())
        return pa.table({name: pa.array([v], pa.list_(t)) for name, (v, t) in zip(("terms", "sizes", "docs", "n"), values, strict=True)})

    parts = by_doc.select("number", "idx", "n").mapInArrow(split, "part long, idx array<int>, docs array<long>, n array<int>")
    by_term = parts.repartition(len(edges), "part").groupBy("part").applyInArrow(turned, "terms array<int>, sizes array<int>, docs array<long>, n array<int>")
    path = work_path(spark, "lsa-terms")
    with shuffles_deleted(spark):
        by_term.write.parquet(path)
    return Sides(by_doc, spark.read.schema(by_term.schema).parquet(path), int(base[-1]), path)


# ── passes ────────────────────────────────────────────────────────────────────


def _added_rows(table: pa.Table) -> pa.Table:
    """One group of terms: the sum of each term's rows."""
    idx, found = table.column("idx").to_numpy(), _matrix(table.column("vec"))
    order = np.argsort(idx, kind="stable")
    idx = idx[order]
    starts = np.flatnonzero(np.r_[True, idx[1:] != idx[:-1]])
    return pa.table({"idx": idx[starts], "vec": _packed(np.add.reduceat(found[order], starts, axis=0))})


def _product(rows: DataFrame, views: Sequence[View], block: Block) -> Block:
    """AᵀA times a block, for every view at once."""
    sc = rows.sparkSession.sparkContext
    shared, width, full = sc.broadcast(list(views)), block.width // len(views), block.width
    fold = ["fold"] if any(v.held is not None for v in views) else []
    if block.whole:
        part = sc.broadcast(block.get(0))
        shape = (block.n_terms, full)

        def both(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            matrix, total = part.value, np.zeros(shape)
            for batch in batches:
                for docs, lengths, columns, counts in _chunks(batch):
                    for v, view in enumerate(shared.value):
                        own = slice(v * width, (v + 1) * width)
                        weights = _weights(view, lengths, columns, counts) * _seen(view, batch, docs, lengths)
                        projected = _projected(lengths, columns, weights, matrix[:, own], 0)
                        _add_back(total[:, own], lengths, columns, weights, projected, 0)
            return total

        out = block.having(total_of(rows.select(*fold, "idx", "n"), both, shape))
        part.unpersist()
        return out
    # No cell is moved: every document's projection is written beside its counts.
    found, parts = _projections(rows, views, block, [*fold, "idx", "n"])
    placed = written(found, "lsa-projected")
    for part in parts:
        part.destroy()
    group, at_once = max(1, block.height // _GROUPS), max(1, _PRODUCT_BYTES // (8 * full))

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column("p"))
            for docs, lengths, columns, counts in _chunks(batch, _PIECE_CELLS):
                weights = [_weights(view, lengths, columns, counts) * _seen(view, batch, docs, lengths) for view in shared.value]
                order = np.argsort(columns, kind="stable")
                row = np.repeat(np.arange(docs.start, docs.stop), lengths)
                for at in range(0, len(order), at_once):
                    cells = order[at : at + at_once]
                    products = found[row[cells]]
                    for v, weight in enumerate(weights):
                        products[:, v * width : (v + 1) * width] *= weight[cells, None]
                    own = columns[cells]
                    starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                    terms = own[starts]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(terms // group), pa.array(terms), _packed(np.add.reduceat(products, starts, axis=0))], names=["part", "idx", "vec"]
                    )

    sums = placed.mapInArrow(back, "part long, idx long, vec binary").groupBy("part").applyInArrow(_added_rows, "idx long, vec binary")
    return block.keep(sums)


# ── public operators ──────────────────────────────────────────────────────────


def _signs(block: Block) -> np.ndarray:
    """+1/-1 per column so that its largest loading is positive."""

    def extremes(values: np.ndarray) -> np.ndarray:
        return values[np.abs(values).argmax(axis=0), np.arange(values.shape[1])]

    if block.whole:
        found = extremes(block.held)
    else:
        turn = block.turn

        def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept = [extremes(_matrix(batch.column("vec")) @ turn) for batch in batches if batch.num_rows]
            if kept:
                yield pa.RecordBatch.from_arrays([_lists(extremes(np.array(kept))[None])], names=["vec"])

        # One row of each task.
        found = extremes(np.array([r["vec"] for r in block.held.select("vec").mapInArrow(largest, "vec array<double>").collect()]))
    return np.where(found < 0, -1.0, 1.0)


def _leading(
    rows: DataFrame, numbered: DataFrame, cells: np.ndarray, views: Sequence[View], dims: int, width: int, rounds: int, seed: int, slice_bytes: int
) -> tuple[Block, list[float]]:
    """Leading eigenvectors of every view's AᵀA side by side, and how far each view is from exact ones."""
    columns = width * len(views)
    block = Block(rows.sparkSession, len(cells), columns, max(1, slice_bytes // (8 * columns)))
    block = _start(block, len(views), seed)
    sides = _sides(numbered, cells, columns) if block.files is not None else None
    for _ in range(rounds):
        block = _orthonormal(block, len(views))
        block = sides.product(views, block, slice_bytes) if sides else _product(rows, views, block)
    block = _orthonormal(block, len(views))
    if sides:
        inner, squares = sides.products(views, block, slice_bytes)
        deleted(rows.sparkSession, sides.path)
    else:
        product = _product(rows, views, block)
        pair = _side_by_side(block, product)
        inner = _grams(block, product, len(views), pair)
    turn, values = np.zeros((columns, dims * len(views))), np.zeros(dims * len(views))
    for v in range(len(views)):
        own = slice(v * width, (v + 1) * width)
        found, vectors = np.linalg.eigh((inner[own, own] + inner[own, own].T) / 2)
        order = np.argsort(found)[::-1][:dims]
        turn[own, v * dims : (v + 1) * dims] = vectors[:, order]
        values[v * dims : (v + 1) * dims] = found[order]
    loadings = block.times(turn)
    if sides:
        # The block's columns are orthonormal: |Yt - Vt·λ|² from products of columns alone.
        gaps = ((squares @ turn) * turn).sum(axis=0) - 2 * values * ((inner @ turn) * turn).sum(axis=0) + values**2
        gaps = np.maximum(gaps, 0.0)
    else:
        gaps = _gaps(loadings, product.times(turn), values, pair)
    by_view = np.sqrt(gaps).reshape(len(views), dims)
    residuals = (by_view.max(axis=1) / np.maximum(values.reshape(len(views), dims)[:, 0], 1e-300)).tolist()
    return loadings.times(np.diag(_signs(loadings))), residuals


def _positioned(rows: DataFrame) -> DataFrame:
    """``rows`` with the task that wrote each (``part``) and its place there (``at``)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            own = [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(np.arange(at, at + batch.num_rows, dtype=np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], names=[*batch.schema.names, "part", "at"])
            at += batch.num_rows

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema)
    return rows.mapInArrow(place, f"{schema}part int, at long")


def counted_rows(bags: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, [fold,] idx, n) of documents that hold a term, looked up inside the task."""
    keep = [c for c in ("doc_id", "fold") if c in bags.columns]
    return bag_positions(bags, terms, keep).where(F.size("idx") > 0)


def fit_lsa(
    docs: DataFrame,
    dims: int = 100,
    settings: TextSettings = TFIDF_TEXT,
    rounds: int = 5,
    oversample: int = 10,
    seed: int = 42,
    slice_bytes: int = SLICE_BYTES,
    folds: Sequence[int] | None = None,
) -> Fit:
    """Model of documents that carry ``terms``; with ``folds``, one for each held-out ``fold``.

    Folds are counted together: a fold's document frequencies are the totals less
    its own, and all fits share their passes. Terms that only other views know weigh
    nothing. A residual over a tenth is a warning: more rounds would change the vectors.
    """
    keep = ["doc_id", *(["fold"] if folds is not None else [])]
    spark = docs.sparkSession
    bags_path = work_path(spark, "lsa-bags")
    bags_of(docs.select(*keep, "terms"), keep).write.parquet(bags_path)
    bags = spark.read.parquet(bags_path)
    held: list[int | None] = [None] if folds is None else list(folds)
    sizes = {r["fold"]: r["n"] for r in bags.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()} if folds is not None else {}
    n_docs = sum(sizes.values()) if folds is not None else bags.count()
    cells = bags.select(*keep[1:], F.inline("bag"))
    own = [F.count_if(F.col("fold") == f).alias(f"own_{f}") for f in held if f is not None]
    counts = cells.groupBy("term").agg(F.count(F.lit(1)).alias("all"), *own)
    df = {f: F.col("all") - F.col(f"own_{f}") if f is not None else F.col("all") for f in held}
    kept = {f: df_bounds(n_docs - sizes.get(f, 0), settings, c) for f, c in df.items()}
    idf = {f: F.when(kept[f], F.log((1.0 + n_docs - sizes.get(f, 0)) / (1.0 + df[f])) + 1.0).otherwise(0.0) for f in held}
    wanted = counts.select("term", F.col("all").alias("df"), *[c.alias(f"idf_{n}") for n, c in enumerate(idf.values())])
    some = " or ".join(f"idf_{n} > 0" for n in range(len(held)))
    terms = cut(require_terms(vocabulary(wanted.where(some))))
    table = terms.select("idx", "df", *[f"idf_{n}" for n in range(len(held))]).toArrow().sort_by("idx")
    views = [View(f, table.column(f"idf_{n}").to_numpy()) for n, f in enumerate(held)]
    n_terms = table.num_rows
    least = min(int((v.idf > 0).sum()) for v in views)
    if dims > least:
        raise ValueError(f"{dims} dimensions need at least as many terms, found {least}")
    numbered = written(_positioned(counted_rows(bags, terms)), "lsa-rows")
    deleted(spark, bags_path)
    rows = numbered.drop("part", "at")
    # Every task returns a slice, so it should read several cells per term.
    n_cells = rows.agg(F.sum(F.size("idx"))).first()[0] or 0
    tasks = max(1, n_cells // (_CELLS_PER_TERM * n_terms))
    few = rows.coalesce(tasks) if rows.rdd.getNumPartitions() > tasks else rows
    width = min(dims + oversample, least)
    loadings, residuals = _leading(few, numbered, table.column("df").to_numpy(), views, dims, width, rounds, seed, slice_bytes)
    if max(residuals) > 0.1:
        warnings.warn(f"LSA residual {max(residuals):.3f} after {rounds} rounds", stacklevel=2)
    models = {}
    for n, view in enumerate(views):
        named = terms.select("term", "df", F.col(f"idf_{n}").alias("idf"), "idx")
        own = loadings.rows(slice(n * dims, (n + 1) * dims))
        left = None if loadings.whole or len(views) > 1 else loadings
        models[view.held] = LsaModel(named, own if left else cut(own), n_terms, dims, residuals[n], left)
    return Fit(models, views, rows)


def _block_of(model: LsaModel, slice_bytes: int) -> Block:
    if model.block is not None and 8 * model.block.height * len(model.block.turn) <= slice_bytes:
        return model.block
    block = Block(model.components.sparkSession, model.n_terms, model.dims, max(1, slice_bytes // (8 * model.dims)))
    vectors = model.components.select("idx", "vec")
    if block.whole:
        return block.having(_matrix(vectors.toArrow().sort_by("idx").column("vec")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("idx"), _packed(_matrix(batch.column("vec")))], names=["idx", "vec"])

    return block.keep(vectors.mapInArrow(pack, "idx long, vec binary"))


def view_of(model: LsaModel) -> View:
    return View(None, model.terms.select("idx", "idf").toArrow().sort_by("idx").column("idf").to_numpy())


def project(model: LsaModel, rows: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(doc_id, vec): U·Σ of the given counted rows, before unit length."""
    placed = project_all(rows, [view_of(model)], _block_of(model, slice_bytes), ["doc_id"])
    return placed.select("doc_id", F.col("p").alias("vec"))


def unit(vec):
    """Unit-length array; zeros stay zeros."""
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))
    # Bound to a name: inside the inner function it would be added up again for every number.
    return let(norm, lambda n: F.when(n > 0, F.transform(vec, lambda x: x / n)).otherwise(vec))


def lsa_vectors(docs: DataFrame, model: LsaModel, rows: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every document with its unit vector; zeros where no term is known."""
    placed = cut(project(model, rows, slice_bytes))
    zeros = F.array_repeat(F.lit(0.0), model.dims)
    return (
        docs.join(placed, "doc_id", "left")
        .withColumn("raw", F.coalesce("vec", zeros))
        .withColumn("vec", unit(F.col("raw")))
    )


def weighted(rows: DataFrame, view: View) -> DataFrame:
    """(doc_id, idx, w): TF-IDF cells of counted rows, with unit rows."""
    shared = rows.sparkSession.sparkContext.broadcast(view)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, lengths, columns, counts in _chunks(batch):
                w = _weights(shared.value, lengths, columns, counts)
                ids = np.repeat(batch.column("doc_id").to_numpy()[docs], lengths)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(columns), pa.array(w)], names=["doc_id", "idx", "w"])

    return rows.select("doc_id", "idx", "n").mapInArrow(weigh, "doc_id long, idx long, w double")


def term_spread(rows: DataFrame, view: View, n_docs: int, slice_bytes: int = SLICE_BYTES) -> float:
    """Sum over all terms of the variance of their weights; sums per term are added up slice by slice."""
    shared = rows.sparkSession.sparkContext.broadcast(view)
    total, height = 0.0, max(1, slice_bytes // 16)
    for low in range(0, len(view.idf), height):
        shape = (min(height, len(view.idf) - low), 2)

        def sums(batches: Iterator[pa.RecordBatch], low: int = low, shape: tuple[int, int] = shape) -> np.ndarray:
            out = np.zeros(shape)
            for batch in batches:
                for _, lengths, columns, counts in _chunks(batch):
                    w = _weights(shared.value, lengths, columns, counts)
                    inside = (columns >= low) & (columns < low + shape[0])
                    for power in (1, 2):
                        out[:, power - 1] += np.bincount(columns[inside] - low, w[inside] ** power, shape[0])
            return out

        s1, s2 = (total_of(rows.select("idx", "n"), sums, shape) / n_docs).T
        total += float((s2 - s1 * s1).sum())
    return total


def explained_variance(vectors: DataFrame, model: LsaModel, rows: DataFrame) -> float:
    """Share of the TF-IDF variance that the (not yet unit) vectors keep."""
    kept = vectors.agg(F.count(F.lit(1)), *[F.var_pop(F.col("raw")[i]) for i in range(model.dims)]).first()
    return float(sum(kept[1:]) / term_spread(rows, view_of(model), kept[0]))

