"""Repeated windows of a fixed number of units (words or bytes), found through anchors.

Shared by substring and suffix-array de-duplication. A window belongs to the anchor
that its own content selects (``kernel.anchored``), so only about one position in
``(window - part) / 2`` is shuffled. Where everything around an anchor is repeated,
all its windows are; single windows are compared only at the edges of repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmine.llm import kernel as K
from newsmine.llm.common import NULL_ID, Batches, sampled, stored

_FLUSH = 2_000_000  # entries that a task combines at once
SPREAD = 1 << 15
SALTS = 64  # tasks that share a frequent anchor
LONG = 64  # units of a window from which on levels do not double
#: Bytes of a block: eight bytes for each stay below the size from which arrays are given back, so they are not mapped anew.
BLOCK = 64 * 1024

Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def word_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = K.words(data, offsets)
    return K.word_hashes(data, starts, ends), first


def byte_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return K.byte_units(data), offsets


@dataclass(frozen=True)
class Shape:
    """``window`` units must repeat; anchors are ``part`` units long."""

    units: Units
    window: int
    part: int
    #: True: the first of equal windows stays. False: none does.
    keep_first: bool

    def longer(self) -> Shape:
        """The next level: anchors of twice the length, at most whole windows.

        Long windows go to seven eighths at once: beside the end of a repeated passage, as many
        windows are compared one by one as the last anchor is shorter than the window.
        """
        last = self.window * 7 // 8
        part = 2 * self.part if self.window < LONG else last
        return replace(self, part=part if self.part < part < self.window else self.window)


def texts_of(docs: DataFrame, rest: bool = False) -> DataFrame:
    """(id, twin, text[, rest]): ``twin`` tells texts apart that share a doc_id.

    ``rest`` carries all columns of the row; for the text, only whether there is one.
    """
    text = F.col("text").cast("string")
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text).alias("twin"),
        text.alias("text"),
        *([F.struct(*[text.isNotNull().alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]).alias("rest")] if rest else []),
    )


def _combined(columns: dict[str, np.ndarray], keys: list[str], keep_first: bool, seed: int, frequent: np.ndarray) -> pa.RecordBatch:
    """Combine a task's rows by ``keys``: one row of each stands for them (``many`` if others follow).

    Rows known to be covered already are marked ``sure``. They need no partner
    any more, so a number deals them out evenly instead of by key. Rows of
    ``frequent`` anchors are dealt by their surroundings as well (a negative salt).
    """
    n = len(columns["id"])
    order = np.lexsort([columns["at"], columns["twin"], columns["id"], *(columns[k] for k in reversed(keys))])
    columns = {k: v[order] for k, v in columns.items()}
    new = np.ones(n, bool)
    moved = np.zeros(n, bool)  # another place than the row before
    for k in keys:
        new[1:] &= columns[k][1:] == columns[k][:-1]
    new[1:] = ~new[1:] if n else new[1:]
    for k in ("id", "twin", "at"):
        moved[1:] |= columns[k][1:] != columns[k][:-1]
    group = np.cumsum(new) - 1
    places = np.zeros(group[-1] + 1 if n else 0, np.int64)
    np.add.at(places, group, (moved & ~new).astype(np.int64))
    many = places[group] > 0
    # Rows at the very place of the group's first one are that document again.
    place = np.cumsum(new | moved)
    leader = place == np.maximum.accumulate(np.where(new, place, 0))
    sure = ~leader if keep_first else many
    stands = new
    rest = sure & ~stands
    twice = stands & sure if not keep_first else np.zeros(n, bool)
    spread = (np.arange(n) * 7919 + seed) % SPREAD + 1
    common = np.isin(columns["anchor"].view(np.int64), frequent)
    dealt = np.where(common, (columns["around"].view(np.uint64) % np.uint64(SALTS)).astype(np.int64) - SALTS, 0)
    parts = []
    for rows, covered in ((stands, False), (rest, True), (twice, True)):
        at = np.flatnonzero(rows)
        salt = spread[at] if covered else dealt[at]
        parts.append({k: v[at] for k, v in columns.items()} | {"many": many[at], "sure": np.full(len(at), covered), "salt": salt.astype(np.int32)})
    whole = {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}
    return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64) if v.dtype == np.uint64 else v) for v in whole.values()], names=list(whole))


ENTRY = "id long, twin long, at int, first int, last int, anchor long, around long, many boolean, sure boolean, salt int"
EDGE = "id long, twin long, at int, anchor long, around long, many boolean, sure boolean, salt int"


def _gather(blocks: Iterator[dict[str, np.ndarray]], keys: list[str], keep_first: bool, frequent: np.ndarray) -> Batches:
    from pyspark import TaskContext

    seed = TaskContext.get().partitionId() * 104729
    held: list[dict[str, np.ndarray]] = []
    size = 0
    for block in blocks:
        held.append(block)
        size += len(block["id"])
        if size >= _FLUSH:
            yield _combined({k: np.concatenate([h[k] for h in held]) for k in held[0]}, keys, keep_first, seed, frequent)
            held, size = [], 0
    if size:
        yield _combined({k: np.concatenate([h[k] for h in held]) for k in held[0]}, keys, keep_first, seed, frequent)


def frequent_anchors(texts: DataFrame, shape: Shape, rows: int = 4_000, percent: int = 1) -> np.ndarray:
    """Anchors in about one hundredth of all texts or more, as a sample of the texts shows them.

    They only say which anchors are dealt to several tasks; what is found does not
    depend on them. A text has a bounded number of anchors per byte, so the list is short.
    """
    some = sampled(texts, rows, F.col("id"))
    counts = entries(some, shape, np.zeros(0, np.int64)).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    found = counts.where(F.col("n") >= max(2, rows * percent // 100)).select("anchor").collect()
    return np.array([r["anchor"] for r in found], np.int64)


def entries(texts: DataFrame, shape: Shape, frequent: np.ndarray, opens: DataFrame | None = None, inner: int = 1) -> DataFrame:
    """One row per anchor, combined inside each task (ENTRY).

    With ``opens``, of their windows only: those at whose start, and at the ``inner`` - 1 starts behind it, a window is open.
    """
    rows, whole = texts.select("id", "twin", "text"), opens is None
    if opens is not None:
        rows = rows.join(_listed(opens), ["id", "twin"]).select("id", "twin", "text", "marks")

    def run(batches: Batches) -> Batches:
        def found() -> Iterator[dict[str, np.ndarray]]:
            for batch in batches:
                for rows, data, offsets in K.blocks(batch, size=BLOCK):
                    units, first = shape.units(data, offsets)
                    allowed = None if whole else _runs(_covered(len(units), first, rows.column(3), 1), inner)
                    got = K.anchored(units, first, shape.window, shape.part, allowed)
                    text = got.pop("text")
                    ids, twin = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    yield {
                        "id": ids[text], "twin": twin[text], "at": got["at"].astype(np.int32), "first": got["first"].astype(np.int32),
                        "last": got["last"].astype(np.int32), "anchor": got["anchor"], "around": got["around"],
                    }

        yield from _gather(found(), ["anchor", "around"], shape.keep_first, frequent)

    return rows.mapInArrow(run, ENTRY)


def _listed(marks: DataFrame) -> DataFrame:
    return marks.groupBy("id", "twin").agg(F.collect_list(F.struct(*[c for c in ("first", "last", "anchor") if c in marks.columns])).alias("marks"))


def _place() -> Column:
    return F.struct("id", "twin", "at")


def covered_rows(rows: DataFrame, keep_first: bool) -> tuple[Column, Column]:
    """(covered, multi): whether a row's surroundings repeat, and whether its anchor has other surroundings too.

    ``rows`` has at most one row for each task and surroundings besides sure ones, and
    a frequent anchor is split by its surroundings (salt below 0): what is repeated
    around it still meets, and that it has several surroundings is known.
    """
    near = W.partitionBy("anchor", "salt", "around")
    wide = W.partitionBy("anchor", "salt")
    low, high = F.min(_place()).over(near), F.max(_place()).over(near)
    again = (_place() > low) if keep_first else (F.max("many").over(near) | (low < high))
    covered = F.col("sure") | again
    multi = ~F.col("sure") & (_place() == low) & ((F.col("salt") < 0) | (F.min("around").over(wide) < F.max("around").over(wide)))
    return covered, multi


def marked(rows: DataFrame, shape: Shape) -> DataFrame:
    """Rows that are covered or still open, with these flags."""
    covered, multi = covered_rows(rows, shape.keep_first)
    flagged = rows.select("id", "twin", "at", "first", "last", "anchor", covered.alias("covered"), multi.alias("open"))
    return flagged.where("covered or open")


def edges(texts: DataFrame, marks: DataFrame, shape: Shape) -> DataFrame:
    """(id, twin, first, last) of windows that repeat, of those in ``marks``: compared one by one."""
    joined = texts.select("id", "twin", "text").join(_listed(marks), ["id", "twin"]).select("id", "twin", "text", "marks")

    def run(batches: Batches) -> Batches:
        def found() -> Iterator[dict[str, np.ndarray]]:
            for batch in batches:
                for rows, data, offsets in K.blocks(batch, size=BLOCK):
                    units, start = shape.units(data, offsets)
                    sums = K.prefix_sums(units)
                    text, mark = lists(rows.column(3))
                    sizes = mark["last"].astype(np.int64) - mark["first"] + 1
                    which = np.repeat(np.arange(len(sizes)), sizes)
                    at = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + mark["first"][which]
                    ids, twin = (rows.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
                    yield {
                        "id": ids[text[which]], "twin": twin[text[which]], "at": at.astype(np.int32), "anchor": mark["anchor"][which],
                        "around": K.run_hashes(sums, start[text[which]] + at, shape.window).view(np.int64),
                    }

        yield from _gather(found(), ["anchor", "around"], shape.keep_first, np.zeros(0, np.int64))

    rows = joined.mapInArrow(run, EDGE)
    covered, _ = covered_rows(rows, shape.keep_first)
    return rows.select("id", "twin", F.col("at").alias("first"), F.col("at").alias("last"), covered.alias("covered")).where("covered").drop("covered")


def lists(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row number and fields of every element in a list<struct> column."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    names = [flat.type.field(i).name for i in range(flat.type.num_fields)]
    return np.repeat(np.arange(len(column)), sizes), {n: flat.field(n).to_numpy(zero_copy_only=False) for n in names}


def _covered(n: int, start: np.ndarray, column: pa.Array, size: int) -> np.ndarray:
    """Units of a block from the first to the last start in ``column``, and ``size`` - 1 units behind."""
    text, mark = lists(column)
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start[text] + mark["first"], 1)
    np.subtract.at(depth, start[text] + mark["last"] + size, 1)
    return np.cumsum(depth[:-1]) > 0


def _runs(flags: np.ndarray, size: int) -> np.ndarray:
    """Where ``size`` neighbouring flags are set, by the place of the first. Texts do not run on: windows do not start at their ends."""
    if size == 1:
        return flags
    out = np.zeros(len(flags), bool)
    if len(flags) >= size:
        total = np.concatenate([[0], np.cumsum(flags)])
        out[: len(flags) - size + 1] = total[size:] - total[:-size] == size
    return out


def cover_mask(units: np.ndarray, start: np.ndarray, column: pa.Array, window: int) -> np.ndarray:
    """Units of a block that repeated windows cover."""
    return _covered(len(units), start, column, window)


def refined(texts: DataFrame, marks: DataFrame, shape: Shape, name: str) -> DataFrame:
    """(id, twin, first, last): starts of repeated windows, from the marks of the first level.

    Level by level, the windows of open anchors are dealt to longer anchors. An anchor that occurs once ends there; where everything around an anchor
    repeats its windows are covered; one row stays open for each surroundings, as other
    ones may share windows with it. Levels end when no candidate is left, or when an
    anchor would be a whole window: then windows themselves are compared.
    """
    spans = ["id", "twin", "first", "last"]
    covers = marks.where("covered").select(*spans)
    opens = marks.where("open")
    while not opens.isEmpty():
        shape = shape.longer()
        if shape.part == shape.window:
            return covers.unionByName(edges(texts, opens, shape))
        level = entries(texts, shape, np.zeros(0, np.int64), opens)
        marks = stored(marked(level, shape), name)
        covers = covers.unionByName(marks.where("covered").select(*spans))
        opens = marks.where("open")
    return covers


def with_covers(texts: DataFrame, covers: DataFrame, name: str = "covers") -> DataFrame:
    """``texts`` with the list ``name`` of its covered stretches (null: none)."""
    spans = covers.groupBy("id", "twin").agg(F.collect_list(F.struct("first", "last")).alias(name))
    return texts.join(spans, ["id", "twin"], "left").select(*texts.columns, name)
