"""What each filter of a chain removes, in every order of the chain.

Every document fails or passes each of five filters, so a part of the corpus is a
2x2x2x2x2 tensor of counts. The tensors are counted by Spark; a step of an order is
one contraction of such a tensor, in which every axis selects the documents that
pass, that fail, or all. No order is ever run over the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmine.llm.common import NULL_ID, Batches, stored

FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
#: Parts whose tensors are contracted at once: 600 result rows each.
PARTS = 64
_WORD = r"[^\x20\x09-\x0D]+"
_TENSORS = ("n", "good", "toxic")
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def own_failures(text: Column) -> list[Column]:
    """Conditions A to D of a text: short, repetitive, upper case, symbols."""
    words = F.regexp_extract_all(text, F.lit(f"({_WORD})"), F.lit(1))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(words) < 50,
        100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        100 * capitals > 5 * F.length(text),
        text.rlike(r"[#$%&*|]"),
    ]


def _judged(docs: DataFrame) -> DataFrame:
    """(id, part, mark, own): failed filters A to D as bits; ``mark`` is the SHA-256 of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(failed, F.lit(1 << k)).otherwise(F.lit(0)) for k, failed in enumerate(own_failures(text))]
    return docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("mark"),
        reduce(lambda a, b: a.bitwiseOR(b), bits).alias("own"),
    )


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(mark, part, own, id, n, good, toxic): equal rows counted together, with their labels."""
    one = F.lit(1).cast("long")
    keys = ["id", "mark", "part", "own"]
    marks = (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.when(F.col("quality") == 1, one)).alias("good"), F.max(F.when(F.col("toxic") == 1, one)).alias("toxic"))
    )
    known = rows.where("id is not null").join(marks, "id", "left")
    zero = F.lit(0).cast("long")
    # The join has dealt the rows by id, so that this count needs no shuffle of its own.
    known = known.groupBy(*keys).agg(F.count(one).alias("n"), F.coalesce(F.max("good"), zero).alias("good"), F.coalesce(F.max("toxic"), zero).alias("toxic"))
    # Rows without a doc_id have no label; they are counted apart, as they would all be one key of the join.
    nameless = rows.where("id is null").groupBy("mark", "part", "own").agg(F.count(one).alias("n"))
    nameless = nameless.select(F.lit(NULL_ID).alias("id"), "mark", "part", "own", "n", zero.alias("good"), zero.alias("toxic"))
    return known.unionByName(nameless)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, cell, n, good, toxic): documents of each part by the set of filters they fail (at most 32 rows a part).

    Copies are found by the SHA-256 of the whole text. They meet already counted, one
    row for each text, part and task, so a text that a third of all documents share
    is a few rows: its counts, and the row with its smallest doc_id, which is the only
    one that passes the filter for copies.
    """
    rows = _labelled(stored(_judged(docs), "audit-rows"), labels)
    shared = ("n", "good", "toxic")
    first = F.min(F.struct("id", *shared)).alias("first")
    totals = [F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")]
    texts = stored(rows.groupBy("mark", "part", "own").agg(*totals, first), "audit-texts")
    lowest = texts.groupBy("mark").agg(F.min("first.id").alias("lowest"))
    met = texts.join(lowest, "mark")
    leads = F.col("first.id") == F.col("lowest")
    alone = {k: F.when(leads, F.col("first.n") * (F.lit(1) if k == "n" else F.col(f"first.{k}"))).otherwise(0) for k in shared}
    passed = met.select("part", F.col("own").alias("cell"), *[v.alias(k) for k, v in alone.items()])
    copies = met.select("part", (F.col("own") + (CELLS >> 1)).alias("cell"), *[(F.col(k) - v).alias(k) for k, v in alone.items()])
    return passed.unionByName(copies).groupBy("part", "cell").agg(*[F.sum(k).alias(k) for k in shared])


def selectors() -> tuple[list[str], dict[str, np.ndarray]]:
    """All orders, and for each order, step and axis what a measure selects: (pass, fail) weights."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    passed, failed, either = (1, 0), (0, 1), (1, 1)
    kept, removed, alone, all_failed = [], [], [], []
    for order in orders:
        for step, own in enumerate(order):
            earlier = order[:step]
            kept.append([passed if f in earlier or f == own else either for f in FILTERS])
            removed.append([failed if f == own else passed if f in earlier else either for f in FILTERS])
            alone.append([failed if f == own else passed for f in FILTERS])
            all_failed.append([failed if f == own else either for f in FILTERS])
    named = {"kept": kept, "removed": removed, "unique_fails": alone, "failed": all_failed}
    return orders, {k: np.array(v, np.int64) for k, v in named.items()}


def contracted(tensors: np.ndarray, selected: np.ndarray) -> np.ndarray:
    """(parts, steps): the documents of each part's tensor that the weights select at each step."""
    axes = [selected[:, k] for k in range(len(FILTERS))]
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensors, *axes, optimize=True)


def audited(cells_of_parts: DataFrame) -> DataFrame:
    """One row per part, order and step (``RESULT``) from the tensors of ``cells``."""
    listed = F.collect_list(F.struct("cell", *_TENSORS)).alias("cells")
    # At most 32 cells in a list, whatever the corpus.
    parts = cells_of_parts.groupBy("part").agg(listed)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        orders, weights = selectors()
        steps = len(FILTERS)
        letters = np.array([[FILTERS.index(f) for f in order] for order in orders]).ravel()
        for batch in batches:
            for at in range(0, batch.num_rows, PARTS):
                piece = batch.slice(at, PARTS)
                found = piece.column(1)
                row = np.repeat(np.arange(piece.num_rows), found.value_lengths().to_numpy())
                flat = found.flatten()
                cell = flat.field("cell").to_numpy()
                tensors = {}
                for name in _TENSORS:
                    table = np.zeros((piece.num_rows, CELLS), np.int64)
                    table[row, cell] = flat.field(name).to_numpy()
                    # The lowest bit is filter A: the last axis of the reshaped table.
                    tensors[name] = table.reshape(-1, *[2] * steps).transpose(0, *range(steps, 0, -1))
                out = {k: contracted(tensors["n"], weights[k]) for k in ("kept", "removed", "unique_fails")}
                out["redundant"] = contracted(tensors["n"], weights["failed"]) - out["removed"]
                out["good_lost"] = contracted(tensors["good"], weights["removed"])
                out["toxic_lost"] = contracted(tensors["toxic"], weights["removed"])
                shares = np.stack([out["removed"][:, letters == k].sum(axis=1) for k in range(steps)], axis=1)
                out["shapley"] = shares[:, letters]
                many = len(orders) * steps
                names = piece.column(0).take(pa.array(np.repeat(np.arange(piece.num_rows), many)))
                order = pa.array(np.repeat(orders, steps).tolist() * piece.num_rows, pa.string())
                step = pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders) * piece.num_rows))
                counts = [pa.array(out[c].ravel()) for c in _COUNTS]
                yield pa.RecordBatch.from_arrays([names.cast(pa.string()), order, step, *counts], names=["part", "filter_order", "step", *_COUNTS])

    return parts.mapInArrow(run, RESULT)


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step (``RESULT``).

    Parts are the values of ``source``; null and the empty string are one part.
    Filters: A under 50 words, B under 65 distinct of 100 words, C over 5 capitals A-Z
    in 100 characters, D a symbol of ``#$%&*|``, E a text that a smaller doc_id has.

    A null text is empty: it fails A only, and E if a smaller doc_id has an empty or
    null text. A null doc_id is smaller than all others and has no label. Rows that
    repeat the smallest doc_id of a text all pass E. A document is good (toxic) if any
    row of ``labels`` with its doc_id says so; null labels say nothing. Other
    columns are not read. An empty table has no parts, so the result is empty. A
    text's words are listed inside its task, so a task needs some ten times the bytes
    of its longest text.
    """
    return audited(cells(docs, labels))
