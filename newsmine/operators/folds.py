"""Stratified folds as an expression.

A document's fold follows from its class and a hash of its doc_id: each class is
cut, in hash order, at the places that give every fold its share. The cuts are exact
order statistics of the hashes; finding them reads labels and ids only, and returns a
few numbers per class. Nothing is joined to the documents afterwards.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Hashable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, STEP = 60, 10  # bits of a hash, and bits that one pass refines
#: A range of hashes with so many rows at most is read as it is.
LISTED = 1_000


def fold_hash(doc_id: Column, seed: int) -> Column:
    """The first 60 bits of the MD5 of doc_id and seed."""
    mark = F.md5(F.concat_ws(":", doc_id.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(mark, 1, BITS // 4), 16, 10).cast("long")


def shares(start: int, size: int, k: int) -> list[int]:
    """Rows of each fold when ``size`` rows are dealt in turn, beginning at fold ``start``."""
    return [size // k + ((f - start) % k < size % k) for f in range(k)]


@dataclass(frozen=True)
class Folds:
    """Lower hash bounds of folds 1 … k-1 of every class."""

    k: int
    seed: int
    bounds: dict[Hashable, list[int]]

    def of(self, doc_id: Column, label: Column) -> Column:
        """The fold of a document; null for a class that was not there."""
        mark = fold_hash(doc_id, self.seed)
        cuts = None
        for name, own in self.bounds.items():
            listed = F.array(*[F.lit(b).cast("long") for b in own]) if own else F.array().cast("array<long>")
            same = label.isNull() if name is None else label == F.lit(name)
            cuts = F.when(same, listed) if cuts is None else cuts.when(same, listed)
        if cuts is None:
            return F.lit(None).cast("int")
        # Both are evaluated once per row.
        both = F.transform(F.array(F.struct(cuts.alias("cuts"), mark.alias("mark"))), lambda r: F.size(F.filter(r["cuts"], lambda b: b <= r["mark"])))
        return F.when(cuts.isNotNull(), F.get(both, F.lit(0)))


def class_bounds(docs: DataFrame, k: int = 5, seed: int = 42) -> Folds:
    """Folds of (doc_id, label) rows: sizes per class and in total differ by at most one.

    Dealing starts where the previous class (alphabetical) stopped. Rows without a label
    are a class of their own, the last one. Rows that repeat a doc_id share a fold.

    Each pass counts the hashes of the ranges that hold a cut by their next bits, until a
    range is short enough to be listed: at most classes x (k - 1) ranges at a time.
    """
    rows = docs.select("label", fold_hash(F.col("doc_id"), seed).alias("mark"))

    def counted(shift: int, wanted: DataFrame | None) -> dict[Hashable, dict[int, int]]:
        some = rows.withColumn("part", F.shiftright("mark", shift))
        if wanted is not None:
            mark = F.shiftright("mark", shift + STEP)
            some = some.join(F.broadcast(wanted), some["label"].eqNullSafe(wanted["name"]) & (mark == wanted["range"]), "left_semi")
        found: dict[Hashable, dict[int, int]] = defaultdict(dict)
        for r in some.groupBy("label", "part").agg(F.count(F.lit(1)).alias("n")).collect():
            found[r["label"]][r["part"]] = r["n"]
        return found

    shift = BITS - STEP
    found = counted(shift, None)
    label = docs.schema["label"].dataType.simpleString()
    spark = docs.sparkSession
    bounds: dict[Hashable, dict[int, int]] = defaultdict(dict)
    # (class, fold) -> (range of hashes, rows of the range before the cut)
    open_cuts: dict[tuple[Hashable, int], tuple[int, int]] = {}
    start = 0
    for name in sorted(found, key=lambda c: (c is None, c if c is not None else 0)):
        size = sum(found[name].values())
        before = 0
        for fold, n in enumerate(shares(start, size, k)[:-1], 1):
            before += n
            open_cuts[name, fold] = (-1, before)
        start = (start + size) % k
    while open_cuts:
        listed: dict[tuple[Hashable, int], tuple[int, int]] = {}
        for (name, fold), (where, rank) in open_cuts.items():
            parts = sorted(p for p in found[name] if where < 0 or p >> STEP == where)
            for part in parts:
                if rank < found[name][part]:
                    break
                rank -= found[name][part]
            else:  # behind the last row
                bounds[name][fold] = 1 << BITS
                continue
            if shift == 0:
                bounds[name][fold] = part
            else:
                listed[name, fold] = (part, rank)
        open_cuts = listed
        if not open_cuts:
            break
        ranges = sorted({(n, p) for (n, _), (p, _) in open_cuts.items()}, key=repr)
        wanted = spark.createDataFrame(ranges, f"name {label}, range long")
        if max(found[n][p] for n, p in ranges) <= LISTED:
            # At most LISTED hashes for each cut.
            mark = F.shiftright("mark", shift)
            some = rows.join(F.broadcast(wanted), rows["label"].eqNullSafe(wanted["name"]) & (mark == wanted["range"]), "left_semi")
            hashes: dict[tuple[Hashable, int], list[int]] = defaultdict(list)
            for r in some.collect():
                hashes[r["label"], r["mark"] >> shift].append(r["mark"])
            for (name, fold), (part, rank) in open_cuts.items():
                bounds[name][fold] = sorted(hashes[name, part])[rank]
            break
        shift -= STEP
        found = counted(shift, wanted)
    return Folds(k, seed, {name: [own[f] for f in sorted(own)] for name, own in bounds.items()})


def stratified_folds(docs: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """(doc_id, label, fold), without a shuffle of the documents."""
    folds = class_bounds(docs, k, seed)
    return docs.select("doc_id", "label", folds.of(F.col("doc_id"), F.col("label")).alias("fold"))


def fold_sizes(folds: DataFrame) -> DataFrame:
    return folds.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n"))
