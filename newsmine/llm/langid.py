"""Language identification with error-correcting output codes.

Each language has a codeword. One binary n-gram classifier per bit of the code
predicts that bit; a text gets the language whose codeword is nearest, where each
bit's loss counts by how reliable its classifier proved.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmine.llm import kernel as K
from newsmine.llm.common import narrow, original, per_batch, sampled, stored

UNKNOWN = "und"
GRAM = 3  # bytes of the lower-case text


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """Matrix classes x bits of -1 and 1 without constant, equal or opposite columns.

    Up to five classes: all such columns. More: random ones, about ten for each
    doubling of the number of classes.
    """
    if classes < 2:
        return np.ones((classes, 1), np.int8)
    if classes <= 5:
        columns = [[1] + [1 if (k >> c) & 1 else -1 for c in range(classes - 1)] for k in range(2 ** (classes - 1) - 1)]
        return np.array(columns, np.int8).T
    rng, want, found = np.random.default_rng(seed), 10 * int(np.ceil(np.log2(classes))), set()
    while len(found) < want:
        column = rng.integers(0, 2, classes) * 2 - 1
        column = column * column[0]
        if abs(column.sum()) < classes - 1:
            found.add(tuple(column))
    return np.array(sorted(found), np.int8).T


def buckets_of(data: np.ndarray, size: int) -> np.ndarray:
    """Hashed byte n-grams, one for each byte but the last ones of the block."""
    if len(data) < GRAM:
        return np.zeros(0, np.int64)
    wide = data.astype(np.uint32)
    code = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - int(size).bit_length() + 1)).astype(np.int64)


def _inside(offsets: np.ndarray, n: int) -> np.ndarray:
    """False for n-grams that would run over the end of a text."""
    good = np.ones(max(0, n), bool)
    for k in range(1, GRAM):
        edge = offsets[1:-1] - k
        good[edge[(edge >= 0) & (edge < n)]] = False
    return good


def sums(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of ``table`` over the n-grams of each text, and their number."""
    picked = buckets_of(data, len(table))
    good = _inside(offsets, len(picked))
    values = table[picked] * good[:, None]
    total = np.zeros((len(picked) + 1, table.shape[1]), np.float64)
    np.cumsum(values, axis=0, out=total[1:])
    at = np.minimum(offsets, len(picked))
    number = np.concatenate([[0], np.cumsum(good)])[at]
    return np.diff(total[at], axis=0), np.diff(number)


@dataclass(frozen=True)
class Coder:
    """A fitted model: languages, code, n-gram weights and bit weights."""

    langs: list[str]
    code: np.ndarray
    table: np.ndarray
    weight: np.ndarray

    def losses(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Loss of each text against each codeword, and the margins of its bits."""
        total, number = sums(data, offsets, self.table)
        margins = total / np.maximum(np.sqrt(number), 1)[:, None]
        signs = margins[:, None, :] * self.code[None, :, :]
        loss = np.logaddexp(0, -np.clip(signs, -30, 30))
        return loss @ self.weight, margins


def _lower(docs: DataFrame, *more: str) -> DataFrame:
    return narrow(docs, *more).withColumn("text", F.lower("text"))


def fitted(labelled: DataFrame, rows: int = 20_000, buckets: int = 1 << 14) -> Coder:
    """Fit on at most about ``rows`` labelled rows (a documented bound), chosen by a hash of their ids.

    Every bit's classifier is the log ratio of n-gram shares between the languages
    on its two sides, from whole texts. What reaches the driver is one row of
    ``buckets`` counts per language. The weight of a bit is how often it is right.
    """
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = known.withColumns({"lang": F.col("lang").cast("string")})
    chosen = stored(_lower(sampled(named.select("doc_id", "text", "lang"), rows, F.col("doc_id")), "lang"), "lang-sample")
    langs = sorted(r[0] for r in chosen.select("lang").distinct().collect())
    if not langs:
        return Coder([], np.ones((0, 1), np.int8), np.zeros((buckets, 1), np.float32), np.ones(1))
    place = {lang: i for i, lang in enumerate(langs)}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), buckets), np.int64)
        for batch in batches:
            for part, data, offsets in K.blocks(batch):
                picked = buckets_of(data, buckets)
                good = _inside(offsets, len(picked))
                own = np.array([place[x] for x in part.column(2).to_pylist()], np.int64)
                text = np.repeat(own, np.diff(offsets))[: len(picked)]
                total += np.bincount((text * buckets + picked)[good], minlength=total.size).reshape(total.shape)
        for i in np.flatnonzero(total.sum(1)):
            at = np.flatnonzero(total[i])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(at), pa.array(total[i, at])], names=["lang", "bucket", "n"])

    found = chosen.mapInArrow(counts, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros((len(langs), buckets))
    total[found["lang"], found["bucket"]] = found["n"]
    share = (total + 0.5) / (total.sum(1, keepdims=True) + 0.5 * buckets)
    code = codewords(len(langs))
    sides = [(share[code[:, b] > 0], share[code[:, b] < 0]) for b in range(code.shape[1])]
    table = np.stack([np.log(a.mean(0)) - np.log(b.mean(0)) if len(b) else np.ones(buckets) for a, b in sides], 1).astype(np.float32)
    plain = Coder(langs, code, table, np.ones(code.shape[1]))

    def checked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in K.blocks(batch):
            own = np.array([place[x] for x in part.column(2).to_pylist()], np.int64)
            right = (np.sign(plain.losses(data, offsets)[1]) == code[own]).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array([right.tolist()], pa.list_(pa.int64())), pa.array([len(own)], pa.int64())], names=["right", "n"])

    bits = code.shape[1]
    hits = chosen.mapInArrow(per_batch(checked), "right array<long>, n long").agg(F.sum("n"), *[F.sum(F.col("right")[b]) for b in range(bits)]).first()
    right = np.array([hits[b + 1] or 0 for b in range(bits)], float) / max(1, hits[0] or 0)
    return Coder(langs, code, table, np.maximum(right - 0.5, 0.01) * 2)


def predicted(docs: DataFrame, coder: Coder, gap: float = 0.1) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every row of ``docs``.

    ``score`` is the nearest codeword's share under a softmax of the losses;
    ``ambiguous`` marks rows whose two best shares differ by less than ``gap``.
    A null text, or one without a letter, is ``und`` with score 0. Repeated rows are
    predicted one by one. Only doc_id and text are read. Of equal shares the
    alphabetically first language counts. A model without languages predicts ``und``;
    an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(coder)  # buckets x bits numbers

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part, data, offsets in K.blocks(batch):
            loss, _ = model.losses(data, offsets)
            share = np.exp(loss.min(1, keepdims=True) - loss)
            share /= share.sum(1, keepdims=True)
            best = share.argmax(1)
            ranked = np.sort(share, 1)
            close = ranked[:, -1] - (ranked[:, -2] if ranked.shape[1] > 1 else 0) < gap
            names = pa.array(model.langs, pa.string()).take(pa.array(best))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), names, pa.array(ranked[:, -1]), pa.array(close)], names=["id", "letters", "lang", "score", "close"])

    rows = narrow(docs).select("id", F.lower("text").alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    if not coder.langs:
        return rows.select(original(F.col("id")).alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("ambiguous"))
    found = rows.mapInArrow(per_batch(work), "id long, letters boolean, lang string, score double, close boolean")
    return found.select(
        original(F.col("id")).alias("doc_id"),
        F.when(F.col("letters"), F.col("lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("letters"), F.col("score")).otherwise(0.0).alias("score"),
        (~F.col("letters") | F.col("close")).alias("ambiguous"),
    )


def held_out(doc_id: Column) -> Column:
    """Remainder 2 of crc32(doc_id as text) modulo 4; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2
