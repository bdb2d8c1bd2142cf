"""Exact Jaccard join of word n-gram sets with set-relation skipping.

Equal sets form a class; everything below works on classes. An inverted index
holds each set's rarest n-grams (as many as a linked set must share one of). In
every index list one set leads: the one that holds the n-gram earliest in its
order. First only leaders are compared with the members of their lists. For the rest,
lists are cut into blocks by size and position, pairs of blocks that cannot hold a
link are skipped whole, bit sketches rule out most of what is left, and a pair that
was compared with the same leader gets its overlap from the two answers' differences
instead of from the sets. Callers that only need components skip the pairs that are
connected already, and peel lists first: in every turn some more heads of a list's
main component meet what is not connected to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsmine.llm import kernel as K
from newsmine.llm.common import Batches, narrow, original, per_batch, stored
from newsmine.llm.exact import one_each
from newsmine.operators.blocks import FAN_IN, SCHEMA, slices

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
BLOCK = 4  # neighbouring positions in one block of a list
HEADS = 8  # members of a list's main component that the others are compared with in one turn


@dataclass(frozen=True)
class Sets:
    """Sets of ``words`` successive words, linked from ``percent`` hundredths of similarity."""

    words: int = 3
    percent: int = 90
    #: Buckets of the frequency table that orders the n-grams: a fixed size, whatever the corpus.
    buckets: int = 1 << 20
    #: Sets of so many classes at most are fetched by a broadcast list of ids (24 bytes each); more by a join.
    broadcast_rows: int = 500_000
    #: Peel open lists by heads before their members are paired (only where just components are wanted).
    peel: bool = True

    def needed(self, a: Column, b: Column) -> Column:
        """Least overlap of linked sets of these sizes."""
        return F.ceil(F.lit(self.percent) * (a + b) / F.lit(100 + self.percent))

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return (100 * F.least(a, b)) >= (self.percent * F.greatest(a, b))

    def linked(self, overlap: Column, a: Column, b: Column) -> Column:
        return (100 * overlap) >= (self.percent * (a + b - overlap))


def set_members(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, fingerprint) of the distinct n-grams of each text in a block, sorted."""
    data = _LOWER[data]
    starts, ends, first = K.words(data, offsets)
    sums = K.prefix_sums(K.word_hashes(data, starts, ends))
    size = np.diff(first)
    runs = np.where(size >= words, size - words + 1, np.minimum(size, 1))
    text = np.repeat(np.arange(len(size)), runs)
    at = first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
    marks = K.run_hashes(sums, at, np.minimum(size, words)[text])
    order = np.lexsort([marks, text])
    text, marks = text[order], marks[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (marks[1:] != marks[:-1])
    return text[new], marks[new]


def classes_of(text: np.ndarray, marks: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and 64-bit fingerprint of each text's set."""
    size = np.bincount(text, minlength=number)
    total = np.concatenate([[np.uint64(0)], np.cumsum(K.mix(marks))])
    bounds = np.concatenate([[0], np.cumsum(size)])
    return size, K.mix(np.diff(total[bounds]) ^ (size.astype(np.uint64) << np.uint64(40)))


def parities(text: np.ndarray, marks: np.ndarray, size: np.ndarray) -> list[bytes]:
    """A bit sketch of each set, one bit for each member or up to twice as many.

    Every member flips one bit, so two sketches differ in no more bits than the
    sets do in members: more differing bits than linked sets may have prove that
    there is no link, without reading the sets.
    """
    bits = np.maximum(64, 1 << np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    begin = np.cumsum(bits) - bits
    flips = np.bincount(begin[text] + (marks >> np.uint64(20)).astype(np.int64) % bits[text], minlength=int(bits.sum()))
    packed = np.packbits((flips & 1).astype(np.uint8), bitorder="little")
    return [packed[b // 8 : (b + n) // 8].tobytes() for b, n in zip(begin.tolist(), bits.tolist(), strict=True)]


def differing_bits(a: bytes, b: bytes) -> int:
    """Bits in which two sketches differ; the longer one is folded to the shorter one's length."""
    one, two = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    return int(np.bitwise_count(one ^ np.bitwise_xor.reduce(two.reshape(-1, len(one)), axis=0)).sum())


def text_mark() -> Column:
    """Fingerprint of a row's own text: tells rows apart that share a doc_id."""
    return F.xxhash64(F.col("text").cast("string"))


def _facts(texts: DataFrame, sets: Sets) -> DataFrame:
    """(id, n, cls, own, sketch) of every row; each task adds one row of n-gram counts (null n)."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros(sets.buckets, np.int32)
        waiting: list[np.ndarray] = []
        for batch in batches:
            for rows, data, offsets in K.blocks(batch):
                text, marks = set_members(data, offsets, sets.words)
                size, cls = classes_of(text, marks, rows.num_rows)
                waiting.append((marks % np.uint64(sets.buckets)).astype(np.int64))
                if sum(map(len, waiting)) > sets.buckets // 2:
                    counts += np.bincount(np.concatenate(waiting), minlength=sets.buckets).astype(np.int32)
                    waiting = []
                none = pa.nulls(rows.num_rows, pa.binary())
                sketch = pa.array(parities(text, marks, size), pa.binary())
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(size, pa.int64()), K.signed(cls), rows.column(2), sketch, none], names=["id", "n", "cls", "own", "sketch", "counts"])
        if waiting:
            counts += np.bincount(np.concatenate(waiting), minlength=sets.buckets).astype(np.int32)
        if counts.any():
            nothing = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays([nothing, nothing, nothing, nothing, pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())], names=["id", "n", "cls", "own", "sketch", "counts"])

    named = texts.select("id", "text", text_mark().alias("own"))
    return stored(named.mapInArrow(run, "id long, n long, cls long, own long, sketch binary, counts binary"), "jaccard-facts")


def _levels(facts: DataFrame, sets: Sets) -> np.ndarray:
    """How common the n-grams of each bucket are, as a power of two.

    Tables are added level by level, FAN_IN at a time; the driver gets one byte a bucket.
    """

    def partial(batches: Batches) -> Batches:
        total = np.zeros(sets.buckets)
        for batch in batches:
            for value in batch.column(0):
                total += np.frombuffer(value.as_py(), np.int32)
        yield from slices(total)

    def added(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(p) for p in table.column("payload").to_pylist()], axis=0)
        part = min(table.column("part").to_pylist())
        return pa.table({"part": pa.array([part], pa.int64()), "slice": table.column("slice").slice(0, 1), "payload": [total.tobytes()]})

    def levelled(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codes = [np.log2(np.frombuffer(p.as_py()) + 1).astype(np.uint8).tobytes() for p in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.binary())], names=["slice", "payload"])

    # As many partial tables as there are cores, not as there are tasks.
    cores = facts.sparkSession.sparkContext.defaultParallelism
    parts = facts.where(F.col("counts").isNotNull()).select("counts").coalesce(cores).mapInArrow(partial, SCHEMA)
    left = cores
    while True:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("part", "slice").applyInArrow(added, SCHEMA)
        left = -(-left // FAN_IN)
        if left == 1:
            break
    found = {r["slice"]: r["payload"] for r in parts.select("slice", "payload").mapInArrow(per_batch(levelled), "slice int, payload binary").collect()}
    whole = b"".join(bytes(found[k]) for k in sorted(found))
    return np.frombuffer(whole, np.uint8) if whole else np.zeros(sets.buckets, np.uint8)


def _index(texts: DataFrame, levels: np.ndarray, sets: Sets) -> DataFrame:
    """(gram, pos, n, cls): the rarest n-grams of each set, rarest first."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Batches) -> Batches:
        seen: set[int] = set()
        level = shared.value
        for batch in batches:
            for rows, data, offsets in K.blocks(batch):
                text, marks = set_members(data, offsets, sets.words)
                size, cls = classes_of(text, marks, rows.num_rows)
                fresh = np.array([n > 0 and not (c in seen or seen.add(c)) for c, n in zip(cls.tolist(), size.tolist(), strict=True)], bool)
                if len(seen) > 2_000_000:  # only saves work: copies may be listed twice
                    seen.clear()
                use = fresh[text]
                text, marks = text[use], marks[use]
                order = np.lexsort([marks, level[(marks % np.uint64(sets.buckets)).astype(np.int64)], text])
                text, marks = text[order], marks[order]
                begin = np.searchsorted(text, np.arange(rows.num_rows))
                pos = np.arange(len(text)) - begin[text]
                n = size[text]
                front = pos < n + (-sets.percent * n // 100) + 1
                text, pos, n, marks = text[front], pos[front], n[front], marks[front]
                yield pa.RecordBatch.from_arrays([K.signed(marks), pa.array(pos, pa.int32()), pa.array(n, pa.int32()), K.signed(cls[text])], names=["gram", "pos", "n", "cls"])

    listed = stored(texts.mapInArrow(run, "gram long, pos int, n int, cls long"), "jaccard-index")
    # Lists of one class only cannot hold a link. Counted in every task before the shuffle.
    shared_grams = listed.groupBy("gram").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low < high").select("gram")
    return stored(listed.join(shared_grams, "gram", "left_semi"), "jaccard-lists")


def _room(n: str, pos: str) -> Column:
    """Members of a set from this position on."""
    return F.col(n) - F.col(pos)


def _leaders(lists: DataFrame) -> DataFrame:
    """(gram, pos_a, n_a, a): the class that leads each list."""
    lead = lists.groupBy("gram").agg(F.min(F.struct("pos", "n", "cls")).alias("lead"))
    return lead.select("gram", F.col("lead.pos").alias("pos_a"), F.col("lead.n").alias("n_a"), F.col("lead.cls").alias("a"))


def _leader_pairs(lists: DataFrame, sets: Sets) -> DataFrame:
    """(a, b): each list's leader with each member that may be linked to it."""
    met = lists.join(_leaders(lists), "gram").where(F.col("a") != F.col("cls"))
    fit = sets.sizes_fit(F.col("n"), F.col("n_a")) & (F.least(_room("n", "pos"), _room("n_a", "pos_a")) >= sets.needed(F.col("n"), F.col("n_a")))
    return met.where(fit).select("a", F.col("cls").alias("b")).distinct()


def _open_members(lists: DataFrame, labels: DataFrame, sets: Sets) -> DataFrame:
    """Members (gram, pos, n, cls, prev, comp, step, slot, main) of lists that still hold several components.

    Leaders are left out, as all their pairs are settled. ``main`` marks a list's
    most frequent component. Without ``labels`` rows every class is a component of
    its own. A list's members of similar size and position have the same step and slot.
    ``prev`` is the set's open list before this one, at its first the set itself; a list
    in which all sets have the same one tells nothing new and is left out.
    """
    followers = lists.join(_leaders(lists).select("gram", "a"), "gram").where(F.col("cls") != F.col("a")).drop("a")
    named = followers.join(labels.select(F.col("node").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    mixed = named.groupBy("gram").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("gram")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / sets.percent)))
    placed = named.join(mixed, "gram", "left_semi").withColumns({"step": step, "slot": F.floor(F.col("pos") / BLOCK)}).distinct()
    # All sets follow one order of n-grams: two sets that have the same open list before this one meet there already.
    before = F.lag("gram").over(W.partitionBy("cls").orderBy("pos"))
    linked = stored(placed.withColumn("prev", F.coalesce(before, "cls")), "jaccard-mixed")
    fresh = linked.groupBy("gram").agg(F.min("prev").alias("low"), F.max("prev").alias("high")).where("low < high").select("gram")
    open_lists = linked.join(fresh, "gram", "left_semi")
    counts = open_lists.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("many"))
    largest = counts.groupBy("gram").agg(F.max(F.struct("many", "comp")).alias("top")).select("gram", F.col("top.comp").alias("largest"))
    return stored(open_lists.join(largest, "gram").withColumn("main", F.col("comp") == F.col("largest")).drop("largest"), "jaccard-open")


def _open_size(members: DataFrame) -> tuple[int, int]:
    """Rows of open lists, and how many pairs with members of other components they may make."""
    sizes = members.groupBy("gram").agg(F.count(F.lit(1)).alias("all"), F.count_if(~F.col("main")).alias("others"))
    found = sizes.agg(F.sum("all"), F.sum(F.col("all") * F.col("others"))).first()
    return found[0] or 0, found[1] or 0


def _head_pairs(members: DataFrame, sets: Sets, turn: int) -> DataFrame:
    """(a, b): some heads of each list's main component with each member of its other components.

    Copies of one text that differ from a list's leader are like other copies of it:
    a few more heads connect nearly all of them, at ``HEADS`` rows for each member.
    The same classes head all their lists; each ``turn`` draws others.
    """
    drawn = F.xxhash64("cls", F.lit(turn))
    main = members.where("main").select("gram", F.pmod(drawn, F.lit(HEADS)).alias("chair"), F.struct(drawn.alias("drawn"), "pos", "n", "cls").alias("head"))
    heads = main.groupBy("gram", "chair").agg(F.min("head").alias("head"))
    heads = heads.select("gram", F.col("head.pos").alias("pos_h"), F.col("head.n").alias("n_h"), F.col("head.cls").alias("h"))
    met = members.where("not main").join(heads, "gram")
    fit = sets.sizes_fit(F.col("n"), F.col("n_h")) & (F.least(_room("n", "pos"), _room("n_h", "pos_h")) >= sets.needed(F.col("n"), F.col("n_h")))
    return met.where(fit).select(F.least("cls", "h").alias("a"), F.greatest("cls", "h").alias("b")).distinct()


def _rest_pairs(members: DataFrame, sets: Sets) -> DataFrame:
    """(a, b) with a < b: open members of one list that are not connected yet and may be linked.

    Members of a list's most frequent component are already connected with each
    other: only the others look for partners, among all. Sets that share a passage
    meet in its first list only.
    """
    blocks = members.groupBy("gram", "main", "step", "slot").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max(_room("n", "pos")).alias("room"), F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.min("prev").alias("early"), F.max("prev").alias("late"),
    )
    x, y = blocks.where("not main").alias("x"), blocks.alias("y")
    c = F.col
    may = (c("x.gram") == c("y.gram")) & (c("y.main") | (F.struct("x.step", "x.slot") <= F.struct("y.step", "y.slot")))
    may &= ~((c("x.low") == c("x.high")) & (c("y.low") == c("y.high")) & (c("x.low") == c("y.low")))
    may &= ~((c("x.early") == c("x.late")) & (c("y.early") == c("y.late")) & (c("x.early") == c("y.early")))
    may &= (100 * c("x.most") >= sets.percent * c("y.least")) & (100 * c("y.most") >= sets.percent * c("x.least"))
    may &= F.least("x.room", "y.room") >= sets.needed(c("x.least"), c("y.least"))
    far = ("main", "step", "slot")
    open_blocks = x.join(y, may).select(c("x.gram"), *[c(f"x.{k}").alias(f"{k}_x") for k in far[1:]], *[c(f"y.{k}").alias(f"{k}_y") for k in far])
    first = members.where("not main").select("gram", *[c(k).alias(f"{k}_x") for k in ("step", "slot", "pos", "n", "cls", "comp", "prev")])
    second = members.select("gram", *[c(k).alias(f"{k}_y") for k in (*far, "pos", "n", "cls", "comp", "prev")])
    near = open_blocks.join(first, ["gram", "step_x", "slot_x"])
    fit = (c("comp_x") != c("comp_y")) & (c("prev_x") != c("prev_y")) & sets.sizes_fit(c("n_x"), c("n_y"))
    fit &= F.least(_room("n_x", "pos_x"), _room("n_y", "pos_y")) >= sets.needed(c("n_x"), c("n_y"))
    for k in ("gram", *[f"{k}_y" for k in far]):
        fit &= near[k] == second[k]
    met = near.join(second, fit)
    return met.select(F.least("cls_x", "cls_y").alias("a"), F.greatest("cls_x", "cls_y").alias("b")).distinct()


def _plausible(pairs: DataFrame, facts: DataFrame, sets: Sets) -> DataFrame:
    """``pairs`` without those whose sketches prove that they are not linked."""
    own = facts.groupBy("cls").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch"))
    one = own.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = own.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            sizes = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.array([differing_bits(x.as_py(), y.as_py()) for x, y in zip(batch.column(4), batch.column(5), strict=True)], np.int64)
            # Linked sets overlap in at least percent / (100 + percent) of both sizes.
            most = sizes - 2 * -(-sets.percent * sizes // (100 + sets.percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(apart <= most))

    return stored(met.mapInArrow(run, "a long, b long"), "jaccard-plausible")


def _sets_of(texts: DataFrame, wanted: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, grams) for wanted rows (id, a, b): the set of class ``b``, taken from the text ``id``."""
    few = F.broadcast(wanted) if wanted.count() <= sets.broadcast_rows else wanted
    found = texts.join(few, "id").select("id", "text", "a", "b")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for rows, data, offsets in K.blocks(batch):
                text, marks = set_members(data, offsets, sets.words)
                size, cls = classes_of(text, marks, rows.num_rows)
                grams = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), K.signed(marks))
                same = pa.array(cls.view(np.int64) == rows.column(3).to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([rows.column(2), rows.column(3), grams], names=["a", "b", "grams"]).filter(same)

    return found.mapInArrow(run, "a long, b long, grams array<long>")


def _compared(texts: DataFrame, facts: DataFrame, pairs: DataFrame, sets: Sets) -> DataFrame:
    """(a, b, n_a, n_b, overlap, apart): both sizes, the overlap, and what only one of the sets holds.

    Only two shuffles carry sets: those of the leaders, and for each pair the
    other set, which goes straight to its leader.
    """
    ids = facts.groupBy("cls").agg(F.min("id").alias("id"))
    ends = stored(pairs.join(ids.withColumnRenamed("cls", "b"), "b").select("id", "a", "b"), "jaccard-members")
    heads = stored(ids.join(pairs.select(F.col("a").alias("cls")).distinct(), "cls").select("id", F.col("cls").alias("a"), F.col("cls").alias("b")), "jaccard-heads")
    one = _sets_of(texts, heads, sets).select("a", F.col("grams").alias("grams_a"))
    two = _sets_of(texts, ends, sets).select("a", "b", F.col("grams").alias("grams_b"))
    met = one.join(two, "a")
    apart = F.concat(F.array_except("grams_a", "grams_b"), F.array_except("grams_b", "grams_a"))
    sized = met.select("a", "b", F.size("grams_a").alias("n_a"), F.size("grams_b").alias("n_b"), apart.alias("apart")).dropDuplicates(["a", "b"])
    return sized.withColumn("overlap", ((F.col("n_a") + F.col("n_b") - F.size("apart")) / 2).cast("long"))


def _tests(rest: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What has to be compared so that the answers of ``rest`` can be derived.

    One set of a pair was compared with a leader before, the most similar one of
    its leaders counts. Comparing the other set with that leader as well answers
    the pair, and all other pairs of that set with sets of this leader. Returned
    are those comparisons (a is the leader), the pairs (lead, a, b) that they
    answer, and the pairs without any leader.
    """
    met = answers.select(F.col("b").alias("node"), F.col("a").alias("lead"), F.col("overlap").alias("near"))
    own = answers.select(F.col("a").alias("node"), F.col("a").alias("lead"), F.col("n_a").cast("long").alias("near"))
    best = stored(met.union(own).groupBy("node").agg(F.max(F.struct("near", "lead")).alias("top")).select("node", F.col("top.lead").alias("lead")), "jaccard-best")
    one = best.select(F.col("node").alias("a"), F.col("lead").alias("lead_a"))
    two = best.select(F.col("node").alias("b"), F.col("lead").alias("lead_b"))
    led = stored(rest.join(one, "a", "left").join(two, "b", "left"), "jaccard-led")
    via = F.coalesce("lead_b", "lead_a")
    other = F.when(F.col("lead_b").isNotNull(), F.col("a")).otherwise(F.col("b"))
    tests = led.where(via.isNotNull()).select(via.alias("a"), other.alias("b")).where("a <> b").distinct()
    tests = tests.join(answers.select("a", "b"), ["a", "b"], "left_anti")
    alone = led.where(via.isNull()).select("a", "b")
    return stored(tests, "jaccard-more-pairs"), led.where(via.isNotNull()).select(via.alias("lead"), "a", "b"), alone


def _derived(pairs: DataFrame, answers: DataFrame) -> DataFrame:
    """Overlaps of ``pairs`` (lead, a, b) that were both compared with the leader: a and b differ where exactly one differs from it."""
    own = answers.select(F.col("a").alias("lead"), F.col("b").alias("node"), F.col("n_b").alias("n"), "apart")
    lead = answers.select(F.col("a").alias("lead"), F.col("a").alias("node"), F.col("n_a").alias("n"), F.array().cast("array<long>").alias("apart"))
    known = own.unionByName(lead.distinct())
    one = known.select("lead", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("apart").alias("apart_a"))
    two = known.select("lead", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("apart").alias("apart_b"))
    met = pairs.join(one, ["lead", "a"]).join(two, ["lead", "b"])
    apart = F.size("apart_a") + F.size("apart_b") - 2 * F.size(F.array_intersect("apart_a", "apart_b"))
    return met.select("a", "b", "n_a", "n_b", ((F.col("n_a") + F.col("n_b") - apart) / 2).cast("long").alias("overlap")).dropDuplicates(["a", "b"])


def _flat(parents: DataFrame) -> DataFrame:
    """``parents`` (node, up) with every node right below its root. Each step halves the way to it."""
    while True:
        above = parents.select(F.col("node").alias("up"), F.col("up").alias("above"))
        jumped = parents.join(above, "up", "left").select("node", F.col("up").alias("was"), F.coalesce("above", "up").alias("up"))
        done = stored(jumped, "component-parents")
        parents = done.select("node", "up")
        if done.where("was <> up").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of all nodes in ``links`` (a, b): least node reachable. Each round is written to the shared folder.

    In a round every component goes below its least neighbour, if that is smaller,
    and links inside a component fall away. In two rounds each component with
    links left is joined with another one, so n nodes take 2 log2(n) rounds at most.
    """
    open_links = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "component-links")
    labels = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("comp", F.col("node"))
    while not open_links.isEmpty():
        hooked = open_links.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up")).withColumnRenamed("a", "node")
        roots = _flat(stored(hooked, "component-hooks"))
        up = roots.select(F.col("node").alias("comp"), "up")
        labels = stored(labels.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "component-labels")
        one = roots.select(F.col("node").alias("a"), F.col("up").alias("up_a"))
        two = roots.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        moved = open_links.join(one, "a").join(two, "b").where("up_a <> up_b")
        open_links = stored(moved.select(F.col("up_a").alias("a"), F.col("up_b").alias("b")).distinct(), "component-links")
    return labels


@dataclass(frozen=True)
class Joined:
    """Rows (id, n, cls, own, sketch), links (a, b, overlap) between classes with a < b, and (node, comp) of linked classes."""

    facts: DataFrame
    links: DataFrame
    labels: DataFrame

    def counts(self) -> DataFrame:
        """(cls, n_links) of every class that has links: whole only if all links were searched for."""
        ends = self.links.select(F.col("a").alias("cls")).union(self.links.select("b"))
        return ends.groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))


def joined(docs: DataFrame, sets: Sets = Sets(), only_components: bool = False) -> Joined:
    """Similar classes and their connections: every link between different sets.

    With ``only_components`` the links just connect whatever is connected; a link
    between sets that leaders already connect is not searched for.
    """
    texts = narrow(docs)
    rows = _facts(texts, sets)
    levels = _levels(rows, sets)
    facts = rows.where(F.col("n").isNotNull()).select("id", "n", "cls", "own", "sketch")
    filled = facts.where("n > 0")
    lists = _index(texts, levels, sets)
    pairs = _plausible(_leader_pairs(lists, sets), filled, sets)
    answers = stored(_compared(texts, filled, pairs, sets), "jaccard-answers")
    good = sets.linked(F.col("overlap"), F.col("n_a"), F.col("n_b"))
    # Two classes may each lead a list of the other one.
    links = answers.where(good).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "overlap").distinct()
    labels = components(links)
    tested = answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if only_components:
        # Turns go on while pairs of open lists outnumber their rows and each turn leaves far fewer.
        before, turn = float("inf"), 0
        while True:
            members = _open_members(lists, labels, sets)
            if not sets.peel:
                break
            rows, pairs = _open_size(members)
            if pairs <= 4 * rows or pairs > 0.7 * before:
                break
            before, turn = pairs, turn + 1
            met = stored(_head_pairs(members, sets, turn).join(tested, ["a", "b"], "left_anti"), "jaccard-heads-met")
            tested = tested.unionByName(met)
            more = _new_links(texts, filled, answers, met, sets)
            if more is None:
                break
            links = links.unionByName(more).distinct()
            labels = components(links)
    else:
        members = _open_members(lists, labels.limit(0), sets)
    more = _new_links(texts, filled, answers, _rest_pairs(members, sets).join(tested, ["a", "b"], "left_anti"), sets)
    if more is not None:
        links = links.unionByName(more)
        links = links.distinct() if only_components else links
        labels = components(links)
    return Joined(facts, links, labels)


def _new_links(texts: DataFrame, filled: DataFrame, answers: DataFrame, pairs: DataFrame, sets: Sets) -> DataFrame | None:
    """(a, b, overlap): linked ones among ``pairs`` (a < b), derived from the leaders' answers where one has them; None: there are none."""
    rest = _plausible(pairs, filled, sets)
    if rest.isEmpty():
        return None
    good = sets.linked(F.col("overlap"), F.col("n_a"), F.col("n_b"))
    tests, led, alone = _tests(rest, answers)
    known = answers.unionByName(stored(_compared(texts, filled, tests, sets), "jaccard-tests"))
    derived = _derived(led, known)
    compared = _compared(texts, filled, alone, sets).select("a", "b", "n_a", "n_b", "overlap")
    more = stored(derived.unionByName(compared).where(good).select("a", "b", "overlap"), "jaccard-more")
    return None if more.isEmpty() else more


def _placed(found: Joined) -> DataFrame:
    """(id, n, cls, own, lowest) of every row: id and text mark of the least row of its component (null for an empty set)."""
    classes = found.facts.where("n > 0").groupBy("cls").agg(F.min(F.struct("id", "own")).alias("least"))
    named = classes.join(found.labels.select(F.col("node").alias("cls"), "comp"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    lowest = named.groupBy("comp").agg(F.min("least").alias("lowest"))
    roots = named.join(lowest, "comp").select("cls", "lowest")
    placed = found.facts.select("id", "n", "cls", "own").join(roots, "cls", "left")
    return placed.withColumn("lowest", F.when(F.col("n") > 0, F.col("lowest")))


def near_duplicates(docs: DataFrame, sets: Sets = Sets()) -> DataFrame:
    """(doc_id, n_shingles, component_id, class_id) of every row of ``docs``.

    A row's set holds its distinct runs of ``sets.words`` words (A-Z lower-cased); a
    shorter text is one run. ``component_id`` is the smallest doc_id reachable by links.

    A text without words, empty or null, has an empty set and is its own component.
    Rows that repeat a doc_id are sets of their own. A null doc_id sorts before
    all; a component that holds one has a null component_id. Other columns are
    not read. An empty table gives an empty result. Sets are told apart by
    64-bit fingerprints, n-grams likewise.
    """
    return _placed(joined(docs, sets, only_components=True)).select(
        original(F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        original(F.coalesce("lowest.id", "id")).alias("component_id"),
        F.col("cls").alias("class_id"),
    )


def deduplicated(docs: DataFrame, sets: Sets = Sets()) -> DataFrame:
    """``docs`` with all columns, one row of each component: one with its smallest doc_id.

    Texts without words are not touched.
    """
    rows = _placed(joined(docs, sets, only_components=True)).where(F.col("lowest").isNotNull())
    stays = (F.col("id") == F.col("lowest.id")) & (F.col("own") == F.col("lowest.own"))
    return one_each(docs, rows.select("id", F.col("own").alias("mark"), stays.alias("stays")), text_mark())
