"""Mixing sources to target weights by weighted fair queueing.

Every source queues its documents in a fixed random order, once for each time a
document may be taken. An entry's virtual finish time is the number of words its
source has queued up to its end, divided by the source's weight. All entries are
sorted by it, whatever their source, and taken until the budget is spent: at any
point the sources have got words in proportion to their weights, and a source whose
queue has ended leaves its share to the others.

Built from DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmine.llm.common import looked_up, stored
from newsmine.operators.ordering import BUCKET, PART, part_offsets, ranged, running, running_by_range

#: Stands for a null source; others have a sign in front.
NO_SOURCE = ""
WORD = r"[^\x20\x09-\x0D]+"
_DIGITS = 3  # leading hex digits of the shuffle key: 4096 order-preserving buckets for each source
#: An entry's place in the mix: finish time, source, shuffle key.
_PLACE = ("finish", "rank", "mark")


def source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(NO_SOURCE))


@dataclass(frozen=True)
class Shares:
    """What the sources may get."""

    #: Weights of the sources in code point order, repeating; null comes last.
    weights: tuple[int, ...] = (3, 1, 2)
    #: Hundredths of all words that the mix may hold.
    percent: int = 150
    #: Times a document may be taken.
    times: int = 2
    seed: int = 42

    @property
    def unit(self) -> int:
        """Finish times are whole numbers: words times this, divided by the weight."""
        return lcm(*self.weights)

    def weight(self, rank: Column) -> Column:
        return F.element_at(F.array(*[F.lit(w) for w in self.weights]), (rank % len(self.weights) + 1).cast("int"))

    def shuffled(self, number: Column, text: Column) -> Column:
        """Shuffle key of a document: depends on its doc_id, its text and the seed only."""
        parts = [F.coalesce(number.cast("string"), F.lit("")), F.lit(str(self.seed)), F.md5(F.coalesce(text, F.lit("")))]
        return F.md5(F.concat_ws(":", *parts))


@dataclass(frozen=True)
class Mix:
    """Sources with their targets, and every document's place in its source's queue."""

    shares: Shares
    #: (source, rank, documents, size, weight, target) of each source.
    sources: DataFrame
    #: (doc_id, source, size, mark, rank, source_size, target, weight, queued): ``queued`` words end with the document.
    queue: DataFrame
    budget: float

    def finish(self, time: int) -> Column:
        """Virtual finish time of a document's entry, when it is taken for the ``time``-th time (from 0)."""
        return ((F.col("source_size") * time + F.col("queued")) * (F.lit(self.shares.unit) / F.col("weight")).cast("long")).cast("long")

    def entries(self) -> DataFrame:
        """(finish, rank, mark, size): one row for each time that a document may be taken."""
        times = F.array(*[self.finish(k) for k in range(self.shares.times)])
        return self.queue.where("size > 0").select(F.explode(times).alias("finish"), "rank", "mark", "size")

    @cached_property
    def end(self) -> tuple | None:
        """Place of the first entry that no longer fits into the budget (None: all fit).

        Only sums of the sorted parts are added up; inside the one part in which the
        budget ends, entries of the same place count together.
        """
        parts = ranged(self.entries(), _PLACE)
        offsets = part_offsets(parts, F.col("size")).where(F.col("_offset") + F.col("_sum") > self.budget)
        last = offsets.orderBy(PART).first()
        if last is None:
            return None
        inside = running_by_range(parts.where(F.col(PART) == last[PART]).groupBy(*_PLACE).agg(F.sum("size").alias("size")), _PLACE, {"spent": F.col("size")})
        over = inside.where(F.col("spent") + last["_offset"] > self.budget)
        return tuple(over.agg(F.min(F.struct(*_PLACE)).alias("end")).first()["end"])

    def taken(self) -> Column:
        """How often a row of ``queue`` is taken."""
        if self.end is None:
            return F.when(F.col("size") > 0, F.lit(self.shares.times)).otherwise(0)
        finish, rank, mark = self.end
        limit = F.struct(F.lit(finish).cast("long").alias("finish"), F.lit(rank).cast("long").alias("rank"), F.lit(mark).alias("mark"))
        count = F.lit(0)
        for k in range(self.shares.times):
            place = F.struct(self.finish(k).alias("finish"), F.col("rank").cast("long").alias("rank"), F.col("mark"))
            count = count + F.when((F.col("size") > 0) & (place < limit), F.lit(1)).otherwise(0)
        return count

    def rows(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) of every document; ``taken`` counts words, repeats included."""
        words = (self.taken() * F.col("size")).cast("long").alias("taken")
        return self.queue.select("doc_id", "size", "source_size", "target", words)


def _sources(rows: DataFrame, shares: Shares, budget: float) -> DataFrame:
    """(source, rank, documents, size, weight, target): one row for each source.

    A source's target is its weight times a level common to all, or ``times`` its
    size if that is less. Sources are sorted by the level at which they reach their
    limit; the level is what the budget leaves to the weights of all sources from some
    point on, and the largest of these values is the one at which none is above its limit.
    """
    one = F.lit(1).cast("long")
    sums = rows.groupBy("source").agg(F.count(one).alias("documents"), F.sum("size").alias("size"))
    named = sums.withColumn("last", F.col("source") == NO_SOURCE)
    ranked = running_by_range(named, ["last", "source"], {"rank": one}, inclusive=False)
    most = shares.times * F.col("size")
    weighted = ranked.withColumn("weight", shares.weight(F.col("rank"))).withColumn("most", most)
    sorted_by = weighted.withColumn("full", F.col("most") / F.col("weight"))
    sums = running_by_range(sorted_by, ["full", "rank"], {"spent": F.col("most"), "gone": F.col("weight")}, inclusive=False)
    levels = stored(sums, "mix-levels")
    whole = levels.agg(F.sum("weight")).first()[0] or 0
    level = levels.agg(F.max((F.lit(budget) - F.col("spent")) / (F.lit(whole) - F.col("gone")))).first()[0]
    target = F.least(F.col("most").cast("double"), F.col("weight") * F.lit(level))
    return levels.select("source", "rank", "documents", "size", "weight", target.alias("target"))


def mix(docs: DataFrame, shares: Shares = Shares()) -> Mix:
    """Queue every document of ``docs`` and find where the budget ends.

    A size is the number of words; a null or empty text has none and is never taken.
    The order inside a source depends on doc_id, text and seed only, so reruns agree.
    A null source is a source of its own, the last one. Null doc_ids are queued by
    their texts. Rows that repeat a doc_id and a text within a source queue one after
    the other; which of them comes first does not matter, as they are equal. Other
    columns are not read. An empty table gives empty results. The mix ends before the
    first entry that exceeds the budget, so it may miss a target by about one document.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        source_key(F.col("source")).alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        shares.shuffled(F.col("doc_id"), F.col("text").cast("string")).alias("mark"),
    )
    rows = stored(base, "mix-rows")
    counted = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = counted[1] * shares.percent / 100
    sources = stored(_sources(rows, shares, budget), "mix-sources")
    facts = sources.select("source", "documents", "rank", F.col("size").alias("source_size"), "target", "weight")
    named = looked_up(rows, facts, "source", "documents", counted[0])
    bucketed = stored(named.withColumn(BUCKET, F.conv(F.substring("mark", 1, _DIGITS), 16, 10).cast("int")), "mix-named")
    queue = running(bucketed, ["rank"], ["mark"], F.col("size"), "queued")
    return Mix(shares, sources, stored(queue, "mix-queue"), budget)


def mixed(docs: DataFrame, shares: Shares = Shares()) -> DataFrame:
    """(copy, row): the mix itself, one row for each time a document is taken; ``row`` holds all its columns.

    Rows that repeat a doc_id and a text within a source are returned as copies of one of them.
    """
    plan = mix(docs, shares)
    times = plan.queue.select("source", "mark", plan.taken().alias("times")).groupBy("source", "mark").agg(F.sum("times").alias("times"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(source_key(F.col("source")).alias("source"), shares.shuffled(F.col("doc_id"), F.col("text").cast("string")).alias("mark"), row)
    met = keyed.dropDuplicates(["source", "mark"]).join(times.where("times > 0"), ["source", "mark"])
    return met.select(F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"), "row")
