"""Best-fit packing into several permitted sequence lengths.

Lengths are whole numbers up to the largest permitted one, so how many rows have
which length is a table of fixed size. The packing is decided on that table:
equal pieces fill equal bins in bulk, with the result of best fit decreasing. Spark
counts the lengths, and deals the rows to the places that the plan holds for them.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmine.llm.common import NULL_ID, original, stored
from newsmine.operators.ordering import BUCKET, running


@dataclass(frozen=True)
class BinCost:
    """What a bin of a capacity costs: fixed part, per place, and per pair of places."""

    fixed: float = 128.0
    place: float = 1.0
    pair: float = 1.0 / 65536

    def __call__(self, capacity: int) -> float:
        return self.fixed + self.place * capacity + self.pair * capacity * capacity


@dataclass
class Plan:
    """Segments (length, from, upto, bin, per_bin, offset, capacity) and finished bins (bin, number, used, capacity)."""

    segments: list[tuple[int, int, int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)


def packed_plan(counts: Mapping[int, int], capacities: Sequence[int], cost: BinCost = BinCost()) -> Plan:
    """Best fit decreasing over a table of lengths.

    A piece goes to the open bin it leaves least room in. If none has room, a
    bin opens in the permitted size that costs least for each place filled: by
    further pieces of this length and then by what all shorter ones can fill.
    At the end every bin shrinks to the least permitted size that holds its contents.
    """
    sizes = sorted(capacities)
    lengths = sorted((n for n in counts if n > 0 and counts[n] > 0), reverse=True)
    shorter = sum(n * counts[n] for n in lengths)
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, int, int]]] = {}  # room: (first bin, number, used)
    raw: list[tuple[int, int, int, int, int, int]] = []
    fresh = 0

    def keep(room: int, first: int, number: int, used: int) -> None:
        if room not in open_bins:
            insort(rooms, room)
            open_bins[room] = []
        open_bins[room].append((first, number, used))

    for length in lengths:
        left, rank = counts[length], 0
        shorter -= length * left
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number, used = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
            else:

                def filled(size: int) -> int:
                    own = length * min(size // length, left)
                    return own + min(size - own, shorter)

                size = min((s for s in sizes if s >= length), key=lambda s: (cost(s) / filled(s), s))
                room, first, used = size, fresh, 0
                number = max(1, left // (size // length))
                fresh += number
            each = min(room // length, left)
            full = min(number, left // each)
            raw.append((length, rank, rank + full * each, first, each, used))
            if number > full:
                keep(room, first + full, number - full, used)
            keep(room - each * length, first, full, used + each * length)
            rank += full * each
            left -= full * each
    plan = Plan()
    for room in rooms:
        for first, number, used in open_bins[room]:
            plan.bins.append((first, number, used, next(s for s in sizes if s >= used)))
    plan.bins.sort()
    edges = [b[0] for b in plan.bins]
    for length, low, high, first, each, offset in raw:
        # Cut where the finished sizes of the bins change.
        end = first + (high - low) // each
        i = bisect_left(edges, first + 1) - 1
        at = first
        while at < end:
            upto = min(end, plan.bins[i][0] + plan.bins[i][1])
            size = plan.bins[i][3]
            while upto < end and plan.bins[i + 1][3] == size:
                i += 1
                upto = min(end, plan.bins[i][0] + plan.bins[i][1])
            plan.segments.append((length, low + (at - first) * each, low + (upto - first) * each, at, each, offset, size))
            at, i = upto, i + 1
    return plan


def packed(
    docs: DataFrame,
    capacities: Sequence[int] = (2048, 4096, 8192, 16384),
    length: Column | None = None,
    cost: BinCost = BinCost(),
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_offset, capacity): where every piece of every row goes.

    ``length`` is the tokens of a row, by default its UTF-8 bytes (a byte-level
    model). A row longer than the largest capacity is cut into pieces of that
    size and a rest; nothing is lost and no piece is cut otherwise. ``bin_id`` is
    the bin, ``bin_offset`` the place in it, ``capacity`` its size after shrinking.

    A null or empty text, or a null length, gives one piece of length 0 without a
    bin. Repeated rows are packed one by one, a null doc_id stays null, other
    columns are only read by ``length``. Rows of equal length take the plan's places in order of
    doc_id inside hash buckets; of bins with equal room those last filled come first, and of sizes
    with equal cost the smaller one opens. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    most = max(capacities)
    own = F.octet_length(F.col("text").cast("string")) if length is None else length
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    sized = docs.select(number.alias("id"), F.coalesce(own, F.lit(0)).cast("long").alias("total"))
    whole, rest = F.floor(F.col("total") / most), F.pmod(F.col("total"), F.lit(most))
    units = F.array(
        F.struct(F.lit(most).cast("long").alias("length"), whole.alias("times"), F.lit(0).cast("long").alias("piece")),
        F.struct(rest.cast("long").alias("length"), F.when((rest > 0) | (F.col("total") == 0), 1).otherwise(0).cast("long").alias("times"), whole.alias("piece")),
    )
    items = stored(sized.select("id", F.inline(units)).where("times > 0"), "packing-items")
    counts = {r["length"]: r["n"] for r in items.where("length > 0").groupBy("length").agg(F.sum("times").alias("n")).collect()}
    plan = packed_plan(counts, capacities, cost)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = items.withColumn(BUCKET, F.pmod(F.xxhash64("id", "piece"), F.lit(buckets)).cast("int"))
    ranked = running(dealt, ["length"], ["id", "piece"], F.col("times"), "rank", inclusive=False)
    single = ranked.select("id", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("k"), "piece", "rank")
    single = single.select("id", "length", (F.col("piece") + F.col("k")).alias("piece"), (F.col("rank") + F.col("k")).alias("rank"))
    segments = spark.createDataFrame(plan.segments, "length long, low long, high long, first long, each long, place long, capacity int")
    # The plan's size follows the capacities, not the rows.
    table = F.broadcast(segments) if len(plan.segments) <= broadcast_rows else segments
    at = single.alias("x").join(
        table.alias("p"),
        (F.col("x.length") == F.col("p.length")) & (F.col("x.rank") >= F.col("p.low")) & (F.col("x.rank") < F.col("p.high")),
        "left",
    )
    step = F.col("rank") - F.col("low")
    return at.select(
        original(F.col("id")).alias("doc_id"),
        "piece",
        (F.col("piece") * most).alias("start"),
        F.col("x.length").alias("length"),
        (F.col("first") + F.floor(step / F.col("each"))).alias("bin_id"),
        (F.col("place") + F.pmod(step, F.col("each")) * F.col("x.length")).alias("bin_offset"),
        "capacity",
    )
