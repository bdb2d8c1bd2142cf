"""Exact de-duplication by progressive refinement: length, then prefix hash, then full hash.

Built from DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmine.llm.common import NULL_ID, WHITE, narrow, original, stored

PREFIX = 128  # characters under the prefix hash


def normalised(text: Column) -> Column:
    """Runs of white space become one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WHITE}+", " ")


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key with its first id and size; counted in every task before the shuffle."""
    return rows.groupBy(*keys).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size"))


def _judged(docs: DataFrame, digest: bool, buckets: int) -> DataFrame:
    """(id, first, size, sha) of every row; without ``digest`` sha is null for texts known to be alone."""
    text = normalised(F.col("text"))
    base = narrow(docs).select(
        "id",
        F.octet_length(text).alias("bytes"),
        F.xxhash64(F.substring(text, 1, PREFIX)).alias("prefix"),
        *([F.sha2(text, 256).alias("sha")] if digest else []),
    )
    rows = stored(base, "exact-rows")
    lengths = rows.groupBy("bytes").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("bytes")
    heads = _groups(rows.join(lengths, "bytes", "left_semi"), ["bytes", "prefix"]).where("size > 1")
    crowded = stored(heads.select("bytes", "prefix"), "exact-crowded")
    settled = rows.join(crowded, ["bytes", "prefix"], "left_anti")
    if digest:
        open_rows = rows.join(crowded, ["bytes", "prefix"], "left_semi")
    else:
        bucket = F.pmod(F.xxhash64("bytes", "prefix"), F.lit(buckets))
        marks = crowded.select(bucket.alias("bucket")).distinct()
        seen = narrow(docs).withColumns(
            {"bytes": F.octet_length(text), "prefix": F.xxhash64(F.substring(text, 1, PREFIX))}
        )
        picked = seen.join(F.broadcast(marks), bucket == F.col("bucket"), "left_semi")
        hashed = picked.select("id", "bytes", "prefix", F.sha2(text, 256).alias("sha"))
        open_rows = stored(hashed.join(crowded, ["bytes", "prefix"], "left_semi"), "exact-open")
    keys = ["bytes", "prefix", "sha"]
    alike = _groups(open_rows, keys).where("size > 1")
    joined = open_rows.join(alike, keys, "left").select(
        *open_rows.columns, F.coalesce("first", "id").alias("first"), F.coalesce("size", F.lit(1)).alias("size")
    )
    alone = settled.select(*settled.columns, F.col("id").alias("first"), F.lit(1).cast("long").alias("size"))
    return joined.unionByName(alone, allowMissingColumns=True).select("id", "first", "size", "sha")


def duplicates(docs: DataFrame, digest: bool = False, buckets: int = 1 << 20) -> DataFrame:
    """(doc_id, keep_id, group_size, kept) of every row, with ``text_sha256`` if ``digest``.

    Level one groups the lengths of all normalised texts, level two the prefix
    hashes inside lengths that occur more than once, level three the full hashes
    inside prefix groups that still hold several rows. Only for those is the
    whole text hashed: a small table of at most ``buckets`` prefix-group buckets
    (a fixed bound, so it is broadcast) picks their rows at the scan. With
    ``digest`` every row has to return its full hash, so it is taken in the first
    scan and level three reads it from there instead of reading texts again.

    Null and empty texts are equal. The smallest doc_id of a group stays; a null
    doc_id sorts before all. Rows that repeat a doc_id count one by one in
    ``group_size``; if that doc_id stays, all of them are marked kept. Other
    columns are not read. An empty table gives an empty result.
    """
    return _judged(docs, digest, buckets).select(
        original(F.col("id")).alias("doc_id"),
        original(F.col("first")).alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("id") == F.col("first")).alias("kept"),
        *([F.col("sha").alias("text_sha256")] if digest else []),
    )


def one_each(docs: DataFrame, judged: DataFrame, mark: Column, limit: int = 1_000_000) -> DataFrame:
    """``docs`` with one row of each group, as ``judged`` (id, mark, stays) says of every row that has a group.

    Rows are told apart by id and ``mark``, a 64-bit fingerprint of the text. Where
    several rows have the id and the mark that stay, any one of them is returned.
    Rows without an entry in ``judged`` stay.

    The entries travel to the texts only while there are at most ``limit`` of them
    (16 bytes each); beyond that both sides are joined.
    """
    counted = judged.groupBy("id", "mark").agg(F.max("stays").alias("_stays"), F.count(F.lit(1)).alias("many"))
    entries = stored(counted.where("many > 1 or not _stays").select(F.col("id").alias("_id"), F.col("mark").alias("_mark"), "_stays"), "one-each")

    def few(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= limit else rows

    # The row travels in a struct, so no name of its columns can clash.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    named = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("_id"), mark.alias("_mark"), row)
    rest = named.join(few(entries.select("_id", "_mark")), ["_id", "_mark"], "left_anti")
    copies = entries.where("_stays").select("_id", "_mark")
    if not copies.isEmpty():
        rest = rest.unionByName(named.join(few(copies), ["_id", "_mark"], "left_semi").dropDuplicates(["_id", "_mark"]))
    return rest.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, one row of each group of equal texts.

    It has the smallest doc_id of the group; of several rows with it any one.
    """
    judged = _judged(docs, False, 1 << 20).where(F.col("sha").isNotNull())
    # The hash as a number: two of one doc_id are as good as never equal.
    mark = lambda sha: F.xxhash64(sha)
    found = judged.select("id", mark(F.col("sha")).alias("mark"), (F.col("id") == F.col("first")).alias("stays"))
    return one_each(docs, found, mark(F.sha2(normalised(F.col("text").cast("string")), 256)))
