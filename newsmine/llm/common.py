"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.session import work_path

#: Stands for a null doc_id inside an operator: sorts before all others.
NULL_ID = -(2**63)
#: ``[\x20\x09-\x0D]`` as a Java character class.
WHITE = r"[\x20\x09-\x0D]"

Batches = Iterator[pa.RecordBatch]


def narrow(docs: DataFrame, *more: str) -> DataFrame:
    """(id, text, *more): only the columns an operator reads; extra ones never clash."""
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    return docs.select(number.alias("id"), F.col("text").cast("string").alias("text"), *more)


def original(number: Column) -> Column:
    """The doc_id behind an internal id."""
    return F.when(number != NULL_ID, number)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives every later reader the
    same rows, so a row number drawn before it stays valid.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(rows: DataFrame, facts: DataFrame, key: str, many: str, total: int, share: int = 1000) -> DataFrame:
    """``rows`` with the columns of ``facts``, one row for each value of ``key`` (no nulls) with its number ``many`` of rows.

    A value with more than a ``share``-th of all ``total`` rows is looked up in its own
    task: there are fewer than ``share`` of them, so they are broadcast. All other
    values are too small to burden a task, and are joined by a shuffle.
    """
    common = F.col(many) * share > total
    frequent = F.broadcast(facts.where(common).drop(many))
    rare = rows.join(frequent.select(key), key, "left_anti").join(facts.where(~common).drop(many), key)
    return rows.join(frequent, key).unionByName(rare)


def sampled(df: DataFrame, rows: int, *keys: Column) -> DataFrame:
    """About ``rows`` rows at most, chosen by a hash of ``keys`` (all, if there are fewer)."""
    total = df.count()
    if total <= rows:
        return df
    share = F.pmod(F.xxhash64(*keys, F.lit("sample")), F.lit(1_000_000))
    return df.where(share < int(1_000_000 * rows / total))


def per_batch(work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return run


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/conversations.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")
