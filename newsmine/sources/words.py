"""Word lists and word vectors."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.functions.text import strip


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line: trimmed, lower-cased, blank lines dropped.

    A leading byte-order mark is removed, so the first word counts. Of equal lines only one is trimmed.
    """
    line = F.regexp_replace("value", "^﻿", "")
    return (
        spark.read.text(path)
        # A plain distinct() would be dropped as the last one repeats it; the count keeps it in the plan.
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 0")
        .select(F.lower(strip(line)).alias("word"))
        .where(F.col("word") != "")
        .distinct()
    )


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str | None:
    """The first path that can be read (unaccented list before accented list)."""
    from pyspark.errors import AnalysisException

    for path in paths:
        try:
            spark.read.text(path).schema
            return path
        except AnalysisException:
            continue
    return None


def preferred_words(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    path = first_existing(spark, paths)
    if path is None:
        return spark.createDataFrame([], "word string")
    return read_words(spark, path)


def read_vectors(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """``word f1 … fd`` lines as (word, vec array<float>); a repeated word keeps its last line.

    A first line of two whole numbers is a header, its second number the length of
    all vectors; else the first line has that length. Blank lines are skipped, a
    line of another length or with something that is no number is an error.
    """
    at = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    trimmed = F.regexp_replace("value", f"{sep}+$", "")
    lines = spark.read.text(path).select(F.split(trimmed, sep).alias("parts"), at.alias("_line"), (trimmed == "").alias("blank"))
    lines = lines.where(~F.col("blank"))
    # One line goes to the driver.
    first = lines.agg(F.min_by("parts", "_line")).first()[0] or []
    header = len(first) == 2 and all(re.fullmatch("[0-9]+", p) for p in first)
    width = int(first[1]) if header else len(first) - 1
    if header:
        start = lines.agg(F.min("_line").alias("_start"))
        lines = lines.join(F.broadcast(start), F.col("_line") != F.col("_start"))
    values = F.slice("parts", F.lit(2), F.size("parts"))
    wrong = F.raise_error(F.concat(F.lit(f"a vector of {width} numbers is expected after: "), F.col("parts")[0]))
    vec = F.when(F.size(values) == width, values.cast("array<float>")).otherwise(wrong.cast("array<float>"))
    rows = lines.select(F.col("parts")[0].alias("word"), vec.alias("vec"), "_line")
    return rows.groupBy("word").agg(F.max_by("vec", "_line").alias("vec"))


def last_vectors(rows: DataFrame, order: str) -> DataFrame:
    """(word, vec) keeping the row with the greatest ``order`` per word."""
    return rows.groupBy("word").agg(F.max_by("vec", order).alias("vec"))
