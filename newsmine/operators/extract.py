"""Stored pages to documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.functions import html as H
from newsmine.functions.text import let


def _extracted(pages: DataFrame, site: SiteSettings, keep) -> DataFrame:
    """Replace ``html`` by ``text`` and ``pub_date`` where ``keep`` accepts the pair.

    The pair is generated from a one-element array: a filter on a plain column
    would be pushed to the scan and the whole extraction evaluated twice.
    """
    html = F.col("html")
    pair = let(
        H.island(html, site),
        lambda data: F.struct(
            H.body_text(html, data, site).alias("text"),
            H.publication_date(html, data, site).alias("pub_date"),
        ),
    )
    others = [c for c in pages.columns if c != "html"]
    return pages.select(*others, F.inline(F.filter(F.array(pair), keep)))


def with_text_and_date(pages: DataFrame, site: SiteSettings) -> DataFrame:
    """Every page; ``text`` is null when too short.

    The island is parsed once, and visible text is only looked at when the
    island does not give enough.
    """
    return _extracted(pages, site, lambda pair: F.lit(True))


def documents(pages: DataFrame, site: SiteSettings) -> DataFrame:
    """Pages with enough text."""
    return _extracted(pages, site, lambda pair: pair["text"].isNotNull())


def rejected(pages: DataFrame, site: SiteSettings) -> DataFrame:
    """Pages without enough text, for the side table."""
    return _extracted(pages, site, lambda pair: pair["text"].isNull()).drop("text", "pub_date")


def extraction_yield(pages: DataFrame, site: SiteSettings) -> DataFrame:
    """(label, ok, total) per class."""
    return (
        with_text_and_date(pages, site)
        .groupBy("label")
        .agg(F.count("text").alias("ok"), F.count(F.lit(1)).alias("total"))
    )


def date_range(docs: DataFrame) -> DataFrame:
    """First and last day among non-empty ISO strings (text order)."""
    dates = docs.where(F.col("pub_date") != "")
    return dates.agg(
        F.substring(F.min("pub_date"), 1, 10).alias("first_day"),
        F.substring(F.max("pub_date"), 1, 10).alias("last_day"),
    )
