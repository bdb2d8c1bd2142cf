"""Crawl seeds: one sitemap per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import SiteSettings


def seed_url(day: Column, site: SiteSettings) -> Column:
    head, tail = site.sitemap_template.replace("{domain}", site.domain).split("{day}")
    return F.concat(F.lit(head), F.date_format(day, "yyyy-MM-dd"), F.lit(tail))


def seeds(ranges: DataFrame, site: SiteSettings) -> DataFrame:
    """(day, url) for every (start, end) row, both ends included; none if start > end."""
    days = F.when(
        F.col("start") <= F.col("end"),
        F.sequence(F.col("start"), F.col("end"), F.expr("interval 1 day")),
    )
    return ranges.select(F.explode(days).alias("day")).select("day", seed_url(F.col("day"), site).alias("url"))


def seed_range(
    spark: SparkSession,
    site: SiteSettings,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Seeds of one range; by default the last days up to today."""
    end = end or dt.date.today()
    start = start or end - dt.timedelta(days=site.lookback_days)
    ranges = spark.createDataFrame([(start, end)], "start date, end date")
    return seeds(ranges, site)
