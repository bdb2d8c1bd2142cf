"""From sitemaps and responses to stored pages, events and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.functions import html as H
from newsmine.functions import urls as U
from newsmine.functions.text import let
from newsmine.operators.ordering import numbered
from newsmine.session import cut

KEY = ["section", "filename"]
# Outcome names.
STORED, SKIPPED, OUTSIDE = "guardado", "omitido", "fuera-de-seccion"
UNTAGGED, NOT_ARTICLE = "sin-seccion", "url-no-reconocida"
FAILED = "error: "  # followed by the reason


def sitemap_links(sitemaps: DataFrame) -> DataFrame:
    """Every ``<loc>`` link in document order, repeats included; entities stay as written."""
    links = F.regexp_extract_all("body", F.lit("<loc>(https?://[^<]+)</loc>"), F.lit(1))
    keep = [c for c in sitemaps.columns if c != "body"]
    return sitemaps.select(*keep, F.posexplode(links).alias("pos", "loc"))


def article_links(links: DataFrame, site: SiteSettings) -> DataFrame:
    return links.where(U.is_article(F.col("loc"), site))


def frontier(links: DataFrame, site: SiteSettings) -> DataFrame:
    """Distinct article links on the site's own hosts."""
    wanted = U.is_article(F.col("loc"), site) & U.host_allowed(F.col("loc"), site)
    return links.where(wanted).select(F.col("loc").alias("url")).dropDuplicates(["url"])


def admitted(fetched: DataFrame, site: SiteSettings) -> DataFrame:
    return fetched.where(U.status_admitted(F.col("status"), site))


def failure(body: Column, filename: Column, site: SiteSettings) -> Column:
    """Why a page cannot be stored (null: it can)."""
    size = F.octet_length(filename)
    return (
        F.when(body.isNull(), "no body")
        .when(size > site.max_name_bytes, F.concat(F.lit("file name of "), size.cast("string"), F.lit(" bytes")))
        .when(~F.is_valid_utf8(body), "body is not valid UTF-8")
    )


def routed(fetched: DataFrame, site: SiteSettings) -> DataFrame:
    """(…, section, filename, outcome, error); the outcome is null for pages that may be stored.

    A page that cannot be stored carries its reason in ``error`` and fails alone.
    Bodies are read once here and not carried along: the narrow result is written
    to the shared folder, and filing joins the bodies of the chosen pages back.
    """

    def decide(section: Column) -> Column:
        filename = F.when(F.col("url").rlike(U.article_pattern(site)), U.file_name(F.col("url"), site))
        outcome = (
            F.when(section.isNull(), UNTAGGED)
            .when(~section.isin(*site.sections), OUTSIDE)
            .when(filename.isNull(), NOT_ARTICLE)
        )
        return F.struct(section.alias("section"), filename.alias("filename"), outcome.alias("outcome"))

    keep = [c for c in fetched.columns if c != "body"]
    # Broken bytes must not stop the search for the section.
    readable = F.make_valid_utf8(F.col("body"))
    decided = fetched.select(*keep, "body", let(H.section(readable, site), decide).alias("_route"))
    error = F.when(F.col("_route.outcome").isNull(), failure(F.col("body"), F.col("_route.filename"), site))
    return cut(decided.select(*keep, "_route.section", "_route.filename", "_route.outcome", error.alias("error")))


def settle(pages: DataFrame, stored: DataFrame | None) -> DataFrame:
    """Complete the outcome: stored once per key, never over an existing page.

    Only keys and sequence numbers are grouped (with map-side combine), so a key
    that is repeated very often stays cheap and page bodies are not moved for it. A
    page that cannot be stored fails, unless its key is there already or comes first;
    it does not keep a later page of its key from being stored.
    """
    candidates = pages.where(F.col("outcome").isNull()).select(*KEY, "seq", "error")
    if stored is not None:
        candidates = candidates.join(stored.select(*KEY), KEY, "left_anti")
    good = candidates.where(F.col("error").isNull())
    winners = good.groupBy(*KEY).agg(F.min("seq").alias("first"))
    broken = candidates.where(F.col("error").isNotNull()).join(winners, KEY, "left")
    failed = broken.where(F.col("first").isNull() | (F.col("seq") < F.col("first")))
    news = winners.select(F.col("first").alias("seq"), F.lit(STORED).alias("_new")).unionByName(
        failed.select("seq", F.concat(F.lit(FAILED), "error").alias("_new"))
    )
    return (
        pages.join(news, "seq", "left").withColumn("outcome", F.coalesce("outcome", "_new", F.lit(SKIPPED))).drop("_new", "error")
    )


def events_of(settled: DataFrame) -> DataFrame:
    """(seq, section, url, filename, status) of pages that were stored or skipped, or failed."""
    shown = F.col("outcome").isin(STORED, SKIPPED) | F.col("outcome").startswith(FAILED)
    return settled.where(shown).select("seq", "section", "url", "filename", F.col("outcome").alias("status"))


def run_numbers(events: DataFrame) -> DataFrame:
    """Running number per section of the stored pages, in fetch order."""
    stored = events.where(F.col("status") == STORED).select(*KEY, "seq")
    return numbered(stored, ["section"], ["seq"], F.col("seq"), "n")


def section_frame(spark: SparkSession, sections: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in sorted(sections)], "section string")


def run_summary(events: DataFrame, site: SiteSettings, reason: str = "finished") -> DataFrame:
    """Stored pages per target section (zeros shown) and the TOTAL row."""
    spark = events.sparkSession
    stored = events.where(F.col("status") == STORED)
    counts = stored.rollup("section").agg(F.count(F.lit(1)).alias("n"))
    named = counts.select(F.coalesce("section", F.lit("TOTAL")).alias("section"), "n")
    frame = section_frame(spark, [*site.sections, "TOTAL"])
    return frame.join(F.broadcast(named), "section", "left").select(
        "section", F.coalesce("n", F.lit(0)).alias("n"), F.lit(reason).alias("reason")
    )
