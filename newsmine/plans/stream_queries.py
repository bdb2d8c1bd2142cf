"""Streaming queries, run until the data at hand is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.operators.acquire import KEY
from newsmine.operators.store import PageStore
from newsmine.plans import fixtures as X
from newsmine.plans.acquire_queries import _ROUTED
from newsmine.plans.registry import query
from newsmine.session import table, work_path
from newsmine.streaming import feeds as S

SITE = X.SITE

_LINES = f"""
WITH parts AS (
  SELECT event_id, event_type, strftime(TIMESTAMP '2026-01-01' + to_seconds(event_id % 86400), '%Y-%m-%d %H:%M:%S') || ' ' AS stamp FROM events),
shown AS (
  SELECT CASE event_type
    WHEN 'view' THEN '[core] DEBUG: Crawled (200) <GET nota-' || event_id || '>'
    WHEN 'click' THEN '[{SITE.crawler_name}] INFO: [economia] #' || event_id || ' guardado'
    WHEN 'error' THEN 'warning ' || event_id END AS value FROM parts)
SELECT value FROM shown WHERE value IS NOT NULL
"""


def _log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Log lines that tell the events: timestamped, short, noisy, with trailing blanks."""
    number = F.col("event_id").cast("string")
    second = (F.col("event_id") % 86400).cast("int")
    clock = [F.floor(second / 3600), F.floor(second / 60) % 60, second % 60]
    digits = [F.lpad(c.cast("string"), 2, "0") for c in clock]
    stamp = F.concat(F.lit("2026-01-01 "), F.concat_ws(":", *digits))
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(stamp, F.lit(" [core] DEBUG: Crawled (200) <GET nota-"), number, F.lit(">  ")))
        .when(kind == "click", F.concat(stamp, F.lit(f" [{SITE.crawler_name}] INFO: [economia] #"), number, F.lit(" guardado\t")))
        .when(kind == "error", F.concat(F.lit("warning "), number))
        .otherwise(F.concat(stamp, F.lit(" [otro] INFO: nada "), number))
    )
    return table(spark, sf, "events").select(line.alias("value"))


@query("log_feed", _LINES)
def log_feed(spark: SparkSession, sf: str) -> DataFrame:
    landing, out = work_path(spark, "log"), work_path(spark, "feed")
    _log_lines(spark, sf).write.text(landing)
    feed = S.log_feed(S.log_lines(spark, landing), SITE)
    S.write_stream(feed, out, work_path(spark, "state")).awaitTermination()
    return spark.read.parquet(out)


def _ingested(spark: SparkSession, sf: str) -> PageStore:
    """All responses, in two waves through one stream."""
    landing, state = work_path(spark, "landing"), work_path(spark, "state")
    store = PageStore(spark, work_path(spark, "store"), SITE)
    pages = X.fetched(spark, sf)
    third = F.col("seq") % 3 == 0
    for wave in (pages.where(third), pages.where(~third | (F.col("seq") % 6 == 0))):
        wave.write.mode("append").parquet(landing)
        source = spark.readStream.schema(pages.schema).parquet(landing)
        S.ingest(source, store, state).awaitTermination()
    return store


@query(
    "ingest_stream",
    _ROUTED + "SELECT section, filename, seq FROM old UNION ALL SELECT section, filename, seq FROM fresh",
)
def ingest_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf).pages().select(*KEY, "seq")


@query(
    "section_counter_stream",
    _ROUTED
    + """SELECT section, count(*) AS n FROM (SELECT section FROM old UNION ALL SELECT section FROM fresh) GROUP BY section""",
)
def section_counter_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of stored pages, added up from the records of filed batches as they come in."""
    store = _ingested(spark, sf)
    out = work_path(spark, "counts")
    records = store.batches().schema
    filed = spark.readStream.schema(records).parquet(f"{store.path}/batches/*")
    counts = filed.select(F.explode("per_section").alias("section", "k")).where("k > 0")
    S.section_counter(counts, out, work_path(spark, "state"), F.col("k")).awaitTermination()
    return spark.read.parquet(out)


@query(
    "newest_feed_stream",
    "SELECT event_id, event_type, value FROM events ORDER BY event_id DESC LIMIT 300",
)
def newest_feed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The event table arrives in three chunks; the last one meets a query with a fresh checkpoint."""
    landing, out, state = (work_path(spark, n) for n in ("landing", "newest", "state"))
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    for part in range(3):
        folder = f"{landing}/{part // 2}"
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(folder)
        source = spark.readStream.schema(events.schema).parquet(folder)
        S.newest_feed(source, "event_id", out, f"{state}/{part // 2}").awaitTermination()
    return S.newest_events(spark, out, "event_id")
