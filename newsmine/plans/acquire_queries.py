"""Seeds, links, routing, filing, events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.functions import urls as U
from newsmine.operators import acquire as A
from newsmine.operators import report as R
from newsmine.operators.store import PageStore
from newsmine.plans import fixtures as X
from newsmine.plans.registry import query
from newsmine.session import table, work_path
from newsmine.sources.seeds import seeds

SITE = X.SITE
_BASE = f"https://www.{SITE.domain}"

# ── what the derived sitemaps and responses contain, stated without parsing ───

def _url(more: str = "''") -> str:
    return f"""
  'https://www.{SITE.domain}/' || strftime(DATE '2026-01-01' + CAST(k % 90 AS INTEGER), '%Y/%m/%d') || '/'
  || CASE WHEN k % 5 = 0 THEN 'Nota-' ELSE 'nota-' END || k || {more} || CASE WHEN k % 4 = 0 THEN '/' ELSE '' END
"""


# Pages that cannot be stored: a name of over 255 bytes, or a body of broken bytes.
_LONG = "CASE WHEN k % 29 = 3 THEN repeat('-x', 150) ELSE '' END"

_LINKS = f"""
WITH base AS (
  SELECT doc_id AS k, strftime(DATE '2026-01-01' + CAST(doc_id % 90 AS INTEGER), '%Y/%m/%d') AS d FROM documents),
main AS (SELECT k, d, {_url()} AS url FROM base),
listed AS (
  SELECT k, list_filter([
    url,
    CASE WHEN k % 7 = 0 THEN '{_BASE}/print/' || d || '/nota-' || k END,
    CASE WHEN k % 11 = 0 THEN url || '?x=1' END,
    CASE WHEN k % 13 = 0 THEN url END,
    CASE WHEN k % 17 = 0 THEN 'https://ajena.example/r/{_BASE}/' || d || '/copia-' || k END
  ], lambda u: u IS NOT NULL) AS l FROM main),
links AS (
  SELECT k AS sitemap_id, CAST(unnest(range(0, len(l))) AS INTEGER) AS pos, unnest(l) AS loc FROM listed),
articles AS (
  SELECT * FROM links WHERE loc NOT LIKE '%/print/%' AND loc NOT LIKE '%?x=1')
"""

_ROUTED = f"""
WITH base AS (
  SELECT doc_id AS seq, CASE WHEN doc_id > 0 AND doc_id % 19 = 0 THEN doc_id - 1 ELSE doc_id END AS k,
    CASE WHEN doc_id % 20 = 0 THEN 404 WHEN doc_id % 20 = 1 THEN 403 WHEN doc_id % 20 = 2 THEN 500 ELSE 200 END AS status,
    CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 9 = 0 THEN 'deportes' WHEN lang = 'es' THEN 'economia'
         WHEN lang = 'fr' THEN 'el-pais' WHEN lang = 'en' THEN 'el-mundo' WHEN lang = 'de' THEN 'sociedad' END AS section
  FROM documents),
named AS (
  SELECT seq, status, section, {_url(_LONG)} || CASE WHEN seq % 23 = 0 THEN '?x=1' ELSE '' END AS url,
    CASE WHEN seq % 23 <> 0 THEN strftime(DATE '2026-01-01' + CAST(k % 90 AS INTEGER), '%Y-%m-%d') || '-'
      || CASE WHEN k % 5 = 0 THEN 'Nota-' ELSE 'nota-' END || k || {_LONG} || '.html' END AS filename
  FROM base),
admitted AS (SELECT * FROM named WHERE status <> 500),
routed AS (
  SELECT *, CASE WHEN section IS NULL THEN 'sin-seccion' WHEN section = 'deportes' THEN 'fuera-de-seccion'
    WHEN filename IS NULL THEN 'url-no-reconocida' END AS outcome,
    CASE WHEN length(filename) > 255 THEN 'file name of ' || length(filename) || ' bytes'
      WHEN seq % 31 = 4 THEN 'body is not valid UTF-8' END AS error FROM admitted),
old AS (
  SELECT section, filename, min(seq) AS seq FROM routed
  WHERE outcome IS NULL AND error IS NULL AND seq % 3 = 0 GROUP BY ALL),
incoming AS (SELECT * FROM routed WHERE seq % 3 <> 0 OR seq % 6 = 0),
fresh AS (
  SELECT section, filename, min(seq) AS seq FROM incoming
  WHERE outcome IS NULL AND error IS NULL AND (section, filename) NOT IN (SELECT section, filename FROM old) GROUP BY ALL),
events AS (
  SELECT i.seq, i.section, i.url, i.filename, i.error, CASE WHEN f.seq = i.seq THEN 'guardado'
    WHEN i.error IS NOT NULL AND o.seq IS NULL AND (f.seq IS NULL OR i.seq < f.seq) THEN 'error: ' || i.error ELSE 'omitido' END AS status
  FROM incoming i LEFT JOIN fresh f ON i.section = f.section AND i.filename = f.filename
    LEFT JOIN old o ON i.section = o.section AND i.filename = o.filename
  WHERE i.outcome IS NULL)
"""


@query(
    "seed_days",
    f"""
WITH ends AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM ends)
SELECT day, '{_BASE}/arc/outboundfeeds/sitemap/' || strftime(day, '%Y-%m-%d') || '/?outputType=xml' AS url FROM days
""",
)
def seed_days(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    ranges = table(spark, sf, "orders").agg(F.min(day).alias("start"), F.max(day).alias("end"))
    return seeds(ranges, SITE)


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return A.sitemap_links(X.sitemaps(spark, sf))


@query("sitemap_links", _LINKS + "SELECT sitemap_id, pos, loc FROM links")
def sitemap_links(spark: SparkSession, sf: str) -> DataFrame:
    return _links(spark, sf)


@query("article_urls", _LINKS + "SELECT sitemap_id, pos, loc FROM articles")
def article_urls(spark: SparkSession, sf: str) -> DataFrame:
    return A.article_links(_links(spark, sf), SITE)


@query(
    "url_parts",
    _LINKS
    + """SELECT loc, d[1:4] AS year, d[6:7] AS month, d[9:10] AS day, slug, replace(d, '/', '-') || '-' || slug || '.html' AS filename
FROM (SELECT loc, strftime(DATE '2026-01-01' + CAST(sitemap_id % 90 AS INTEGER), '%Y/%m/%d') AS d,
  CASE WHEN loc LIKE '%/copia-%' THEN 'copia-' WHEN sitemap_id % 5 = 0 THEN 'Nota-' ELSE 'nota-' END || sitemap_id AS slug FROM articles)""",
)
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    links = A.article_links(_links(spark, sf), SITE)
    parts = [c.alias(n) for n, c in U.url_parts(F.col("loc"), SITE).items()]
    return links.select("loc", *parts, U.file_name(F.col("loc"), SITE).alias("filename"))


@query("host_allowed", _LINKS + "SELECT sitemap_id, pos, loc FROM links WHERE loc NOT LIKE 'https://ajena.example/%'")
def host_allowed(spark: SparkSession, sf: str) -> DataFrame:
    return _links(spark, sf).where(U.host_allowed(F.col("loc"), SITE))


@query(
    "frontier_dedup",
    _LINKS + "SELECT DISTINCT loc AS url FROM articles WHERE loc NOT LIKE 'https://ajena.example/%'",
)
def frontier_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return A.frontier(_links(spark, sf), SITE)


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return A.routed(A.admitted(X.fetched(spark, sf), SITE), SITE)


@query("status_admit", _ROUTED + "SELECT seq, CAST(status AS INTEGER) AS status FROM admitted")
def status_admit(spark: SparkSession, sf: str) -> DataFrame:
    return A.admitted(X.fetched(spark, sf), SITE).select("seq", "status")


@query("section_tag", _ROUTED + "SELECT seq, section FROM admitted")
def section_tag(spark: SparkSession, sf: str) -> DataFrame:
    return _routed(spark, sf).select("seq", "section")


@query(
    "route_pages",
    _ROUTED
    + """SELECT r.seq, r.url, r.section, r.filename, coalesce(r.outcome, e.status) AS outcome
FROM incoming r LEFT JOIN events e ON r.seq = e.seq""",
)
def route_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose names are too long or whose bodies are broken fail alone."""
    old, incoming = _batches(spark, sf)
    stored = old.where(F.col("outcome").isNull() & F.col("error").isNull()).select(*A.KEY).distinct()
    return A.settle(incoming, stored).select("seq", "url", "section", "filename", "outcome")


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every page is in the first batch, the second one, or both."""
    pages = _routed(spark, sf)
    third = F.col("seq") % 3 == 0
    return pages.where(third), pages.where(~third | (F.col("seq") % 6 == 0))


def _second_run(spark: SparkSession, sf: str) -> PageStore:
    """A store with a finished first run and a second one over it, both within the times of ``events``."""
    store, bodies = PageStore(spark, work_path(spark, "store"), SITE), X.fetched(spark, sf)
    times = table(spark, sf, "events").agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    for run, batch in zip(("old", "new"), _batches(spark, sf), strict=True):
        store.start(run, "2026-01-01", "2026-03-31", times["first"])
        store.file(run, 0, batch, bodies)
        store.finish(run, ended=times["last"])
    return store


@query(
    "file_new_pages",
    _ROUTED + "SELECT section, filename, seq FROM old UNION ALL SELECT section, filename, seq FROM fresh",
)
def file_new_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches into one store; the second one again, as itself and under another number, must add nothing."""
    store, bodies = PageStore(spark, work_path(spark, "store"), SITE), X.fetched(spark, sf)
    old, incoming = _batches(spark, sf)
    for number, batch in ((0, old), (1, incoming), (1, incoming), (2, incoming)):
        store.file("run", number, batch, bodies)
    return store.pages().select(*A.KEY, "seq")


@query("skipped_pages", _ROUTED + "SELECT seq, section, url, filename, status FROM events WHERE status = 'omitido'")
def skipped_pages(spark: SparkSession, sf: str) -> DataFrame:
    return _new_events(spark, sf).where(F.col("status") == A.SKIPPED)


def _new_events(spark: SparkSession, sf: str) -> DataFrame:
    return A.events_of(_second_run(spark, sf).decisions("new-0"))


@query("run_events", _ROUTED + "SELECT seq, section, url, filename, status FROM events")
def run_events(spark: SparkSession, sf: str) -> DataFrame:
    return _new_events(spark, sf)


@query(
    "page_errors",
    _ROUTED
    + """, first_run AS (SELECT r.seq, r.url, r.section, r.filename, r.error FROM routed r LEFT JOIN old o ON r.section = o.section AND r.filename = o.filename
  WHERE r.outcome IS NULL AND r.error IS NOT NULL AND r.seq % 3 = 0 AND (o.seq IS NULL OR r.seq < o.seq))
SELECT * FROM first_run UNION ALL SELECT seq, url, section, filename, error FROM events WHERE status LIKE 'error: %'""",
)
def page_errors(spark: SparkSession, sf: str) -> DataFrame:
    """The side table of pages that could not be stored, of both runs."""
    return _second_run(spark, sf).errors()


@query(
    "run_numbering",
    _ROUTED
    + "SELECT section, filename, seq, row_number() OVER (PARTITION BY section ORDER BY seq) AS n FROM events WHERE status = 'guardado'",
)
def run_numbering(spark: SparkSession, sf: str) -> DataFrame:
    return A.run_numbers(_new_events(spark, sf))


@query(
    "progress_log",
    _ROUTED
    + """, kept AS (SELECT section, filename, row_number() OVER (PARTITION BY section ORDER BY seq) AS n FROM events WHERE status = 'guardado')
SELECT section, n, format('[{}] #{:03d} | {}', section, n, filename) AS line FROM kept""",
)
def progress_log(spark: SparkSession, sf: str) -> DataFrame:
    return _second_run(spark, sf).progress("new")


@query(
    "run_summary",
    _ROUTED
    + """, kept AS (SELECT section FROM events WHERE status = 'guardado'),
frame AS (SELECT unnest(['economia','el-mundo','el-pais','sociedad']) AS section)
SELECT f.section, count(k.section) AS n, 'finished' AS reason FROM frame f LEFT JOIN kept k ON f.section = k.section GROUP BY f.section
UNION ALL SELECT 'TOTAL', count(*), 'finished' FROM kept""",
)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _second_run(spark, sf).summary("new")


_HEADER = """, times AS (SELECT min(ts) AS a, max(ts) AS b, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS s FROM events_table),
shown AS (
  SELECT strftime(a, '%Y-%m-%d %H:%M:%S') AS started, strftime(b, '%Y-%m-%d %H:%M:%S') AS ended, CASE WHEN s // 86400 = 0 THEN '' WHEN s // 86400 = 1 THEN '1 day, ' ELSE (s // 86400) || ' days, ' END
    || format('{}:{:02d}:{:02d}', s % 86400 // 3600, s % 3600 // 60, s % 60) AS duration FROM times),
both_runs AS (
  SELECT 'new' AS run, coalesce(r.outcome, e.status) AS outcome FROM incoming r LEFT JOIN events e ON r.seq = e.seq
  UNION ALL SELECT 'old', coalesce(r.outcome, CASE WHEN o.seq = r.seq THEN 'guardado' WHEN r.error IS NOT NULL AND (o.seq IS NULL OR r.seq < o.seq) THEN 'error: ' ELSE 'omitido' END)
  FROM routed r LEFT JOIN old o ON r.section = o.section AND r.filename = o.filename WHERE r.seq % 3 = 0)
SELECT run, any_value(started) AS started, any_value(ended) AS ended, '2026-01-01 → 2026-03-31' AS range,
  'economia, el-mundo, el-pais, sociedad' AS sections, 'finished' AS state, any_value(duration) AS duration, 'finished' AS reason, CAST(1 AS BIGINT) AS batches,
  count(*) FILTER (outcome = 'guardado') AS stored, count(*) FILTER (outcome = 'omitido') AS skipped, count(*) FILTER (outcome = 'fuera-de-seccion') AS outside,
  count(*) FILTER (outcome = 'sin-seccion') AS untagged, count(*) FILTER (outcome = 'url-no-reconocida') AS not_article,
  count(*) FILTER (outcome LIKE 'error: %') AS failed
FROM both_runs, shown GROUP BY run"""


# The routed events and the table of that name are told apart.
@query("run_header", "WITH events_table AS (SELECT ts FROM main.events)," + _ROUTED.strip().removeprefix("WITH") + _HEADER)
def run_header(spark: SparkSession, sf: str) -> DataFrame:
    """Start, range, sections, duration and counters of both runs, from their records."""
    clock = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("started", "ended")}
    return _second_run(spark, sf).headers().withColumns(clock)


@query(
    "event_feed_300",
    "SELECT event_id, event_type, user_id, value FROM events ORDER BY event_id DESC LIMIT 300",
)
def event_feed_300(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id", "value")
    return R.newest(events, "event_id", 300)


@query(
    "event_status_counts",
    """SELECT CASE event_type WHEN 'purchase' THEN 'ok' WHEN 'view' THEN 'skip' ELSE 'err' END AS status_class, count(*) AS n
FROM events GROUP BY 1""",
)
def event_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counts(table(spark, sf, "events"), "event_type", ok="purchase", skip="view")
