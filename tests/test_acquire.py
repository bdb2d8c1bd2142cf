import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.functions import urls as U
from newsmine.functions.logs import duration_text
from newsmine.operators import acquire as A
from newsmine.operators import report as R
from newsmine.operators.store import PageStore
from newsmine.session import work_path
from newsmine.sources.seeds import seed_range, seeds

SITE = SiteSettings(domain="diario.example")
PREFIX = "https://www.diario.example"


@pytest.mark.parametrize(
    "start, end, days",
    [
        ("2026-02-27", "2026-03-01", 3),
        ("2024-02-28", "2024-03-01", 3),
        ("2026-01-01", "2026-01-01", 1),
        ("2026-01-02", "2026-01-01", 0),
    ],
)
def test_seed_ranges(spark, start, end, days):
    ranges = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "start date, end date")
    found = seeds(ranges, SITE).orderBy("day").collect()
    assert len(found) == days
    if days:
        assert found[0]["url"] == f"{PREFIX}/arc/outboundfeeds/sitemap/{start}/?outputType=xml"


def test_default_seeds_are_three_days(spark):
    assert seed_range(spark, SITE, end=dt.date(2026, 3, 1)).count() == 3


@pytest.mark.parametrize(
    "url, article, allowed",
    [
        (f"{PREFIX}/2026/01/02/una-nota", True, True),
        ("HTTPS://diario.example/2026/01/02/Una-Nota/", True, True),
        (f"{PREFIX}/2026/99/99/imposible", True, True),
        (f"{PREFIX}/2026/01/02/nota?x=1", False, True),
        (f"{PREFIX}/2026/01/02/nota#a", False, True),
        (f"{PREFIX}/2026/01/02/-nota", False, True),
        (f"{PREFIX}/print/2026/01/02/nota", False, True),
        (f"https://otra.example/r/{PREFIX}/2026/01/02/nota", True, False),
        ("https://maldiario.example/2026/01/02/nota", False, False),
        ("https://sub.diario.example/x", False, True),
    ],
)
def test_urls(spark, url, article, allowed):
    row = spark.createDataFrame([(url,)], "u string").select(
        U.is_article(F.col("u"), SITE), U.host_allowed(F.col("u"), SITE)
    )
    assert tuple(row.first()) == (article, allowed)


def test_file_name_keeps_case(spark):
    row = spark.createDataFrame([(f"{PREFIX}/2026/01/02/Una-Nota/",)], "u string")
    assert row.select(U.file_name(F.col("u"), SITE)).first()[0] == "2026-01-02-Una-Nota.html"


def responses(spark, rows):
    return spark.createDataFrame(rows, "seq long, url string, status int, body string")


def page(section):
    return f'<meta name="p12:section" content="{section}">'


def routes_of(fetched):
    return A.routed(A.admitted(fetched, SITE), SITE)


def test_filing_twice_equals_once(spark):
    rows = [
        (1, f"{PREFIX}/2026/01/01/a", 200, page("economia")),
        (2, f"{PREFIX}/2026/01/01/a/", 200, page("Economia ")),
        (3, f"{PREFIX}/2026/01/01/b", 200, page("deportes")),
        (4, f"{PREFIX}/x", 200, page("economia")),
        (5, f"{PREFIX}/2026/01/01/c", 404, "<p>"),
        (6, f"{PREFIX}/2026/01/01/d", 500, page("economia")),
        (7, f"{PREFIX}/2026/01/01/a", 200, page("sociedad")),
    ]
    fetched = responses(spark, rows)
    routes = routes_of(fetched)
    outcomes = {r.seq: r.outcome for r in routes.collect()}
    assert outcomes == {1: None, 2: None, 3: A.OUTSIDE, 4: A.NOT_ARTICLE, 5: A.UNTAGGED, 7: None}
    store = PageStore(spark, work_path(spark, "t"), SITE)
    expected = {1: A.STORED, 2: A.SKIPPED, 7: A.STORED}
    assert {r.seq: r.status for r in store.file("r", 0, routes, fetched).collect()} == expected
    # The same batch is read back; as another batch it adds nothing.
    assert {r.seq: r.status for r in store.file("r", 0, routes, fetched).collect()} == expected
    assert {r.status for r in store.file("r", 1, routes, fetched).collect()} == {A.SKIPPED}
    assert sorted(r.seq for r in store.pages().collect()) == [1, 7]
    assert store.events().count() == 6
    (counts,) = store.batches().where("batch = 'r-0'").collect()
    assert [counts[c] for c in ("stored", "skipped", "outside", "untagged", "not_article", "failed")] == [2, 1, 1, 1, 1, 0]
    assert counts.per_section == {"economia": 1, "el-mundo": 0, "el-pais": 0, "sociedad": 1}


def test_broken_pages_fail_alone(spark):
    long = f"{PREFIX}/2026/01/01/{'x' * 300}"
    rows = [(1, long, 200, page("economia")), (2, f"{PREFIX}/2026/01/01/a", 200, page("economia")), (3, f"{PREFIX}/2026/01/01/b", 200, page("economia")), (4, None, 200, page("economia")), (5, f"{PREFIX}/2026/01/01/n", 200, None)]
    broken = F.when(F.col("seq") == 2, F.concat("body", F.unhex(F.lit("FF")).cast("string"))).otherwise(F.col("body"))
    fetched = responses(spark, [*rows, (6, f"{PREFIX}/2026/01/01/a", 200, page("economia"))]).withColumn("body", broken)
    store = PageStore(spark, work_path(spark, "t"), SITE)
    found = {r.seq: r.status for r in store.file("r", 0, routes_of(fetched), fetched).collect()}
    # The second page of a key is stored when the first one could not be; no address and no body have no section to fail in.
    assert found == {1: "error: file name of 316 bytes", 2: "error: body is not valid UTF-8", 3: A.STORED, 6: A.STORED}
    assert {r.seq: r.error for r in store.errors().collect()} == {1: "file name of 316 bytes", 2: "body is not valid UTF-8"}
    assert {r.seq: r.status for r in store.file("r", 1, routes_of(fetched), fetched).collect()} == {1: "error: file name of 316 bytes", 2: A.SKIPPED, 3: A.SKIPPED, 6: A.SKIPPED}


def test_a_killed_batch_repeats_without_doubles(spark, monkeypatch):
    fetched = responses(spark, [(k, f"{PREFIX}/2026/01/0{1 + k % 3}/n{k}", 200, page("economia")) for k in range(6)])
    routes = routes_of(fetched)
    store = PageStore(spark, work_path(spark, "t"), SITE)
    with monkeypatch.context() as broken:
        broken.setattr(PageStore, "_put", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.file("r", 0, routes, fetched)
    assert store.pages().count() == 0 and store.events().count() == 0
    # Meanwhile another batch stores two of the pages.
    other = fetched.where("seq < 2")
    store.file("s", 0, routes_of(other), other)
    events = {r.seq: r.status for r in store.file("r", 0, routes, fetched).collect()}
    assert events == {0: A.SKIPPED, 1: A.SKIPPED, **{k: A.STORED for k in range(2, 6)}}
    assert sorted(r.seq for r in store.pages().collect()) == list(range(6))


def test_filing_reads_the_days_of_the_batch_only(spark):
    fetched = responses(spark, [(k, f"{PREFIX}/2026/01/{1 + k:02d}/n", 200, page("economia")) for k in range(20)])
    store = PageStore(spark, work_path(spark, "t"), SITE)
    store.file("r", 0, routes_of(fetched), fetched)
    def scanned(rows):
        rows.collect()
        leaves = rows._jdf.queryExecution().executedPlan().collectLeaves()
        names = [leaves.apply(i).toString() for i in range(leaves.size())]
        found = [leaves.apply(i) for i, n in enumerate(names) if "filename#" in n]
        return found[0].metrics().apply("numFiles").value()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned(store.keys()) == 20
        assert scanned(store.keys(["2026-01-03", "2026-01-07", "2027-01-01"])) == 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert {r.day for r in store.keys(["2026-01-03"]).collect()} == {"2026-01-03"}


def test_run_records(spark):
    store = PageStore(spark, work_path(spark, "t"), SITE)
    start = dt.datetime(2026, 1, 1, 10, 0, 0, 900_000)
    store.start("r", "2026-01-01", "2026-01-02", start)
    (row,) = store.headers(now=start + dt.timedelta(hours=30, seconds=5)).collect()
    assert (row.state, row.duration, row.batches, row.stored) == ("running", "1 day, 6:00:05", 0, 0)
    fetched = responses(spark, [(k, f"{PREFIX}/2026/01/01/n{k}", 200, page("economia")) for k in range(3)])
    for number in range(2):
        part = fetched.where(f"seq % 2 = {number}")
        store.file("r", number, routes_of(part), part)
    store.finish("r", "shutdown", start + dt.timedelta(seconds=59))
    (row,) = store.headers().collect()
    assert (row.range, row.sections, row.state, row.duration, row.reason) == ("2026-01-01 → 2026-01-02", "economia, el-mundo, el-pais, sociedad", "finished", "0:00:59", "shutdown")
    assert (row.batches, row.stored, row.failed) == (2, 3, 0)
    assert {r.section: r.n for r in store.summary("r").collect()} == {"economia": 3, "el-mundo": 0, "el-pais": 0, "sociedad": 0, "TOTAL": 3}
    assert sorted(r.line for r in store.progress("r").collect()) == [f"[economia] #00{k + 1} | 2026-01-01-n{k}.html" for k in range(3)]


@pytest.mark.parametrize("seconds", [0, 59.99, 3600, 86_399, 86_400, 2 * 86_400 + 1.5, 100 * 86_400, -0.5, -86_400, -86_401])
def test_duration_text(spark, seconds):
    start = dt.datetime(2026, 3, 1, 12)
    row = spark.createDataFrame([(start, start + dt.timedelta(seconds=seconds))], "a timestamp, b timestamp")
    assert row.select(duration_text(F.col("a"), F.col("b"))).first()[0] == str(dt.timedelta(seconds=seconds)).split(".")[0]


def test_one_key_holds_most_rows(spark):
    """Copies of one page and one big section: all rows are settled, none are lost."""
    rows = spark.range(3000).select(
        F.col("id").alias("seq"),
        F.lit("u").alias("url"),
        F.lit("economia").alias("section"),
        F.when(F.col("id") % 3 == 0, "hot.html").otherwise(F.concat(F.lit("f"), F.col("id"))).alias("filename"),
        F.lit(None).cast("string").alias("outcome"),
        F.lit(None).cast("string").alias("error"),
    )
    settled = A.settle(rows, None)
    assert settled.count() == 3000
    assert settled.where("outcome = 'guardado'").count() == 2001
    numbers = A.run_numbers(A.events_of(settled)).select("n", "seq").orderBy("n").collect()
    assert [r.n for r in numbers] == list(range(1, 2002))
    assert [r.seq for r in numbers] == sorted(r.seq for r in numbers)


def test_status_classes(spark):
    events = spark.createDataFrame([("guardado",), ("omitido",), ("error: x",)], "status string")
    assert {r.status_class: r.n for r in R.status_counts(events).collect()} == {"ok": 1, "skip": 1, "err": 1}
