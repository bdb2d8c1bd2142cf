import pytest
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.operators import sinks as K
from newsmine.operators.store import PageStore
from newsmine.session import checkpoint_dir, work_path
from newsmine.sources import tables as T
from newsmine.sources import words as W
from newsmine.streaming import feeds as S

SITE = SiteSettings()


def test_checkpoint_dir_comes_from_the_session(spark):
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_word_lists(spark, tmp_path):
    accented, plain = tmp_path / "a.txt", tmp_path / "b.txt"
    accented.write_text("﻿Algún\n\n de \n", encoding="utf-8")
    assert {r.word for r in W.preferred_words(spark, [str(plain), str(accented)]).collect()} == {"algún", "de"}
    plain.write_text("algun\n", encoding="utf-8")
    assert [r.word for r in W.preferred_words(spark, [str(plain), str(accented)]).collect()] == ["algun"]
    assert W.preferred_words(spark, [str(tmp_path / "none.txt")]).count() == 0


def test_labelled_pages(spark, tmp_path):
    for section, name, data in (("a", "1.html", b"x\xff"), ("b", "2.html", "ñ".encode()), ("b", "3.txt", b"no")):
        (tmp_path / section).mkdir(exist_ok=True)
        (tmp_path / section / name).write_bytes(data)
    (tmp_path / "b" / "deep").mkdir()
    (tmp_path / "b" / "deep" / "4.html").write_bytes(b"too deep")
    pages = T.labelled_pages(spark, str(tmp_path))
    found = sorted((r.section, r.filename, r.bytes, r.html) for r in pages.collect())
    assert found == [("a", "1.html", 2, "x�"), ("b", "2.html", 2, "ñ")]
    assert pages.select("section", "modified").where("modified is not null").count() == 2


def test_dataset_presence(spark):
    folder = work_path(spark, "dataset")
    one = spark.range(1)
    with pytest.raises(T.MissingTables, match="docs, vocab"):
        T.load_dataset(spark, folder, ["docs", "vocab"])
    K.write_dataset(one, one, one, folder)
    assert T.stage_done(spark, folder, ["docs", "vocab", "tf"])
    assert T.load_dataset(spark, folder, ["docs"])["docs"].count() == 1


def test_log_lines(spark):
    lines = [
        "2026-01-01 10:00:00 [noticias_sitemap] INFO: x",
        "Spider opened",
        "a warning b",
        "2026-01-01 10:00:00 [otro] nada",
        "[OMITIDO]",
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    shown = [r.value for r in S.log_feed(df, SITE).collect()]
    assert shown == ["[noticias_sitemap] INFO: x", "Spider opened", "a warning b"]


def test_replayed_batch_adds_nothing(spark):
    """The same files through a stream with new state: nothing is stored twice."""
    landing, store = work_path(spark, "landing"), PageStore(spark, work_path(spark, "store"), SITE)
    url = f"https://www.{SITE.domain}/2026/01/01/"
    rows = spark.range(6).select(
        F.col("id").alias("seq"),
        F.concat(F.lit(url), F.lit("n"), F.col("id") % 4).alias("url"),
        F.lit(200).alias("status"),
        F.lit('<meta name="p12:section" content="economia">').alias("body"),
    )
    rows.write.parquet(landing)
    for _ in range(2):
        source = spark.readStream.schema(rows.schema).parquet(landing)
        S.ingest(source, store, work_path(spark, "state")).awaitTermination()
    assert sorted(r.seq for r in store.pages().collect()) == [0, 1, 2, 3]
    assert store.batches().count() == 2


def test_newest_events_survive_gaps_and_fresh_checkpoints(spark):
    landing, out = work_path(spark, "landing"), work_path(spark, "newest")
    schema = "k long, note string, at timestamp, v double"

    def feed(folder, state, rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{landing}/{folder}")
        source = spark.readStream.schema(schema).parquet(f"{landing}/{folder}")
        S.newest_feed(source, "k", out, state, n=5, shards=3).awaitTermination()
        return [r.k for r in S.newest_events(spark, out, "k", 5).collect()]

    first, fresh = work_path(spark, "state"), work_path(spark, "state")
    row = lambda k: (k, None if k % 2 else "x", None, None)
    assert feed("a", first, [row(k) for k in range(0, 40, 2)]) == [38, 36, 34, 32, 30]
    # Old news, then a repeated row, change nothing.
    assert feed("a", first, [row(k) for k in (1, 3, 38)]) == [38, 36, 34, 32, 30]
    # A fresh checkpoint that does not see the old files keeps what is known.
    assert feed("b", fresh, [row(37), row(99)]) == [99, 38, 37, 36, 34]
    assert feed("b", fresh, [row(35)]) == [99, 38, 37, 36, 35]


def test_pages_of_attempts_that_did_not_end_are_removed(spark, tmp_path):
    """A file per row as Spark's writer makes them, also for odd sections; what another attempt left goes."""
    rows = [("es", b"uno"), ("es", b"uno"), ("a/b=ñ %", b"\xc3"), (None, b"x"), ("", None), ("fr", b"")]
    pages = spark.createDataFrame(rows, "section string, value binary")
    (tmp_path / "new/_attempts").mkdir(parents=True)
    (tmp_path / "new/section=es").mkdir()
    (tmp_path / "new/_attempts/00000-999").touch()
    (tmp_path / "new/section=es/part-00000-999-0.txt").write_bytes(b"lost")
    T.write_labelled_pages(pages, str(tmp_path / "new"))
    old = pages.withColumn("value", F.col("value").cast("string")).write.partitionBy("section").option("maxRecordsPerFile", 1)
    old.text(str(tmp_path / "old"))
    held = [sorted((f.parent.name, f.read_bytes()) for f in (tmp_path / d).glob("section=*/*.txt")) for d in ("new", "old")]
    assert held[0] == held[1] and len(held[0]) == 6
    assert T.labelled_pages(spark, str(tmp_path / "new"), "*.txt").count() == 6
