"""The page store: pages by section and day, filed in batches that count once.

Folders below the store's path:

* ``pages``           by section and attempt, in order of the day inside a file
* ``keys``            section, filename and seq of all pages, by day and attempt
* ``decisions``       outcome of every page of an attempt
* ``batches``         one record per filed batch; it names the attempt that counts
* ``runs``, ``ends``  one record per started and per finished run

A batch that is killed and repeated writes a new attempt; what the old one left is
named by no record, so nobody reads it. Filing reads the keys of those days only that
occur in the batch, and no page.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsmine.config import SiteSettings
from newsmine.functions.logs import duration_text
from newsmine.operators.acquire import (
    FAILED,
    KEY,
    NOT_ARTICLE,
    OUTSIDE,
    SKIPPED,
    STORED,
    UNTAGGED,
    events_of,
    run_numbers,
    section_frame,
    settle,
)

_PAGES = "day string, filename string, seq long, url string, html string, section string, attempt string"
_KEYS = "section string, filename string, seq long, day string, attempt string"
_DECISIONS = "seq long, url string, section string, filename string, day string, outcome string, attempt string"
_COUNTERS = ("stored", "skipped", "outside", "untagged", "not_article", "failed")
_BATCHES = "batch string, run string, attempt string, " + ", ".join(f"{c} long" for c in _COUNTERS) + ", per_section map<string,long>"
_RUNS = "run string, started timestamp, range_start string, range_end string, sections string"
_ENDS = "run string, ended timestamp, reason string"
#: Days that are listed in a filter; more are read as one range.
LISTED = 2_000


def _folder(name: str) -> str:
    """A value of a partition column that every file system takes."""
    return "".join(c if c.isalnum() or c in "-_." else "-" for c in name)


@dataclass(frozen=True)
class PageStore:
    spark: SparkSession
    path: str
    site: SiteSettings = SiteSettings()

    def _read(self, name: str, schema: str) -> DataFrame:
        try:
            rows = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return rows.select(*[c.split(" ")[0] for c in schema.split(", ")])

    def _put(self, name: str, key: str, row: tuple, schema: str) -> None:
        """One record in a folder of its own; a repeated record replaces the old one."""
        self.spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{name}/id={_folder(key)}")

    # ── what is stored ────────────────────────────────────────────────────────

    def batches(self) -> DataFrame:
        return self._read("batches", _BATCHES)

    def _counted(self, rows: DataFrame) -> DataFrame:
        """Rows of attempts that count; one record per batch is broadcast and prunes the others' folders."""
        return rows.join(F.broadcast(self.batches().select("attempt")), "attempt", "left_semi")

    def pages(self) -> DataFrame:
        return self._counted(self._read("pages", _PAGES))

    def keys(self, days: list[str] | None = None) -> DataFrame:
        """Keys of all pages, or of those of the given days: other days' folders are not read."""
        rows = self._read("keys", _KEYS)
        if days:
            rows = rows.where(F.col("day").isin(days) if len(days) <= LISTED else F.col("day").between(min(days), max(days)))
        return self._counted(rows)

    def decisions(self, batch: str | None = None) -> DataFrame:
        rows = self._read("decisions", _DECISIONS)
        counted = self.batches() if batch is None else self.batches().where(F.col("batch") == batch)
        return rows.join(F.broadcast(counted.select("attempt", "run")), "attempt")

    def events(self) -> DataFrame:
        """(seq, section, url, filename, status) of all counted batches, each once."""
        return events_of(self.decisions())

    def errors(self) -> DataFrame:
        """(seq, url, section, filename, error): pages that could not be stored."""
        failed = self.decisions().where(F.col("outcome").startswith(FAILED))
        reason = F.substring("outcome", len(FAILED) + 1, 1_000_000)
        return failed.select("seq", "url", "section", "filename", reason.alias("error"))

    # ── runs ──────────────────────────────────────────────────────────────────

    def start(self, run: str, range_start: str, range_end: str, started: dt.datetime | None = None) -> None:
        sections = ", ".join(sorted(self.site.sections))
        self._put("runs", run, (run, started or dt.datetime.now(), range_start, range_end, sections), _RUNS)

    def finish(self, run: str, reason: str = "finished", ended: dt.datetime | None = None) -> None:
        self._put("ends", run, (run, ended or dt.datetime.now(), reason), _ENDS)

    def file(self, run: str, number: int, routes: DataFrame, bodies: DataFrame) -> DataFrame:
        """File batch ``number`` of a run and return its events; a batch that was filed already is only read.

        ``routes`` comes from ``routed``, ``bodies`` has (seq, body). Outcomes are
        written before pages, and the batch counts from the moment its record is there.
        """
        batch = f"{run}-{number}"
        if not self.batches().where(F.col("batch") == batch).isEmpty():
            return events_of(self.decisions(batch))
        attempt = _folder(f"{batch}-{uuid.uuid4().hex}")
        dated = routes.withColumn("day", F.substring("filename", 1, 10))
        # The days of a batch: a few thousand at most, whatever its size.
        days = dated.where(F.col("outcome").isNull()).agg(F.array_sort(F.collect_set("day"))).first()[0]
        settled = settle(dated, self.keys(days)).select("seq", "url", *KEY, "day", "outcome")
        counters = Observation()
        path = f"{self.path}/decisions/attempt={attempt}"
        settled.observe(counters, *self._counters()).write.mode("overwrite").parquet(path)
        counts = counters.get
        decided = self.spark.read.parquet(path)
        chosen = decided.where(F.col("outcome") == STORED).select("seq", "url", *KEY, "day", F.lit(attempt).alias("attempt"))
        new = chosen.join(bodies.select("seq", F.col("body").alias("html")), "seq")
        # One file per folder where it is small, several where it is large: Spark splits what is uneven.
        sorted_pages = new.hint("rebalance", "section").sortWithinPartitions("section", "day")
        sorted_pages.write.mode("append").partitionBy("section", "attempt").parquet(f"{self.path}/pages")
        keys = chosen.select("section", "filename", "seq", "day", "attempt").hint("rebalance", "day")
        keys.write.mode("append").partitionBy("day", "attempt").parquet(f"{self.path}/keys")
        per_section = {s: counts[f"section_{k}"] for k, s in enumerate(self.site.sections)}
        self._put("batches", batch, (batch, run, attempt, *(counts[c] for c in _COUNTERS), per_section), _BATCHES)
        return events_of(decided)

    def _counters(self) -> list:
        """Counts of outcomes and of stored pages by section, taken while the outcomes are written."""
        outcome = F.col("outcome")
        kinds = dict(zip(_COUNTERS, (STORED, SKIPPED, OUTSIDE, UNTAGGED, NOT_ARTICLE), strict=False))
        named = [F.count_if(outcome == value).alias(name) for name, value in kinds.items()]
        failed = F.count_if(outcome.startswith(FAILED)).alias("failed")
        stored = [F.count_if((outcome == STORED) & (F.col("section") == s)).alias(f"section_{k}") for k, s in enumerate(self.site.sections)]
        return [*named, failed, *stored]

    def headers(self, now: dt.datetime | None = None) -> DataFrame:
        """One row per run: start, range, sections, state, duration so far, counters."""
        sums = self.batches().groupBy("run").agg(F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in _COUNTERS])
        runs = self._read("runs", _RUNS).join(self._read("ends", _ENDS), "run", "left").join(sums, "run", "left")
        until = F.coalesce("ended", F.lit(now or dt.datetime.now()))
        state = F.when(F.col("ended").isNull(), "running").otherwise("finished")
        zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        return runs.select(
            "run", "started", "ended", F.concat_ws(" → ", "range_start", "range_end").alias("range"), "sections", state.alias("state"),
            duration_text(F.col("started"), until).alias("duration"), "reason", zero("batches"), *[zero(c) for c in _COUNTERS],
        )

    def summary(self, run: str) -> DataFrame:
        """(section, n, reason): stored pages per target section (zeros shown) and the TOTAL row, from the run's records."""
        counts = self.batches().where(F.col("run") == run).select(F.explode("per_section").alias("section", "n"))
        sums = counts.rollup("section").agg(F.sum("n").alias("n")).select(F.coalesce("section", F.lit("TOTAL")).alias("section"), "n")
        frame = section_frame(self.spark, [*self.site.sections, "TOTAL"])
        reason = self._read("ends", _ENDS).where(F.col("run") == run).agg(F.max("reason").alias("reason"))
        rows = frame.join(F.broadcast(sums), "section", "left").select("section", F.coalesce("n", F.lit(0)).alias("n"))
        return rows.withColumn("reason", F.lit(reason.first()["reason"]))

    def progress(self, run: str) -> DataFrame:
        """(section, n, line): the run's progress log, one line for each stored page by its running number in the section."""
        own = events_of(self.decisions().where(F.col("run") == run))
        stored = run_numbers(own)
        line = F.format_string("[%s] #%03d | %s", "section", "n", "filename")
        return stored.select("section", "n", line.alias("line"))
