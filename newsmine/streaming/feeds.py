"""Log feed, incremental filing, live counters and live event feed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from newsmine.config import SiteSettings
from newsmine.functions.logs import relevant, without_timestamp
from newsmine.functions.text import rstrip
from newsmine.operators.acquire import admitted, routed
from newsmine.operators.report import newest
from newsmine.operators.store import PageStore
from newsmine.session import written
from newsmine.sources.tables import present


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of log chunks as they land in a fresh folder (a file is read once, whole)."""
    return spark.readStream.text(folder).select(rstrip(F.col("value")).alias("value"))


def log_feed(lines: DataFrame, site: SiteSettings) -> DataFrame:
    shown = lines.where(relevant(F.col("value"), site))
    return shown.select(without_timestamp(F.col("value")).alias("value"))


def write_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and stop."""
    writer = df.writeStream.format("parquet").outputMode("append")
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a query for the life of its checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]


def ingest(fetched: DataFrame, store: PageStore, checkpoint: str) -> StreamingQuery:
    """File each micro-batch of responses, skipping every page that was ever stored.

    A micro-batch counts once, under its number and the name of its checkpoint: when it
    runs again it finds its record, and what a killed attempt left behind is not read.
    A fresh checkpoint is another name, so its batches are judged by their pages.
    """

    def file_batch(batch: DataFrame, number: int) -> None:
        routes = routed(admitted(batch, store.site), store.site)
        store.file(stream_name(batch.sparkSession, checkpoint), number, routes, batch)

    writer = fetched.writeStream.foreachBatch(file_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def section_counter(rows: DataFrame, path: str, checkpoint: str, n: Column | None = None) -> StreamingQuery:
    """Rows (or the sum of ``n``) per section so far; every update replaces the small result."""
    counts = rows.groupBy("section").agg(F.sum(F.lit(1).cast("long") if n is None else n).alias("n"))

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = counts.writeStream.outputMode("complete").foreachBatch(replace)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class _Newest(StatefulProcessor):
    """Keeps the ``n`` rows of a shard with the greatest ``order``; a row that comes again counts once."""

    def __init__(self, schema: StructType, order: str, n: int) -> None:
        self.schema, self.order, self.n = schema, order, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.schema)

    def _merged(self, more: Iterable[pd.DataFrame]) -> pd.DataFrame:
        names = self.schema.names
        kept = pd.DataFrame(list(self.rows.get()), columns=names, dtype=object)
        for part in more:
            kept = pd.concat([kept, part[names].astype(object)], ignore_index=True)
            kept = kept.drop_duplicates(self.order).sort_values(self.order, ascending=False, kind="stable").head(self.n)
        self.rows.put([tuple(None if pd.isna(v) else v for v in row) for row in kept.itertuples(index=False)])
        return kept

    def handleInitialState(self, key, initial: pd.DataFrame, timers) -> None:  # noqa: ANN001, N802
        self._merged([initial])

    def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802
        yield self._merged(rows).assign(shard=key[0])[["shard", *self.schema.names]]

    def close(self) -> None:
        pass


def newest_feed(
    events: DataFrame, order: str, path: str, checkpoint: str, n: int = 300, shards: int = 16
) -> StreamingQuery:
    """Keep the last ``n`` events so far; ``newest_events`` reads them.

    Every shard holds its own newest rows in keyed state, and writes its list anew when
    it changes: numbers of batches do not matter. A fresh checkpoint starts from the
    lists that are there. ``order`` tells events apart.
    """
    spark = events.sparkSession
    names = events.schema.names
    shard = F.pmod(F.xxhash64(order), F.lit(shards)).cast("int").alias("shard")
    keyed = events.select(shard, *names)
    shape = f"shard int, {', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in events.schema.fields)}"
    # A table of its own: the lists are overwritten while the first batch still reads it.
    known = None
    if present(spark, path):
        known = written(spark.read.schema(shape).parquet(path), "newest").groupBy("shard")
    lists = keyed.groupBy("shard").transformWithStateInPandas(
        _Newest(events.schema, order, n), outputStructType=shape, outputMode="Update", timeMode="None", initialState=known
    )

    def replace(batch: DataFrame, _: int) -> None:
        writer = batch.repartition("shard").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("shard").parquet(path)

    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    # Lists in state need this provider; a query keeps the settings it was started with.
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        writer = lists.writeStream.outputMode("update").foreachBatch(replace)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(provider, before)


def newest_events(spark: SparkSession, path: str, order: str, n: int = 300) -> DataFrame:
    """The last ``n`` events, newest first."""
    return newest(spark.read.parquet(path).drop("shard"), order, n)
