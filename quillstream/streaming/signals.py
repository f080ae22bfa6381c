"""Signals on streams: tumbling windows and the cooldown gate with state per key, as in batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_events(spark: SparkSession, folder: str, name: str = "events", time: str = "ts", delay: str = "1 hour", files: int = 100) -> DataFrame:
    """The events table, one file or a folder of part files, as a stream with a watermark on its time."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    context = spark.sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        stream = reader.parquet(path)
    else:
        stream = reader.option("pathGlobFilter", f"{name}*.parquet").parquet(folder)
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def cooldown_stream(stream: DataFrame, keys: list[str], at: str, seconds: float, tie: str) -> DataFrame:
    """(keys, tie, at, decision) for every event: keep where the last kept one of its keys is `seconds` back or more.

    State is the time of the last kept event, one number a key. Events of one trigger are taken in the order of time and tie;
    one that comes in a later trigger is judged against what was kept by then.
    """
    pause = pd.Timedelta(seconds=seconds)
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    out = ", ".join(f"`{c}` {kinds[c]}" for c in [*keys, tie, at]) + ", decision string"

    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values([at, tie])
        last = pd.Timestamp(state.get[0], unit="us") if state.exists else None
        decisions = []
        for t in rows[at]:
            keep = last is None or t - last >= pause
            last = t if keep else last
            decisions.append("keep" if keep else "suppress")
        if last is not None:
            state.update((last.value // 1000,))
        yield rows[[*keys, tie, at]].assign(decision=decisions)

    return stream.groupBy(*keys).applyInPandasWithState(judge, out, "last long", "append", GroupStateTimeout.NoTimeout)


def windows_stream(stream: DataFrame, at: str, width: str, keys: list[str], value: str) -> DataFrame:
    """(window_start, keys, n, total) over tumbling windows; a window is closed by the watermark."""
    counted = stream.groupBy(F.window(F.col(at), width).alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"))
    return counted.select(F.col("w.start").alias("window_start"), *keys, "n", "total")


def sessions_stream(stream: DataFrame, at: str, gap: str, keys: list[str]) -> DataFrame:
    """(session_start, session_end, keys, n): bursts of events with less than `gap` between them."""
    counted = stream.groupBy(F.session_window(F.col(at), gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now, into Parquet under `path`, and reads the result."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)
