"""Structured Streaming: windowed sums with late data, distinct events, as-of state, chunked results."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def tumbling(stream: DataFrame, time: str, width: str, late: str, keys: list[str], value: str) -> DataFrame:
    """Count and sum per window and key; rows later than ``late`` are dropped once their window is closed."""
    out = stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), *keys, "n", "total")


def sliding(stream: DataFrame, time: str, width: str, slide: str, late: str, keys: list[str], value: str) -> DataFrame:
    """As tumbling, with a window of ``width`` beginning every ``slide``."""
    out = stream.withWatermark(time, late).groupBy(F.window(time, width, slide), *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return out.select(F.col("window.start").alias("start"), *keys, "n", "total")


def sessions(stream: DataFrame, time: str, gap: str, late: str, keys: list[str]) -> DataFrame:
    out = stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")


def distinct_events(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, total) after each batch for the keys in it, kept as state."""

    def update(k, frames: Iterator[pd.DataFrame], state):
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n long, total double", "n long, total double", "update", "NoTimeout")


def run_to_memory(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there into a table in memory (for tests and small results)."""
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def run_to_folder(df: DataFrame, path: str) -> DataFrame:
    """Runs a stream over all that is there in complete mode; each batch's whole result replaces the last at ``path``."""
    q = df.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.parquet(path)


def chunks(df: DataFrame, rows: int) -> Iterator[list]:
    """A result in lists of ``rows`` rows, one partition at a time in the driver."""
    out = []
    for r in df.toLocalIterator(prefetchPartitions=True):
        out.append(r)
        if len(out) == rows:
            yield out
            out = []
    if out:
        yield out
