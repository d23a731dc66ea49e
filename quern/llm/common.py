"""Helpers that several operators share: text handling in tasks, checkpoints, connected components."""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task turns into Python objects at a time; bounds the memory of a Python worker.
SLICE = 256
#: Ids (eight bytes each) that may be broadcast.
BROADCAST_IDS = 1_000_000
#: Links of a partition, about, and partitions besides.
PART_LINKS, PARTS = 25_000, 8


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Set a checkpoint folder of our own only in a local session that names none (tests)."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quern-checkpoint-"))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def with_ties(rows: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """``rows`` with a column tie that tells documents of one id apart: a hash of the text where the id (not null) has
    several texts, else 0.  Rows of the same id and text are one document.  An id of very many texts is a value like any other."""
    hashed = rows.select(F.col(doc).alias("_tied"), F.xxhash64(text).alias("_hash"))
    ends = hashed.groupBy("_tied").agg(F.min("_hash").alias("_low"), F.max("_hash").alias("_high"))
    several = checkpointed(ends.where("_low <> _high").select("_tied"))
    n = several.count()
    if not n:
        return rows.withColumn("tie", F.lit(0).cast("long"))
    if n <= BROADCAST_IDS:
        several = F.broadcast(several)
    joined = rows.join(several, rows[doc] == F.col("_tied"), "left")
    return joined.withColumn("tie", F.when(F.col("_tied").isNotNull(), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))).drop("_tied")


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to slices of at most SLICE rows of each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                out = fn(batch.slice(at, SLICE))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each run, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable over the undirected links, for every node that has one.

    Alternating large-star and small-star rounds: each joins a node's smallest neighbour back to its
    links, so a hub's links are split like any skewed join's and never gathered.  A round's links go
    to the shared checkpoint folder.  Self links are ignored; an empty input gives an empty result.

    Links are held in about as many partitions as their number asks for, since a round has six shuffles and each
    writes files by partition: a few thousand links in hundreds of partitions take far more disk than their bytes.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    links = checkpointed(links)
    parts, seen = PARTS + links.count() // PART_LINKS, None
    links = links.coalesce(parts)
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").coalesce(parts).distinct().coalesce(parts)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.where("u > v").unionByName(low.withColumnRenamed("m", "v")).coalesce(parts).distinct()
        links = checkpointed(small.coalesce(parts))
        now = links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen, parts = now, PARTS + now[0] // PART_LINKS
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = links.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
