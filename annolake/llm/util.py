"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Key under which rows without an id are ordered: before every other row.
NO_ID = -(2**63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id written as text, modulo `parts`; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def materialise(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the cluster's shared folder (spark.checkpoint.dir)."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    done = df.checkpoint(eager=True)
    # shuffle and checkpoint files live until the driver's JVM has collected the plans that own them
    gc.collect()
    sc._jvm.System.gc()
    return done


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, 1 at least: what the number of chunks follows, so that a chunk's size does not."""
    return max(1, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def hash_sample(df: DataFrame, most: int, *ties: str) -> DataFrame:
    """At most `most` rows in the order of the hash column h. A cut on the hash comes first, so no task ever gathers more
    than about twice the sample, however many partitions there are."""
    n = df.count()
    if n > 2 * most:
        df = df.where(F.pmod("h", F.lit(1 << 32)) < int(2 * most / n * (1 << 32)))
    return df.orderBy("h", *ties).limit(most)


def small_batches(spark: SparkSession) -> None:
    """Let no Arrow batch hold more than 8 MB of texts: a worker's memory then follows a batch, not its rows' length."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def tidy() -> None:
    """Give freed memory back: workers are reused, and what one stage freed would else count against the next."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose `column` holds about `most_bytes` (one row at least)."""
    if batch.num_rows == 0:
        return
    sizes = binary_lengths(batch.column(column))
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    tidy()


def binary_lengths(col: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)


def flat_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column as one array, and the n + 1 offsets of its rows; nulls are empty."""
    import pyarrow.compute as pc

    values = pc.fill_null(col, b"")
    lengths = binary_lengths(values)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    data = np.frombuffer(b"".join(values.to_pylist()), dtype=np.uint8)
    return data, offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
