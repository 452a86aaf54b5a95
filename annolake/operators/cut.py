"""Tables that are written once, and small tables whose size is checked."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; in local mode a new one if it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    return tempfile.mkdtemp(prefix="spark-")


_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame) -> DataFrame:
    """The same rows whenever they are read again: a reliable checkpoint in the shared folder. The files of the shuffles on the way to it go at once."""
    spark = df.sparkSession
    sc, conf, given = spark.sparkContext, spark.conf, spark.conf.get(_SHUFFLES_GO, None)
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(spark))
    conf.set(_SHUFFLES_GO, True)
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own, which takes the setting
    finally:
        conf.unset(_SHUFFLES_GO) if given is None else conf.set(_SHUFFLES_GO, given)


#: About how many rows of a table one shuffle partition is to hold.
PIECE = 400_000
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Up to how many bytes adaptive execution joins small partitions again: a few sorts of one task hold several times that.
JOINED = 16 << 20
_JOINED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def pieces(df: DataFrame) -> int:
    """How many partitions hold about PIECE rows of a table each; never fewer than the session's shuffles have."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PIECE))


def roomy(df: DataFrame) -> DataFrame:
    """`df` itself; from now on the session's shuffles start with as many partitions as it has pieces, if they had fewer, and adaptive execution joins
    small ones again, up to JOINED. So what a task sorts does not grow with the table. Streams keep their number of partitions."""
    conf, least = df.sparkSession.conf, pieces(df)
    set_ = re.fullmatch(r"(\d+)([bkmgt]?)b?", conf.get(_JOINED).strip().lower())
    if set_ is None or int(set_[1]) << 10 * "bkmgt".index(set_[2] or "b") > JOINED:
        conf.set(_JOINED, JOINED)
    if least > int(conf.get(_FIRST, None) or conf.get("spark.sql.shuffle.partitions")):
        conf.set(_FIRST, least)
    return df


def few(df: DataFrame, column: str, most: int = 20_000) -> list:
    """The distinct values of a column, ascending; more than `most` of them are an error, as they are to be a literal."""
    values = [r[0] for r in df.select(column).where(df[column].isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(values)
