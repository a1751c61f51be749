"""Intermediate tables, written once to the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Large tables are worked on in shares of about this many rows, one after the other.
SHARE_ROWS = 80 << 20
# With it Spark removes the shuffle files of a statement at its end, else when the driver collects its garbage.
FREEING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_freeing_lock, _freeing_now = threading.Lock(), Counter()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stallbook-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; without it, a local session gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
    return _local_folder()


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df once and return it read back.

    Cuts lineage so that lost executors cost a re-read and not a re-run, and
    lets every reader take only its columns; by is a column of few values, none of them null,
    by which the files are parted, so that readers that filter on it read only theirs.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


@contextmanager
def _freeing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run within are removed as it ends, unless the session has a choice of its own."""
    session = id(spark)
    with _freeing_lock:
        set_here = _freeing_now[session] > 0 or spark.conf.get(FREEING, None) is None
        if set_here:
            spark.conf.set(FREEING, "true")
            _freeing_now[session] += 1
    try:
        yield
    finally:
        if set_here:
            with _freeing_lock:
                _freeing_now[session] -= 1
                if not _freeing_now[session]:
                    spark.conf.unset(FREEING)


def shares_of(rows: int) -> int:
    """How many shares a table of so many rows makes."""
    return max(1, -(-rows // SHARE_ROWS))


def written_in_shares(shares: Iterable[DataFrame], name: str, by: str | None = None) -> DataFrame:
    """Write the shares of one table, one after the other, and return it read back; by as for written.

    For the largest tables: the disk holds the table, packed closer than others, and the shuffles of one share, as
    those of the last are removed before the next begins.
    """
    path, first = None, None
    for share in shares:
        if first is None:
            first, path = share, f"{shared_folder(share.sparkSession)}/{name}-{uuid.uuid4().hex}"
        writer = share.write.mode("append").option("compression", "zstd")
        with _freeing(share.sparkSession):
            (writer.partitionBy(by) if by else writer).parquet(path)
    return first.sparkSession.read.schema(first.schema).parquet(path).select(*first.columns)
