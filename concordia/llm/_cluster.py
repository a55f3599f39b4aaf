"""Shared-folder helpers: where intermediate tables go so that any executor can read them again."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most ids that a semi-join may broadcast (8 bytes each); beyond it the join shuffles.
BROADCAST_IDS = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`. Where that is unset, a session on one machine (as in tests) gets a folder
    of its own; on a cluster it is an error, as no other machine would see such a folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="concordia-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Folders of the open `workspace`s, the innermost last.
_OPEN: list[str] = []


@contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """What is settled inside goes into one folder, which is deleted at the end (after an error as well).

    Results that are read later must be settled with `keep`."""
    path = f"{shared_dir(spark)}/work-{uuid.uuid4().hex}"
    _OPEN.append(path)
    try:
        yield
    finally:
        _OPEN.remove(path)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame, name: str = "t", keep: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts lineage, survives lost executors.

    It stays until the open workspace ends, with `keep` the one around that; without one, until the shared folder is
    cleared."""
    folders = [shared_dir(df.sparkSession), *_OPEN]
    folder = folders[max(len(folders) - 1 - keep, 0)]
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def semi_by_id(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows of df whose `key` is in ids (a settled table of distinct keys).

    The ids are broadcast only when counted to be at most BROADCAST_IDS; else both sides shuffle on the key."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, key, "left_semi")


def partitions_for(rows: int, per_partition: int) -> int:
    return max(1, -(-rows // per_partition))


#: Bytes of an Arrow batch that a Python worker gets at a time (Spark's own default is 64 MB); a session's smaller value stays.
BATCH_BYTES = 8 << 20
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives this package to the executors' Python workers, once for each application, and bounds their Arrow batches."""
    app = spark.sparkContext.applicationId
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) in ("64MB", "64m", "67108864", "67108864b"):
        spark.conf.set(key, BATCH_BYTES)
    if app not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(), f"{os.path.basename(top)}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, files in os.walk(top):
                for f in files:
                    if f.endswith(".py"):
                        own = os.path.join(folder, f)
                        z.write(own, os.path.relpath(own, os.path.dirname(top)))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)
    return spark
