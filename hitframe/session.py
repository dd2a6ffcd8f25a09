"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime SQL settings the plans are shaped for. A frame may hold a large share
# of all hits, so the frame joins rely on the skew split; it has to be allowed
# also where the split costs an extra exchange, because that exchange sits after
# the partial aggregation and is small.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# what each application has written below the shared folder, for drop_scratch
_written: dict[str, list[str]] = defaultdict(list)
# the lists of the open scratch_scope blocks; every thread has its own
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scratch scopes", default=())


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``, else the warehouse.

    Both are settings that a cluster has to point at shared storage anyway; a
    temporary folder of one machine is never used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written[spark.sparkContext.applicationId].append(path)
    for made in _scopes.get():
        made.append(path)
    return path


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """The paths that are made inside, in order, as a list that grows with them."""
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield made
    finally:
        _scopes.reset(token)


def release_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of what has been written go.

    Spark deletes them once the driver's garbage collector finds that no plan refers to
    them any more, which on a large heap may be long after. To be called between the
    tables of a long chain, where disk matters more than the collector's short pause.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def drop_scratch(spark: SparkSession, since: int = 0) -> None:
    """Delete the scratch tables of this application, once nothing reads them any more.

    ``since`` is a number from ``scratch_mark``: only later ones are deleted.
    """
    drop_paths(spark, _written[spark.sparkContext.applicationId][since:])


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete some of the scratch tables, which nothing reads any more."""
    written = _written[spark.sparkContext.applicationId]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        if path in written:  # else it is gone already
            place = hadoop.Path(path)
            place.getFileSystem(conf).delete(place, True)
            written.remove(path)


def scratch_mark(spark: SparkSession) -> int:
    return len(_written[spark.sparkContext.applicationId])
