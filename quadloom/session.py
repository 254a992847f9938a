"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on; all of them can be changed at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The fallback folder of each local application; the setting itself cannot be changed at run time.
_LOCAL_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended run-time settings to a session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder, one per
    application: on a cluster the other machines could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="quadloom-")
    return _LOCAL_FOLDERS[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    path = f"{shared_folder(spark)}/quadloom-{label}-{uuid.uuid4().hex}"
    for held in _HELD:
        held.append(path)
    return path


# The intermediate folders of each open ``temporary`` block.
_HELD: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate folders that are made inside, at the end.

    Results that read them must be consumed, or written elsewhere, before.
    """
    held: list[str] = []
    _HELD.append(held)
    try:
        yield
    finally:
        _HELD.remove(held)
        for path in held:
            removed(spark, path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job that runs inside go when it ends, not when the driver collects its garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def removed(spark: SparkSession, path: str) -> None:
    """Remove an intermediate folder that nothing reads any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def renamed(spark: SparkSession, path: str, target: str) -> None:
    """Give a folder its final name, in place of what has it."""
    removed(spark, target)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(place, hadoop.Path(target)):
        raise OSError(f"{path} can't become {target}")


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back.

    The written table cuts the lineage, survives lost executors, and gives the
    optimizer real sizes for its join choices.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
