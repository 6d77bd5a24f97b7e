"""Keep an intermediate table so that later passes do not recompute it."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_written: weakref.WeakKeyDictionary[SparkSession, list[str]] = weakref.WeakKeyDictionary()
_own_folder: str | None = None


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names, or one of our own in local mode.

    No setting of the session is changed. A cluster must name a folder that all its
    machines see; without one there is no safe place, and that is an error.
    """
    global _own_folder
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if _own_folder is None:
            _own_folder = tempfile.mkdtemp(prefix="shopworth-")
            atexit.register(shutil.rmtree, _own_folder, ignore_errors=True)
        folder = _own_folder
    return folder.rstrip("/")


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    A written table cuts the lineage, survives the loss of executors and still
    prunes columns on every later pass. It lives until :func:`release`.
    """
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/shopworth-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _written.setdefault(spark, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the tables this session has pinned, but for the first ``since``.

    Results that read them must have been written or collected before.
    """
    paths = _written.get(spark, [])
    files = spark._jvm.org.apache.hadoop.fs
    while len(paths) > since:
        path = files.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def pinned(spark: SparkSession) -> int:
    """How many tables are pinned now."""
    return len(_written.get(spark, []))
