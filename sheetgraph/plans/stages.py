"""Tables written between stages: they cut the lineage, and survive a lost executor."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders that this driver process has written and not yet removed.
_LIVE: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A local master, which has no other machine, may do without."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        return set_to
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    own = os.path.join(tempfile.gettempdir(), "checkpoints")
    os.makedirs(own, exist_ok=True)
    return f"file://{own}"


def stash(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df to the shared folder and read it back. drop_stash() or the end of the driver process removes it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _LIVE[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def drop_stash(df: DataFrame | None) -> None:
    """Remove a table that stash() wrote; nothing may read it any more."""
    path = getattr(df, "_stash_path", None)
    if path in _LIVE:
        _remove(_LIVE.pop(path), path)


@contextmanager
def scratch() -> Iterator[None]:
    """Every table that stash() writes within is removed at the end, so results must be stored before."""
    before = set(_LIVE)
    try:
        yield
    finally:
        for path in [p for p in _LIVE if p not in before]:
            _remove(_LIVE.pop(path), path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for path, spark in list(_LIVE.items()):
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the JVM may have ended already
            return


def read_through(spark: SparkSession, path: str, compute: Callable[[], DataFrame], valid: Callable[[DataFrame], bool] | None = None) -> DataFrame:
    """The table stored at path if it is complete (and valid); else compute() it and store it there."""
    if exists(spark, f"{path}/_SUCCESS"):
        stored = spark.read.parquet(path)
        if valid is None or valid(stored):
            return stored
    compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
