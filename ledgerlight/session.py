"""Session settings this library expects."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Settings the jobs rely on.  Adaptive execution sizes the shuffles, turns joins
#: with a small side into broadcasts from measured sizes, and splits skewed join
#: partitions even where that costs one more shuffle.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def builder(app_name: str = "ledgerlight", **conf: str) -> SparkSession.Builder:
    """A session builder carrying :data:`DEFAULTS`; ``conf`` keys use ``__`` for dots."""
    made = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        made = made.config(key, value)
    for key, value in conf.items():
        made = made.config(key.replace("__", "."), value)
    return made


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, which hour and day buckets depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def holding(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for as long as the block runs."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset, as
    in a local test, a temporary folder stands in, which goes with the process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _own_folder()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="ledgerlight-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_STAGED: list[str] = []


def staged(df: DataFrame, reader: SparkSession | None = None) -> DataFrame:
    """``df`` written to the shared folder as a table and read from there.

    For a frame that several later branches read: they share one computation, take the
    columns they need, and a lost executor costs no rerun of it.  The table stays until
    :func:`drop_staged`.  ``reader`` is the session that goes on with it where that is
    not the frame's own: a stream's session has no adaptive execution, which sizes
    shuffles and brings the rows of a folder together.
    """
    spark = reader or df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid4().hex}"
    _STAGED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Remove what this process has staged, once the results made from it are written; how many tables."""
    conf = spark._jsc.hadoopConfiguration()
    for path in _STAGED:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    dropped = len(_STAGED)
    _STAGED.clear()
    return dropped
