"""Session helpers: scratch space, shipping the package and temporary settings."""

from __future__ import annotations

import contextlib
import functools
import os
import pathlib
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only on one machine (a ``local`` master) may that setting be absent; a temporary folder is made then.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if root:
        return root
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^]]*\])?", master):
        raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on master {master}")
    return _local_dir()


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="marketlens-")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`shared_dir`, never used before."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, worked out now and read back from a fresh path, for plans that use them several times."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors once per application, so that Python functions find their modules there."""
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    package = pathlib.Path(__file__).resolve().parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="marketlens-code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent).as_posix())
    context.addPyFile(str(archive))
    _SHIPPED["application"] = context.applicationId


_SHIPPED: dict[str, str] = {}


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str):
    """Set session options for the duration of a block (``__`` stands for a dot)."""
    wanted = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
