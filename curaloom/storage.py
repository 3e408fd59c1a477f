"""Written tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset a local session, as in tests, gets a temporary folder; a cluster's is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="curaloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Paths given out and not released, in order.
_given: list[str] = []


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder; deleted by `release`, or when the process ends."""
    path = f"{shared_folder(spark)}/curaloom-{tag}-{uuid.uuid4().hex}"
    _given.append(path)
    atexit.register(_delete, spark, path)
    return path


def written(df: DataFrame, tag: str, rows: int | None = None, per_task: int = 1_000_000) -> DataFrame:
    """df as a table in the shared folder, read back; deleted when the process ends.

    rows, a bound of its narrow rows where one is known, keeps a small table from being written by many tasks.
    """
    path = fresh_path(df.sparkSession, tag)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // per_task)))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def given() -> list[str]:
    return list(_given)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that no later step reads, so that a long session doesn't fill the shared folder."""
    for path in paths:
        _delete(spark, path)
        if path in _given:
            _given.remove(path)


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the gateway may be gone at exit
        pass
