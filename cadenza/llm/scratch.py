"""Tables that cut lineage: written to the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this process if all runs on this machine (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="cadenza-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def materialize(df: DataFrame, name: str = "step", by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder (a folder for each value of the columns ``by``) and read it back.

    The copy survives the loss of any executor, and what reads it has no lineage
    behind it. The files go with ``release``, or when the driver ends. There is no mark of success, as only this process reads
    them once they are whole: on a local store each file made by the driver starts a process, which shares the driver's memory at first.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*by).option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_written"] = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more: what was made of them is written itself."""
    for df in tables:
        path = df.__dict__.pop("_written", None)
        if path:
            _delete(df.sparkSession, path)
            _WRITTEN.remove((df.sparkSession, path))


def written_once(make: Callable[[], DataFrame], name: str = "step") -> DataFrame:
    """``make()`` written and read back; the tables that were made on the way are deleted, as nothing reads them any more."""
    before = set(_WRITTEN)
    out = materialize(make(), name)
    for spark, path in [w for w in _WRITTEN if w not in before and w[1] != out.__dict__["_written"]]:
        _delete(spark, path)
        _WRITTEN.remove((spark, path))
    return out


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _WRITTEN:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone
            return
