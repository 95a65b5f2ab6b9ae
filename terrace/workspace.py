"""Where intermediate tables and exported files live."""

import re
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root = None
_scope = threading.local()


def one_process(spark: SparkSession) -> bool:
    """Whether driver and tasks share one process (``local`` or ``local[n]``)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Every executor must see it, so a machine-local folder is used only when the
    setting is missing *and* the session itself is local.
    """
    global _local_root
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not one_process(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="terrace-")
    return _local_root


def scratch(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses.

    All paths of one application lie together, to be removed when it has ended.
    """
    run = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/terrace/{run}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame once as Parquet in the shared folder and read it back.

    This cuts lineage in a way that survives lost executors, and the file sizes
    give Spark true statistics, so its own broadcast threshold is a real check.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    for scope in getattr(_scope, "open", [])[-1:]:
        scope.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _placed(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    place, files = _placed(spark, path)
    files.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Move a file, unless that has been done."""
    place, files = _placed(spark, path)
    if files.exists(place) and not files.rename(place, _placed(spark, to)[0]):
        raise OSError(f"could not move {path} to {to}")


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove on leaving what ``materialise`` stores inside.

    For work that ends in a write of its own: no frame made inside may be read afterwards.
    """
    if not hasattr(_scope, "open"):
        _scope.open = []
    _scope.open.append([])
    try:
        yield
    finally:
        for path in _scope.open.pop():
            remove(spark, path)
