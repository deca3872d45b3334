"""Staged tables: a result written once to the shared folder and read back.

A staged table cuts the lineage and survives lost executors. It is used where a result is read more
than once and is costly to compute again. All tables of one application lie in one folder named after
it; ``clear_staged`` deletes it when its results are no longer read, and ``staged_for`` deletes those of one job.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def own_folder() -> str:
    """A folder of this process, for local sessions that name none. It is deleted when the process ends."""
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="spinmart-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return _own[0]


def staging_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a local session, whose executor is this process, gets a folder of its own; any other is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local") and "cluster" not in spark.conf.get("spark.master", ""):
        return own_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def application_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/spinmart-{spark.conf.get('spark.app.id', 'application')}"


_jobs: list[str] = []


def staging_path(spark: SparkSession, label: str) -> str:
    """A new folder; inside ``staged_for`` it belongs to that job."""
    return "/".join([application_folder(spark), *_jobs[-1:], f"{label}-{uuid.uuid4().hex}"])


@contextmanager
def staged_for(spark: SparkSession, label: str) -> Iterator[None]:
    """A job whose staged tables are deleted at its end; its results must be written by then."""
    _jobs.append(f"{label}-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        _delete(spark, f"{application_folder(spark)}/{_jobs.pop()}")


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete the staged tables of this application. Results built on them must be written by then."""
    _delete(spark, application_folder(spark))


def stage(df: DataFrame, label: str = "staged") -> DataFrame:
    """Write ``df`` as parquet to a new folder of its own and return a scan of it."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
