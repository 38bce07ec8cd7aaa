"""Session helpers: where intermediate tables live and how lineage is cut."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
_RUN_FOLDERS: set[str] = set()
_GROUP: ContextVar[str | None] = ContextVar("settled_group", default=None)
_SETTLED: dict[tuple[str, str], list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used, but only when the master is
    local; on a cluster a machine-local folder would lose data with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="curbline-")
    return _LOCAL_DIRS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's part of the shared folder, which goes when the driver exits."""
    folder = f"{shared_dir(spark)}/curbline-{spark.sparkContext.applicationId}"
    if folder not in _RUN_FOLDERS:
        _RUN_FOLDERS.add(folder)
        atexit.register(_delete, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the shared file system has this path."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


def copy_folder(spark: SparkSession, source: str, target: str) -> None:
    """Copy a folder of the shared file system, in place of what the target held."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    here, there = hadoop.Path(source), hadoop.Path(target)
    files, others = here.getFileSystem(conf), there.getFileSystem(conf)
    others.delete(there, True)
    if not hadoop.FileUtil.copy(files, here, others, there, False, True, conf):
        raise OSError(f"could not copy {source} to {target}")


def _delete(folder: str) -> None:
    """Remove a folder of the shared file system, if the session is still there to do it."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage in iterative plans and stops a table that feeds many joins from being
    computed once per join. The table survives the loss of executors, keeps column
    pruning, and its file sizes let the planner choose broadcast or shuffle joins.
    """
    path = scratch_path(df.sparkSession, name)
    if group := _GROUP.get():
        _SETTLED.setdefault((df.sparkSession.sparkContext.applicationId, group), []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settled_as(group: str) -> Iterator[None]:
    """Tables settled within belong to ``group`` and go with ``release``; others stay until the shared
    folder is emptied."""
    token = _GROUP.set(group)
    try:
        yield
    finally:
        _GROUP.reset(token)


def release(spark: SparkSession, group: str, *, keep_for: DataFrame | None = None) -> None:
    """Delete the settled tables of ``group``, but for those that ``keep_for`` reads. Nothing else that
    reads them may be evaluated afterwards."""
    key = (spark.sparkContext.applicationId, group)
    paths = _SETTLED.pop(key, [])
    names = {p: p.rsplit("/", 1)[-1] for p in paths}
    read = set()
    if paths and keep_for is not None:
        read = {folder for file in keep_for.inputFiles() for folder in file.split("/")[-2:-1]}
    _SETTLED[key] = [p for p in paths if names[p] in read]
    for path in paths:
        if names[path] not in read:
            _delete(path)
