"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import io
import tempfile
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators are written for.

    ``settings`` use ``__`` for dots: ``spark__driver__memory="8g"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The reliable folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one process, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir()


_MADE: list[str] = []
#: Of each thread: what it wrote inside its innermost block of ``passing_stages``.
_OWN = threading.local()
#: Removes an execution's shuffle files when it ends; otherwise they stay until the driver's next garbage collection.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING = threading.Lock()
_cleaners, _cleanup_before = 0, None


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block remove their shuffle files when they end; several threads may be inside."""
    global _cleaners, _cleanup_before
    with _CLEANING:
        if not _cleaners:
            _cleanup_before = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _cleaners += 1
    try:
        yield
    finally:
        with _CLEANING:
            _cleaners -= 1
            if not _cleaners:
                if _cleanup_before is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, _cleanup_before)


def materialize(df: DataFrame, by: str | None = None, rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, in a folder per value of ``by`` if given, and read it back.

    Cuts the lineage, fixes values that depend on task placement, and survives
    lost executors. Parquet keeps sizes known to the planner. What was shuffled for it goes from the disk at once.
    The folder stays until ``release`` or the end of the ``stage_folders`` block around it, or for good where there is neither.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    _MADE.append(path)
    if getattr(_OWN, "made", None) is not None:
        _OWN.made.append(path)
    writer = (df.write.partitionBy(by) if by else df.write).option("compression", "zstd")
    with _shuffles_removed(spark):
        (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage = path
    return out


def _delete(place: str) -> None:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(place)
    if system.get_file_info(path).type == fs.FileType.Directory:
        system.delete_dir(path)


def release(stored: DataFrame) -> None:
    """Remove what ``materialize`` wrote for ``stored``, once nothing reads it any more."""
    _MADE.remove(stored._stage)
    _delete(stored._stage)


@contextmanager
def stage_folders() -> Iterator[None]:
    """Remove what ``materialize`` wrote inside the block when it ends.

    Write the result out before: a DataFrame made inside reads these folders only when
    it runs.
    """
    first = len(_MADE)
    try:
        yield
    finally:
        for place in _MADE[first:]:
            _delete(place)
        del _MADE[first:]


@contextmanager
def passing_stages() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Remove what this thread's ``materialize`` wrote inside the block when it ends, except tables given to the yielded function."""
    kept: set[str] = set()

    def keep(stored: DataFrame) -> DataFrame:
        kept.add(stored._stage)
        return stored

    outer = getattr(_OWN, "made", None)
    _OWN.made = made = []
    try:
        yield keep
    finally:
        _OWN.made = outer
        for place in made:
            if place in kept:
                if outer is not None:
                    outer.append(place)
            elif place in _MADE:
                _MADE.remove(place)
                _delete(place)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per session's context.

    Functions that run in workers import it; on a cluster it need not be installed there.
    """
    from pyarrow import fs

    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    package, packed = Path(__file__).resolve().parent, io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    uri = f"{shared_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}.zip"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as out:
        out.write(packed.getvalue())
    context.addPyFile(uri)
    context._tidemark_shipped = True
