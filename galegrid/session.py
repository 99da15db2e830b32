"""Session helpers: a local session for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "galegrid") -> SparkSession:
    """A `local[...]` session for tests and the bench; a cluster brings its own."""
    partitions = "8" if cpus == "*" else str(max(1, int(cpus)))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by `spark.checkpoint.dir`.

    A local session without that setting gets a temporary folder of its own; a cluster
    without it is an error, as its executors share no local folder.
    """
    conf = spark.sparkContext.getConf()
    configured = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is not None:
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="galegrid-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/galegrid-{spark.sparkContext.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder of this application in the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application staged; DataFrames that still read it become invalid."""
    delete(spark, _scratch_root(spark))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on whatever store it lies; one that is not there is no error."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Paths that `cut_lineage` wrote for a named owner, by application and owner.
_OWNED: dict[tuple[str, str], list[str]] = {}
_OWNERS: list[str] = []
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs that start inside send Python at most `most` rows in an Arrow batch."""
    before = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, str(most))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


@contextmanager
def owned_by(owner: str) -> Iterator[None]:
    """What is staged inside belongs to `owner`, until `free_owned` deletes it."""
    _OWNERS.append(owner)
    try:
        yield
    finally:
        _OWNERS.pop()


def free_owned(spark: SparkSession, owner: str, unless_read_by: DataFrame) -> None:
    """Delete what was staged for `owner`; files that a frame still reads stay, to be freed later."""
    key = (spark.sparkContext.applicationId, owner)
    paths = _OWNED.pop(key, [])
    if paths:
        read = unless_read_by.inputFiles()
        kept = [p for p in paths if any(p.split("://")[-1].split(":", 1)[-1].lstrip("/") in f for f in read)]
        for path in set(paths) - set(kept):
            delete(spark, path)
        if kept:
            _OWNED[key] = kept


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames that `cut_lineage` returned and nobody will read any more."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            delete(df.sparkSession, path)


def cut_lineage(df: DataFrame, replacing: DataFrame | None = None, free: bool = False) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    A lost executor then costs no recomputation, and the planner knows the true size. With `free`
    what the write shuffled goes with its end, not when the driver next collects garbage. `replacing`
    is a frame that this function returned before and nobody reads any more: its files go.
    """
    spark = df.sparkSession
    path = staging_path(spark, "cut")
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true" if free else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._staged_path = path
    if _OWNERS:
        _OWNED.setdefault((spark.sparkContext.applicationId, _OWNERS[-1]), []).append(path)
    if replacing is not None:
        discard(replacing)
    return stored
