"""Session for local runs, and the shared folder that staged tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
# Tables staged within each open ``passing``, the innermost last.
_passing: list[list[str]] = []
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "stopover", cores: str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session, for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting: there one machine
    holds all executors, and a temporary folder is as good as a shared one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="stopover-")
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _staged_path(spark: SparkSession, label: str) -> str:
    path = fresh_path(spark, label)
    if _passing:
        _passing[-1].append(path)
    return path


def staged(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    The written table cuts the lineage and survives the loss of executors. ``codec`` packs
    it otherwise than the session does.
    """
    path = _staged_path(df.sparkSession, label)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_from(
    spark: SparkSession, make: Callable[[], DataFrame], label: str, codec: str | None = None
) -> DataFrame:
    """``staged`` of what ``make`` returns; what that stages and shuffles on its way goes."""
    path = _staged_path(spark, label)
    with passing(spark):
        df = make()
        df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged within goes at its end, so what is read from it must be written by then.

    The shuffle files of what is written within go as soon as it is written; else they stay
    until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    _passing.append([])
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)
        for name in _passing.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
