"""Session and shared-folder helpers used by every part of the package."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}
_TRACKS: list[list[DataFrame]] = []


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench: one JVM, UTC, adaptive execution."""
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("radiospark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    importable(session)
    return session


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is absent and the session runs in one process (tests) a temporary folder is made and set.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="radiospark-")
        atexit.register(shutil.rmtree, _OWN_DIRS[app], ignore_errors=True)
        spark.sparkContext.setCheckpointDir(_OWN_DIRS[app])
    return "file://" + os.path.abspath(_OWN_DIRS[app])


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package from where the driver has it, whatever their working folder.

    A function keeps the paths of the time when it was given to Spark, so operators that run Python call this first.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    importable(spark)
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder and read it back.

    The files survive lost executors; later stages start from them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    for track in _TRACKS:
        track.append(out)
    return out


#: Bytes of a leaf whose size Spark does not know are above this.
_UNKNOWN = 1 << 60


def input_bytes(df: DataFrame) -> int:
    """Bytes that ``df`` comes from, about: the sizes of the tables at its leaves, or its own size as planned if that is less
    (joins multiply it, projections cut it down). Leaves of unknown size count nothing."""
    plan = df._jdf.queryExecution().optimizedPlan()
    size = lambda p: int(str(p.stats().sizeInBytes()))
    leaves = plan.collectLeaves()
    sizes = [size(leaves.apply(k)) for k in range(leaves.size())]
    return min(size(plan), sum(s for s in sizes if s < _UNKNOWN))


#: Rows of a few fixed-size columns that every executor may hold (some tens of MB).
FEW_ROWS = 1 << 20


def few(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and counted: broadcast where it has at most ``FEW_ROWS`` rows, left to a shuffle beyond.

    For tables of one row a scan, which would otherwise send all samples of a scan to one task.
    """
    own = written(df, label)
    return F.broadcast(own) if own.count() <= FEW_ROWS else own


@contextlib.contextmanager
def tracked() -> Iterator[list[DataFrame]]:
    """The list of all tables that ``written`` makes inside the block, for ``release`` once nothing reads them any more."""
    frames: list[DataFrame] = []
    _TRACKS.append(frames)
    try:
        yield frames
    finally:
        _TRACKS[:] = [t for t in _TRACKS if t is not frames]


def release(*frames: DataFrame) -> None:
    """Delete the files of tables from ``written`` that nothing will read any more."""
    for df in frames:
        path = df.__dict__.pop("_scratch", None)
        if path:
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table of ``sf_dir``."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
