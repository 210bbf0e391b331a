"""Sessions and the shared folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "chromaloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC timestamps and Arrow. ``conf`` overrides anything."""
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = builder.config(map=defaults | conf).getOrCreate()
    if not is_local(spark):
        ship(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process."""
    return spark.conf.get("spark.master", "").split("[")[0] == "local"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, where it isn't installed."""
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="chromaloom-")
    path = Path(folder, f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    shutil.rmtree(folder)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent in local mode (tests) a temporary folder is made and set. On a
    cluster it must be set, as executors couldn't read each other's local folders.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if where is None and context.getCheckpointDir() is None and not is_local(spark):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(where or tempfile.mkdtemp(prefix="chromaloom-"))
    if where is None:
        where = context.getCheckpointDir().rsplit("/", 1)[0]
    return where


_scratch: list[tuple[object, object]] = []


@atexit.register
def clean_scratch() -> None:
    """Deletes what scratch_path has named so far: for a session's end, or after a query's result is written."""
    while _scratch:
        place, hadoop = _scratch.pop()
        try:
            place.getFileSystem(hadoop).delete(place, True)
        except Exception:  # the JVM may be gone, or a folder not ours any more: go on with the rest
            continue


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; what is there is deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if getattr(spark, "_jvm", None) is not None:
        _scratch.append((spark._jvm.org.apache.hadoop.fs.Path(path), spark._jsc.hadoopConfiguration()))
    return path


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` written once to the shared folder and read back: what follows survives lost executors.

    A compressed columnar table is used rather than ``checkpoint()``, whose files hold
    uncompressed rows, several times as large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
