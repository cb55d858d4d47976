"""Session construction and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: list[tuple[SparkSession, str]] = []


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "skysift") -> SparkSession:
    """A UTC, AQE-enabled session for tests and benchmarks."""
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where the setting is absent and Spark runs in one process (``local[..]``) a
    temporary folder is taken; a cluster without the setting is an error, because a
    machine-local folder would be lost with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="skysift-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of its file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def room(spark: SparkSession, label: str) -> str:
    """A folder in the shared place for what a stream leaves; deleted at the end like written steps."""
    path = f"{scratch_root(spark).rstrip('/')}/skysift-{label}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def _delete(spark: SparkSession, path: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _clean() -> None:
    for spark, path in _SCRATCH:
        try:
            _delete(spark, path)
        except Exception:  # the JVM is gone: nothing left to ask
            pass


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of any executor, and keeps a result that
    several branches need from being computed once per branch.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark).rstrip('/')}/skysift-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _SCRATCH.append((spark, path))
    back = spark.read.schema(df.schema).parquet(path)
    back._skysift_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialize` that no later plan reads."""
    path = getattr(df, "_skysift_path", None)
    if path:
        _delete(df.sparkSession, path)
        _SCRATCH[:] = [x for x in _SCRATCH if x[1] != path]
