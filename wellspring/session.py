"""Session helpers: where shared intermediate tables live and how executors get this package."""

from __future__ import annotations

import atexit
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; cluster jobs bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wellspring")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the cluster names in spark.checkpoint.dir, else what the context already uses. Where neither is set, a
    local session gets a temporary folder; on a cluster that would be the driver's own disk, so it's an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    context = spark.sparkContext._jsc.sc()
    if named:
        if not context.getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if not context.getCheckpointDir().isDefined():
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wellspring-"))
    return context.getCheckpointDir().get().rstrip("/")


_WRITTEN: list[tuple[SparkSession, str]] = []


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends in replicated files.

    Unlike a persisted frame it survives lost executors, and unlike checkpoint() it is columnar, so
    later reads prune columns and the optimizer knows its size.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/wellspring-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _WRITTEN:
        atexit.register(drop_written)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_written() -> None:
    """Delete every table that materialize() wrote in this process."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
        except Exception:  # noqa: BLE001  the JVM may be gone when the process ends
            return


_SHIPPED: set[str] = set()

#: Python workers get batches of so many bytes at most: by default one is 10,000 rows, however long.
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, and bound the batches that its Python code gets, unless a bound is set."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent).as_posix())
    path = os.path.join(tempfile.mkdtemp(prefix="wellspring-"), "wellspring.zip")
    Path(path).write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def release() -> None:
    """Give back what a Python worker has freed, when its task ends: idle workers are kept, and else keep their peak too."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        return
