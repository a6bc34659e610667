"""Incremental ingest: new tile files are read as they come, repeated reads dropped, cells upserted.

The batch pipeline recomputes by file times; here a checkpoint remembers what was read, and availableNow ends the run
when everything is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_rows(spark: SparkSession, path: str, schema: StructType | str, keys: list[str], kind: str = "parquet", max_files: int | None = None, time: str | None = None, late: str = "1 day") -> DataFrame:
    """Stream of the rows of new files, the first of each key.

    With a time column a key is forgotten when the watermark passes its row's time by `late`, so that the state is as
    large as that span; without one the state holds every key seen, as a run over a bounded set of files can afford.
    """
    reader = spark.readStream.schema(schema).format(kind)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(path)
    if not time:
        return rows.dropDuplicates(keys)
    # Watermarks take instants only; times without a zone are read in the session's.
    return rows.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Everything that has arrived, then stop. The sink sees a batch at least once: it must be idempotent by batch id."""
    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch to a folder of its own: a batch written twice is written once."""
    return lambda df, batch: df.withColumn("batch_id", F.lit(batch)).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def upsert_batches(path: str, keys: list[str], order: list[str]) -> Callable[[DataFrame, int], None]:
    """A sink that keeps the last row (by order) of each key: each batch makes the table's next version, in a folder of its
    own. A batch that comes again starts from the version before it and makes the same one."""

    def sink(df: DataFrame, batch: int) -> None:
        last = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
        known = [v for v in versions(df.sparkSession, path) if v < batch]
        all_rows = df.unionByName(df.sparkSession.read.schema(df.schema).parquet(f"{path}/version={max(known)}")) if known else df
        all_rows.withColumn("k_", last).where("k_ = 1").drop("k_").write.mode("overwrite").parquet(f"{path}/version={batch}")

    return sink


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the whole versions under path, by Hadoop's file system: any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    done = lambda x: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))
    return sorted(int(s.getPath().getName().split("=")[1]) for s in fs.listStatus(p) if s.getPath().getName().startswith("version=") and done(s.getPath()))


def windowed_counts(stream: DataFrame, time: str, every: str, late: str, by: list[str]) -> DataFrame:
    """Rows in each time window and group; a window is final once the watermark has passed it."""
    return stream.withWatermark(time, late).groupBy(F.window(time, every), *by).agg(F.count("*").alias("n"))
