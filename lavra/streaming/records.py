"""Structured Streaming forms of collection: new records are read as files arrive and change the stored state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lavra.operators.staging import upsert


def read_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def first_deliveries(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Each key once within ``late``; the state of older keys is dropped. A null time is never late and never dropped by time."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, by: str, size: str = "1 day", late: str | None = "7 days") -> DataFrame:
    """``start, by, rows`` of tumbling windows; rows later than ``late`` (null: than the watermark that the stream has) are left out."""
    marked = stream.withWatermark(time, late) if late else stream
    return marked.groupBy(F.window(time, size).alias("w"), F.col(by)).agg(F.count(F.lit(1)).alias("rows")).select(F.col("w.start").alias("start"), by, "rows")


def upsert_stream(stream: DataFrame, folder: str, checkpoint: str, key: str, order: str) -> StreamingQuery:
    """Keeps the latest row of each key in ``folder/version=N``; every batch writes a new version, so a failed one changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs
        files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        older = [n for n in range(number - 1, -1, -1) if files.exists(hadoop.Path(f"{folder}/version={n}/_SUCCESS"))]
        existing = spark.read.parquet(f"{folder}/version={older[0]}") if older else batch.limit(0)
        upsert(existing, batch, key, order).write.mode("overwrite").parquet(f"{folder}/version={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
