"""Ingest as a stream of files: the checkpoint is the ledger.

Files that arrive under a folder are read once each, conformed, thinned out and appended by day; what was read is kept in the
stream's checkpoint, and a batch that failed is read again. AvailableNow works off what there is and ends, like a batch job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..params import Box
from ..sources.readers import conform, decimate


def file_stream(spark: SparkSession, folder: str, raw: StructType, files_per_batch: int = 250, box: Box | None = Box(), every: int = 5) -> DataFrame:
    """State vectors of the Parquet files under a folder, as they arrive."""
    rows = spark.readStream.schema(raw).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(folder)
    if "time" in rows.columns:
        rows = rows.withColumnRenamed("time", "event_time")
    return conform(decimate(rows, box, every))


def append_by_day(rows: DataFrame, to: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Starts writing the stream as Parquet, partitioned by day; exactly once per file."""
    w = rows.withColumn("event_day", F.to_date("event_time")).writeStream.format("parquet").partitionBy("event_day").option("path", to).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()
