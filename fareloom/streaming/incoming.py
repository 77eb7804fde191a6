"""New files of a directory into a partitioned table, each record once.

A run takes all files that came since the last one and ends (``availableNow``), so it can be scheduled like a batch job.
The checkpoint remembers files and keys; the file sink commits a batch as a whole, so a run that was cut off is finished
by the next one.

Repeated records are removed by key with a watermark on the time of *arrival*. A watermark on the event time would bound
the state just as well, but it drops records that come late; here records may be late by any time. State holds the
keys that arrived within ``repeat_within``; a record sent again after a longer time is taken as a new one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_ARRIVED = "arrived_in_batch_at"


def take_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    *,
    partition_by: Sequence[str] = (),
    prepare: Callable[[DataFrame], DataFrame] = lambda records: records,
    repeat_within: str = "30 days",
    files_per_batch: int = 1000,
) -> None:
    """Append the records of new Parquet files below ``landing`` to ``target``; returns when all are there.

    ``prepare`` may add columns, such as those of ``partition_by``. Records with equal keys are one record, the first to
    arrive; null keys are equal to each other. Read the target by its path as a whole: its log names the files that count.
    The number of state partitions is that of ``spark.sql.shuffle.partitions`` in the first run; for very many keys set
    ``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
    """
    arrivals = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    once = (
        prepare(arrivals)
        .withColumn(_ARRIVED, F.current_timestamp())
        .withWatermark(_ARRIVED, repeat_within)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop(_ARRIVED)
    )
    writer = once.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.trigger(availableNow=True).start().awaitTermination()
