"""Crawl files arriving in a folder -> bronze, with the batch function applied to every micro-batch."""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hirelake import schemas as S
from hirelake.operators import state
from hirelake.sources.snapshots import Snapshots


def ingest(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    root: str,
    order: list[str],
    checkpoint: str | None = None,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Insert-if-absent every new Parquet file of ``folder`` into ``<root>/bronze``; ends when caught up.

    Each micro-batch adds one version holding its new jobs only, found by an anti join on the stored
    keys. A batch that is replayed after a failure adds nothing, because its keys are stored.
    """
    store = Snapshots(spark, root)

    def merge(batch: DataFrame, batch_id: int) -> None:
        stored = store.read_all("bronze", S.RAW).select(S.RAW.names)
        store.write("bronze", state.absent_rows(stored, batch, ["source", "job_id"], order))

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint or f"{root}/_checkpoints/bronze-{crc32(folder.encode()):08x}")
        .trigger(availableNow=True)
        .start()
    )
