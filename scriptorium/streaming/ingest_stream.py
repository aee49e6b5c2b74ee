"""Incremental ingest of newly landed bronze files.

The file source remembers in its checkpoint which files it has read. Nothing
else is kept in state: what is new is decided against the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptorium.plans.ingest import IngestOptions, ingest
from scriptorium.schemas import BRONZE
from scriptorium.sinks.logs import succeeded
from scriptorium.sources.bronze import run_date


def bronze_stream(
    spark: SparkSession, folder: str, array_files: bool = True, files_per_batch: int = 1000
) -> DataFrame:
    """Landed array files, or JSON-lines files, as a stream of raw rows."""
    reader = spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", files_per_batch)
    if array_files:
        reader = reader.option("multiLine", True)
    raw = reader.json(folder)
    return raw.select(
        *BRONZE.fieldNames(),
        run_date().alias("ds"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def ingest_stream(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    handler: Callable[[DataFrame, int], None] | None = None,
    db: str = "default",
    options: IngestOptions = IngestOptions(),
    **source,
) -> StreamingQuery:
    """Process all files that have landed since the last call, then stop.

    The default handler runs the batch ingest on each micro-batch, as a run
    named by the stream (its id lasts as long as its checkpoint) and the number
    of the batch: one that is delivered again after its commit is recognised in
    the run log and left alone. Rejected papers are stored by the ingest. A
    batch whose files name no run date gets today's.
    """

    def default_handler(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # Fixed value: the property in which Spark gives a stream's id.
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_id = f"stream-{stream or checkpoint}-{batch_id}"
        if succeeded(session, run_id, db):
            return
        run_date = batch.agg(F.max(F.nullif("ds", F.lit("")))).first()[0]
        run_date = run_date or dt.datetime.now(dt.timezone.utc).date().isoformat()
        ordered = batch.withColumn("source_row", F.monotonically_increasing_id())
        ingest(ordered, run_id, run_date, db, options=options)

    return (
        bronze_stream(spark, folder, **source)
        .writeStream.foreachBatch(handler or default_handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
