"""Bronze ingest as a Structured Streaming file source (C1, S11 in streaming form).

The stream's checkpoint remembers which landed files were processed, which is
exactly the "skip files already loaded" rule of the batch ingest, kept by
Spark instead of by a log lookup. With ``trigger(availableNow=True)`` the
query drains what has landed and stops, so it runs like a scheduled batch job
yet only ever reads new files.

Each micro-batch is conformed, tagged with its batch id and written with
dynamic partition overwrite on ``(partition columns..., ingest_batch)``: if
a batch is retried after a failure it replaces its own folders, so the sink
stays exactly-once without a transactional table format. One SUCCESS log row
per file is appended after the batch's write commits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from strata.operators import runlog
from strata.operators.conform import conform
from strata.sinks.writer import replace_partitions

BATCH_COL = "ingest_batch"


def ingest_stream(
    spark: SparkSession,
    landing: str,
    read_schema: StructType,
    target: str,
    checkpoint: str,
    schema: Mapping[str, DataType],
    partition_cols: Sequence[str],
    log_path: str | None = None,
    max_files_per_batch: int | None = None,
    derive=None,
) -> None:
    """Ingest every file that has landed under ``landing`` and not been ingested yet.

    ``read_schema`` is the landed layout (streams need it up front; ``key=value``
    folders named in it are filled from the path). ``derive`` may add the
    partition columns from the data (``DataFrame -> DataFrame``).
    """
    reader = spark.readStream.schema(read_schema)
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    stream = reader.parquet(landing).withColumn("_source_file", F.col("_metadata.file_path"))
    parts = list(partition_cols)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        df = conform(batch, schema)
        if derive is not None:
            df = derive(df)
        df = df.drop("_source_file").withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
        replace_partitions(df, target, [*parts, BATCH_COL])
        if log_path:
            # the id is a function of target, batch and file: rows that a retried batch appends again count once
            rows = batch.select(F.col("_source_file").alias("file_name")).distinct().select(
                F.xxhash64(F.lit(target), F.lit(batch_id), "file_name").alias("id"), "file_name", F.lit(landing).alias("source"),
                F.lit(target).alias("destination"), F.lit(runlog.SUCCESS).alias("status"), F.lit("stream").alias("load_type"),
                F.current_timestamp().alias("processed_at"), F.lit(runlog.NO_ERROR).alias("error"), F.lit("bronze").alias("layer"))
            runlog.append_log(rows, log_path)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination already
        raise q.exception()
