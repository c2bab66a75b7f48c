"""Incremental ingestion of raw transaction batches with Structured Streaming.

The batch run picks up the newest raw file each time.  As a stream,
the file source remembers which batch folders it has already processed (in
its checkpoint), and each micro-batch is cleaned and loaded with
the warehouse's insert-or-ignore, the older batch stamp first, so a
re-delivered batch or a restarted query adds nothing twice.  Each load brings
its days and regions into their dimensions before its lines, keys its rejects
by the batch, and logs the lines added and those the cleaner dropped.  ``availableNow`` processes whatever has arrived
and stops, which suits scheduled runs; a processing-time trigger keeps it
running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import CleanCounts, clean_transactions, new_clean_counts
from ..operators.dedupe import note_file
from ..plans.warehouse import Warehouse
from ..sources.files import BATCH_COL, RAW_TRANSACTIONS


def raw_transaction_stream(spark: SparkSession, raw_dir: str, max_files: int | None = None,
                           layout: str = "folders") -> DataFrame:
    """``layout='folders'``: batches under ``transactions/batch_ts=<ts>/``;
    ``layout='flat'``: files ``transactions_<ts>.csv`` directly in ``raw_dir``."""
    if layout not in ("folders", "flat"):
        raise ValueError(layout)
    fields = list(RAW_TRANSACTIONS.fields)
    if layout == "folders":
        fields.append(T.StructField(BATCH_COL, T.StringType()))
    reader = spark.readStream.schema(T.StructType(fields)).option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    root = raw_dir.rstrip("/")
    return note_file(reader.csv(f"{root}/transactions" if layout == "folders" else f"{root}/transactions_*.csv"))


def to_sales_lines(raw: DataFrame, counts: CleanCounts | None = None) -> DataFrame:
    """Raw transactions (one line per order) in the warehouse's fact shape."""
    return (clean_transactions(raw, counts)
            .withColumn("date_id", F.date_format("order_date", "yyyy-MM-dd"))
            .withColumn("line_number", F.lit(1)))


def start_fact_ingest(spark: SparkSession, raw_dir: str, warehouse: Warehouse, checkpoint: str,
                      once: bool = True, max_files: int | None = None, layout: str = "folders") -> StreamingQuery:
    """Start the stream; each micro-batch goes through ``warehouse.load_fact``,
    and its lines and its log entry become visible together.  A batch that
    fails is logged as FAILED and stops the stream, which takes it up again when restarted."""

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        stage = f"stream_batch_{epoch_id}"

        def load() -> None:
            counts = new_clean_counts()
            order = [BATCH_COL] if BATCH_COL in batch.columns else []
            added = warehouse.load_fact(to_sales_lines(batch, counts), order=order, batch_id=f"{checkpoint}#{epoch_id}")
            warehouse.log_run(stage, "SUCCESS", added,
                              error=f"{counts.dropped()} of {counts.seen.get['rows']} lines dropped by the cleaner")

        try:
            warehouse.transact(load)
        except Exception as failure:
            warehouse.log_run(stage, "FAILED", error=str(failure))
            raise

    writer = (raw_transaction_stream(spark, raw_dir, max_files, layout).writeStream
              .foreachBatch(load_batch).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")
    return writer.start()
