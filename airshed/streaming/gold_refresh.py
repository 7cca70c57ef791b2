"""T2: keep Silver and Gold current as Bronze grows, late rows included.

Cleaning is stateless and runs in the stream. Each micro-batch then (1) writes
its Silver rows into month folders under a load of its own, so a replayed batch
replaces exactly what it wrote before (idempotent), and (2) recomputes Gold for
the months the batch touched from all Silver rows of those months, replacing only
those Gold folders. The layout is that of the batch run, which a stream may continue.
No streaming state is kept, so a row arriving weeks late simply refreshes its month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from airshed.operators.clean import to_silver
from airshed.schema import BRONZE_SCHEMA
from airshed.sources.incremental import refresh_gold
from airshed.sources.layers_io import MONTH, partitions_with_load, write_by_month
from airshed.streaming.gold_delta import stream_id


def process_batch(batch: DataFrame, batch_id: int, silver_dir: str, gold_dir: str) -> None:
    """The batch's load bears the id of its stream, which the checkpoint keeps: batch numbers start at 0 in each
    checkpoint, and streams that share a Silver keep each other's folders."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    load_id = f"stream-{stream_id(batch)}-{batch_id}"
    write_by_month(batch, silver_dir, ["date"], load_id=load_id, replace_months=True)
    # the months are those of the load's folders, so the batch is read once and kept nowhere
    months = [int(m) for m in partitions_with_load(spark, silver_dir, MONTH, load_id) if m.isdigit()]
    refresh_gold(spark, silver_dir, months, gold_dir)


def start_bronze_to_gold(spark: SparkSession, bronze_dir: str, silver_dir: str, gold_dir: str,
                         checkpoint: str, available_now: bool = True) -> StreamingQuery:
    bronze = spark.readStream.schema(BRONZE_SCHEMA).parquet(bronze_dir)
    w = (to_silver(bronze).writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, silver_dir, gold_dir))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
