"""T2: Gold kept current by deltas, without reading Silver again.

A micro-batch is summed up to mergeable partial aggregates per Gold key (count, sum, min, max) and folded into its
stream's own partials of the months it touches. Each fold writes a new folder (stream, month, batch); a ledger entry
(stream, batch, months), written last, makes these folders the stream's present ones. A batch that the ledger holds changes nothing, and one
that failed before its entry is folded again from the same folders. Streams share no folder, so any number of them may feed one
Gold, which merges the present partials of all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airshed.operators.clean import to_silver
from airshed.schema import BRONZE_SCHEMA, GOLD_KEYS, GOLD_SCHEMA
from airshed.sources.layers_io import MONTH, drop_partition, month_of, partition_folder, path_exists, write_by_month, write_partitions

STREAM, BATCH = "stream", "batch"
PARTIALS = T.StructType([*[GOLD_SCHEMA[k] for k in GOLD_KEYS], T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType()),
                         T.StructField("least", T.DoubleType()), T.StructField("most", T.DoubleType())])
_FOLDERS = [T.StructField(STREAM, T.StringType()), T.StructField(MONTH, T.IntegerType()), T.StructField(BATCH, T.LongType())]
LEDGER = T.StructType([T.StructField("months", T.ArrayType(T.IntegerType())), _FOLDERS[0], _FOLDERS[2]])


def partials(silver: DataFrame) -> DataFrame:
    """The partial aggregates of Silver rows per Gold key; rows with a NULL key are dropped, as in Gold."""
    return silver.dropna(subset=list(GOLD_KEYS)).groupBy(*GOLD_KEYS).agg(
        F.count("value").alias("n"), F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("most"))


def merged(parts: DataFrame) -> DataFrame:
    """Partials of equal keys as one; in any order and grouping the result is the same, up to the rounding of sums."""
    return parts.groupBy(*GOLD_KEYS).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"))


def finished(parts: DataFrame) -> DataFrame:
    """Gold rows of merged partials."""
    return parts.select(*GOLD_KEYS, F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("avg_value"), F.col("most").alias("max_value"),
                        F.col("least").alias("min_value"), F.col("n").alias("record_count"))


def present(spark: SparkSession, state: str) -> list[tuple[str, int, int]]:
    """(stream, month, batch) of the folders that the ledger makes the present ones: each stream's last of each month."""
    if not path_exists(spark, f"{state}/ledger"):
        return []
    ledger = spark.read.schema(LEDGER).parquet(f"{state}/ledger").select(STREAM, F.explode("months").alias(MONTH), BATCH)
    return [tuple(r) for r in ledger.groupBy(STREAM, MONTH).agg(F.max(BATCH).alias(BATCH)).collect()]


def read_partials(spark: SparkSession, state: str, folders: list[tuple[str, int, int]]) -> DataFrame:
    """The partials in these folders; no other folder is listed or opened."""
    if not folders:
        return spark.createDataFrame([], PARTIALS)
    paths = [f"{state}/partials/" + "/".join(partition_folder(spark, n, v) for n, v in zip((STREAM, MONTH, BATCH), f, strict=True)) for f in folders]
    return spark.read.option("basePath", f"{state}/partials").schema(T.StructType([*PARTIALS.fields, *_FOLDERS])).parquet(*paths).select(*PARTIALS.names)


def gold_from_partials(spark: SparkSession, state: str, months: list[int] | None = None) -> DataFrame:
    """Gold as all streams' present partials give it: a merge of rows that are aggregated already."""
    return finished(merged(read_partials(spark, state, [f for f in present(spark, state) if months is None or f[1] in months])))


def fold_batch(batch: DataFrame, batch_id: int, stream: str, state: str, gold_dir: str) -> bool:
    """Fold one micro-batch of Silver rows; False if the ledger holds it already, in which case only Gold's months are written again.

    An empty batch, or one of rows without keys, gets an entry without months. Gold's folders of the touched months are replaced from all streams'
    partials; of streams that do so at the same moment, the last to write may miss the other's batch there until either's next
    batch of that month (``gold_from_partials`` never does).
    """
    spark = batch.sparkSession
    now = present(spark, state)
    entry = f"{state}/ledger/{partition_folder(spark, STREAM, stream)}/{partition_folder(spark, BATCH, batch_id)}"
    known = path_exists(spark, f"{entry}/_SUCCESS")
    if known:
        months = spark.read.schema(T.StructType(LEDGER.fields[:1])).parquet(entry).first()["months"]
    else:
        new = partials(batch).withColumn(MONTH, month_of("date"))
        folder = f"{state}/deltas/{partition_folder(spark, STREAM, stream)}"
        new.write.mode("overwrite").parquet(folder)  # the batch is read once
        delta = spark.read.parquet(folder)
        months = sorted(r[0] for r in delta.select(MONTH).distinct().collect())
        own = [f for f in now if f[0] == stream and f[1] in months]
        if months:
            both = merged(read_partials(spark, state, own).unionByName(delta.select(*PARTIALS.names)))
            both = both.withColumns({STREAM: F.lit(stream), MONTH: month_of("date"), BATCH: F.lit(batch_id)})
            write_partitions(both.hint("rebalance", F.col(MONTH)), f"{state}/partials", [STREAM, MONTH, BATCH])
        spark.createDataFrame([(months,)], T.StructType(LEDGER.fields[:1])).coalesce(1).write.mode("overwrite").parquet(entry)
        for _, month, old in own:
            if old != batch_id:
                drop_partition(spark, f"{state}/partials", STREAM, stream, MONTH, month, BATCH, old)
    if months:
        write_by_month(gold_from_partials(spark, state, months), gold_dir, list(GOLD_KEYS), replace_months=True)
    return not known


def start_bronze_to_gold_deltas(spark: SparkSession, bronze_dir: str, state: str, gold_dir: str, checkpoint: str,
                                max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Bronze files as they come, cleaned in the stream and folded into Gold. The stream's name in the ledger is the id that Spark keeps in its checkpoint,
    so a restarted stream goes on under it, and a new checkpoint is another stream."""
    reader = spark.readStream.schema(BRONZE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, batch_id, stream_id(batch), state, gold_dir)
    w = to_silver(reader.parquet(bronze_dir)).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def stream_id(batch: DataFrame) -> str:
    """The id of the stream a micro-batch belongs to, which its checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
