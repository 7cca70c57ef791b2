"""T1: load CSV files as they land, exactly once per file (checkpointed).

``start_landing_to_bronze`` streams files of one header. ``start_landing_loads`` takes files of any headers: a micro-batch is a set
of files, which are read by their own headers and become a load of the Bronze that the batch run writes too. The
checkpoint knows files by name; a ledger of content digests, appended with each load, keeps out a file that comes again under another name.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from airshed.schema import RAW_COLUMNS
from airshed.sources.csv_ingest import read_csv_groups, to_bronze, typed_raw
from airshed.sources.layers_io import LOAD, path_exists, write_partitions
from airshed.streaming.gold_delta import stream_id

TEXT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True) for n in RAW_COLUMNS])


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of typed raw rows from CSV files arriving in ``landing_dir``.

    A stream needs a schema and binds it by position; ``enforceSchema=false``
    makes Spark check each file's header against it, so a file with another
    column order fails instead of silently swapping columns.
    """
    reader = (spark.readStream.schema(TEXT_SCHEMA).option("header", True)
              .option("enforceSchema", False).option("mode", "FAILFAST"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    text = reader.csv(landing_dir)
    return typed_raw(text).withColumn("source_file", F.col("_metadata.file_name"))


def bronze_rows(raw_stream: DataFrame) -> DataFrame:
    """Raw rows + ``ingestion_timestamp`` (the micro-batch time) + ``source_file``."""
    cols = [c for c in raw_stream.columns if c != "source_file"]
    return raw_stream.select(*cols, F.current_timestamp().alias("ingestion_timestamp"), "source_file")


def start_landing_to_bronze(spark: SparkSession, landing_dir: str, bronze_dir: str,
                            checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append new files' rows to the Bronze Parquet folder. The checkpoint
    records processed files, so a restart neither skips nor repeats a file."""
    w = (bronze_rows(landing_stream(spark, landing_dir)).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).option("compression", "snappy")
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(bronze_dir)


_FILES = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
                       T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
DELIVERIES = "digest string, file string, loaded boolean, stream string, batch long"
DIGESTS = "path string, digest string, header string"
#: Lines whose digests are hashed together; a digest has so many bytes.
LEAF, SHA = 1 << 14, 32
_PIECES = pa.schema([("block", pa.int64()), ("leaf", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("digests", pa.binary()), ("header", pa.binary())])


def _pieces(before: dict[int, int]):
    """Of lines (block, digest, value where the line is its file's first) in the order of their blocks, a row per block and leaf: the hash of a whole
    leaf, or the digests of those of its lines that the block has. ``before``: the lines of its file that come before a block."""
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, no, held, header = None, 0, bytearray(), None

        def piece() -> pa.RecordBatch:
            at, whole = no - len(held) // SHA, len(held) == LEAF * SHA
            row = {"block": now, "leaf": at // LEAF, "at": at, "whole": whole, "digests": hashlib.sha256(held).digest() if whole else bytes(held), "header": header}
            return pa.RecordBatch.from_pylist([row], schema=_PIECES)
        for batch in batches:
            blocks, digests, first = batch.column(0).to_numpy(), batch.column(1), batch.column(2)
            turns = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(turns[:-1], turns[1:], strict=True):
                if a < b and blocks[a] != now:
                    if held:
                        yield piece()
                    now, held, header = int(blocks[a]), bytearray(), first[a].as_py()
                    no = before[now]
                    if (no == 0) == (header is None):
                        raise ValueError("the blocks of the files are not those that were counted")
                while a < b:
                    n = min(b - a, LEAF - no % LEAF)
                    held += b"".join(digests.slice(a, n).to_pylist())
                    a, no = a + n, no + n
                    if no % LEAF == 0:
                        yield piece()
                        held, header = bytearray(), None
        if held:
            yield piece()
    return pieces


def file_digests(spark: SparkSession, files: list[tuple[str, int]]) -> DataFrame:
    """path, digest and header (None: an empty file) of files (path, length). The digest is a SHA-256 tree of the length and the lines in their order: lines,
    leaves of ``LEAF`` lines, file. Files are read as lines, in blocks by any number of tasks; a task holds a leaf's digests and a line of them, however
    large a file is. Where blocks begin does not change the digest. A row per block (its number of lines) and per file reach the driver."""
    found = []
    if files:
        path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
        block = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
        lines = spark.read.option("lineSep", "\n").text([p for p, _ in files]).select(
            path.alias("path"), F.col("_metadata.file_block_start").alias("start"), block.alias("block"),
            F.col("value").cast("binary").alias("value"), F.monotonically_increasing_id().alias("id"))
        counts = lines.groupBy("path", "start", "block").agg(F.count("*").alias("n"), F.min("id").alias("id")).collect()
        before, total, firsts = {}, Counter(), []
        for r in sorted(counts, key=lambda r: (r["path"], r["start"])):
            if not total[r["path"]]:
                firsts.append(r["id"])
            before[r["block"]] = total[r["path"]]
            total[r["path"]] += r["n"]
        if len(before) < len(counts) or not set(total) <= {p for p, _ in files}:
            raise ValueError(f"blocks of {sorted(total)} do not tell the files apart")
        if counts:
            pieces = lines.select("block", F.unhex(F.sha2("value", 256)), F.when(F.col("id").isin(firsts), F.col("value"))).mapInArrow(
                _pieces(before), "block long, leaf long, at long, whole boolean, digests binary, header binary")
            names = F.broadcast(spark.createDataFrame([(r["block"], r["path"]) for r in counts], "block long, path string"))
            parts = F.array_sort(F.collect_list(F.struct("at", "digests")))
            leaves = pieces.join(names, "block").groupBy("path", "leaf").agg(F.bool_or("whole").alias("whole"), parts.alias("parts"), F.max("header").alias("header"))
            joined = F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["digests"]))
            leaves = leaves.select("path", "leaf", F.when(F.col("whole"), F.lower(F.hex(joined))).otherwise(F.sha2(joined, 256)).alias("hash"), "header")
            tree = F.transform(F.array_sort(F.collect_list(F.struct("leaf", "hash"))), lambda x: x["hash"])
            found = leaves.groupBy("path").agg(F.sha2(F.array_join(tree, ",").cast("binary"), 256).alias("tree"), F.max("header").cast("string").alias("header")).collect()
    trees = {r["path"]: r for r in found}
    # the length tells whether the last line is ended, and whether a mark of the byte order, which the reader drops, comes first
    rows = [(p, hashlib.sha256(f"{n}:{trees[p]['tree'] if p in trees else ''}".encode()).hexdigest(), trees[p]["header"] if p in trees else None) for p, n in files]
    return spark.createDataFrame(rows, DIGESTS)


def new_files(batch: DataFrame, ledger: str, stream: str, batch_id: int) -> DataFrame:
    """path, digest, header and ``fresh`` of a micro-batch's files (path, length): of equal files the first by name is fresh, unless a load other than this
    batch's own has brought one like it."""
    spark = batch.sparkSession
    files = file_digests(spark, [tuple(r) for r in batch.select("path", "length").collect()])
    files = files.withColumn("header", F.regexp_replace("header", "^\ufeff|\r$", ""))
    files = files.join(files.groupBy("digest").agg(F.min("path").alias("first")), "digest")
    if path_exists(spark, ledger):
        known = spark.read.schema(DELIVERIES).parquet(ledger).filter(F.col("loaded") & ~((F.col("stream") == stream) & (F.col("batch") == batch_id)))
        files = files.join(known.select("digest").distinct().withColumn("known", F.lit(True)), "digest", "left")
    else:
        files = files.withColumn("known", F.lit(None).cast("boolean"))
    return files.select("path", "digest", "header", ((F.col("path") == F.col("first")) & F.col("known").isNull()).alias("fresh"))


def load_files(batch: DataFrame, batch_id: int, stream: str, bronze_dir: str, ledger: str, strict: bool = True) -> int:
    """One micro-batch of files as a load of Bronze; returns how many files it took. A batch given again replaces its load and its entries. Names,
    digests and headers of the batch's files reach the driver, which lists files for their scan anyway. A file without a header is recorded and gives no rows."""
    spark = batch.sparkSession
    files = new_files(batch, ledger, stream, batch_id).collect()
    groups: dict[str, list[str]] = {}
    for f in files:
        if f["fresh"] and f["header"]:
            groups.setdefault(f["header"], []).append(f["path"])
    rows = read_csv_groups(spark, [sorted(g) for _, g in sorted(groups.items())], strict)
    if rows is not None:
        write_partitions(to_bronze(rows).withColumn(LOAD, F.lit(f"landing-{stream}-{batch_id}")), bronze_dir, [LOAD])
    entries = [(f["digest"], f["path"], f["fresh"], stream, batch_id) for f in files]
    write_partitions(spark.createDataFrame(entries, DELIVERIES).coalesce(1), ledger, ["stream", "batch"])
    return sum(f["fresh"] for f in files)


def start_landing_loads(spark: SparkSession, landing_dir: str, bronze_dir: str, ledger: str, checkpoint: str, pattern: str = "*.csv",
                        max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Files of ``landing_dir``, whatever the order of their columns, as loads of Bronze; each content once. Streams that take the same content at the
    same moment may both load it: the ledger is read when a batch starts."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def load(batch: DataFrame, batch_id: int) -> None:
        load_files(batch, batch_id, stream_id(batch), bronze_dir, ledger)
    # contents are not read here: a file's content would have to fit into a task
    w = reader.load(landing_dir).select("path", "length").writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
