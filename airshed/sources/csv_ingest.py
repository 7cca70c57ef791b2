"""Raw CSV -> Bronze: typed columns bound by header name, metadata columns."""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.functions import labels as L
from airshed.schema import RAW_FIELDS
from airshed.sources.layers_io import _is_missing_path, write_layer

_TYPES = dict(RAW_FIELDS)


def _na_to_null(c: Column) -> Column:
    """Map the NA tokens to NULL in a text column."""
    return F.when(c.isin(*L.NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def _to_double(name: str) -> Column:
    """Text -> DOUBLE; a token that is neither NA nor a number fails the job
    (raise_error inside the projection: checked row by row in the same pass)."""
    tok = _na_to_null(F.col(name))
    # a trailing d or f is a literal's suffix to Spark's parser, not part of a number
    num = F.when(~tok.rlike(r"[0-9.][dDfF]$"), tok.try_cast("double"))
    return F.when(tok.isNotNull() & num.isNull(),
                  F.raise_error(F.concat(F.lit(f"could not convert to float in column {name}: "), tok))
                  ).otherwise(num)


def typed_raw(text: DataFrame, strict: bool = True) -> DataFrame:
    """All-string CSV rows -> declared types, by column *name*.

    Declared columns are typed (numbers via ``try_cast``, NA tokens to NULL);
    undeclared columns are kept as text, as the reference keeps them. With
    ``strict`` a missing declared column raises ValueError.
    """
    missing = [n for n in _TYPES if n not in text.columns]
    if missing and strict:
        raise ValueError(f"CSV lacks required columns: {missing}")
    cols = []
    for name in text.columns:
        dtype = _TYPES.get(name)
        if dtype is not None and dtype.typeName() == "double":
            cols.append(_to_double(name).alias(name))
        else:
            cols.append(_na_to_null(F.col(name)).alias(name))
    return text.select(*cols)


def _files_by_header(spark: SparkSession, paths) -> list[list[str]]:
    """The input files, grouped by their header line. Headers are read as a
    distributed text scan (the first line of each file's first block); file names
    reach the driver, which lists them for the scan anyway."""
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("line"))
    headers = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    groups: dict[str, list[str]] = {}
    for r in headers.collect():
        groups.setdefault(r["header"].lstrip("\ufeff").rstrip("\r"), []).append(r["file"])
    return [sorted(files) for _, files in sorted(groups.items())]


def read_raw_csv(spark: SparkSession, paths, strict: bool = True, multi_line: bool = False) -> DataFrame:
    """Read one or many CSV files (a path, a glob or a list) with a header.

    Every column is text and bound by the header name of its own file: files are read in groups
    of equal headers and combined by name, so files may order their columns differently; a column that a file lacks is NULL in its rows
    (a declared one raises with ``strict``). ``source_file`` is the base name of
    the file each row came from. ``multi_line`` accepts line breaks inside quotes, at
    the price of one task for each file.
    """
    try:
        groups = _files_by_header(spark, paths)
    except AnalysisException as e:
        if _is_missing_path(e):
            raise FileNotFoundError(f"no CSV file at {paths}") from e
        raise
    df = read_csv_groups(spark, groups, strict, multi_line)
    if df is None:
        raise ValueError(f"no rows and no header in {paths}")
    return df


def read_csv_groups(spark: SparkSession, groups: list[list[str]], strict: bool = True, multi_line: bool = False) -> DataFrame | None:
    """Typed rows of groups of CSV files, the files of a group having one header; combined by name. None where no file has one."""
    frames = []
    for files in groups:
        text = (spark.read.option("header", True).option("mode", "FAILFAST").option("multiLine", multi_line)
                .option("encoding", "UTF-8").csv(files))
        if text.columns:
            frames.append(typed_raw(text, strict).withColumn("source_file", F.col("_metadata.file_name")))
    if not frames:
        return None
    df = frames[0]
    for other in frames[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    return df.select(*[c for c in df.columns if c != "source_file"], "source_file")


def to_bronze(raw: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Add ``ingestion_timestamp`` (one literal per run) after the raw columns,
    then ``source_file`` last."""
    run_ts = run_ts or _dt.datetime.now()
    cols = [c for c in raw.columns if c != "source_file"]
    src = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    return raw.select(*cols, F.lit(run_ts).cast("timestamp").alias("ingestion_timestamp"),
                      src.alias("source_file"))


def ingest_csv(spark: SparkSession, input_path, output_path: str, strict: bool = True) -> DataFrame:
    """CSV -> Bronze Parquet. Raises FileNotFoundError for a missing input and
    ValueError for an empty one (zero bytes or header only). Returns the
    Bronze DataFrame read back from what was written."""
    raw = read_raw_csv(spark, input_path, strict)
    if raw.isEmpty():
        raise ValueError(f"no rows in {input_path}")
    write_layer(to_bronze(raw), output_path)
    return spark.read.parquet(output_path)
