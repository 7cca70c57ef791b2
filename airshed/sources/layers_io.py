"""Layer sinks and scans: Parquet (Snappy), guards, the month layout, tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Silver and Gold, however they are written (batch run, refresh, stream), lie in
# one folder per calendar month; Silver has a folder per load below it.
MONTH = "month"
LOAD = "load_id"
BATCH_LOAD = "batch"


def month_of(date: Column | str) -> Column:
    """The month folder of a date: year * 100 + month."""
    return F.year(date) * 100 + F.month(date)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None, merge: bool = False) -> DataFrame:
    """Parquet scan of a layer; a missing path raises FileNotFoundError and a
    layer without rows (or without columns) raises ValueError.

    The emptiness test is ``isEmpty()`` - a one-row job, not a count. With ``merge`` the columns are those of
    all files (their footers are read in tasks), else those of one.
    """
    try:
        df = spark.read.option("mergeSchema", merge).parquet(path)
        if not df.columns:
            raise ValueError(f"layer has no columns: {path}")
        if schema is not None:
            df = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if _is_missing_path(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        raise
    if df.isEmpty():
        raise ValueError(f"layer is empty: {path}")
    return df


def _is_missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Snappy Parquet; overwrite replaces the layer as a whole (idempotent
    reruns). Parent folders are created by the writer."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic partition overwrite, an
    option of this write alone): idempotent reruns of one day or one micro-batch."""
    (df.write.mode("overwrite").option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_by_month(df: DataFrame, path: str, order: list[str], load_id: str | None = None,
                   replace_months: bool = False) -> None:
    """Write a layer with a ``date`` column into month folders.

    Rows are rebalanced by month first, so a month goes to one file or, when it
    is large, to as many as adaptive execution splits it into; files are sorted
    by ``order``, which gives tight date statistics. The whole layer is replaced, or
    with ``replace_months`` only the folders that ``df`` has rows for. A target that
    holds files of another layout is refused: a reader would miss one of the two.
    """
    parts = [MONTH] + ([LOAD] if load_id is not None else [])
    d = df.drop(MONTH, LOAD).withColumn(MONTH, month_of("date"))
    if load_id is not None:
        d = d.withColumn(LOAD, F.lit(load_id))
    d = d.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, *order)
    if replace_months:
        _refuse_other_layout(df.sparkSession, path)
        write_partitions(d, path, parts)
    else:
        write_layer(d, path, parts)


def read_by_month(spark: SparkSession, path: str, months: list[int] | None = None) -> DataFrame:
    """A layer written by ``write_by_month`` without its folder columns; with
    ``months``, only those folders are read."""
    df = spark.read.parquet(path)
    if months is not None:
        df = df.filter(F.col(MONTH).isin(months))
    return df.drop(MONTH, LOAD)


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def drop_partition(spark: SparkSession, path: str, name: str, value, *below) -> None:
    """Remove one partition folder of a layer, where it exists; ``below`` goes on with the
    name and value of a folder inside it."""
    p, fs = _path(spark, "/".join([path, partition_folder(spark, name, value), *(partition_folder(spark, *x) for x in zip(below[::2], below[1::2], strict=True))]))
    if fs.exists(p):
        fs.delete(p, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none where it is missing."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with what it holds, where it exists."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _path(spark, path)
    if not fs.rename(p, _path(spark, to)[0]):
        raise OSError(f"{path} could not be renamed to {to}")


def move_files(spark: SparkSession, path: str, to: str) -> None:
    """Move the files of a folder, where it exists, into another, which is made; they keep their names."""
    p, fs = _path(spark, path)
    target = _path(spark, to)[0]
    fs.mkdirs(target)
    for status in fs.listStatus(p) if fs.exists(p) else []:
        if status.isFile() and not fs.rename(status.getPath(), _path(spark, f"{to}/{status.getPath().getName()}")[0]):
            raise OSError(f"{status.getPath()} could not be moved to {to}")


def partition_folder(spark: SparkSession, name: str, value) -> str:
    """The folder name that Spark's writer gives a partition."""
    return f"{name}={spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))}"


def partitions_with_load(spark: SparkSession, path: str, name: str, load_id: str) -> list[str]:
    """The values of the ``name`` folders of a layer that hold a folder of the load."""
    p, fs = _path(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n.partition("=")[2] for n in names if n.startswith(f"{name}=")
                  and fs.exists(_path(spark, f"{path}/{n}/{partition_folder(spark, LOAD, load_id)}")[0]))


def _refuse_other_layout(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    if fs.exists(p):
        for status in fs.listStatus(p):
            name = status.getPath().getName()
            if not name.startswith(("_", ".", f"{MONTH}=")):
                raise ValueError(f"{path} is not laid out in {MONTH} folders (it holds {name})")


def external_table(spark: SparkSession, path: str, name: str = "gold_weather") -> DataFrame:
    """Catalog table over an existing Parquet folder (no copy): the
    ``CREATE EXTERNAL TABLE ... LOCATION`` of a warehouse, in Spark SQL. An external
    table of that name is replaced; a managed one, whose files a replacement would delete, is refused."""
    if not all(part.isidentifier() for part in name.split(".")):
        raise ValueError(f"not a table name: {name}")
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} exists and is not an external table")
        spark.sql(f"DROP TABLE {name}")
    quoted = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{quoted}'")
    if "month" in spark.table(name).columns:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def refresh_table(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Full refresh of a derived table (a materialized summary). Each refresh is
    a folder of its own below ``path``, so a frame of an earlier one stays readable."""
    version = f"{path}/version-{uuid.uuid4().hex}"
    write_layer(df, version)
    return spark.read.parquet(version)
