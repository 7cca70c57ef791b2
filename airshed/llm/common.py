"""Helpers shared by the corpus operators."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.session import scratch_path
from airshed.sources.tables import read_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared scratch folder."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


_OPEN: list[list[DataFrame]] = []


@contextmanager
def scratch_tables() -> Iterator[None]:
    """Removes, at its end, the tables that ``written`` made inside it. What reads them has to be written before, outside of them: see ``settled``."""
    _OPEN.append([])
    try:
        yield
    finally:
        for df in _OPEN.pop():
            forget(df)


def settled(make, name: str) -> DataFrame:
    """The table that ``make`` returns, written; the tables that were written on the way to it are removed."""
    with scratch_tables():
        out = written(make(), name)
        _OPEN[-1].remove(out)
    for around in _OPEN[-1:]:
        around.append(out)
    return out


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The written table cuts the lineage: a lost executor recomputes nothing
    above it, and what is numbered or sampled in it keeps its value however
    often it is read. The shuffle files of the finished write are of no further use;
    Spark removes them once the driver has collected its garbage, which is asked for here, so that
    an operator of many steps holds the shuffle of one step at a time. The listeners hold the last event, the
    write's end with its plan and shuffles, until a next one comes: that of a job without tasks, for which they get a moment.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    spark.sparkContext._jsc.emptyRDD().count()
    time.sleep(0.1)
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    for inside in _OPEN[-1:]:
        inside.append(out)
    return out


def forget(df: DataFrame) -> None:
    """Remove the files of a table that ``written`` made, once everything that reads it has been written too."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators read, under fixed names. Further columns
    of the input, whatever their names, are left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def slices(n: int, step: int) -> Iterator[tuple[int, int]]:
    for at in range(0, n, step):
        yield at, min(n, at + step)
