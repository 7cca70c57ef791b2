"""D2 / S4: loads whose schemas differ, read together by name.

A ledger keeps the schema of every load. Columns are matched by name; a type widens to one that holds both (a whole number to a
longer one or to a double, a float to a double), a column that a load lacks is NULL in its rows, and every other difference is refused
before the load is written. Reading takes the schemas from the ledger: no file is opened to find them.
"""

from __future__ import annotations

import datetime as _dt
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.sources.layers_io import LOAD, partition_folder, path_exists, write_partitions

LEDGER_SCHEMA = "load_id string, schema string, recorded_at timestamp"
#: Types that widen, each to all that follow it.
_WIDER = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType())


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both, or None."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if T.FloatType() in (a, b):
        a, b = (T.DoubleType() if x == T.FloatType() else x for x in (a, b))
    if a in _WIDER and b in _WIDER:
        return _WIDER[max(_WIDER.index(a), _WIDER.index(b))]
    return None


def merged(first: T.StructType, second: T.StructType) -> T.StructType:
    """The columns of both, in the order they came; ValueError names those whose types do not go together."""
    types = {f.name: f.dataType for f in first}
    refused = []
    for f in second:
        both = wider(types.get(f.name, T.NullType()), f.dataType)
        if both is None:
            refused.append(f"{f.name}: {types[f.name].simpleString()} and {f.dataType.simpleString()}")
        types[f.name] = both
    if refused:
        raise ValueError(f"types that do not go together: {', '.join(refused)}")
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def load_schemas(spark: SparkSession, ledger: str) -> dict[str, T.StructType]:
    """The last recorded schema of each load, in the order of the loads' first entries: one row a load reaches the driver."""
    if not path_exists(spark, ledger):
        return {}
    entries = spark.read.schema(LEDGER_SCHEMA).parquet(ledger).orderBy("recorded_at").collect()
    return {e["load_id"]: T.StructType.fromJson(json.loads(e["schema"])) for e in entries}


def write_load(spark: SparkSession, rows: DataFrame, path: str, ledger: str, load_id: str) -> T.StructType:
    """Write a load into a folder of its own and record its schema; returns the schema of all loads together. A load of that name is
    replaced. Nothing is written if the load's types do not go with the others'; a load without rows records its schema too."""
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema if f.name != LOAD])
    others = [s for name, s in load_schemas(spark, ledger).items() if name != load_id]
    together = reduce(merged, [*others, schema])
    write_partitions(rows.drop(LOAD).withColumn(LOAD, F.lit(load_id)), path, [LOAD])
    entry = [(load_id, schema.json(), _dt.datetime.now())]
    spark.createDataFrame(entry, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(ledger)
    return together


def read_loads(spark: SparkSession, path: str, ledger: str, loads: list[str] | None = None) -> DataFrame:
    """All rows of the recorded loads (or of ``loads``) with all their columns and ``load_id``. Loads of one schema are one scan, which reads
    the chosen columns of their folders only; ValueError where nothing is recorded."""
    schemas = {name: s for name, s in load_schemas(spark, ledger).items() if loads is None or name in loads}
    if not schemas:
        raise ValueError(f"no load in {ledger}")
    together = reduce(merged, schemas.values())
    groups: dict[str, list[str]] = {}
    for name, schema in schemas.items():
        groups.setdefault(schema.json(), []).append(name)
    out = None
    for names in groups.values():
        schema = schemas[names[0]]
        folders = [f"{path}/{partition_folder(spark, LOAD, n)}" for n in names]
        own = T.StructType([*schema, T.StructField(LOAD, T.StringType())])
        folders = [f for f in folders if path_exists(spark, f)]
        rows = spark.read.option("basePath", path).schema(own).parquet(*folders) if folders else spark.createDataFrame([], own)
        rows = rows.select(*[(F.col(f"`{f.name}`").cast(f.dataType) if f.name in schema.names else F.lit(None).cast(f.dataType)).alias(f.name) for f in together], LOAD)
        out = rows if out is None else out.unionByName(rows)
    return out
