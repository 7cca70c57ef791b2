"""The registered queries: every report and operator over the driver tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and runs over the whole tables.
As in the reference's layered design, the layers are materialised once per
session - lineitem -> raw measurements (Bronze) -> Silver -> Gold, each written
as Parquet in the shared checkpoint folder - and every operator reads the
layer it consumes: cleaning and quarantine read Bronze, the daily aggregate
reads Silver, the reports read Gold. The report date is the latest Gold date.
"""

from __future__ import annotations

import datetime
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.operators import checks, clean
from airshed.operators.gold import daily_gold
from airshed.plans import (calendar_reports as cal, compliance, forecast, levels, locations,
                           quality, runs as runmon, stats, summary)
from airshed.session import scratch_path
from airshed.sources import adapter
from airshed.sources.tables import read_table
from airshed.schema import GOLD_KEYS
from airshed.sources.layers_io import (BATCH_LOAD, LOAD, MONTH, move_files, read_by_month, refresh_table, remove_folder,
                                       write_by_month, write_layer)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw measurement rows from the driver tables (lazy)."""
    return adapter.raw_measurements(spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as one lazy plan from the driver tables (nothing written)."""
    return clean.to_silver(raw(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold as one lazy plan from the driver tables (nothing written)."""
    return daily_gold(silver(spark, sf_dir))


@dataclass(frozen=True)
class LayerTables:
    bronze: str
    silver: str
    gold: str


_LAYERS: dict[tuple[str, str], LayerTables] = {}


def layer_tables(spark: SparkSession, sf_dir: str) -> LayerTables:
    """Write Bronze, Silver and Gold for ``sf_dir`` once per session.

    Each layer is written from the one below, read back (the written table
    is the lineage cut: a lost executor recomputes nothing upstream of it).
    Silver and Gold lie in month folders and are sorted by date inside: a
    report's last-N-days filter skips the older files by their date statistics.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    t = _LAYERS.get(key)
    if t is None:
        root = scratch_path(spark, f"layers-{uuid.uuid4().hex[:12]}")
        t = LayerTables(*(os.path.join(root, n) for n in ("bronze", "silver", "gold")))
        write_layer(raw(spark, sf_dir), t.bronze)
        write_by_month(clean.to_silver(spark.read.parquet(t.bronze)), t.silver, ["date"], BATCH_LOAD)
        write_by_month(daily_gold(read_by_month(spark, t.silver)), t.gold, list(GOLD_KEYS))
        _LAYERS[key] = t
    return t


_SCANS: dict[str, DataFrame] = {}
_REPORT_DATES: dict[str, object] = {}


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """The session's layer tables are written once and never changed, so each
    scan (file listing, footer schema) is resolved once and reused."""
    df = _SCANS.get(path)
    if df is None:
        df = _SCANS[path] = spark.read.parquet(path).drop(MONTH, LOAD)
    return df


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, layer_tables(spark, sf_dir).bronze)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, layer_tables(spark, sf_dir).silver)


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, layer_tables(spark, sf_dir).gold)


def report_date(g: DataFrame):
    """Latest Gold date as a literal, so the reports' date filters are pushed
    into the Gold scan. One global aggregate reading only the date column
    (partial max per task, one value to the driver)."""
    return g.agg(F.max("date")).first()[0]


def gold_report_date(spark: SparkSession, sf_dir: str):
    """Latest date of the session's Gold table (computed once per table)."""
    path = layer_tables(spark, sf_dir).gold
    if path not in _REPORT_DATES:
        _REPORT_DATES[path] = report_date(gold_table(spark, sf_dir))
    return _REPORT_DATES[path]


def _report(fn, **kw):
    """Wrap a report that takes (gold, as_of=...) with as_of = max(date)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(gold_table(spark, sf_dir), as_of=gold_report_date(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    return run


def _plain(fn, **kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(gold_table(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    return run


def _runs(fn, **kw):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(adapter.run_history(spark, sf_dir), **kw)
    run.__name__ = fn.__name__
    return run


_CSV_DIRS: dict[tuple[str, str], str] = {}


def landing_csv(spark: SparkSession, sf_dir: str) -> str:
    """The raw measurement rows as CSV files with a header (a landing folder),
    written once per session from Bronze."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _CSV_DIRS.get(key)
    if path is None:
        path = scratch_path(spark, f"landing-{uuid.uuid4().hex[:12]}")
        bronze_table(spark, sf_dir).write.option("header", True).csv(path)
        _CSV_DIRS[key] = path
    return path


def _csv_ingest_rows(spark, sf_dir):
    """CSV landing folder -> typed raw rows, bound by header name (S1), with
    the file name of each row (S2) dropped for the comparison."""
    from airshed.sources.csv_ingest import read_raw_csv
    return read_raw_csv(spark, os.path.join(landing_csv(spark, sf_dir), "*.csv")).drop("source_file")


def _gold_daily(spark, sf_dir):
    return daily_gold(silver_table(spark, sf_dir))


def _clean_rows(spark, sf_dir):
    return clean.to_silver(bronze_table(spark, sf_dir))


def _reject_counts(spark, sf_dir):
    return clean.reject_counts(bronze_table(spark, sf_dir))


def _quarantine_rows(spark, sf_dir):
    q = clean.to_quarantine(bronze_table(spark, sf_dir))
    return q.withColumn(clean.REJECT_REASONS, F.array_join(clean.REJECT_REASONS, ","))


def _layer_reconciliation(spark, sf_dir):
    b = bronze_table(spark, sf_dir)
    return checks.reconcile(b, silver_table(spark, sf_dir), clean.to_quarantine(b),
                            gold_table(spark, sf_dir))


def _aggregate_violations(spark, sf_dir):
    return checks.aggregate_violations(gold_table(spark, sf_dir))


def _dedupe(spark, sf_dir):
    return silver_table(spark, sf_dir).dropDuplicates()


def _silver_retention(spark, sf_dir):
    from airshed.sources.incremental import retention_split
    s = silver_table(spark, sf_dir)
    # the latest Silver date is a scalar subquery: no job runs while the plan is built
    keep, _ = retention_split(s, days=365, as_of=s.agg(F.max("date")).scalar())
    return keep


def _silver_expired(spark, sf_dir):
    from airshed.sources.incremental import retention_split
    s = silver_table(spark, sf_dir)
    return retention_split(s, days=365, as_of=s.agg(F.max("date")).scalar())[1]


def _monthly_summary_table(spark, sf_dir):
    path = scratch_path(spark, "monthly_summary")
    return refresh_table(spark, levels.monthly_levels(gold_table(spark, sf_dir)), path)


def _ordered_reports(spark, sf_dir):
    """The order of every report that has one: report, position and key of each row."""
    from functools import reduce
    from airshed.plans.order import REPORT_ORDER, report_positions
    root = scratch_path(spark, f"ordered-{uuid.uuid4().hex[:12]}")
    return reduce(DataFrame.unionByName, [report_positions(QUERIES[n](spark, sf_dir), n, os.path.join(root, n)) for n in REPORT_ORDER])


def _gold_refreshed(spark, sf_dir):
    """Gold written from about half of Silver's rows of each month, then all months refreshed in place from the whole."""
    from airshed.sources.incremental import refresh_gold, touched_months
    silver_path = layer_tables(spark, sf_dir).silver
    path = scratch_path(spark, f"gold-refreshed-{uuid.uuid4().hex[:12]}")
    s = read_by_month(spark, silver_path)
    half = F.pmod(F.xxhash64("date", "location", "pollutant_type", "value"), F.lit(2)) == 0
    write_by_month(daily_gold(s.filter(half)), path, list(GOLD_KEYS))
    refresh_gold(spark, silver_path, touched_months(s), path)
    return read_by_month(spark, path)


def _incremental_load(spark, sf_dir):
    """Two loads of one run date by mark, up to the middle of 1998 and then the rest; Gold as after one full load."""
    from airshed.layers import LayerPaths, run_incremental
    root = scratch_path(spark, f"incremental-{uuid.uuid4().hex[:12]}")
    paths, marks, rows = LayerPaths(root), os.path.join(root, "marks"), bronze_table(spark, sf_dir)
    run_date = datetime.date(1998, 12, 31)
    run_incremental(spark, paths, rows, marks, as_of="1998-06-17", run_date=run_date)
    run_incremental(spark, paths, rows, marks, as_of="2099-12-31", run_date=run_date)
    return read_by_month(spark, paths.gold)


def _incremental_late_rows(spark, sf_dir):
    """Three loads of a source that changes: months that arrive late, values corrected later, rows delivered twice and withdrawn; Gold as after one
    full load of the last state."""
    from airshed.layers import LayerPaths
    from airshed.sources.fingerprints import sync_layers
    root = scratch_path(spark, f"late-rows-{uuid.uuid4().hex[:12]}")
    paths, ledger, rows = LayerPaths(root), os.path.join(root, "fingerprints"), bronze_table(spark, sf_dir)
    late = F.col("date").between("1995-02-01", "1995-05-31") & (F.col("location") < "J")
    wrong = F.col("date").between("1996-07-01", "1996-07-31")
    twice = rows.filter(F.col("date").between("1997-03-01", "1997-03-31") & (F.col("value") > 30))
    early = rows.withColumn("value", F.when(wrong, F.col("value") + 1000).otherwise(F.col("value"))).filter(F.coalesce(~late, F.lit(True)))
    run_date = datetime.date(1998, 12, 31)
    for state in (early.unionByName(twice), early, rows):
        sync_layers(spark, paths, state, ledger, as_of="2099-12-31", run_date=run_date)
    return read_by_month(spark, paths.gold)


#: Repairs of the registered replay: the sign of negative values is dropped, coordinates beyond the poles or the date line go to these.
def _repairs():
    from airshed.sources.replay import Repair
    return [Repair("value_negative", "value", F.abs("value")),
            Repair("latitude_out_of_range", "latitude", F.greatest(F.lit(-90.0), F.least(F.lit(90.0), "latitude"))),
            Repair("longitude_out_of_range", "longitude", F.greatest(F.lit(-180.0), F.least(F.lit(180.0), "longitude")))]


def _replayed(spark, sf_dir):
    """The layers of a full run whose quarantine has been replayed twice with the same repairs."""
    from airshed.layers import LayerPaths, write_bronze, write_gold, write_silver
    from airshed.sources.replay import replay_quarantine
    root = scratch_path(spark, f"replayed-{uuid.uuid4().hex[:12]}")
    paths, ledger = LayerPaths(root), os.path.join(root, "replays")
    write_bronze(spark, bronze_table(spark, sf_dir), paths.bronze)
    write_silver(spark, paths.bronze, paths.silver, paths.quarantine, datetime.date(1998, 12, 31))
    write_gold(spark, paths.silver, paths.gold)
    for _ in range(2):
        replay_quarantine(spark, paths, _repairs(), ledger, "signs-and-bounds")
    return paths


def _replayed_quarantine(spark, sf_dir):
    """Gold after the replay."""
    return read_by_month(spark, _replayed(spark, sf_dir).gold)


def _replay_leftovers(spark, sf_dir):
    """What the replay leaves in quarantine, with its reasons."""
    left = clean.REJECT_REASONS
    q = spark.read.parquet(_replayed(spark, sf_dir).quarantine)
    return q.drop("run_date", LOAD, "ingestion_timestamp", "source_file").withColumn(left, F.array_join(left, ","))


def _expired_layers(spark, sf_dir):
    """What 90 days of Bronze and 365 days of Silver leave, at noon of the report date. Rows arrived on their date (before July 1998: on the
    first of its month, without a date: on the report date), at the hour that is the day of the month."""
    from airshed.sources.retention import expire_bronze, expire_months_exactly, write_by_arrival
    root, day = scratch_path(spark, f"expired-{uuid.uuid4().hex[:12]}"), clean.parse_date("date")
    bronze, silver_path, as_of = os.path.join(root, "bronze"), os.path.join(root, "silver"), gold_report_date(spark, sf_dir)
    arrived = F.coalesce(F.when(day < "1998-07-01", F.trunc(day, "month")).otherwise(day), F.lit(as_of))
    hour = F.make_dt_interval(hours=F.coalesce(F.dayofmonth(day) % 24, F.lit(0)))
    rows = bronze_table(spark, sf_dir).withColumn("ingestion_timestamp", arrived.cast("timestamp") + hour)
    early = F.coalesce(F.col("latitude") < 0, F.lit(False))
    write_by_arrival(rows.filter(early), bronze, "south")
    write_by_arrival(rows.filter(~early), bronze, "north")
    write_by_month(silver_table(spark, sf_dir), silver_path, ["date"], BATCH_LOAD)
    expire_bronze(spark, bronze, 90, datetime.datetime.combine(as_of, datetime.time(12)))
    expire_months_exactly(spark, silver_path, 365, as_of)
    left = spark.read.parquet(bronze).select(F.lit("bronze").alias("layer"), F.to_date("ingestion_timestamp").alias("day"), "location", "pollutant_type", "value")
    kept = read_by_month(spark, silver_path).select(F.lit("silver").alias("layer"), F.col("date").alias("day"), "location", "pollutant_type", "value")
    return left.unionByName(kept)


def _drifted_bronze(spark, sf_dir):
    """Three loads of Bronze: the second gains a column and has another's numbers longer, the third lacks a column and has them with fractions."""
    from airshed.sources.schema_ledger import read_loads, write_load
    root, b = scratch_path(spark, f"drifted-{uuid.uuid4().hex[:12]}"), bronze_table(spark, sf_dir)
    path, ledger = os.path.join(root, "bronze"), os.path.join(root, "schemas")
    value, humidity = F.col("value"), (F.col("value") + 20).alias("humidity")
    write_load(spark, b.filter("date < '1994'").select("*", value.cast("int").alias("reading")), path, ledger, "first")
    write_load(spark, b.filter("date >= '1994' AND date < '1997'").select(humidity, "*", value.cast("long").alias("reading")), path, ledger, "second")
    write_load(spark, b.filter("date >= '1997'").select("*", humidity, (value / 2).alias("reading")).drop("unit"), path, ledger, "third")
    return read_loads(spark, path, ledger)


def _csv_mixed_headers(spark, sf_dir):
    """The raw rows as CSV files of two header orders in one landing folder, read in one call."""
    from airshed.sources.csv_ingest import read_raw_csv
    path = scratch_path(spark, f"mixed-headers-{uuid.uuid4().hex[:12]}")
    b = bronze_table(spark, sf_dir)
    south = F.coalesce(F.col("latitude") < 0, F.lit(False))
    b.filter(south).write.option("header", True).csv(path)
    b.filter(~south).select(*reversed(b.columns)).write.mode("append").option("header", True).csv(path)
    return read_raw_csv(spark, os.path.join(path, "*.csv")).drop("source_file").select(*b.columns)


def _extra_rule_counts(spark, sf_dir):
    """Reject counts with a rule on a column that Bronze does not declare (text, as an undeclared CSV column)."""
    b = bronze_table(spark, sf_dir).withColumn("humidity", (F.col("value") + 20).cast("string"))
    return clean.reject_counts(b, clean.default_rules() + [clean.range_rule("humidity", 0, 100)])


def _violations_found(spark, sf_dir):
    """Gold with a fault in the first day of each month: min above max."""
    g = gold_table(spark, sf_dir)
    bad = F.when(F.dayofmonth("date") == 1, F.col("max_value") + 1).otherwise(F.col("min_value"))
    return checks.aggregate_violations(g.withColumn("min_value", bad))


def _schema_problems(spark, sf_dir):
    """Bronze without a declared column, with one as text and one too many, against its schema."""
    from airshed.schema import RAW_SCHEMA
    b = bronze_table(spark, sf_dir)
    changed = b.drop("zone").withColumn("value", F.col("value").cast("string")).withColumn("humidity", F.lit(1))
    return checks.schema_diff(spark, changed.schema, RAW_SCHEMA).crossJoin(
        changed.agg(F.count("*").alias("rows")))


def _finished(query):
    query.awaitTermination()
    return query


def _stream_paths(spark, name):
    root = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    return [os.path.join(root, x) for x in ("in", "out", "state", "gold")]


def _stream_bronze_rows(spark, sf_dir):
    """The landing folder streamed into Bronze (T1), with the metadata columns (S2) checked per row."""
    from airshed.streaming.landing import start_landing_to_bronze
    _, out, state, _ = _stream_paths(spark, "stream-bronze")
    _finished(start_landing_to_bronze(spark, landing_csv(spark, sf_dir), out, state))
    b = spark.read.parquet(out)
    known = F.col("source_file").endswith(".csv") & F.col("ingestion_timestamp").isNotNull()
    return b.withColumn("has_metadata", known).drop("ingestion_timestamp", "source_file")


def _land(spark, sf_dir, landed, columns, south):
    """The southern or the other rows as CSV files, each time the same ones under new names."""
    b = bronze_table(spark, sf_dir)
    part = F.coalesce(F.col("latitude") < 0, F.lit(False)) == south
    rows = b.filter(part).repartition(8, "location", "date", "pollutant_type", "value").sortWithinPartitions(*b.columns).select(*columns)
    rows.write.mode("append").option("header", True).csv(landed)


def _stream_mixed_headers(spark, sf_dir):
    """Files of two header orders streamed into one Bronze (T1), two files a micro-batch."""
    from airshed.streaming.landing import start_landing_loads
    landed, out, state, ledger = _stream_paths(spark, "stream-mixed")
    columns = bronze_table(spark, sf_dir).columns
    _land(spark, sf_dir, landed, columns, True)
    _land(spark, sf_dir, landed, columns[::-1], False)
    _finished(start_landing_loads(spark, landed, out, ledger, state, max_files_per_trigger=2))
    return spark.read.parquet(out).select(*columns)


def _stream_redelivered(spark, sf_dir):
    """Every file delivered twice under unlike names (T4), over two runs of the stream: the second run has the other half of the first and all once more."""
    from airshed.streaming.landing import start_landing_loads
    landed, out, state, ledger = _stream_paths(spark, "stream-redelivered")
    columns = bronze_table(spark, sf_dir).columns
    for parts in ((True, True), (False, True, False)):
        for south in parts:
            _land(spark, sf_dir, landed, columns, south)
        _finished(start_landing_loads(spark, landed, out, ledger, state, max_files_per_trigger=4))
    return spark.read.parquet(out).select(*columns)


def _stream_gold(spark, sf_dir):
    """Bronze streamed into Silver and Gold (T2), in two runs of the stream."""
    from airshed.sources.csv_ingest import to_bronze
    from airshed.streaming.gold_refresh import start_bronze_to_gold
    landed, out, state, gold_path = _stream_paths(spark, "stream-gold")
    b = to_bronze(bronze_table(spark, sf_dir))
    late = F.coalesce(F.col("latitude") < 0, F.lit(False))
    for part in (b.filter(~late), b.filter(late)):
        part.write.mode("append").parquet(landed)
        _finished(start_bronze_to_gold(spark, landed, out, gold_path, state))
    return read_by_month(spark, gold_path)


def _bronze_in_parts(spark, sf_dir, of):
    """Bronze with its ``part`` of ``of`` equal shares by a hash of the row."""
    from airshed.sources.csv_ingest import to_bronze
    share = F.pmod(F.xxhash64("date", "location", "pollutant_type", "value", "latitude"), F.lit(of))
    return to_bronze(bronze_table(spark, sf_dir)).withColumn("part", share.cast("int"))


def _stream_gold_delta(spark, sf_dir):
    """Bronze folded into one Gold by two streams with checkpoints of their own, a file a micro-batch; the first stream goes on after the
    second has run, and then loses its last commit, so that its last batch is given again."""
    from airshed.streaming.gold_delta import start_bronze_to_gold_deltas
    landed, state, checkpoints, gold_path = _stream_paths(spark, "stream-gold-delta")
    # all parts are written side by side, one file each in row groups for several tasks, and put into the streams' folders when it is their turn
    parts_of_6 = _bronze_in_parts(spark, sf_dir, 6).repartitionById(6, "part")
    parts_of_6.write.option("parquet.block.size", 16 << 20).partitionBy("part").parquet(f"{landed}/parts")
    for stream, parts in (("a", (0, 1)), ("b", (2, 3)), ("a", (4, 5))):
        folder, checkpoint = f"{landed}/{stream}", f"{checkpoints}/{stream}"
        for part in parts:
            move_files(spark, f"{landed}/parts/part={part}", folder)
        run = lambda f=folder, c=checkpoint: _finished(start_bronze_to_gold_deltas(spark, f, state, gold_path, c, max_files_per_trigger=1))
        run()
    remove_folder(spark, f"{checkpoints}/a/commits/3")
    run()
    return read_by_month(spark, gold_path)


def _stream_two_checkpoints(spark, sf_dir):
    """Two streams with checkpoints of their own over one Silver (T2): neither takes the other's rows for its own."""
    from airshed.streaming.gold_refresh import start_bronze_to_gold
    landed, out, state, gold_path = _stream_paths(spark, "stream-two")
    for part in (0, 1):
        _bronze_in_parts(spark, sf_dir, 2).filter(F.col("part") == part).drop("part").write.parquet(f"{landed}/{part}")
        _finished(start_bronze_to_gold(spark, f"{landed}/{part}", out, gold_path, f"{state}/{part}"))
    return read_by_month(spark, out).drop("ingestion_timestamp", "source_file")


def _events_in_parts(spark, sf_dir, parts=4):
    """The events in ``parts`` spans of time, one after the other, each as a frame of one file."""
    ev = read_table(spark, sf_dir, "events")
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / parts
    for k in range(parts):
        begins = F.lit(True) if k == 0 else F.col("ts") >= F.lit(first + k * step)
        yield ev.filter(begins & (F.lit(True) if k == parts - 1 else F.col("ts") < F.lit(first + (k + 1) * step))).coalesce(1)


def _stream_dedupe(spark, sf_dir):
    """Events delivered twice, the second time in a later run of the stream, through the duplicate suppression (T4)."""
    from airshed.streaming import alerts
    landed, out, state, _ = _stream_paths(spark, "stream-dedupe")
    for part in _events_in_parts(spark, sf_dir):
        for _ in range(2):
            part.write.mode("append").parquet(landed)
            runs = alerts.drop_duplicate_runs(alerts.runs_stream(spark, landed))
            _finished(runs.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out))
    return spark.read.parquet(out).select("pipeline_name", "status", "event_id")


def _stream_failure_windows(spark, sf_dir):
    """Sliding failure windows (T3) of the event stream over four runs, whole counts after each micro-batch."""
    from airshed.streaming import alerts
    landed, out, state, _ = _stream_paths(spark, "stream-windows")
    for part in _events_in_parts(spark, sf_dir):
        part.write.mode("append").parquet(landed)
        windows = alerts.failure_alerts(alerts.runs_stream(spark, landed))
        _finished(windows.writeStream.outputMode("complete").option("checkpointLocation", state).trigger(availableNow=True)
                  .foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(out)).start())
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    return spark.read.parquet(out).select(*ntz, "failed_runs")


def _appended(spark, sf_dir, name, make):
    """What ``make(runs)`` emits in append mode over five micro-batches; the last is one failure a day after all others, by which the watermark
    passes them, and what it opens itself is never final."""
    from airshed.streaming import alerts
    landed, out, state, _ = _stream_paths(spark, name)
    ev = read_table(spark, sf_dir, "events")
    for part in _events_in_parts(spark, sf_dir):
        part.write.mode("append").parquet(landed)
    end = ev.agg(F.max("ts").alias("ts")).select(F.lit(-1).cast("long").alias("event_id"), (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"),
                                                 F.lit(-1).cast("long").alias("user_id"), F.lit("error").alias("event_type"), F.lit(0.0).alias("value"))
    end.coalesce(1).write.mode("append").parquet(landed)
    emitted = make(alerts, landed)
    _finished(emitted.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out))
    return spark.read.parquet(out)


def _stream_failure_windows_final(spark, sf_dir):
    """Sliding failure windows in append mode: each once, when the watermark has passed its end."""
    out = _appended(spark, sf_dir, "stream-windows-final", lambda alerts, landed: alerts.failure_alerts(alerts.runs_stream(spark, landed, max_files_per_trigger=1)))
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "failed_runs")


def _alert_episodes(spark, sf_dir):
    """Alerts of three pipelines (the events of a third of the users each) from their first failure until five quiet minutes have passed."""
    name = F.concat(F.lit("pipeline-"), (F.col("user_id") % 3).cast("string"))
    out = _appended(spark, sf_dir, "alert-episodes", lambda alerts, landed: alerts.alert_episodes(alerts.runs_stream(spark, landed, name, 1)))
    return out.select("pipeline_name", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("opened_at", "last_failure", "closed_at")], "failed_runs")


def _rolling_stats(spark, sf_dir):
    return stats.rolling_stats(gold_table(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # the 21 reports
    "quality_summary": _report(quality.quality_summary),
    "location_coverage": _plain(quality.location_coverage),
    "missing_series_days": _report(quality.missing_series_days),
    "missing_series_runs": _plain(quality.missing_series_runs),
    "current_levels": _plain(levels.current_levels),
    "daily_trend": _report(levels.daily_trend),
    "top_exceedances": _plain(levels.top_exceedances),
    "monthly_levels": _plain(levels.monthly_levels),
    "location_ranking": _report(locations.location_ranking),
    "zone_comparison": _report(locations.zone_comparison),
    "location_scorecard": _report(locations.location_scorecard),
    "anomalies": _report(stats.anomalies),
    "percentile_profile": _report(stats.percentile_profile),
    "percentile_profile_literal": _report(stats.percentile_profile, collapse=False),
    "weekday_pattern": _report(cal.weekday_pattern),
    "seasonal_levels": _plain(cal.seasonal_levels),
    "month_over_month": _plain(cal.month_over_month),
    "days_over_limit": _report(compliance.days_over_limit),
    "compliance_status": _report(compliance.compliance_status),
    "volatility": _report(forecast.volatility),
    "trend_slope": _report(forecast.trend_slope),
    "executive_summary": _report(summary.executive_summary),
    "monthly_compliance": _plain(compliance.monthly_compliance),
    # guide and quick-start queries
    "health_alerts": _report(levels.health_alerts),
    "quarter_audit": _report(compliance.quarter_audit),
    "policy_weekday_compare": _report(cal.policy_weekday_compare),
    "sensor_failure_candidates": _plain(stats.sensor_failure_candidates),
    "latest_status": _plain(levels.latest_status),
    "recent_levels": _report(levels.recent_levels),
    "monthly_summary_table": _monthly_summary_table,
    "ordered_reports": _ordered_reports,
    # run-history monitoring
    "run_failure_rate": _runs(runmon.run_failure_rate),
    "run_failure_rate_any": _runs(runmon.run_failure_rate, alert_percent=0.0),
    "circuit_breaker": _runs(runmon.circuit_breaker),
    "failure_windows": _runs(runmon.failure_windows),
    # layers and data-quality operators
    "csv_ingest_rows": _csv_ingest_rows,
    "gold_daily": _gold_daily,
    "clean_rows": _clean_rows,
    "reject_counts": _reject_counts,
    "quarantine_rows": _quarantine_rows,
    "layer_reconciliation": _layer_reconciliation,
    "aggregate_violations": _aggregate_violations,
    "aggregate_violations_found": _violations_found,
    "extra_rule_counts": _extra_rule_counts,
    "schema_problems": _schema_problems,
    "gold_refreshed": _gold_refreshed,
    "incremental_load": _incremental_load,
    "incremental_late_rows": _incremental_late_rows,
    "expired_layers": _expired_layers,
    "drifted_bronze": _drifted_bronze,
    "replayed_quarantine": _replayed_quarantine,
    "replay_leftovers": _replay_leftovers,
    "csv_mixed_headers": _csv_mixed_headers,
    "silver_expired": _silver_expired,
    # streams, run to the end of their input and read back
    "stream_bronze_rows": _stream_bronze_rows,
    "stream_gold": _stream_gold,
    "stream_mixed_headers": _stream_mixed_headers,
    "stream_redelivered": _stream_redelivered,
    "stream_gold_delta": _stream_gold_delta,
    "stream_two_checkpoints": _stream_two_checkpoints,
    "stream_dedupe": _stream_dedupe,
    "stream_failure_windows": _stream_failure_windows,
    "stream_failure_windows_final": _stream_failure_windows_final,
    "alert_episodes": _alert_episodes,
    "dedupe_rows": _dedupe,
    "silver_retention": _silver_retention,
    "rolling_stats": _rolling_stats,
}
