"""Loads that follow a changing source, replays of quarantine, and Gold by deltas."""

from __future__ import annotations

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from airshed.layers import LayerPaths, write_bronze, write_gold, write_silver
from airshed.operators import clean
from airshed.operators.gold import daily_gold
from airshed.schema import GOLD_KEYS, RAW_COLUMNS, RAW_SCHEMA
from airshed.sources import fingerprints as fp
from airshed.sources.csv_ingest import to_bronze
from airshed.sources.layers_io import read_by_month
from airshed.sources.replay import Repair, replay_quarantine
from airshed.streaming import gold_delta
from airshed.streaming.gold_refresh import start_bronze_to_gold
from tests.conftest import SF_SMALL

RUN_DATE = dt.date(2025, 1, 1)


def row(date, value, location="A", latitude=1.0):
    return (date, location, latitude, 1.0, "urban", "z", "NO2", value, "u", "valid")


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def counted(df, columns=None):
    return Counter(tuple(r) for r in df.select(*(columns or df.columns)).collect())


def expect_state(spark, paths, rows):
    silver = clean.to_silver(raw(spark, rows))
    assert counted(spark.read.parquet(paths.bronze), RAW_COLUMNS) == Counter(rows)
    assert counted(read_by_month(spark, paths.silver), silver.columns) == counted(silver)
    assert counted(spark.read.parquet(paths.quarantine), RAW_COLUMNS) == counted(clean.to_quarantine(raw(spark, rows)), RAW_COLUMNS)
    assert counted(read_by_month(spark, paths.gold), daily_gold(silver).columns) == counted(daily_gold(silver))


FIRST = [row("2024-01-02", 1.0), row("2024-01-02", 1.0), row("2024-01-05", 1.5), row("2024-02-03", 2.0), row("2024-03-03", 2.0), row("bad", 2.0), row("2024-03-04", -2.0)]
SECOND = [row("2024-01-02", 1.0), row("2024-01-05", 1.5), row("2024-02-03", 2.5), row("2024-03-03", 2.0), row("bad", 2.0), row("bad", 2.0), row("2024-03-04", -2.0),
          row("2023-12-31", None), row("2023-12-31", 7.0)]


def test_sync_takes_late_changed_and_withdrawn_rows(spark, tmp_path):
    paths, ledger = LayerPaths(str(tmp_path)), str(tmp_path / "ledger")

    def sync(rows):
        return fp.sync_layers(spark, paths, raw(spark, rows), ledger, as_of="2025-01-01", run_date=RUN_DATE)
    assert sync(FIRST) == [0, 202401, 202402, 202403]
    expect_state(spark, paths, FIRST)
    march = [r["ingestion_timestamp"] for r in spark.read.parquet(paths.bronze).filter("date LIKE '2024-03%'").collect()]
    january = spark.read.parquet(paths.bronze).filter("date = '2024-01-05'").first()["ingestion_timestamp"]
    assert sync(list(reversed(FIRST))) == []  # the order of rows is no change
    assert sync(SECOND) == [0, 202312, 202401, 202402]  # March is as it was
    expect_state(spark, paths, SECOND)
    assert [r["ingestion_timestamp"] for r in spark.read.parquet(paths.bronze).filter("date LIKE '2024-03%'").collect()] == march
    assert spark.read.parquet(paths.bronze).filter("date = '2024-01-05'").first()["ingestion_timestamp"] == january  # kept with its month's change
    changes = spark.read.parquet(f"{paths.bronze}_changes/load_id=sync-2")
    assert counted(changes, ["date", "value", "more"]) == Counter([("2024-01-02", 1.0, -1), ("2024-02-03", 2.0, -1), ("2024-02-03", 2.5, 1), ("bad", 2.0, 1)])
    assert sync(SECOND[3:4]) == [0, 202312, 202401, 202402, 202403]
    assert counted(spark.read.parquet(paths.bronze), RAW_COLUMNS) == Counter(SECOND[3:4])
    assert read_by_month(spark, paths.gold).count() == 1


def test_sync_reads_the_changed_months_only(spark, tmp_path, monkeypatch):
    paths, ledger, opened = LayerPaths(str(tmp_path)), str(tmp_path / "ledger"), []
    read = fp.read_months
    monkeypatch.setattr(fp, "read_months", lambda *a: opened.append(df := read(*a)) or df)
    fp.sync_layers(spark, paths, raw(spark, FIRST), ledger, as_of="2025-01-01")
    opened.clear()
    fp.sync_layers(spark, paths, raw(spark, FIRST + [row("2024-02-09", 3.0)]), ledger, as_of="2025-01-01")
    files = {f for df in opened for f in df._jdf.queryExecution().analyzed().collectLeaves().apply(0).relation().location().inputFiles()}
    assert files and all("/month=202402/" in f for f in files)


def test_a_failed_sync_is_repeated(spark, tmp_path, monkeypatch):
    paths, ledger = LayerPaths(str(tmp_path)), str(tmp_path / "ledger")
    fp.sync_layers(spark, paths, raw(spark, FIRST), ledger, as_of="2025-01-01", run_date=RUN_DATE)
    with monkeypatch.context() as m:
        m.setattr(fp, "refresh_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            fp.sync_layers(spark, paths, raw(spark, SECOND), ledger, as_of="2025-01-01", run_date=RUN_DATE)
    # the source is as it was before the failed run: its months are written again all the same
    assert set(fp.sync_layers(spark, paths, raw(spark, FIRST), ledger, as_of="2025-01-01", run_date=RUN_DATE)) == {0, 202312, 202401, 202402}
    expect_state(spark, paths, FIRST)


def test_fingerprints_tell_nulls_and_counts_apart(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "a"), (3, "a", None), (3, "a", None), (4, None, None)], "month int, x string, y string")
    got = {r["month"]: tuple(r)[1:] for r in fp.fingerprints(rows, ["x", "y"]).collect()}
    assert len(set(got.values())) == 4 and got[3][0] == 2 and got[3][1] == 2 * got[1][1] and got[3][2] == 0


def test_copies_of_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(fp, "COPIES", 100)
    got = counted(fp.copies(spark.createDataFrame([("a", 1), ("b", 100), ("c", 1234)], "x string, n long"), "n"))
    assert got == Counter({("a",): 1, ("b",): 100, ("c",): 1234})


def test_replay_ends_in_the_layers_once(spark, tmp_path):
    paths, ledger = LayerPaths(str(tmp_path)), str(tmp_path / "replays")
    rows = [row("2024-01-02", 1.0), row("2024-01-02", -4.0), row("2024-02-02", -5.0, latitude=999.0), row("bad", -1.0), row("2024-03-01", None), row("2024-03-02", 1.0, latitude=-100.0)]
    write_bronze(spark, raw(spark, rows), paths.bronze)
    write_silver(spark, paths.bronze, paths.silver, paths.quarantine, RUN_DATE)
    write_gold(spark, paths.silver, paths.gold)
    signs = [Repair("value_negative", "value", F.abs("value"))]
    assert replay_quarantine(spark, paths, signs, ledger, "signs") == 1
    assert counted(spark.read.parquet(paths.quarantine), RAW_COLUMNS) == Counter(rows[2:])  # as they were delivered
    for _ in range(2):
        assert replay_quarantine(spark, paths, signs, ledger, "signs") == 0
    both = [*signs, Repair("latitude_out_of_range", "latitude", F.greatest(F.lit(-90.0), F.least(F.lit(90.0), "latitude")))]
    assert replay_quarantine(spark, paths, both, ledger, "both") == 2
    assert counted(spark.read.parquet(paths.quarantine), RAW_COLUMNS) == Counter(rows[3:5])
    fixed = [rows[0], row("2024-01-02", 4.0), row("2024-02-02", 5.0, latitude=90.0), row("2024-03-02", 1.0, latitude=-90.0)]
    silver = clean.to_silver(raw(spark, fixed))
    assert counted(read_by_month(spark, paths.silver), silver.columns) == counted(silver)
    assert counted(read_by_month(spark, paths.gold), daily_gold(silver).columns) == counted(daily_gold(silver))
    assert counted(spark.read.parquet(paths.bronze), RAW_COLUMNS) == Counter(rows) + Counter(fixed[1:])


def test_a_replay_that_failed_is_repeated(spark, tmp_path, monkeypatch):
    from airshed.sources import replay
    paths, ledger = LayerPaths(str(tmp_path)), str(tmp_path / "replays")
    write_bronze(spark, raw(spark, [row("2024-01-02", 1.0), row("2024-01-02", -4.0), row("bad", 1.0)]), paths.bronze)
    write_silver(spark, paths.bronze, paths.silver, paths.quarantine, RUN_DATE)
    write_gold(spark, paths.silver, paths.gold)
    repairs = [Repair("value_negative", "value", F.abs("value"))]
    with monkeypatch.context() as m:
        m.setattr(replay, "refresh_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            replay_quarantine(spark, paths, repairs, ledger, "r")
    assert replay_quarantine(spark, paths, repairs, ledger, "r") == 1
    assert [tuple(r) for r in read_by_month(spark, paths.gold).select("avg_value", "record_count").collect()] == [(2.5, 2)]
    assert counted(spark.read.parquet(paths.quarantine), ["date"]) == Counter([("bad",)])


def _silver(spark, rows):
    return clean.to_silver(to_bronze(raw(spark, rows)))


def test_folded_batches_equal_one_aggregate(spark, tmp_path):
    state, gold = str(tmp_path / "state"), str(tmp_path / "gold")
    batches = [("a", 0, [row("2024-01-02", 1.0), row("2024-02-02", 8.0)]), ("b", 0, [row("2024-01-02", 3.0), row("2024-01-03", 1.0)]),
               ("a", 1, []), ("a", 2, [row("2024-01-02", 5.0), row("2023-12-31", 2.0)]), ("b", 1, [row("2024-01-03", 9.0, location="B")])]
    for stream, batch, rows in batches:
        assert gold_delta.fold_batch(_silver(spark, rows), batch, stream, state, gold)
        assert not gold_delta.fold_batch(_silver(spark, rows), batch, stream, state, gold)
    assert not gold_delta.fold_batch(_silver(spark, batches[0][2]), 0, "a", state, gold)  # an early batch given again
    want = counted(daily_gold(_silver(spark, [r for _, _, rows in batches for r in rows])), [*GOLD_KEYS, "avg_value", "min_value", "max_value", "record_count"])
    for got in (read_by_month(spark, gold), gold_delta.gold_from_partials(spark, state)):
        assert counted(got, [*GOLD_KEYS, "avg_value", "min_value", "max_value", "record_count"]) == want
    # one folder for each stream and month is left
    kept = [f"{s}/{m}" for s in os.listdir(f"{state}/partials") if s.startswith("stream=") for m in os.listdir(f"{state}/partials/{s}")
            for b in os.listdir(f"{state}/partials/{s}/{m}") if b.startswith("batch=")]
    assert len(kept) == len(set(kept)) == 4


def test_streams_with_checkpoints_of_their_own_keep_each_others_rows(spark, tmp_path):
    out, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    for name, rows in (("one", [row("2024-01-02", 1.0, location="A")] * 5), ("two", [row("2024-01-09", 2.0, location="B")] * 3)):
        to_bronze(raw(spark, rows)).write.parquet(str(tmp_path / name))
        start_bronze_to_gold(spark, str(tmp_path / name), out, gold, str(tmp_path / f"state-{name}")).awaitTermination()
    assert counted(read_by_month(spark, out), ["location"]) == Counter({("A",): 5, ("B",): 3})
    assert counted(read_by_month(spark, gold), ["location", "record_count"]) == Counter([("A", 5), ("B", 3)])


def test_a_streamed_batch_is_kept_nowhere_and_read_once(spark, tmp_path, monkeypatch):
    from airshed.streaming import gold_refresh
    monkeypatch.setattr(type(spark.range(0)), "persist", lambda *a, **k: pytest.fail("a micro-batch may be larger than the executors' memory"))
    monkeypatch.setattr(gold_refresh, "stream_id", lambda batch: "s")
    rows = [(f"2024-0{m}-01", "London", 51.5, -0.1, "urban", "south", "NO2", 1.0, "u", "valid") for m in (1, 2)]
    out, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    for _ in range(2):
        gold_refresh.process_batch(_silver(spark, rows), 0, out, gold)
    gold_refresh.process_batch(_silver(spark, rows[:1]), 1, out, gold)
    gold_refresh.process_batch(_silver(spark, []), 2, out, gold)
    assert sorted((r["date"].month, r["record_count"]) for r in read_by_month(spark, gold).collect()) == [(1, 2), (2, 1)]


def test_landed_parts_are_one_file_each_written_side_by_side(spark, tmp_path, monkeypatch):
    from airshed import catalog
    folders = []
    from airshed.streaming import gold_delta as module
    run = module.start_bronze_to_gold_deltas
    monkeypatch.setattr(module, "start_bronze_to_gold_deltas", lambda s, folder, *a, **k: (folders.append((folder, len([f for f in os.listdir(folder) if f.endswith(".parquet")]))), run(s, folder, *a, **k))[1])
    monkeypatch.setattr(type(spark.range(0)), "coalesce", lambda df, n, f=type(spark.range(0)).coalesce: pytest.fail("Bronze goes through one task") if "location" in df.columns else f(df, n))
    catalog.QUERIES["stream_gold_delta"](spark, SF_SMALL).count()
    assert [n for _, n in folders] == [2, 2, 4, 4]
