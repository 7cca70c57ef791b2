"""Incremental loads, marks, retention, partition-wise Gold refresh, schema
checks and the layer run log."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from airshed.layers import LayerPaths, run_layers, write_gold, write_silver
from airshed.operators.checks import schema_diff
from airshed.operators.gold import daily_gold
from airshed.schema import GOLD_SCHEMA, SILVER_SCHEMA
from airshed.sources import incremental as inc
from airshed.sources.layers_io import read_by_month, write_by_month
from tests.conftest import HEADER, RAW_ROWS, RUN_TS


def silver_rows(spark, days):
    rows = [("L", 1.0, 1.0, "urban", "z", "NO2", float(v), "u", "valid", RUN_TS, "f", dt.date(2024, 1, d))
            for d, v in days]
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def test_since_mark_window(spark):
    s = silver_rows(spark, [(d, d) for d in range(1, 11)])
    got = sorted(r.date.day for r in inc.since_mark(s, dt.date(2024, 1, 3), dt.date(2024, 1, 7)).collect())
    assert got == [4, 5, 6, 7]
    first = inc.since_mark(s, None, dt.date(2024, 1, 2)).count()
    assert first == 2


def test_marks_round_trip(spark, tmp_path):
    path = str(tmp_path / "marks")
    mark = lambda name: spark.range(1).select(inc.read_mark(spark, path, name).alias("m")).first().m
    assert mark("main") is None
    inc.write_mark(spark, silver_rows(spark, [(5, 1), (9, 1)]), path, "main")
    inc.write_mark(spark, silver_rows(spark, [(2, 1)]), path, "other")
    inc.write_mark(spark, silver_rows(spark, [(12, 1)]), path, "main")
    inc.write_mark(spark, silver_rows(spark, []), path, "main")  # nothing loaded: the mark stays
    assert mark("main") == dt.date(2024, 1, 12) and mark("other") == dt.date(2024, 1, 2) and mark("none") is None


def test_an_unreadable_mark_is_an_error_and_loses_nothing(spark, tmp_path):
    path = tmp_path / "marks"
    inc.write_mark(spark, silver_rows(spark, [(5, 1)]), str(path), "main")
    (path / "part-broken.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception):
        spark.range(1).select(inc.read_mark(spark, str(path), "main").alias("m")).collect()
    inc.write_mark(spark, silver_rows(spark, [(9, 1)]), str(path), "other")  # appends, rewrites nothing
    (path / "part-broken.parquet").unlink()
    assert spark.range(1).select(inc.read_mark(spark, str(path), "main").alias("m")).first().m == dt.date(2024, 1, 5)


def test_retention_split(spark):
    s = silver_rows(spark, [(d, d) for d in range(1, 11)])
    keep, expire = inc.retention_split(s, days=3, as_of=dt.date(2024, 1, 10))
    assert sorted(r.date.day for r in keep.collect()) == [7, 8, 9, 10]
    assert keep.count() + expire.count() == 10


def _month_rows(spark, days):
    rows = [("L", 1.0, 1.0, "urban", "z", "NO2", float(v), "u", "valid", RUN_TS, "f", dt.date(2024, m, d)) for m, d, v in days]
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def _gold_values(spark, path):
    return {(r.date.month, r.date.day): (r.avg_value, r.record_count) for r in read_by_month(spark, path).collect()}


def test_refresh_after_a_batch_build_touches_only_its_months(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    s1 = _month_rows(spark, [(1, 1, 10), (1, 2, 20), (2, 3, 30), (3, 4, 40)])
    write_by_month(s1, silver, ["date"], "batch")
    write_gold(spark, silver, gold)
    before = {f: os.path.getmtime(os.path.join(gold, f)) for f in os.listdir(gold) if f in ("month=202401", "month=202403")}
    late = _month_rows(spark, [(2, 3, 50), (2, 9, 7)])
    write_by_month(late, silver, ["date"], "late", replace_months=True)
    inc.refresh_gold(spark, silver, inc.touched_months(late), gold)
    assert _gold_values(spark, gold) == {(1, 1): (10.0, 1), (1, 2): (20.0, 1), (2, 3): (40.0, 2), (2, 9): (7.0, 1), (3, 4): (40.0, 1)}
    assert before == {f: os.path.getmtime(os.path.join(gold, f)) for f in before}
    assert len([f for f in os.listdir(os.path.join(gold, "month=202402")) if f.endswith(".parquet")]) == 1


def test_a_month_that_loses_its_rows_loses_its_gold(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_by_month(_month_rows(spark, [(1, 1, 10), (2, 3, 30)]), silver, ["date"], "batch")
    write_gold(spark, silver, gold)
    write_by_month(_month_rows(spark, [(1, 1, 10)]), silver, ["date"], "batch")
    inc.refresh_gold(spark, silver, [202402], gold)
    assert _gold_values(spark, gold) == {(1, 1): (10.0, 1)}


def test_a_gold_folder_of_another_layout_is_refused(spark, tmp_path):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    s = _month_rows(spark, [(1, 1, 10)])
    write_by_month(s, silver, ["date"], "batch")
    daily_gold(s).write.parquet(gold)
    with pytest.raises(ValueError, match="not laid out"):
        inc.refresh_gold(spark, silver, [202401], gold)


def test_expire_months(spark, tmp_path):
    silver = str(tmp_path / "silver")
    write_by_month(_month_rows(spark, [(1, 1, 1), (2, 28, 2), (3, 4, 3)]), silver, ["date"], "batch")
    assert inc.expire_months(spark, silver, 10, dt.date(2024, 3, 5)) == [202401]
    assert read_by_month(spark, silver).count() == 2


def test_schema_diff(spark):
    s = silver_rows(spark, [(1, 1)])
    assert schema_diff(spark, s.schema, SILVER_SCHEMA).count() == 0
    bad = s.drop("zone").withColumn("value", F.col("value").cast("string")).withColumn("x", F.lit(1))
    got = {(r.column, r.problem) for r in schema_diff(spark, bad.schema, SILVER_SCHEMA).collect()}
    assert got == {("zone", "missing"), ("value", "type_changed"), ("x", "unexpected")}


def test_run_layers_log_and_reconciliation(spark, tmp_path, sample_raw_csv):
    src, rows = sample_raw_csv
    paths = LayerPaths(str(tmp_path / "lake"))
    log = {r.stage: (r.status, r.rows) for r in
           run_layers(spark, paths, csv_input=str(src), run_date=dt.date(2024, 1, 4)).collect()}
    assert log == {"bronze": ("success", 6), "silver": ("success", 6), "quarantine": ("success", 0),
                   "gold": ("success", 6)}
    gold = read_by_month(spark, paths.gold)
    assert gold.schema == GOLD_SCHEMA
    assert gold.count() == daily_gold(spark.read.parquet(paths.silver)).count()


def test_run_layers_logs_failure(spark, tmp_path):
    paths = LayerPaths(str(tmp_path / "lake"))
    log = run_layers(spark, paths, csv_input=str(tmp_path / "missing.csv")).collect()
    assert [(r.stage, r.status) for r in log] == [("bronze", "error")]
    assert "FileNotFoundError" in log[0].error


def test_quarantine_rerun_same_day_is_idempotent(spark, tmp_path, bronze_with_invalid_data):
    from airshed.layers import write_silver
    p, _ = bronze_with_invalid_data
    q = str(tmp_path / "q")
    for _ in range(2):
        write_silver(spark, p, str(tmp_path / "s"), q, run_date=dt.date(2024, 1, 4))
    write_silver(spark, p, str(tmp_path / "s"), q, run_date=dt.date(2024, 1, 5))
    counts = {r.run_date: r["count"] for r in spark.read.parquet(q).groupBy("run_date").count().collect()}
    assert counts == {dt.date(2024, 1, 4): 3, dt.date(2024, 1, 5): 3}


def test_csv_to_gold_end_to_end_matches_reference_fixture(spark, tmp_path, sample_raw_csv):
    src, _ = sample_raw_csv
    paths = LayerPaths(str(tmp_path / "lake"))
    run_layers(spark, paths, csv_input=str(src))
    got = sorted((r.date.isoformat(), r.location, r.pollutant_type, r.avg_value)
                 for r in spark.read.parquet(paths.gold).collect())
    assert got == sorted((r[0], r[1], r[6], r[7]) for r in RAW_ROWS)


def test_external_table_over_gold(spark, tmp_path):
    from airshed.sources.layers_io import external_table
    rows = [(dt.date(2024, 1, 1), "A", "NO2", "z", 1.0, 1.0, 1.0, 1)]
    path = str(tmp_path / "gold")
    spark.createDataFrame(rows, GOLD_SCHEMA).write.parquet(path)
    t = external_table(spark, path, "gold_weather_ext")
    assert t.count() == 1
    assert spark.sql("SELECT COUNT(*) AS n FROM gold_weather_ext").first().n == 1
    spark.sql("DROP TABLE gold_weather_ext")


def test_scale_conf():
    from airshed.session import scale_conf
    c = scale_conf(100 << 40, executor_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1 << 20, executor_cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_run_log_checks(spark, tmp_path, bronze_with_invalid_data):
    from airshed.operators.checks import run_log_checks
    good = spark.createDataFrame(
        [("bronze", "success", 6, "b", None), ("silver", "success", 3, "s", None),
         ("quarantine", "success", 3, "q", None), ("gold", "success", 3, "g", None)],
        "stage string, status string, rows bigint, output_path string, error string")
    assert {r.check: r.ok for r in run_log_checks(good).collect()} == {
        "all_stages_succeeded": True, "silver_within_bronze": True, "split_complete": True,
        "gold_within_silver": True}
    bad = spark.createDataFrame(
        [("bronze", "success", 6, "b", None), ("silver", "error", None, None, "boom")],
        "stage string, status string, rows bigint, output_path string, error string")
    assert not any(r.ok for r in run_log_checks(bad).collect())


def test_quarantine_rerun_with_clean_input_leaves_nothing(spark, tmp_path, bronze_with_invalid_data):
    p, _ = bronze_with_invalid_data
    q, day = str(tmp_path / "q"), dt.date(2024, 1, 4)
    assert write_silver(spark, p, str(tmp_path / "s"), q, run_date=day)[1] == 3
    assert write_silver(spark, p, str(tmp_path / "s"), q, run_date=dt.date(2024, 1, 5))[1] == 3
    clean_bronze = spark.read.parquet(p).filter("value >= 0 and latitude < 90 and date <> 'invalid-date' and longitude < 180")
    assert write_silver(spark, p, str(tmp_path / "s"), q, run_date=day, bronze=clean_bronze)[1] == 0
    assert {r.run_date for r in spark.read.parquet(q).collect()} == {dt.date(2024, 1, 5)}


def test_external_table_refuses_a_managed_one(spark, tmp_path):
    from airshed.sources.layers_io import external_table
    path = str(tmp_path / "o'clock gold")
    spark.range(3).write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS managed_gold")
    spark.range(7).write.saveAsTable("managed_gold")
    with pytest.raises(ValueError, match="not an external"):
        external_table(spark, path, "managed_gold")
    assert spark.table("managed_gold").count() == 7
    spark.sql("DROP TABLE managed_gold")
    for _ in range(2):  # an external one is replaced
        assert external_table(spark, path, "outer_gold").count() == 3
    spark.sql("DROP TABLE outer_gold")


def test_refreshed_table_keeps_earlier_frames_readable(spark, tmp_path):
    from airshed.sources.layers_io import refresh_table
    first = refresh_table(spark, spark.range(3), str(tmp_path / "t"))
    second = refresh_table(spark, spark.range(5), str(tmp_path / "t"))
    assert (first.count(), second.count()) == (3, 5)


def test_extra_columns_and_rules_go_through_the_layers(spark, tmp_path, sample_raw_csv):
    from airshed.operators import clean
    _, rows = sample_raw_csv
    src = tmp_path / "extra.csv"
    src.write_text(HEADER + ",temperature\n" + "".join(",".join(map(str, r)) + f",{t}\n" for r, t in zip(rows, [5, 99, "x", "", 7, 8])), encoding="utf-8")
    paths = LayerPaths(str(tmp_path / "lake"))
    from airshed.layers import write_bronze
    from airshed.sources.csv_ingest import read_raw_csv
    write_bronze(spark, read_raw_csv(spark, str(src)), paths.bronze)
    kept, rejected = write_silver(spark, paths.bronze, paths.silver, paths.quarantine,
                                  rules=clean.default_rules() + [clean.range_rule("temperature", -50, 60)])
    assert (kept, rejected) == (3, 3)
    assert sorted(r.temperature for r in read_by_month(spark, paths.silver).collect()) == ["5", "7", "8"]


def test_incremental_loads_equal_one_full_load(spark, tmp_path, sample_raw_csv):
    from airshed.layers import run_incremental
    from airshed.sources.csv_ingest import read_raw_csv
    src, _ = sample_raw_csv
    raw, marks = read_raw_csv(spark, str(src)), str(tmp_path / "marks")
    full, parts = LayerPaths(str(tmp_path / "full")), LayerPaths(str(tmp_path / "parts"))
    run_layers(spark, full, raw=raw)
    assert run_incremental(spark, parts, raw, marks, as_of="2024-01-02", load_id="a") == [202401]
    assert run_incremental(spark, parts, raw, marks, as_of="2024-01-09", load_id="b") == [202401]
    assert run_incremental(spark, parts, raw, marks, as_of="2024-01-09", load_id="c") == []  # nothing new
    assert _gold_values(spark, parts.gold) == _gold_values(spark, full.gold)
    assert spark.read.parquet(parts.bronze).count() == 6


def test_default_loads_of_one_day_keep_each_other(spark, tmp_path, sample_raw_csv, monkeypatch):
    from airshed import layers
    from airshed.sources.csv_ingest import read_raw_csv
    src, _ = sample_raw_csv
    raw, marks, day = read_raw_csv(spark, str(src)), str(tmp_path / "marks"), dt.date(2024, 1, 9)
    full, parts = LayerPaths(str(tmp_path / "full")), LayerPaths(str(tmp_path / "parts"))
    run_layers(spark, full, raw=raw)
    later = raw.unionByName(raw.filter("date = '2024-01-03'").withColumn("date", F.lit("2024-02-03")))
    layers.run_incremental(spark, parts, raw, marks, as_of="2024-01-01", run_date=day)
    with monkeypatch.context() as m:  # a run that fails before its mark, reaching further than its repetition
        m.setattr(layers, "write_mark", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run_incremental(spark, parts, later, marks, as_of="2024-02-09", run_date=day)
    assert layers.run_incremental(spark, parts, raw, marks, as_of="2024-01-02", run_date=day) == [202401, 202402]
    assert layers.run_incremental(spark, parts, raw, marks, as_of="2024-01-09", run_date=day) == [202401]
    assert layers.run_incremental(spark, parts, raw, marks, as_of="2024-01-09", run_date=day) == []
    assert spark.read.parquet(parts.bronze).count() == spark.read.parquet(parts.silver).count() == 6
    assert _gold_values(spark, parts.gold) == _gold_values(spark, full.gold)


def test_quarantine_of_the_loads_is_that_of_one_full_load(spark, tmp_path, monkeypatch):
    from airshed import layers
    from airshed.catalog import QUERIES, bronze_table
    from airshed.operators import clean
    from tests.conftest import SF_SMALL
    paths, marks, days = LayerPaths(str(tmp_path / "lake")), str(tmp_path / "marks"), [dt.date(1999, 1, d) for d in (1, 2)]
    rows = bronze_table(spark, SF_SMALL)
    dated, undated = (rows.filter(f"date {c} 'invalid-date'") for c in ("<>", "="))
    assert layers.run_incremental(spark, paths, undated.limit(3), marks, as_of="1992-06-17", run_date=days[0]) == []  # nothing dated
    layers.run_incremental(spark, paths, dated, marks, as_of="1995-06-17", run_date=days[0])
    with monkeypatch.context() as m:  # fails before midnight, repeated the next day
        m.setattr(layers, "write_mark", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run_incremental(spark, paths, rows, marks, as_of="1998-06-17", run_date=days[0])
    for as_of in ("1998-06-17", "2099-12-31"):
        layers.run_incremental(spark, paths, rows, marks, as_of=as_of, run_date=days[1])
    assert layers.run_incremental(spark, paths, rows, marks, as_of="2099-12-31", run_date=days[1]) == []
    text = lambda q: q.select(*rows.columns, F.array_join(clean.REJECT_REASONS, ",").alias(clean.REJECT_REASONS))
    got, want = text(spark.read.parquet(paths.quarantine)), QUERIES["quarantine_rows"](spark, SF_SMALL).select(*rows.columns, clean.REJECT_REASONS)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    assert spark.read.parquet(paths.quarantine).select("load_id").distinct().count() == 4
    assert spark.read.parquet(paths.bronze).count() == rows.count()


def test_the_refreshed_query_rests_on_the_refresh(spark, monkeypatch):
    from airshed.catalog import QUERIES
    from tests.conftest import SF_SMALL
    want = QUERIES["gold_daily"](spark, SF_SMALL)
    months = lambda g: {r[0] for r in g.select(F.date_format("date", "yyyyMM")).distinct().collect()}
    assert months(QUERIES["gold_refreshed"](spark, SF_SMALL).select(want.columns).exceptAll(want)) == set()
    monkeypatch.setattr(inc, "refresh_gold", lambda *a: None)
    assert months(want.exceptAll(QUERIES["gold_refreshed"](spark, SF_SMALL).select(want.columns))) == months(want)


def test_run_log_feeds_the_monitoring(spark, tmp_path):
    from airshed.layers import as_run_history
    from airshed.plans.runs import circuit_breaker
    log = run_layers(spark, LayerPaths(str(tmp_path / "lake")), csv_input=str(tmp_path / "none.csv"))
    history = as_run_history(log)
    for _ in range(4):
        history = history.unionByName(as_run_history(log))
    assert circuit_breaker(history).first().should_proceed is False


def test_command_line(spark, tmp_path, sample_raw_csv):
    from airshed.__main__ import main
    src, _ = sample_raw_csv
    assert main(["--input", str(src), "--root", str(tmp_path / "lake"), "--run-date", "2024-01-04"]) == 0
    assert spark.read.parquet(str(tmp_path / "lake" / "gold")).count() == 6
    assert main(["--input", str(tmp_path / "none.csv"), "--root", str(tmp_path / "lake2")]) == 1
