"""Landing files of unlike headers, and files that come again under another name."""

from __future__ import annotations

import shutil
from collections import Counter

import pytest

from airshed.layers import LayerPaths, write_bronze, write_silver
from airshed.schema import RAW_COLUMNS, RAW_SCHEMA
from airshed.sources.layers_io import read_by_month
from airshed.streaming import landing as landing_module
from airshed.streaming.landing import DELIVERIES, load_files, start_landing_loads
from tests.conftest import HEADER, RAW_ROWS, _csv_text


def turned(rows):
    """The same rows with their columns in the opposite order."""
    return _csv_text([r[::-1] for r in rows], ",".join(HEADER.split(",")[::-1]))


@pytest.fixture
def landing(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def run(files=2):
        start_landing_loads(spark, str(folder), str(tmp_path / "bronze"), str(tmp_path / "ledger"), str(tmp_path / "state"), max_files_per_trigger=files).awaitTermination()
        return Counter(tuple(r) for r in spark.read.parquet(str(tmp_path / "bronze")).select(*RAW_COLUMNS).collect())
    return folder, run


def test_files_of_unlike_headers_share_a_bronze_with_the_batch(spark, tmp_path, landing):
    folder, run = landing
    write_bronze(spark, spark.createDataFrame(RAW_ROWS[:1], RAW_SCHEMA), str(tmp_path / "bronze"))
    (folder / "a.csv").write_text(_csv_text(RAW_ROWS[1:3]), encoding="utf-8")
    (folder / "b.csv").write_text("﻿" + turned(RAW_ROWS[3:5]).replace("\n", "\r\n"), encoding="utf-8")
    (folder / "c.csv").write_text(turned(RAW_ROWS[5:]), encoding="utf-8")
    (folder / "empty.csv").write_text("")
    (folder / "notes.txt").write_text("not a table")
    assert run() == Counter(RAW_ROWS)
    paths = LayerPaths(str(tmp_path))
    write_silver(spark, paths.bronze, paths.silver, paths.quarantine)
    assert read_by_month(spark, paths.silver).count() == len(RAW_ROWS)


def test_a_file_under_another_name_is_loaded_once(spark, tmp_path, landing):
    folder, run = landing
    (folder / "a.csv").write_text(_csv_text(RAW_ROWS[:3] + RAW_ROWS[:1]), encoding="utf-8")  # repeated rows of one file stay
    shutil.copy(folder / "a.csv", folder / "again.csv")
    assert run() == Counter(RAW_ROWS[:3] + RAW_ROWS[:1])
    (folder / "a.csv").rename(folder / "renamed.csv")
    (folder / "new.csv").write_text(_csv_text(RAW_ROWS[3:]), encoding="utf-8")
    shutil.copy(folder / "again.csv", folder / "third.csv")
    assert run(1) == Counter(RAW_ROWS + RAW_ROWS[:1])
    seen = spark.read.schema(DELIVERIES).parquet(str(tmp_path / "ledger"))
    assert Counter(r["loaded"] for r in seen.collect()) == {True: 2, False: 3}


def test_a_batch_given_again_replaces_its_load(spark, tmp_path, landing):
    folder, _ = landing
    (folder / "a.csv").write_text(_csv_text(RAW_ROWS), encoding="utf-8")
    batch = spark.read.format("binaryFile").load(str(folder))
    for _ in range(2):
        assert load_files(batch, 3, "s", str(tmp_path / "bronze"), str(tmp_path / "ledger")) == 1
    assert load_files(batch, 4, "s", str(tmp_path / "bronze"), str(tmp_path / "ledger")) == 0
    assert spark.read.parquet(str(tmp_path / "bronze")).count() == len(RAW_ROWS)


def test_a_digest_is_of_all_lines_in_their_order_wherever_blocks_begin(spark, tmp_path):
    lines = [f"line {i % 7}" for i in range(landing_module.LEAF * 2 + 5)]
    texts = {"a b+c%41.csv": "\n".join(lines), "copy.csv": "\n".join(lines), "ended.csv": "\n".join(lines) + "\n", "marked.csv": "﻿" + "\n".join(lines),
             "returns.csv": "\r\n".join(lines), "turned.csv": "\n".join([lines[1], lines[0], *lines[2:]]), "swapped.csv": "\n".join([*lines[:-2], lines[-1], lines[-2]]),
             "one.csv": "a", "two.csv": "b"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    files = [tuple(r) for r in spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length").collect()]
    found = {r["path"].rpartition("/")[2]: (r["digest"], r["header"]) for r in landing_module.file_digests(spark, files).collect()}
    assert found["a b+c%41.csv"] == found["copy.csv"]
    assert len({d for d, _ in found.values()}) == len(texts) - 1
    assert {n: h for n, (_, h) in found.items()} == {n: t.split("\n")[0].lstrip("﻿") for n, t in texts.items()}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
        assert found == {r["path"].rpartition("/")[2]: (r["digest"], r["header"]) for r in landing_module.file_digests(spark, files).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_stream_reads_no_content_of_a_file_whole(spark, tmp_path, landing):
    folder, run = landing
    (folder / "a.csv").write_text(_csv_text(RAW_ROWS * 50), encoding="utf-8")
    before = spark.conf.get("spark.sql.sources.binaryFile.maxLength")
    try:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", "100")  # a larger content than this fails
        assert run() == Counter(RAW_ROWS * 50)
    finally:
        spark.conf.set("spark.sql.sources.binaryFile.maxLength", before)
