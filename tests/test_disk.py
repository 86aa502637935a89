"""What loads leave on disk while they run, and how long."""

import time
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from trips import BAD, GOOD, write_files

from tripledger.plans import gold as gold_plan
from tripledger.plans import raw as raw_plan
from tripledger.plans import silver as silver_plan
from tripledger.plans.gold import build_gold
from tripledger.plans.raw import load_raw
from tripledger.plans.silver import build_silver
from tripledger.schemas import FILES
from tripledger.sources.delimited import read_delimited
from tripledger.staging import Staging, lean
from tripledger.workload import files

CLEANUP, SPLIT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.files.maxPartitionBytes"


def shuffles(spark):
    """Shuffle files of this process."""
    names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(",")
    return {n for n in names.split(",") if n.startswith("shuffle_")}


def left(spark, before, seconds=3.0):
    """Shuffle files that are new since ``before`` and still there after a while: they go beside the next job."""
    end = time.monotonic() + seconds
    while (new := shuffles(spark) - before) and time.monotonic() < end:
        time.sleep(0.1)
    return new


def load(spark, tmp_path, database, rows):
    return load_raw(spark, write_files(tmp_path, rows), database)


def staged(spark, label):
    """Staged tables and parts of that label that are there now."""
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    return {p.name.rsplit("-", 1)[0] for p in shared.glob("stage-*/*") if p.name.startswith(label)}


def test_shuffles_go_when_their_query_ends(spark, tmp_path):
    rows = spark.range(100).repartition(3, "id")
    before = shuffles(spark)
    with lean(spark):
        rows.write.parquet(str(tmp_path / "a"))
    assert not left(spark, before)
    frame = rows.groupBy("id").count()
    assert frame.count() == frame.count() == 100


def test_settings_return_with_the_last_who_is_within(spark):
    before = [spark.conf.get(k, None) for k in (CLEANUP, SPLIT)]
    with lean(spark):
        with lean(spark):
            assert spark.conf.get(CLEANUP) == "true" and int(spark.conf.get(SPLIT)) <= 32 << 20
        assert spark.conf.get(CLEANUP) == "true"
    assert [spark.conf.get(k, None) for k in (CLEANUP, SPLIT)] == before


def test_small_splits_stay_small(spark):
    spark.conf.set(SPLIT, "1m")
    try:
        with lean(spark):
            assert spark.conf.get(SPLIT) == str(1 << 20)
        assert spark.conf.get(SPLIT) == "1m"
    finally:
        spark.conf.unset(SPLIT)


def test_written_files_leave_no_shuffle(spark, tmp_path):
    before = shuffles(spark)
    files.write_lines(spark.range(800).select(F.col("id").alias("k"), F.col("id").cast("string").alias("line")), ["k"],
                      "K", str(tmp_path / "f"))
    assert not left(spark, before)


def test_compressed_files_hold_the_same_rows(spark, tmp_path):
    rows = spark.range(800).select(F.col("id").alias("k"), F.concat(F.col("id").cast("string"), F.lit(";\"é\"")).alias("line"))
    read = {}
    for how in ("none", "gzip"):
        path = files.write_lines(rows, ["k"], "K;V", str(tmp_path / how), compression=how)
        with Staging(spark) as staging:
            read[how] = sorted(tuple(r) for r in read_delimited(spark, path, staging=staging).collect())
    assert read["gzip"] == read["none"] == sorted((str(k), "é") for k in range(800))
    assert all(f.suffix == ".gz" for f in Path(tmp_path, "gzip").glob("part=*/part-*"))


def next_shuffle(spark, seen):
    """The number of a shuffle that is made now."""
    spark.range(10).repartition(2).foreach(lambda _: None)
    return max(int(n.split("_")[1]) for n in shuffles(spark) - seen)


def test_raw_and_silver_builds_leave_hardly_a_shuffle(spark, tmp_path):
    """One may end after its query, where adaptive execution found that it is not needed."""
    first = next_shuffle(spark, shuffles(spark))
    before = shuffles(spark)
    load(spark, tmp_path, "disk1", BAD)
    build_silver(spark, "disk1", mode="quarantine", ids="dense")
    still = {n.split("_")[1] for n in left(spark, before)}
    made = next_shuffle(spark, shuffles(spark)) - first
    assert made > 20 and len(still) * 5 < made


def test_what_is_staged_goes_when_its_table_is_written(spark, tmp_path, monkeypatch):
    seen, write = {}, silver_plan.write_version
    monkeypatch.setattr(raw_plan, "publish", lambda *a, **b: (seen.update(raw=staged(spark, "raw_")), publish(*a, **b))[1])
    publish = silver_plan.publish
    load(spark, tmp_path, "disk2", BAD)
    assert seen == {"raw": set()}
    monkeypatch.setattr(silver_plan, "write_version", lambda df, table, database=None: (
        seen.update({table: staged(spark, "part_")}), write(df, table, database))[1])
    build_silver(spark, "disk2", mode="quarantine", ids="dense")
    part = {t: f"part_silver_{t}" for t in ("viagem", "pagamento", "passagem", "trecho")}
    assert part["viagem"] in seen["silver_viagem"] and part["trecho"] in seen["silver_trecho"]
    assert part["viagem"] not in seen["orfaos_silver_pagamento"]
    assert part["pagamento"] not in seen["orfaos_silver_passagem"] and part["passagem"] not in seen["orfaos_silver_trecho"]
    assert not staged(spark, "part_")


def test_tables_are_stored_dense(spark, tmp_path):
    """A second load keeps the tables of the first for a day, so they count twice."""
    load(spark, tmp_path, "disk3", GOOD)
    found = [f for f in spark.table("disk3.raw_viagem").inputFiles()]
    assert found and {pq.ParquetFile(f.removeprefix("file:").replace("//", "/")).metadata.row_group(0).column(0).compression
                      for f in found} == {"ZSTD"}


def test_a_gold_build_leaves_no_shuffle(spark, tmp_path):
    load(spark, tmp_path, "disk4", GOOD)
    build_silver(spark, "disk4")
    before = shuffles(spark)
    build_gold(spark, "disk4")
    assert not left(spark, before)
    assert spark.table(f"disk4.{gold_plan.GOLD_TABLE}").count() > 0


def test_the_files_of_the_shared_load_are_compressed(spark, tmp_path, monkeypatch):
    told = {}
    monkeypatch.setattr(files, "write_trip_files", lambda t, folder, **options: told.update(options) or dict.fromkeys(FILES, folder))
    monkeypatch.setattr(files, "_load", lambda *a: None)
    files.layers(spark, str(tmp_path))
    monkeypatch.undo()
    files.close(spark)
    assert told == {"compression": "gzip"}
