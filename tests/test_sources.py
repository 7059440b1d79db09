"""Readers, the partitioned sink and the shared folder."""

from __future__ import annotations

import os
import re
import time
import uuid
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from conftest import TESTDATA
from millrace.plans.star import write_orders_by_year
from millrace.sources.partitioned import write_partitioned
from millrace.sources import shared
from millrace.sources.shared import new_run_dir, remove_old_runs, shared_dir
from millrace.sources.tables import table, table_stream
from millrace.streaming.run import run_available

SF = f"{TESTDATA}/sf0.01"


def test_sink_is_read_back_whole_and_by_year(spark, tmp_path):
    path = f"{tmp_path}/orders"
    write_orders_by_year(spark, SF, path)
    orders = table(spark, SF, "orders")
    back = spark.read.parquet(path)
    assert rows_of(back.drop("order_year")) == rows_of(orders)

    year = back.filter("order_year = 1997").drop("order_year")
    assert rows_of(year) == rows_of(orders.filter("year(o_orderdate) = 1997"))
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*\(order_year#\d+ = 1997\)\]", plan)


def test_sink_splits_a_hot_value_and_spares_small_ones(spark, conf, tmp_path):
    """A third of the rows in one value: several files there, one for each other."""
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    df = spark.range(300_000, numPartitions=24).select(
        "id",
        F.expr("md5(string(id))").alias("payload"),
        F.expr("if(id % 3 = 0, 0, 1 + id % 400)").alias("part"),
    )
    path = f"{tmp_path}/t"
    write_partitioned(df, path, "part")
    files = [len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "t").glob("part=*")]
    hot = len(list((tmp_path / "t" / "part=0").glob("*.parquet")))
    assert hot > 1
    assert sum(files) - hot < 2 * (len(files) - 1)
    assert spark.read.parquet(path).count() == 300_000


@pytest.mark.parametrize("folder", [True, False])
def test_stream_reads_a_file_or_a_folder(spark, tmp_path, folder):
    sf_dir = SF
    if folder:
        sf_dir = str(tmp_path)
        table(spark, SF, "events").repartition(3).write.parquet(f"{sf_dir}/events.parquet")
    stream = table_stream(spark, sf_dir, "events")
    got = run_available(stream, f"{tmp_path}/t", f"{tmp_path}/c")
    assert rows_of(got) == rows_of(table(spark, SF, "events"))


def fake_session(setting, in_use, master):
    """Only what ``shared_dir`` asks a session for."""
    used = []
    context = SimpleNamespace(
        getCheckpointDir=lambda: in_use, setCheckpointDir=used.append, master=master
    )
    conf = SimpleNamespace(get=lambda key, default: setting)
    return SimpleNamespace(sparkContext=context, conf=conf), used


def test_shared_folder_is_the_named_one():
    session, used = fake_session("hdfs://nn/shared/", None, "yarn")
    assert shared_dir(session) == "hdfs://nn/shared"
    assert used == ["hdfs://nn/shared/"]


def test_shared_folder_falls_back_to_the_one_in_use():
    session, used = fake_session(None, "hdfs://nn/used", "yarn")
    assert shared_dir(session) == "hdfs://nn/used"
    assert used == []


def test_shared_folder_must_be_named_on_a_cluster():
    session, _ = fake_session(None, None, "spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session)


def test_shared_folder_of_a_local_session():
    session, used = fake_session(None, None, "local[2]")
    assert used == [shared_dir(session)]


def test_old_runs_are_removed_and_nothing_else(tmp_path, spark, monkeypatch):
    root = tmp_path / "millrace"
    old, new = (root / f"q-{uuid.uuid4()}" for _ in range(2))
    touched = root / f"q-{uuid.uuid4()}"
    others = [root / "notes", tmp_path / f"q-{uuid.uuid4()}"]
    for folder in (old, new, touched, *others):
        (folder / "table").mkdir(parents=True)
        (folder / "table" / "part").write_text("x")
    hour_ago = time.time() - 3600
    for folder in (old, touched, *others):
        for path in (folder / "table" / "part", folder / "table", folder):
            os.utime(path, (hour_ago, hour_ago))
    (touched / "table" / "part").write_text("y")
    monkeypatch.setattr(shared, "shared_dir", lambda _: str(tmp_path))
    assert remove_old_runs(spark, older_than_hours=0.5) == [old.name]
    assert not old.exists()
    assert all(folder.exists() for folder in (new, touched, *others))
    assert remove_old_runs(spark, older_than_hours=0.5) == []


def test_runs_get_folders_of_their_own(spark):
    assert new_run_dir(spark, "x") != new_run_dir(spark, "x")
    assert new_run_dir(spark, "x").startswith(shared_dir(spark))
