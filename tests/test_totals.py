"""Totals with removals: every batch counts once, whatever fails."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.streaming import totals
from millrace.streaming.totals import run_totals

SCHEMA = "k string, cents bigint, sign int"


@pytest.fixture
def changes(spark, tmp_path):
    """``send`` adds a file of changes, ``run`` processes what is there, a file a batch."""

    class Changes:
        def send(self, *rows):
            df = spark.createDataFrame(list(rows), SCHEMA).coalesce(1)
            df.write.mode("append").parquet(str(tmp_path / "changes"))

        def run(self):
            reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            stream = reader.parquet(str(tmp_path / "changes"))
            folders = str(tmp_path / "table"), str(tmp_path / "checkpoint")
            found = run_totals(stream, ["k"], "sign", F.col("cents"), *folders)
            assert found.columns == ["k", "n_rows", "total"]
            return {row["k"]: (row["n_rows"], row["total"]) for row in found.collect()}

    return Changes()


def test_removals_in_any_batch(changes):
    changes.send(("a", 100, 1), ("a", 250, 1), ("b", 7, 1), (None, 1, 1))
    changes.send(("c", 40, -1), ("a", 100, -1))
    assert changes.run() == {
        "a": (1, Decimal("2.50")), "b": (1, Decimal("0.07")), None: (1, Decimal("0.01")),
        "c": (-1, Decimal("-0.40")),
    }
    # The addition comes after its removal; the last row of a key goes.
    changes.send(("c", 40, 1), ("b", 7, -1), (None, None, 1))
    assert changes.run() == {"a": (1, Decimal("2.50")), None: (2, Decimal("0.01"))}
    assert changes.run() == {"a": (1, Decimal("2.50")), None: (2, Decimal("0.01"))}


@pytest.mark.parametrize("written", [False, True])
def test_a_batch_that_runs_again_counts_once(changes, monkeypatch, written):
    """The job ends before a batch is written, or after that and before it is committed."""
    store, failed = totals._store, []

    def fail_once(sums, folder):
        if not folder.endswith("batch=1") or failed:
            return store(sums, folder)
        failed.append(folder)
        if written:
            store(sums, folder)
        raise RuntimeError("the driver is lost")

    monkeypatch.setattr(totals, "_store", fail_once)
    for i in range(3):
        changes.send(("a", 10 * (i + 1), 1), ("a", 20, 1), ("a", 1, -1))
    with pytest.raises(StreamingQueryException):
        changes.run()
    assert failed
    assert changes.run() == {"a": (3, Decimal("1.17"))}
    changes.send(("a", 5, 1))
    assert changes.run() == {"a": (4, Decimal("1.22"))}


def test_nothing_to_add_up(changes):
    changes.send()
    assert changes.run() == {}
