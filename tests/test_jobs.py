"""The command line, and one failing table in the batch job."""

import os
import sys

import pytest

from tests.build import NOON, stored
from tidewatch import __main__ as cli
from tidewatch.plans import batch_job
from tidewatch.session import work_dir
from tidewatch.sources import files, lake
from tidewatch.streaming import live as streams


@pytest.fixture
def command(monkeypatch, spark):
    def run(*args):
        monkeypatch.setattr(sys, "argv", ["tidewatch", *args])
        cli.main()

    return run


@pytest.fixture
def filled(spark, tmp_path):
    path = str(tmp_path / "lake")
    lake.write_lake(stored(spark, {"user": "a"}, {"user": "b", "timestamp": NOON + 1}), path, by="event_time")
    return path


def test_batch_and_compact(command, spark, filled, tmp_path, capsys):
    command("batch", "--lake", filled, "--out", str(tmp_path / "t"), "--days", "0")
    assert "'events': 2" in capsys.readouterr().out
    assert batch_job.read_history(spark, str(tmp_path / "t"), "top_contributors").count() == 2
    command("batch", "--lake", filled, "--out", str(tmp_path / "t"), "--days", "1")
    assert "nothing written" in capsys.readouterr().out
    command("compact", "--lake", filled, "--target", str(tmp_path / "c"))
    assert lake.scan_lake(spark, str(tmp_path / "c"), 0).count() == 2


def test_expire(command, spark, tmp_path, capsys):
    table = streams.changes_path(str(tmp_path))
    spark.sql("SELECT DATE'2020-01-01' AS event_date, 1 AS x").write.partitionBy("event_date").parquet(table)
    command("expire", "--root", str(tmp_path))
    assert "2020-01-01" in capsys.readouterr().out
    assert not [name for name in files.names(spark, table) if name.startswith("event_date")]


def test_an_error_in_one_table_is_raised_and_the_intermediate_is_deleted(spark, filled):
    root = os.path.dirname(work_dir(spark, "x"))
    before = files.names(spark, root)

    def store(view, table):
        if table.endswith("server_rankings"):
            raise OSError("store is down")
        return view.count()

    with pytest.raises(OSError, match="store is down"):
        batch_job.run(spark, filled, store, days_back=0)
    assert files.names(spark, root) == before
