from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

from clickcredit.llm import shared as S

from .conftest import documents

ROOT = Path(__file__).resolve().parents[2]


def test_workers_get_the_package_wherever_the_driver_runs(tmp_path):
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from clickcredit.llm import simhash
print("rows", simhash.mark(spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string")).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows 1" in done.stdout, done.stderr[-2000:]


class Session:
    """As much of a session as paths need."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: folder or default)})()


def test_scratch_lies_in_the_folder_that_the_session_names():
    for master in ("yarn", "local[2]"):
        path = S.scratch_path(Session(master, "hdfs://shared/folder/"), "x")
        assert path.startswith("hdfs://shared/folder/x-") and path != S.scratch_path(Session(master, "hdfs://shared/folder"), "x")


def test_only_a_local_session_may_name_none():
    first, second = (Path(S.scratch_path(Session("local[2]"), "x")) for _ in range(2))
    assert first.parent == second.parent and first.parent.is_dir()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        S.scratch_path(Session("yarn"), "x")


def test_names_that_are_taken(spark):
    df = documents(spark, [(1, "a")]).selectExpr("*", "1 AS Fresh", "2 AS _fresh")
    assert S.free_name(df, "fresh") == "__fresh" and S.free_name(df, "new") == "new"
