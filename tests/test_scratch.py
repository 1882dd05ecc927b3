"""Scratch tables live in the shared folder, and only one machine may do without it."""

import os
from types import SimpleNamespace

import pytest

from quire.sources import scratch


def test_tables_are_written_reread_and_deleted(spark):
    df = scratch.written(spark.range(5), "few")
    at = df._scratch
    assert df.count() == 5 and at.startswith(scratch.root(spark)) and os.path.isdir(at)
    scratch.discard(df)
    assert not os.path.exists(at)
    scratch.discard(spark.range(1))
    assert scratch.written(spark.range(0), "none").count() == 0


def test_a_cluster_needs_a_shared_folder():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None), sparkContext=SimpleNamespace(master="spark://a:7077"))
    with pytest.raises(ValueError):
        scratch.root(unset)
