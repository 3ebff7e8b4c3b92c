"""Shared storage of the text operators."""

import time

import pytest

pytest.importorskip("sparkelt.llm")

from sparkelt.llm.common import let_go, written  # noqa: E402


def test_one_call_lets_shuffles_of_written_tables_go(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()

    def shuffled():
        files = env.blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    def step():
        return written(spark.range(1000).repartition(3, "id"), "step")

    before = shuffled()
    rows = step()
    fresh = shuffled() - before
    assert fresh
    let_go(spark)
    until = time.time() + 10  # files are deleted in the background
    while fresh & shuffled() and time.time() < until:
        time.sleep(0.2)
    assert not fresh & shuffled()
    assert rows.count() == 1000
