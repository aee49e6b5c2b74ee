"""Shapes of physical plans that must hold at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(queries()))
def test_no_nested_loops_and_no_window_in_one_task(spark, key):
    text = plan(queries()[key](spark, FOLDER))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # A window without partitioning may only run over the counts of the
    # partitions of checkpointed keys, as in the offsets of surrogate ids.
    for line in text.splitlines():
        if "windowspecdefinition" in line:
            # [functions], [partitioning,] [ordering]
            parts = line.split("], [")
            assert len(parts) == 3 or parts[1].startswith("part#"), line


def test_columns_and_filters_reach_the_scan(spark):
    text = plan(queries()["new_today"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz,o_orderpriority:string>" in text
    text = plan(queries()["coauthor_pairs"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint>" in text


def test_group_limits_run_before_the_shuffle(spark):
    for key in ("clean_docs", "group_topk", "dedup_first"):
        text = plan(queries()[key](spark, FOLDER))
        assert re.search(r"WindowGroupLimit .*, row_number\(\), \d+, Partial", text)


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(queries()["knn_cosine"](spark, FOLDER))
    assert "TakeOrderedAndProject" in plan(queries()["top_coauthors"](spark, FOLDER))


def test_texts_stay_out_of_the_grouping_shuffle(spark):
    text = plan(queries()["dedup_keep_latest"](spark, FOLDER))
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "text#" not in line


def test_a_shuffle_is_cut_by_its_size_not_by_a_fixed_number(spark):
    # About 50 MB of rows, in a session of 4 shuffle partitions.
    hashed = spark.range(3_000_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", "id").alias("b"))
    parts = hashed.groupBy("a", "b").count().select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > int(spark.conf.get("spark.sql.shuffle.partitions"))
    small = spark.range(100).groupBy("id").count().select(F.spark_partition_id().alias("p")).distinct().count()
    assert small <= 4
