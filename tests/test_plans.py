"""Plans: native expressions, pruned scans, early duplicate filters, few exchanges."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from newsflow.plans.registry import QUERIES
from newsflow.plans.views import view
from newsflow.session import scratch_path
from newsflow.sources import readers, writers

FOLDER = "/root/testdata/sf0.001"
PYTHON = {"score_map_partitions", "score_map_top1", "score_errors", "score_pandas_udf", "score_struct", "score_tokens"}
WRITING = {n for n in QUERIES if n.startswith(("sink_", "scan_", "stream_"))} | {
    "read_partition", "land_by_year", "sql_view", "sql_catalog_table", "merge_after_removal", "price_json_unpivot", "seq_regression_compare",
    "seq_regression_line", "merge_equals_days"}


def plan_of(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_python_only_where_needed(spark, name):
    plan = plan_of(spark, name)
    assert "BatchEvalPython" not in plan.replace("ArrowEvalPython", "")
    used = any(x in plan for x in ("ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"))
    assert used == (name in PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_duplicates_are_dropped_before_the_shuffle(spark):
    plan = plan_of(spark, "dedup_news")
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:] and "WindowGroupLimit" in plan[:shuffle]


def test_lags_need_two_exchanges_and_one_window(spark):
    plan = plan_of(spark, "lag_features")
    assert plan.count("Exchange hashpartitioning") == 2
    assert len(re.findall(r"Window \[", plan)) == 1


def test_filters_reach_the_scan(spark):
    plan = entry.queries()["filter_blank_text"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    days = view(spark, FOLDER, "senti_v").select("event_id")
    assert "props" not in days._jdf.queryExecution().executedPlan().toString()


def test_native_scores_are_not_shuffled(spark):
    assert "Exchange" not in plan_of(spark, "document_mean")


def test_merge_shuffles_for_duplicates_only(spark):
    assert plan_of(spark, "merge_sources").count("Exchange hashpartitioning") == 2


def test_months_of_a_join_prune_the_catalog_table(spark):
    plan = entry.queries()["sql_catalog_table"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_a_flat_csv_is_read_by_several_tasks(spark):
    path = scratch_path(spark, "flat")
    texts = spark.range(3000).select("id", F.concat(F.lit("a\nb\\n\r\"c\\\\ "), F.col("id"), F.repeat(F.lit("x"), 99)).alias("t"))
    writers.write_csv(texts.coalesce(1), path, flat=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = readers.read_csv(spark, path, texts.schema, flat=True)
        assert rows.select(F.spark_partition_id()).distinct().count() > 3
        assert sorted(rows.collect()) == sorted(texts.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
