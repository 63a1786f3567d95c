"""The shape of the plans: what is read, and where rows are shuffled."""

import pytest

from chatloom.operators import censor_messages, compare_runs, latency_summary, load_rate, top_users
from chatloom.plans import views
from chatloom.plans.catalog import QUERIES
from helpers import messages, texts
from pyspark.sql import functions as F


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, read",
    [
        ("count_messages", "struct<>"),
        ("top_channels", "struct<value:double>"),
        ("top_users", "struct<user_id:bigint>"),
        ("sql_top_users", "struct<user_id:bigint>"),
    ],
)
def test_only_the_key_is_read(spark, sf_dir, name, read):
    assert f"ReadSchema: {read}" in plan(QUERIES[name](spark, sf_dir))


def test_top_list_has_one_shuffle_and_no_global_sort(spark, sf_dir):
    text = plan(top_users(views.chat_headers(spark, sf_dir)))
    assert "TakeOrderedAndProject" in text
    assert "partial_count" in text
    assert text.count("Exchange") == 1


def test_length_mask_compiles_its_pattern_once(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert "split(" not in plan(censor_messages(documents, views.LEXICON, "length"))


@pytest.mark.parametrize("mask", ["***", "length"])
def test_masking_does_not_shuffle(spark, sf_dir, mask):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = plan(censor_messages(documents, views.LEXICON, mask))
    assert "Exchange" not in text
    assert "Python" not in text


def test_summaries_have_one_shuffle(spark, sf_dir):
    log = views.latency_log(spark, sf_dir)
    for frame in (
        latency_summary(log, ["task"]),
        load_rate(log, ["task"]),
        compare_runs(log, ["task"], "engine", "a", "b", "latency_us"),
    ):
        assert plan(frame).count("Exchange") == 1


def test_large_tables_are_joined_without_a_broadcast(spark, sf_dir):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(views.chat(spark, sf_dir))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
        text = plan(censor_messages(views.chat(spark, sf_dir), views.LEXICON, max_pattern_chars=0, max_table_chars=0))
        # Only the hot words are broadcast, of which there can be few: twice with their pieces, and
        # once those to leave out.
        assert text.count("BroadcastExchange") == 3
        assert text.count("LocalTableScan") + text.count("Scan ExistingRDD") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_registered_plan_needs_python_or_a_cross_join(spark, sf_dir):
    for name, query in QUERIES.items():
        if name.startswith(("stream_", "job_")):
            continue
        text = plan(query(spark, sf_dir))
        assert "Python" not in text and "InPandas" not in text, name
        assert "Cartesian" not in text and "NestedLoop" not in text, name


def test_a_large_lexicon_is_not_written_out_in_plans(spark):
    words = spark.range(5000).select(F.format_string("qqzzxx%d", "id").alias("word"))
    phrase = spark.createDataFrame([("qqzzxx1 qqzzxx2",), ("Scum \x01\x02",)], "word string")
    rows = messages(spark, ["a Qqzzxx4999 b", "qqzzxx5000", "qqzzxx1 qqzzxx2", "x scum \x01\x02", None])
    masked = censor_messages(rows, words.union(phrase), max_pattern_chars=0)
    query = masked._jdf.queryExecution()
    assert "qqzzxx" not in query.toString() + query.executedPlan().treeString()
    assert texts(masked) == ["a *** b", "qqzzxx5000", "***", "x ***", None]
