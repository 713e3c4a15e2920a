"""Plans that must hold at scale: no shuffle too many, no column too many."""

import re

from pyspark.sql import functions as F

from rowtide.operators.latest import latest_per_key
from rowtide.operators.merge import apply_changes
from rowtide.operators.parse import changes, decode
from rowtide.sources.topic import Topic
from rowtide.spec import USERS
from rowtide.workload import tables as t
from rowtide.workload.queries import QUERIES
from tests.helpers import plan, rows

SF = "/root/testdata/sf0.01"


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange (?:hash|range|Single)", plan(df)))


def test_parsing_is_one_stage_without_python(spark, tmp_path):
    topic = Topic(spark, str(tmp_path / "t"), "events")
    topic.append(t.events_topic(spark, SF))
    df = changes(decode(topic.read()), t.EVENT_SPEC)
    text = plan(df)
    assert exchanges(df) == 0 and "Python" not in text
    assert text.count("json_tuple") == 1  # the message is read once, also by the filter
    assert text.count("get_json_object") == 1  # and the key once


def test_ranking_cuts_each_key_before_the_shuffle(spark):
    text = plan(QUERIES["latest_change"](spark, SF))
    partial, final = text.index(", Partial"), text.index(", Final")
    assert final < text.index("Exchange hashpartitioning") < partial
    assert exchanges(QUERIES["latest_change"](spark, SF)) == 1


def test_merge_reuses_the_partitioning_of_the_ranking(spark):
    assert exchanges(QUERIES["merge_apply"](spark, SF)) == 2  # one per side, to rank it


def test_merge_has_one_plan_for_changes_of_any_size(spark):
    state = spark.range(1000).selectExpr("id ID", "'a' name", "'b' email", "1 age", "now() created_at")
    inc = state.withColumn("__op", F.lit("d")).filter("ID < 10")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []
    for most in ("100", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
        merged = apply_changes(state, inc, USERS)
        plans.append(plan(merged).count("FullOuter"))
        assert merged.count() == 990
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans == [1, 1]


def test_counting_actions_reads_keys_and_operations_only(spark):
    text = plan(QUERIES["merge_action_counts"](spark, SF))
    assert "o_totalprice" not in text and "o_orderpriority" not in text


def test_top_rows_are_not_a_global_sort(spark):
    for name in ("changelog_pending", "recent_changes", "recent_change_ids", "topic_peek"):
        text = plan(QUERIES[name](spark, SF))
        assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_a_hot_key_sends_one_row_per_task(spark):
    """A key with most of the rows leaves each input task as one row."""
    rows_in = spark.range(0, 100_000, numPartitions=8).select(
        F.when(F.col("id") % 5 < 4, 7).otherwise(F.col("id")).alias("ID"),
        F.lit("u").alias("__op"),
        F.timestamp_seconds("id").alias("kafka_timestamp"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    latest = latest_per_key(rows_in, "ID")
    assert rows(latest.filter("ID = 7"), "offset") == [(99_998,)]
    latest.collect()
    executed = latest._jdf.queryExecution().executedPlan()
    shuffled = re.search(r"Exchange hashpartitioning", executed.toString())
    assert shuffled
    # 20 000 other keys plus one row of the hot key per input task.
    metric = _shuffle_rows(executed)
    assert 20_000 <= metric <= 20_000 + 8


def _shuffle_rows(node) -> int:
    """Rows written by the shuffle of an adaptive plan that has run."""
    stack = [node.executedPlan()]
    while stack:
        n = stack.pop()
        if n.nodeName() == "Exchange":
            return int(n.metrics().apply("shuffleRecordsWritten").value())
        if n.nodeName().endswith("QueryStage"):
            stack.append(n.plan())
        else:
            stack.extend(n.children().apply(i) for i in range(n.children().size()))
    raise AssertionError("no shuffle in the plan")
