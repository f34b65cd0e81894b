"""Physical-plan properties the design relies on at scale."""

import re

import pytest

from tidemark.plans import catalog as c

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static_plans(spark):
    """Plans without AQE's runtime rewrites, with broadcasting off, as at large scale."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    for k, v in old.items():
        spark.conf.set(k, v)


def test_fold_cuts_to_one_row_a_key_before_its_only_shuffle(spark, static_plans):
    plan = static_plans(c.fold_lsn(spark, SF))
    exchange = plan.index("Exchange hashpartitioning")
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Final") < exchange < plan.index("Partial")  # WindowGroupLimit on either side
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan


def test_reconcile_join_adds_no_shuffle(spark, static_plans):
    plan = static_plans(c.recon_keys(spark, SF))
    assert "SortMergeJoin" in plan and "FullOuter" in plan
    # one exchange per fold (truth, lake), none for the join itself
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2


def test_samples_limit_before_shuffle(spark, static_plans):
    plan = static_plans(c.recon_samples(spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan


def test_running_max_shuffles_rows_on_key_and_chunk(spark, static_plans):
    plan = static_plans(c.applied_events(spark, SF))
    assert re.search(r"Exchange hashpartitioning\(order_id#\d+L, _chunk#\d+L", plan)


def test_net_changes_fold_the_log_once(spark, static_plans):
    plan = static_plans(c.batch_net_changes(spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 5
    assert len(re.findall(r"WindowGroupLimit .*Final", plan)) == 1  # one fold


def test_prior_state_is_found_by_hash_aggregates(spark, static_plans):
    plan = static_plans(c.batch_against_state(spark, SF))
    assert re.search(r"HashAggregate\(keys=\[batch#\d+L, order_id#\d+L\], functions=\[partial_max\(_lsn", plan)


def test_applying_changes_probes_the_state_once(spark, static_plans):
    plan = static_plans(c.apply_changes(spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 6


def test_prior_images_take_no_part_in_windows_or_maxima(spark, static_plans):
    plan = static_plans(c.changelog_before_after(spark, SF))
    ranked = [line for line in plan.splitlines() if re.search(r"Window \[|max\(", line)]
    assert ranked and not any("max(struct" in line or "max(named_struct" in line for line in ranked)
    assert not any("status" in re.sub(r"output=.*", "", line.split("windowspec")[0]) for line in ranked if "max(" in line)


def test_running_max_has_windows_by_key_and_upper_chunk(spark, static_plans):
    plan = static_plans(c.applied_events(spark, SF))
    assert re.search(r"Exchange hashpartitioning\(order_id#\d+L, _upper#\d+", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_hot_key_spans_chunks_with_topic_coordinates(spark):
    """One key on one partition of a topic: its offsets must not share a chunk."""
    from pyspark.sql import functions as F

    from tidemark.operators.ordered import ARRIVAL_CHUNK, chunk_at
    rows = spark.range(10).select(F.lit(3).alias("partition"), (F.col("id") * ARRIVAL_CHUNK).alias("offset"))
    assert rows.select(chunk_at(("partition", "offset"), "offset", ARRIVAL_CHUNK).alias("c")).distinct().count() == 10


def test_decode_parses_each_line_once(spark, static_plans):
    plan = static_plans(c.decode_op_counts(spark, SF))
    # one parse of the line, one of an optional {schema, payload} wrapper
    assert plan.count("from_json(") == 2
