"""Plans stay as designed: pruned scans, one shuffle per key, built-in expressions."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tesselar.operators.alarms import breach_counters
from tesselar.operators.cuts import fitting_cuts, id_counts
from tesselar.operators.dsgd import FactorStore, block_layout, dsgd_update, turn_error
from tesselar.operators.evaluate import stored_block_error
from tesselar.operators.factors import init_factors, observed_ids
from tesselar.operators.grid import measured_grid
from tesselar.operators.health import health_state
from tesselar.operators.membership import active_members
from tesselar.plans import views
from tesselar.workspace import materialize

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_blocks(spark, rows_per_block=10_000):
    ratings = materialize(views.ratings(spark, SF_DIR), "ratings")
    cuts = fitting_cuts(measured_grid(ratings, 4), id_counts(ratings), rows_per_block)
    layout = block_layout(ratings, cuts, rows_per_block=rows_per_block)
    return layout, FactorStore(layout, init_factors(observed_ids(ratings), 4, 1))


@pytest.mark.parametrize("rows_per_block", [10_000, 300])
def test_a_turn_shuffles_nothing(spark, rows_per_block):
    """No Exchange above the stored samples, nor above the factors; only the samples of the turn are read."""
    layout, store = stored_blocks(spark, rows_per_block)
    for turn in (0, 1):
        updated = dsgd_update(layout, store.read(), turn, 0.01)
        plan = plan_of(updated)
        assert "Exchange" not in plan
        assert plan.count("Bucketed: true") == 2
        assert "(s#" in plan.split("PartitionFilters: [isnotnull(s#")[1]
        store.write(updated)
    # Users stay in their bucket; items go where they are needed next.
    buckets = store.files().select("role", "key", F.regexp_extract(F.input_file_name(), r"_(\d{5})\.", 1).cast("int").alias("bucket"))
    assert buckets.where("key <> bucket").count() == 0


def test_no_vector_is_shuffled_for_an_error(spark):
    layout, store = stored_blocks(spark)
    assert "Exchange" not in plan_of(turn_error(layout, store.read(), 0, 1))
    plan = plan_of(stored_block_error(store))
    assert plan.count("Exchange") == 1
    assert "vec" not in plan.split("Exchange")[1].split("\n")[0]


def test_samples_are_stored_by_level_in_one_file_a_block(spark):
    layout, _ = stored_blocks(spark, 300)
    files = layout.table.files().select(F.input_file_name().alias("file"), "rs", "cs", "lvl", F.monotonically_increasing_id().alias("n"))
    assert files.select("file").distinct().count() == files.select("rs", "cs").distinct().count()
    before = F.lag("lvl").over(Window.partitionBy("file").orderBy("n"))
    assert files.withColumn("before", before).where("before > lvl").count() == 0


def test_three_running_scans_share_one_shuffle_and_sort(spark):
    plan = plan_of(health_state(views.probes(spark, SF_DIR)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_state_of_hot_keys_needs_one_layout(spark):
    """Rows of hot keys are shuffled when they are stored in order, and never again: one scan of the stored rows."""
    probes = views.probes(spark, SF_DIR)
    plan = plan_of(health_state(probes, 2, 2, 50))
    assert "Exchange" not in plan and "Window" not in plan
    assert plan.count("FileScan") == plan.count("Bucketed: true") == 1
    labelled = probes.select(F.lit("all").alias("dim"), F.col("ts").alias("t"), F.lit("up").alias("label"))
    plan = plan_of(breach_counters(labelled, 50))
    assert "Exchange" not in plan and plan.count("FileScan") == 1


def test_members_shuffle_once_and_filter_in_the_scan(spark):
    plan = plan_of(active_members(views.members(spark, SF_DIR)))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "PushedFilters: [In(event_type, [error,signup])" in plan
