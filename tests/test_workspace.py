"""Where intermediate tables go."""

import pytest

from tesselar import workspace


def test_configured_folder_is_used(spark):
    configured = spark.conf.get(workspace.CHECKPOINT_DIR, None)
    if configured:
        assert workspace.new_path(spark, "t").startswith(configured.rstrip("/"))


def test_local_master_without_setting(spark, monkeypatch):
    monkeypatch.setattr(workspace, "CHECKPOINT_DIR", "spark.checkpoint.dir.unset")
    first, second = workspace.new_path(spark, "t"), workspace.new_path(spark, "t")
    assert first != second
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
    assert workspace.materialize(spark.range(5), "five").count() == 5


def test_cluster_master_needs_the_setting(spark, monkeypatch):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = spark.conf
        sparkContext = Context()

    monkeypatch.setattr(workspace, "CHECKPOINT_DIR", "spark.checkpoint.dir.unset")
    with pytest.raises(ValueError, match="every executor"):
        workspace.root_dir(Session())


def test_written_tables_have_no_lineage(spark):
    written = workspace.materialize(spark.range(10).selectExpr("id * 2 AS twice"), "twice")
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in plan and "FileScan parquet" in plan
    assert sorted(row["twice"] for row in written.collect()) == list(range(0, 20, 2))
