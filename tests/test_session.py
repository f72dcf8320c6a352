from types import SimpleNamespace

from wickwork.session import materialise, scratch_path, scratch_root


def test_the_named_folder_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(f"{root}/x-")


def test_a_temporary_folder_only_without_one():
    state = {"dir": None, "set": 0}

    def set_dir(path):
        state.update(dir=path, set=state["set"] + 1)

    context = SimpleNamespace(master="local[2]", getCheckpointDir=lambda: state["dir"], setCheckpointDir=set_dir)
    unset = SimpleNamespace(
        sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default)
    )
    assert scratch_root(unset) == scratch_root(unset)
    assert state["set"] == 1


def test_materialised_tables_are_plain_scans(spark):
    rows = spark.range(10).selectExpr("id", "id * 2 as twice")
    stored = materialise(rows, "t")
    assert stored.dtypes == rows.dtypes and stored.count() == 10
    assert "Range" not in stored._jdf.queryExecution().executedPlan().toString()
