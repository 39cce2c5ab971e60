"""The shared working folder comes from the session; only local sessions may do without."""

from types import SimpleNamespace

import pytest

from tablesync.session import new_work_path, work_dir


def fake(master, configured=None, current=None):
    state = {"dir": current}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda path: state.update(dir=path),
    )
    conf = SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_configured_folder_wins():
    session = fake("yarn", "hdfs:///shared")
    assert work_dir(session) == "hdfs:///shared" and session.sparkContext.getCheckpointDir() == "hdfs:///shared"
    assert work_dir(fake("yarn", None, "hdfs:///set-before")) == "hdfs:///set-before"


def test_cluster_without_folder_fails():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_dir(fake("yarn"))


def test_local_session_gets_one_folder():
    session = fake("local[2]")
    assert work_dir(session) == work_dir(session)


def test_work_paths_differ(spark):
    assert new_work_path(spark, "a") != new_work_path(spark, "a")
    assert new_work_path(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
