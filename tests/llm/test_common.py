import pytest

from plateworks.llm import common


def test_a_worker_forgets_when_a_task_ends(monkeypatch):
    kept = [{1: 1}, {2: 2}]
    monkeypatch.setattr(common, "MEMOS", [k.clear for k in kept])
    common.leave()
    assert kept == [{}, {}]


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        common.shared_root(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs://h/shared/"}
    assert common.shared_root(Session()) == "hdfs://h/shared"


def test_shared_folder_is_the_sessions(spark):
    assert common.shared_root(spark) == (spark.conf.get("spark.checkpoint.dir", None) or common.shared_root(spark))
    df = common.materialize(spark.range(3), "test")
    assert df.count() == 3
    common.discard(df)
    assert common.local_path("file:///tmp/x") == "/tmp/x" and common.local_path("hdfs://h/x") is None and common.local_path("/a") == "/a"
