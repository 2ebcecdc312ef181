import os

from telarium import session


def test_settled_tables_keep_rows_and_types_and_go(spark):
    session.release(spark)
    df = spark.createDataFrame([(1, None, [1, 2]), (1, "x", None)], "a int, b string, c array<int>")
    got = session.settle(df)
    assert got.schema == df.schema and sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    path = session.local_path(session._settled[session._session(spark)][-1])
    assert os.path.isdir(path) and path.startswith(session.local_path(session.shared_dir(spark)))
    assert session.release(spark) == 1 and not os.path.exists(path)
    assert session.settle(df.limit(0)).count() == 0


def test_local_paths():
    assert session.local_path("file:///a/b") == "/a/b" and session.local_path("file:/a") == "/a" and session.local_path("hdfs://h/a") == "hdfs://h/a"


def test_scope_removes_its_own_tables_only(spark):
    from telarium.session import release, scope, settle

    release(spark)
    kept = settle(spark.range(3))
    with scope(spark):
        inside = settle(spark.range(4))
        path = inside.inputFiles()[0].removeprefix("file://")
        assert inside.count() == 4
    assert kept.count() == 3 and not os.path.exists(path)
    assert release(spark) == 1


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    import pytest
    from telarium.session import shared_dir

    conf, context = SimpleNamespace(get=lambda k, d: d), SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        shared_dir(SimpleNamespace(conf=conf, sparkContext=context))
