from types import SimpleNamespace

import pytest

from lakewarden.session import new_folder, shared_folder, shuffle_partitions


def test_configured_folder_is_used(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "x").startswith(shared_folder(spark) + "/lakewarden/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def stub(master, current=None):
    context = SimpleNamespace(master=master, current=current)
    context.getCheckpointDir = lambda: context.current
    context.setCheckpointDir = lambda folder: setattr(context, "current", folder)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(stub("yarn"))
    assert shared_folder(stub("yarn", "hdfs://nn/shared/")) == "hdfs://nn/shared"


def test_a_local_session_gets_one_folder():
    session = stub("local[2]")
    assert shared_folder(session) == shared_folder(session)


def test_shuffle_partitions_follow_the_size():
    mib = 1024**2
    assert [shuffle_partitions(size) for size in (0, 1, 128 * mib, 128 * mib + 1, 1280 * mib)] == [1, 1, 1, 2, 10]
