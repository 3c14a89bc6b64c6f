from types import SimpleNamespace

import pytest

from tallyforge.session import scratch_path, shared_root


def fake(settings, master="yarn"):
    conf = SimpleNamespace(get=lambda k, d=None: settings.get(k, d), set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_cluster_folder_is_taken_from_the_session():
    spark = fake({"spark.checkpoint.dir": "hdfs:///shared/cp/"})
    assert shared_root(spark) == "hdfs:///shared/cp/"
    assert scratch_path(spark, "x").startswith("hdfs:///shared/cp/x-")


def test_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError):
        shared_root(fake({}))


def test_local_mode_makes_one_folder():
    spark = fake({}, "local[2]")
    assert shared_root(spark) == shared_root(spark)
