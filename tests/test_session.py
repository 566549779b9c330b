from types import SimpleNamespace

import pytest

from sensorweave import session


def fake(master, folder=None):
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default), sparkContext=context)


def test_named_folder_is_used_everywhere():
    assert session.shared_folder(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.scratch_path(fake("yarn", "hdfs:///shared"), "x").startswith("hdfs:///shared/sensorweave/app-yarn/x-")


def test_local_session_gets_one_folder_of_its_own():
    local = fake("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_cluster_must_name_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("spark://host:7077"))


def test_object_store_settings():
    conf = session.s3a_conf("http://store:9000", "k", "s")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"


def test_session_has_the_engine_settings(spark):
    for key, value in session.ENGINE_CONF.items():
        assert spark.conf.get(key) == value
