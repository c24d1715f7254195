from types import SimpleNamespace

import pytest

from tidemark.session import shared_root, work_folder


def fake_session(master, checkpoint_dir=None, app="app-1"):
    settings = {} if checkpoint_dir is None else {"spark.checkpoint.dir": checkpoint_dir}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master, applicationId=app),
    )


def test_the_cluster_names_the_shared_folder():
    assert shared_root(fake_session("spark://host", "hdfs://shared/")) == "hdfs://shared"


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(fake_session("yarn"))


def test_a_local_session_gets_its_own():
    local = fake_session("local[2]")
    assert shared_root(local) == shared_root(local)
    assert work_folder(local, "a") != work_folder(local, "a")


def test_settings_the_operators_rely_on(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
