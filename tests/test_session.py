"""The shared folder for intermediate tables."""

from types import SimpleNamespace

import pytest

from shardlog.session import scratch_path, shared_dir, store


def fake(master, setting=None):
    conf = SimpleNamespace(get=lambda key, default=None: setting or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_the_setting_is_used_as_it_is():
    assert shared_dir(fake("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake("spark://host:7077"))


def test_one_machine_gets_a_folder_of_its_own():
    one = fake("local[2]")
    assert shared_dir(one) == shared_dir(one)
    assert scratch_path(one, "a") != scratch_path(one, "a")


def test_a_stored_table_stays_what_it_was(spark):
    rows = store(spark.range(100).selectExpr("id", "rand() as r"), "random")
    assert sorted(rows.collect()) == sorted(rows.collect()) and rows.schema.names == ["id", "r"]
