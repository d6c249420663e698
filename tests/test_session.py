from __future__ import annotations

from types import SimpleNamespace

import pytest

from tallyloom.session import SETTINGS, scratch_folder


def fake(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_session_has_the_settings(spark):
    assert {key: spark.conf.get(key) for key in SETTINGS} == SETTINGS


def test_scratch_lies_in_the_shared_folder():
    cluster = fake("spark://host:7077", spark_checkpoint_dir="hdfs://shared/scratch/")
    first, second = scratch_folder(cluster), scratch_folder(cluster)
    assert first.startswith("hdfs://shared/scratch/tallyloom-")
    assert first != second


@pytest.mark.parametrize("master", ["yarn", "local[2]", "local-cluster[2,1,1024]"])
def test_any_master_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_folder(fake(master))
