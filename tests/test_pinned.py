"""Where intermediate tables go, by what the session names."""

import os
from unittest.mock import MagicMock

import pytest

from shopworth.sources import pin, pinned, release
from shopworth.sources.pinned import scratch_folder


def session(named=None, set_by_user=None, master="local[2]"):
    spark = MagicMock()
    spark.conf.get.return_value = named
    spark.sparkContext.master = master
    spark.sparkContext.getCheckpointDir.return_value = set_by_user
    return spark


def test_the_named_folder_is_used():
    assert scratch_folder(session(named="hdfs://shared/scratch")) == "hdfs://shared/scratch"
    assert scratch_folder(session(set_by_user="hdfs://mine", master="yarn")) == "hdfs://mine"


def test_local_mode_makes_its_own_folder_and_sets_nothing():
    spark = session()
    assert "shopworth-" in scratch_folder(spark)
    spark.sparkContext.setCheckpointDir.assert_not_called()
    spark.conf.set.assert_not_called()


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_a_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session(master=master))


def test_tables_get_their_own_paths_and_can_be_released(spark):
    before = pinned(spark)
    first, second = pin(spark.range(3)), pin(spark.range(4))
    assert (first.count(), second.count()) == (3, 4)
    folders = [os.path.dirname(df.inputFiles()[0].removeprefix("file://")) for df in (first, second)]
    assert len(set(folders)) == 2 and pinned(spark) == before + 2
    release(spark, since=before)
    assert pinned(spark) == before and not any(map(os.path.exists, folders))
