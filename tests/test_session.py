from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from marketfold import session
from marketfold.operators.staging import stage


def test_settings_follow_the_input_size():
    assert session.settings_for(10**9)["spark.sql.shuffle.partitions"] == "200"
    assert 20_000 < int(session.settings_for(10**14)["spark.sql.shuffle.partitions"]) < 30_000


def test_checkpoint_folder_comes_from_the_session(spark, scratch):
    assert str(scratch / "checkpoints") in session.checkpoint_dir(spark)
    assert session.checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_staged_rows_lie_in_that_folder(spark, scratch):
    def files():
        return set((scratch / "checkpoints").rglob("part-*"))

    before = files()
    staged = stage(spark.range(5).groupBy().agg(F.sum("id").alias("total")))
    assert files() > before
    assert staged.first()["total"] == 10
    assert "Aggregate" not in plan_of(staged)


def fake_session(master, configured, current=None):
    chosen = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: current or (chosen[-1] if chosen else None),
        setCheckpointDir=chosen.append,
    )
    conf = SimpleNamespace(get=lambda key, default: configured or default)
    return SimpleNamespace(sparkContext=context, conf=conf), chosen


def test_a_cluster_must_name_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake_session("yarn", None)[0])


def test_a_cluster_folder_is_used_as_given():
    fake, chosen = fake_session("yarn", "hdfs:///shared")
    assert session.checkpoint_dir(fake) == "hdfs:///shared"
    assert chosen == ["hdfs:///shared"]


def test_a_local_session_falls_back_to_a_temporary_folder():
    fake, chosen = fake_session("local[2]", None)
    assert session.checkpoint_dir(fake) == chosen[0]


@pytest.mark.parametrize("configured", [None, "hdfs:///other"])
def test_a_folder_set_by_the_caller_is_kept(configured):
    fake, chosen = fake_session("yarn", configured, current="hdfs:///mine/run-1")
    assert session.checkpoint_dir(fake) == "hdfs:///mine/run-1"
    assert chosen == []
