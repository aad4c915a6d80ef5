from types import SimpleNamespace

import pytest

from tallyhouse.operators.staging import released, settled
from tallyhouse.session import shared_folder, shuffle_width


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(context, folder=None):
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder} if folder else {}, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_folder(session(Context("yarn"), "hdfs:/shared/"), "x").startswith("hdfs:/shared/x-")
    assert shared_folder(session(Context("yarn", "s3a://b/c")), "x").startswith("s3a://b/c/x-")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError):
        shared_folder(session(Context("spark://host:7077")), "x")


def test_local_sessions_fall_back_once():
    local = session(Context("local[2]"))
    first, second = shared_folder(local, "x"), shared_folder(local, "x")
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_session_settings(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_shuffle_width_follows_the_input():
    assert shuffle_width(0) == 200
    assert shuffle_width(100 << 40) == 100 * 8192


def test_settled_tables_are_removed_when_released(spark):
    import os

    released(spark)
    table = settled(spark.range(5), "five")
    folder = table.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert table.count() == 5 and os.path.isdir(folder)
    assert released(spark) == 1 and not os.path.exists(folder)
    assert released(spark) == 0
