from types import SimpleNamespace

from ratelens.session import configure, work_dir


def session(**settings):
    settings = {"spark.sql.warehouse.dir": "file:/w/house", **settings}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))


def test_shared_folder_is_used():
    set_ = session(**{"spark.checkpoint.dir": "hdfs://shared/x/"})
    assert work_dir(set_, "a").startswith("hdfs://shared/x/a-")


def test_warehouse_where_no_folder_is_set():
    first, second = (work_dir(session(), "a") for _ in range(2))
    assert first != second and first.startswith("file:/w/house/_work/a-")



def test_tasks_after_a_shuffle_are_small(spark):
    assert configure(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16MB"
