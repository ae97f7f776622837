from gleanframe.session import shared_path


class Session:
    """Stands in for a session with given settings."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_comes_from_the_session():
    got = shared_path(Session(**{"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"}), "x")
    assert got.startswith("hdfs:///shared/x-")


def test_the_warehouse_is_the_other_shared_folder():
    got = shared_path(Session(**{"spark.master": "yarn", "spark.sql.warehouse.dir": "hdfs:///tables"}), "x")
    assert got.startswith("hdfs:///tables/x-")


def test_fresh_path_each_time(spark):
    assert shared_path(spark, "x") != shared_path(spark, "x")
