import pytest

from stopover.session import fresh_path, shared_folder, staged


class Settings:
    """Stands in for a session: only its settings are read."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_named_folder_is_used():
    named = Settings(spark_checkpoint_dir="hdfs:///shared/", spark_master="yarn")
    assert shared_folder(named) == "hdfs:///shared"
    assert fresh_path(named, "x").startswith("hdfs:///shared/x-")
    assert fresh_path(named, "x") != fresh_path(named, "x")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,3000]"])
def test_a_cluster_without_one_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Settings(spark_master=master))


def test_a_local_session_may_go_without():
    local = Settings(spark_master="local[4]", spark_app_id="one")
    assert shared_folder(local) == shared_folder(local)


def test_staged_tables_come_back_whole(spark):
    df = spark.range(50).selectExpr("id", "if(id % 2 = 0, null, struct(id as a)) s")
    assert sorted(staged(df, "t").collect()) == sorted(df.collect())
