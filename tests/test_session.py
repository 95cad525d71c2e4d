"""Session settings and scratch space."""

import pytest

from ticketmill.session import SESSION_CONF, pin_utc, scratch_dir, shared_folder, state_partitions


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    """Just the two things scratch_dir looks at."""

    def __init__(self, master, **conf):
        self.conf = Conf({key.replace("_", "."): value for key, value in conf.items()})
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_space_follows_the_session():
    shared = Session("spark://host:7077", spark_checkpoint_dir="hdfs:///shared/")
    assert shared_folder(shared) == "hdfs:///shared"
    first, second = scratch_dir(shared, "x"), scratch_dir(shared, "x")
    assert first.startswith("hdfs:///shared/ticketmill/x-") and first != second


def test_scratch_space_without_a_checkpoint_folder_is_below_the_warehouse():
    plain = Session("yarn", spark_sql_warehouse_dir="hdfs:///warehouse/")
    assert shared_folder(plain) == "hdfs:///warehouse/_scratch"
    assert scratch_dir(plain, "x").startswith("hdfs:///warehouse/_scratch/ticketmill/x-")


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
@pytest.mark.parametrize("warehouse", ["file:/home/me/spark-warehouse", "/home/me/spark-warehouse"])
def test_a_warehouse_on_the_drivers_disk_is_no_scratch_space_for_other_nodes(master, warehouse):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(master, spark_sql_warehouse_dir=warehouse))
    assert shared_folder(Session("local[4]", spark_sql_warehouse_dir=warehouse)) == f"{warehouse}/_scratch"


def test_settings_are_applied(spark):
    for key, value in SESSION_CONF.items():
        assert spark.conf.get(key) == value


def test_pin_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    pin_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_state_partitions_are_those_of_the_session_unless_given(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with state_partitions(spark):
        assert spark.conf.get(key) == before
    with state_partitions(spark, 7):
        assert spark.conf.get(key) == "7"
    assert spark.conf.get(key) == before
