import os
import time

import pytest
from pyspark.sql import functions as F

from typerank.sources import stage


class Settings(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Session:
    def __init__(self, **settings):
        self.conf = Settings({k.replace("_", "."): v for k, v in settings.items()})


def test_order_of_the_settings():
    assert stage.shared_folder(Session(spark_checkpoint_dir="a", spark_sql_warehouse_dir="b")) == "a"
    assert stage.shared_folder(Session(spark_sql_warehouse_dir="b")) == "b"
    with pytest.raises(ValueError):
        stage.shared_folder(Session())


def test_staged_tables_can_be_cleared(spark):
    table = stage.staged(spark.range(3), "cleared")
    path = table.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert table.count() == 3 and os.path.isdir(path)
    paths = stage._written.pop(spark.sparkContext.applicationId)
    stage._written[spark.sparkContext.applicationId] = [p for p in paths if "cleared" in p]
    assert stage.clear(spark) == 1 and not os.path.isdir(path)
    stage._written[spark.sparkContext.applicationId] = [p for p in paths if "cleared" not in p]


def test_a_stored_table_leaves_no_shuffle(spark):
    """What its write has shuffled is deleted at once; the setting is as before."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(stage.CLEANUP, None)
    table = stage.staged(spark.range(1000).repartition(5, "id").groupBy((F.col("id") % 7).alias("m")).count(), "whole")
    assert {r["m"]: r["count"] for r in table.collect()}[0] == 143
    end = time.time() + 20
    while shuffles() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffles() - before
    assert spark.conf.get(stage.CLEANUP, None) == setting
