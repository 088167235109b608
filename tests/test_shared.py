import pytest

from tablehaul.shared import new_folder, remove_staged, shared_root, stage


def test_staged_rows_do_not_change(spark):
    from pyspark.sql import functions as F

    staged = stage(spark.range(50).select(F.rand().alias("r")), "random")
    assert sorted(staged.collect()) == sorted(staged.collect())
    assert staged.dtypes == [("r", "double")]


def test_folders_are_below_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root.rstrip("/")
    one, two = new_folder(spark, "a"), new_folder(spark, "a")
    assert one != two and one.startswith(f"{root}/tablehaul-{spark.sparkContext.applicationId}/")


def test_staged_rows_can_be_removed(spark):
    staged = stage(spark.range(5), "gone")
    assert staged.count() == 5
    remove_staged(spark)
    with pytest.raises(Exception):
        staged.collect()
    assert stage(spark.range(3), "again").count() == 3
