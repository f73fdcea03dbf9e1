"""Staged tables: what is freed, and when."""

import os

import pytest

from crawlstrata.session import FREE_SHUFFLES, checkpoint_dir, drop_folder, scratch, stage


def local(path):
    return path.removeprefix("file:")


def test_a_folder_of_staged_tables_is_dropped_alone(spark):
    folder = scratch(spark, "part")
    inside = stage(spark.range(5), folder)
    other = stage(spark.range(3))
    assert inside.count() == 5 and os.listdir(local(folder))
    drop_folder(spark, folder)
    assert not os.path.exists(local(folder)) and other.count() == 3
    drop_folder(spark, folder)


def test_only_folders_of_this_application_are_dropped(spark):
    for path in (checkpoint_dir(spark), "/", "/tmp/other"):
        with pytest.raises(ValueError):
            drop_folder(spark, path)


def test_stage_leaves_the_session_as_it_was(spark):
    before = spark.conf.get(FREE_SHUFFLES)
    rows = spark.range(100).groupBy("id").count()
    assert stage(rows).count() == 100 and spark.conf.get(FREE_SHUFFLES) == before
    with pytest.raises(Exception):
        stage(rows.selectExpr("raise_error('stop') AS x"))
    assert spark.conf.get(FREE_SHUFFLES) == before
    # What was staged can be made again, though its shuffle is gone.
    assert stage(rows).count() == rows.count() == len(rows.collect()) == 100
