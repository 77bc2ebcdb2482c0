"""Where written intermediates go."""

from __future__ import annotations

import os
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest

from tallybrook.scratch import cleared, shared_folder, written


def session(context=None, **settings):
    settings = {k.replace("_", "."): v for k, v in settings.items()}
    get = lambda key, default=None: settings.get(key, default)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(getCheckpointDir=lambda: context))


def test_the_cluster_names_the_folder():
    spark = session(spark_checkpoint_dir="hdfs://shared/work/", spark_master="yarn")
    first, second = shared_folder(spark, "a"), shared_folder(spark, "a")
    assert first.startswith("hdfs://shared/work/a-") and first != second


def test_a_cluster_without_the_setting_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session(spark_master="yarn"), "a")


def test_local_mode_has_a_folder_of_its_own():
    first = shared_folder(session(spark_master="local[2]"), "a")
    second = shared_folder(session(spark_master="local[2]"), "a")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_written_keeps_rows_and_schema_and_cuts_lineage(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', 1.50BD), (2, NULL, NULL) AS t(i, s, d)")
    back = written(df, "t")
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert back.inputFiles()
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in back.inputFiles())


def test_a_folder_set_on_the_context_counts():
    spark = session(context="hdfs://shared/set", spark_master="yarn")
    assert shared_folder(spark, "a").startswith("hdfs://shared/set/a-")


def test_what_was_written_in_a_scope_is_deleted(spark):
    df = spark.range(3)
    outside = written(df, "kept")
    with cleared(spark):
        inside = written(df, "gone").inputFiles()[0]
        assert written(df, "gone").count() == 3
    assert outside.count() == 3
    assert not os.path.exists(urlparse(inside).path)
