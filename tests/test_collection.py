"""Collections as a data source: life cycle, atomic inserts, pushed filters."""

import os

import pytest
from pyspark.sql import functions as F

from tessera.session import work_path
from tessera.sources.collection import Collection, _latest

SCHEMA = "id bigint, vec array<double>, subject string"


def some(spark, ids, subject="s"):
    return spark.createDataFrame([(i, [float(i), 1.0], f"{subject}{i % 3}" if i % 5 else None) for i in ids], SCHEMA)


@pytest.fixture
def made(spark):
    collection = Collection(spark, work_path(spark, "collection"))
    collection.create(some(spark, [1]).schema, 2, "subject")
    return collection


def ids(df):
    return sorted(r.id for r in df.collect())


def test_life_cycle(spark, made):
    assert made.exists() and ids(made.rows()) == []
    made.insert(some(spark, range(10)))
    made.insert(some(spark, range(10, 14)))
    assert ids(made.rows()) == list(range(14))
    with pytest.raises(ValueError):
        made.create(some(spark, [1]).schema, 2, "subject")
    made.insert(some(spark, [77]), replace=True)
    assert ids(made.rows()) == [77]
    made.create(some(spark, [1]).schema, 2, "subject", drop_if_exists=True)
    assert ids(made.rows()) == []
    made.insert(some(spark, [5, 6]))
    made.drop()
    assert not made.exists()
    with pytest.raises(Exception, match="no collection"):
        made.rows().collect()
    made.create(some(spark, [1]).schema, 2, "subject")
    assert ids(made.rows()) == []


def test_a_failed_insert_leaves_nothing(spark, made):
    made.insert(some(spark, range(3)))
    before = _latest(made.path)
    bad = some(spark, range(10, 40)).union(spark.createDataFrame([(99, [1.0], "s1")], SCHEMA)).union(spark.createDataFrame([(98, None, "s1")], SCHEMA)).repartition(4)
    with pytest.raises(Exception, match="dimension"):
        made.insert(bad)
    assert _latest(made.path) == before and ids(made.rows()) == [0, 1, 2]
    made.vacuum()
    assert len(os.listdir(f"{made.path}/data")) == len(before[1]["files"])
    with pytest.raises(Exception, match="cannot be resolved|columns"):
        made.insert(some(spark, [1]).withColumnRenamed("subject", "topic"))


def test_a_filter_reads_only_its_files(spark, made):
    made.insert(some(spark, range(40)))
    rows = made.rows()
    assert ids(rows.filter("subject = 's1'")) == [i for i in range(40) if i % 3 == 1 and i % 5]
    assert ids(rows.filter(F.col("subject").isin("s0", "s2"))) == [i for i in range(40) if i % 3 != 1 and i % 5]
    assert ids(rows.filter("subject is null")) == list(range(0, 40, 5))
    assert ids(rows.filter("subject = 's1' and id > 20")) == [i for i in range(21, 40) if i % 3 == 1 and i % 5]
    for f in _latest(made.path)[1]["files"]:  # without the other files the filter still works
        if f["value"] != "s1":
            os.rename(f"{made.path}/data/{f['name']}", f"{made.path}/data/{f['name']}.away")
    assert len(ids(made.rows().filter("subject = 's1'"))) == len([i for i in range(40) if i % 3 == 1 and i % 5])
