"""The versioned store: what an update touches, and what a failed one leaves."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harborline import jobs
from harborline.sources.store import Conflict, Store

ROWS = "id long, v string"


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(os.path.join(path, "data")) for n in names if n.endswith(".parquet")}


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_update_rewrites_only_touched_parts(spark, tmp_path):
    path = str(tmp_path / "store")
    store = Store(spark, path)
    rows = [(k, f"old {k}") for k in range(500)]
    assert store.create(spark.createDataFrame(rows, ROWS), "id", parts=32) == 1
    before, first = files(path), store.manifest()
    assert store.upsert(spark.createDataFrame([(7, "new"), (1_000, "more"), (7, "a")], ROWS)) == 2
    want = sorted([(k, "new" if k == 7 else v) for k, v in rows] + [(1_000, "more")], key=str)
    assert content(store.read()) == want and store.count() == 501
    now = store.manifest()
    changed = [p for p in now["held"] if now["held"][p] != first["held"].get(p)]
    assert 1 <= len(changed) <= 2 and before <= files(path)
    assert content(store.read(1)) == sorted(rows, key=str) and store.count(1) == 500
    gone = store.vacuum()
    assert gone == [] and store.versions() == [2]  # the first folder still holds most parts
    assert content(store.read()) == want
    store.upsert(spark.createDataFrame([(k, "all") for k in range(500)] + [(1_000, "all")], ROWS))
    assert len(store.vacuum()) == 2 and content(store.read()) == sorted([(k, "all") for k in [*range(500), 1_000]], key=str)


def test_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    store = Store(spark, path)
    store.create(spark.createDataFrame([(k, "old") for k in range(50)], ROWS), "id", parts=4)
    before, versions, rows = files(path), store.versions(), content(store.read())
    bad = spark.range(60).select("id", F.when(F.col("id") == 59, F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.lit("new")).alias("v"))
    with pytest.raises(Exception, match="broken row"):
        store.upsert(bad)
    assert store.versions() == versions and content(store.read()) == rows and before <= files(path)
    store.vacuum()
    assert files(path) == before


def test_second_writer_of_a_version_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.create(spark.createDataFrame([(1, "a")], ROWS), "id", parts=2)
    stale = store.manifest()
    store.upsert(spark.createDataFrame([(2, "b")], ROWS))
    with pytest.raises(Conflict):
        store._commit(stale | {"version": 2})
    with pytest.raises(Conflict):
        store.create(spark.createDataFrame([(1, "a")], ROWS), "id")
    assert content(store.read()) == [(1, "a"), (2, "b")]


def test_odd_stores(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.read()
    store.create(spark.createDataFrame([], ROWS), "id")
    assert store.count() == 0 and store.read().count() == 0
    assert store.upsert(spark.createDataFrame([], ROWS)) == 1
    store.upsert(spark.createDataFrame([(5, None)], ROWS).select("v", "id", F.lit(1).alias("extra")))
    assert content(store.read()) == [(5, None)] and isinstance(store.read().schema["id"].dataType, T.LongType)


def test_index_is_updated_in_place(spark, tmp_path):
    path = str(tmp_path / "index")
    schema = "text string, source string, page int"
    docs = spark.createDataFrame([("Annual leave needs approval.", "leave.txt", None), ("Rotate passwords often.", "security.txt", None)], schema)
    assert jobs.update_index(spark, docs, path) == 1
    assert jobs.update_index(spark, spark.createDataFrame([("Lunch is at noon.", "food.txt", None)], schema), path) == 2
    asked = spark.createDataFrame([(1, "When is lunch?"), (2, "Who approves annual leave?")], "question_id int, text string")
    _, hits = jobs.ask(spark, path, asked)
    assert {r.question_id: r.source for r in hits.where("rank = 1").collect()} == {1: "food.txt", 2: "leave.txt"}
