"""The bucketed store: commits, touched buckets, versions, failed and repeated runs."""

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from docweave.operators import merge as M
from docweave.operators import store as ST

SCHEMA = TY.StructType([*[TY.StructField(c, TY.StringType()) for c in ("id", "link", "collection_name", "content")],
                        *[TY.StructField(c, TY.TimestampType()) for c in ("created_at", "updated_at")]])


def day(d):
    return F.lit(f"2024-01-{d:02d} 00:00:00").cast("timestamp")


def rows_of(spark, root, **at):
    return {(r.link, r.collection_name, r.content, r.created_at.day, r.updated_at.day) for r in ST.read_store(spark, root, SCHEMA, **at).collect()}


@pytest.fixture
def store(spark):
    root = tempfile.mkdtemp(prefix="dw-store-") + "/store"
    first = spark.range(200).select(F.concat(F.lit("l"), "id").alias("link"), F.lit("blogs").alias("collection_name"), F.lit("old").alias("content"))
    ST.create_store(first.select(M.document_id().alias("id"), "*", day(1).alias("created_at"), day(1).alias("updated_at")), root, buckets=16)
    return root


def batch(spark, rows):
    return spark.createDataFrame(rows, "seq long, link string, collection_name string, content string")


def test_a_batch_rewrites_its_buckets_only(spark, store):
    before = set(os.listdir(f"{store}/data"))
    assert ST.current_version(spark, store) == 1 and len(rows_of(spark, store)) == 200
    version, actions = ST.merge_batch(spark, store, SCHEMA, batch(spark, [(1, "l7", "news", "new")]), now=day(5))
    assert version == 2 and [r.action for r in actions.collect()] == ["moved"]
    (folder,) = set(os.listdir(f"{store}/data")) - before
    assert len([x for x in os.listdir(f"{store}/data/{folder}") if x.startswith("bucket=")]) == 1
    now = rows_of(spark, store)
    assert len(now) == 200 and ("l7", "news", "new", 1, 5) in now and ("l8", "blogs", "old", 1, 1) in now
    assert ("l7", "blogs", "old", 1, 1) in rows_of(spark, store, version=1)
    ids = {r.link: r.id for r in ST.read_store(spark, store, SCHEMA).collect()}
    assert ids["l7"] == {r.link: r.id for r in ST.read_store(spark, store, SCHEMA, version=1).collect()}["l7"] and len(set(ids.values())) == 200


def test_repeated_and_failed_runs(spark, store, monkeypatch):
    offered = batch(spark, [(1, "l7", "news", "new"), (2, "x", "news", "x"), (3, "l3", "blogs", "same place")])
    assert ST.merge_batch(spark, store, SCHEMA, offered, now=day(5))[0] == 2
    after = rows_of(spark, store)
    version, actions = ST.merge_batch(spark, store, SCHEMA, offered, now=day(6))
    assert version == 2 and {r.action for r in actions.collect()} == {"duplicate"} and rows_of(spark, store) == after
    more = batch(spark, [(1, "l9", "news", "lost")])

    def broken(*args, **kwargs):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(spark, "createDataFrame", broken)
    with pytest.raises(RuntimeError):
        ST.merge_batch(spark, store, SCHEMA, more, now=day(7))
    monkeypatch.undo()
    assert ST.current_version(spark, store) == 2 and rows_of(spark, store) == after
    assert ST.merge_batch(spark, store, SCHEMA, more, now=day(8))[0] == 3
    assert ("l9", "news", "lost", 1, 8) in rows_of(spark, store)


def test_store_equals_a_sequential_fold(spark, store):
    rnd = random.Random(2)
    state = {f"l{i}": ("blogs", "old") for i in range(200)}
    for run in range(3):
        rows = [(s, f"l{rnd.randrange(260)}", rnd.choice(["blogs", "news", "github"]), f"c{run}-{s}") for s in range(40)]
        ST.merge_batch(spark, store, SCHEMA, batch(spark, rows), now=day(9))
        for _, link, collection, content in rows:
            if state.get(link, ("", ""))[0] != collection:
                state[link] = (collection, content)
    assert {(a, b, c) for a, b, c, _, _ in rows_of(spark, store)} == {(k, *v) for k, v in state.items()}


def test_outcomes_and_an_empty_store(spark):
    root = tempfile.mkdtemp(prefix="dw-store-") + "/store"
    ST.create_store(spark.createDataFrame([], SCHEMA), root, buckets=4)
    assert ST.read_store(spark, root, SCHEMA).count() == 0
    offered = batch(spark, [(1, "a", "news", "a"), (2, "b", None, None)]).withColumn("outcome", F.expr("if(seq = 1, 'candidate', 'error')"))
    version, actions = ST.merge_batch(spark, root, SCHEMA, offered, outcome="outcome", now=day(2))
    assert version == 2 and {r.seq: r.action for r in actions.collect()} == {1: "inserted", 2: "error"}
    assert rows_of(spark, root) == {("a", "news", "a", 2, 2)}


def test_no_text_in_the_merge_windows(spark, store):
    offered = batch(spark, [(1, "l7", "news", "new")])
    stored = ST.read_store(spark, store, SCHEMA)
    state = M.new_state(stored, M.merge_actions(offered.select("seq", "link", "collection_name"), stored), offered, now=day(3))
    plan = state._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line or "Aggregate" in line:
            assert "content" not in line
