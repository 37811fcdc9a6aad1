import datetime as dt
import random

import pytest

from plumbline.operators import changes, passages
from plumbline.session import scratch_path
from plumbline.sources import tables
from plumbline.streaming import feed as feeds


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id string, content_hash string, text string")


@pytest.fixture()
def states(spark):
    before = docs(spark, [("same", "1", "a"), ("edited", "2", "b"), ("gone", "3", "c")])
    after = docs(spark, [("same", "1", "a"), ("edited", "9", "B"), ("fresh", "4", "d")])
    return before, after


def test_statuses(states):
    before, after = states
    got = {r["doc_id"]: r["status"] for r in changes.classify(before, after).collect()}
    assert got == {"same": "unchanged", "edited": "changed", "gone": "removed", "fresh": "new"}
    full = {r["doc_id"]: r["status"] for r in changes.classify(before, after, full_refresh=True).collect()}
    assert full["same"] == "changed" and full["fresh"] == "new" and full["gone"] == "removed"


def test_applying_twice_changes_nothing(states):
    before, after = states
    once = changes.apply_diff(before, after, changes.classify(before, after))
    assert sorted(once.collect()) == sorted(after.collect())
    second = changes.classify(once, after)
    assert {r["status"] for r in second.collect()} == {"unchanged"}
    assert sorted(changes.apply_diff(once, after, second).collect()) == sorted(after.collect())


def test_stats(states):
    before, after = states
    diff = changes.classify(before, after)
    row = changes.write_stats(diff, after.union(after)).first().asDict()
    assert row == {
        "documents_seen": 3, "documents_changed": 2, "documents_removed": 1, "documents_unchanged": 1,
        "chunks_written": 4, "quarantined": 0, "errors": 0,
    }


def test_feed_replays_to_the_new_snapshot(spark):
    rng = random.Random(3)
    def snapshot():
        return spark.createDataFrame(
            [(f"c{i}", rng.choice("abc"), rng.choice((1, None))) for i in range(60) if rng.random() < 0.7], "chunk_id string, text string, page int"
        )
    before, after = snapshot(), snapshot()
    feed = changes.change_feed(before, after)
    assert sorted(map(str, changes.replay(before, feed).collect())) == sorted(map(str, after.collect()))
    assert changes.change_feed(after, after).count() == 0


def test_only_touched_buckets_are_rewritten(spark, states):
    before, after = states
    path = scratch_path(spark, "t")
    tables.with_bucket(before, 8).write.partitionBy(tables.BUCKET).parquet(path)
    diff = changes.classify(spark.read.parquet(path).drop(tables.BUCKET), after)
    touched = {r[0] for r in tables.with_bucket(diff.where("status <> 'unchanged'"), 8).select(tables.BUCKET).collect()}
    def parts():
        return {r["b"]: r["f"] for r in spark.read.parquet(path).selectExpr("bucket as b", "_metadata.file_name as f").distinct().collect()}
    old = parts()
    tables.replace_changed(path, after, diff, buckets=8)
    new = parts()
    assert {b: f for b, f in old.items() if b not in touched} == {b: f for b, f in new.items() if b not in touched}
    stored = spark.read.parquet(path).select(*after.columns)
    assert sorted(stored.collect()) == sorted(after.collect())
    # all documents removed: the emptied buckets go as well
    tables.replace_changed(path, after.limit(0), changes.classify(stored, after.limit(0)), buckets=8)
    assert not tables.exists(spark, path) or spark.read.parquet(path).count() == 0


def test_a_whole_run_is_stored(spark):
    layout = tables.Layout(scratch_path(spark, "base"), "dev")
    section = [(["T"], "Some words here. And more of them.", None)]
    df = spark.createDataFrame(
        [("d1", "h1", "2026-01-01", section), ("d2", "h2", None, section)],
        "doc_id string, content_hash string, effective_date string, sections array<struct<heading_path:array<string>,text:string,page:int>>",
    )
    held = spark.createDataFrame([("q", "/q", "h9", "chi_number: ...")], "doc_id string, source_path string, content_hash string, findings string")
    def run(documents):
        state = tables.read(spark, layout.path("bronze_documents"), tables.schema_of("bronze_documents"))
        diff = changes.classify(state, documents)
        tables.store_run(layout, documents, passages.passages(documents, 5, 0), held, diff, dt.datetime(2026, 10, 9))
    run(df)
    run(df.where("doc_id = 'd2'"))
    stored = tables.read(spark, layout.path("bronze_documents"))
    assert [r["doc_id"] for r in stored.collect()] == ["d2"]
    chunks = tables.read(spark, layout.path("silver_chunks"))
    assert {r["doc_id"] for r in chunks.collect()} == {"d2"} and chunks.first()["chunk_max_tokens"] == 5
    # the same finding is written once
    assert tables.read(spark, layout.path("ops_pii_quarantine")).count() == 1


def test_a_changed_document_may_lose_all_passages(spark):
    path = scratch_path(spark, "t")
    rows = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    new = spark.createDataFrame([("a", "new")], "doc_id string, status string")
    tables.replace_changed(path, rows, new, buckets=4)
    assert spark.read.parquet(path).count() == 1
    changed = spark.createDataFrame([("a", "changed")], "doc_id string, status string")
    tables.replace_changed(path, rows.limit(0), changed, buckets=4)
    assert not tables.exists(spark, path) or spark.read.parquet(path).count() == 0


def test_tables(spark):
    path = scratch_path(spark, "t")
    tables.create(spark, path, tables.schema_of("ops_pii_quarantine"))
    tables.create(spark, path, tables.schema_of("ops_pii_quarantine"))
    assert tables.read(spark, path).count() == 0 and "findings" in tables.read(spark, path).columns
    assert not tables.exists(spark, scratch_path(spark, "none"))
    typed = tables.conform(
        spark.createDataFrame([("d", "2026-04-01", float("nan")), ("e", "April", 2.0)], "doc_id string, effective_date string, page double"),
        tables.schema_of("silver_chunks"),
    )
    rows = {r["doc_id"]: r for r in typed.collect()}
    assert str(rows["d"]["effective_date"]) == "2026-04-01" and rows["d"]["page"] is None
    assert rows["e"]["effective_date"] is None and rows["e"]["page"] == 2


def test_stream_takes_each_change_once(spark):
    feed, target, progress = (scratch_path(spark, n) for n in ("feed", "target", "progress"))
    first = spark.createDataFrame([("a", "1"), ("b", "1")], "chunk_id string, text string")
    second = spark.createDataFrame([("b", "2"), ("c", "1")], "chunk_id string, text string")
    feeds.publish_feed(changes.change_feed(first.limit(0), first), feed, 1)
    feeds.sync(spark, feed, target, progress)
    assert sorted(map(tuple, feeds.current(spark, target).collect())) == [("a", "1"), ("b", "1")]
    feeds.publish_feed(changes.change_feed(first, second), feed, 2)
    feeds.sync(spark, feed, target, progress)
    def written():
        return sorted(r[0] for r in spark.read.parquet(target).selectExpr("_metadata.file_name").distinct().collect())
    before = written()
    feeds.sync(spark, feed, target, progress)  # nothing new: no batch, no file
    assert written() == before
    feeds.sync(spark, feed, target, scratch_path(spark, "lost"))  # progress lost: all changes again
    assert sorted(map(tuple, feeds.current(spark, target).collect())) == [("b", "2"), ("c", "1")]


def test_older_versions_change_nothing(spark):
    """Batches arrive out of order: what the target holds wins by version, deleted rows too."""
    feed, target, progress = (scratch_path(spark, n) for n in ("feed", "target", "progress"))
    def publish(version, *rows):
        df = spark.createDataFrame([(*r, kind) for *r, kind in rows], "chunk_id string, text string, _change_type string")
        feeds.publish_feed(df, feed, version)
        feeds.sync(spark, feed, target, progress, buckets=4)
        return {r["chunk_id"]: r["text"] for r in feeds.current(spark, target).collect()}
    assert publish(5, ("a", "5", "insert"), ("b", "5", "insert")) == {"a": "5", "b": "5"}
    assert publish(7, ("b", "5", "delete"), ("c", "7", "insert")) == {"a": "5", "c": "7"}
    assert publish(6, ("a", "6", "update_postimage"), ("b", "6", "update_postimage"), ("c", "6", "delete"), ("d", "6", "insert")) == {"a": "6", "c": "7", "d": "6"}
    assert publish(4, ("a", "4", "delete"), ("d", "4", "update_postimage")) == {"a": "6", "c": "7", "d": "6"}
    assert publish(8, ("b", "8", "insert")) == {"a": "6", "b": "8", "c": "7", "d": "6"}
    feeds.sync(spark, feed, target, scratch_path(spark, "again"), buckets=4)  # all changes in one batch
    assert {r["chunk_id"]: r["text"] for r in feeds.current(spark, target).collect()} == {"a": "6", "b": "8", "c": "7", "d": "6"}


def test_newest_of_few_repeated_keys(spark):
    """Keys that occur once keep their row as it is, repeated ones are reduced; a null key is a key."""
    from plumbline.streaming import feed as feeds

    rows = [("a", 1, False, "x"), ("b", 1, False, "x"), ("b", 2, True, None), ("c", 1, True, None), ("c", 1, False, "y"), (None, 1, False, "p"), (None, 2, False, "q")]
    changes = spark.createDataFrame(rows, f"chunk_id string, {feeds.VERSION} long, {feeds.DELETED} boolean, text string")
    found = {tuple(r) for r in feeds._newest(changes, "chunk_id").collect()}
    assert found == {("a", 1, False, "x"), ("b", 2, True, None), ("c", 1, False, "y"), (None, 2, False, "q")}
