"""Queries of incremental maintenance. Today's documents meet an earlier state: toxic ones were
not there yet, poor ones had another text, and the web pages have gone since."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import changes
from plumbline.plans.base import longs, query, table
from plumbline.session import scratch_path
from plumbline.sources import tables
from plumbline.streaming import feed as feeds


def now_documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", F.sha2("text", 256).alias("content_hash")
    )


def earlier_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")
    text = F.when(F.col("quality") == 0, F.concat("text", F.lit("\nold line"))).otherwise(F.col("text"))
    docs = docs.where(F.coalesce(F.col("toxic"), F.lit(0)) == 0).select(F.col("doc_id").cast("string").alias("doc_id"), text.alias("text"))
    gone = table(spark, folder, "pages").select(F.concat(F.lit("page-"), "page_id").alias("doc_id"), F.col("html").alias("text"))
    return docs.unionByName(gone).withColumn("content_hash", F.sha2("text", 256))


def line_chunks(docs: DataFrame) -> DataFrame:
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_index", "text"))
    return lines.select(F.concat_ws("-", "doc_id", "chunk_index").alias("chunk_id"), "doc_id", "chunk_index", "text")


STATES = """now_docs as (select doc_id::varchar as doc_id, text, sha256(text) as content_hash from documents),
  old_docs as (
    select d.doc_id::varchar as doc_id, case when quality = 0 then text || chr(10) || 'old line' else text end as text
    from documents d left join labels l using (doc_id) where coalesce(toxic, 0) = 0
    union all select 'page-' || page_id, html from pages),
  earlier as (select *, sha256(text) as content_hash from old_docs),
  diff as (
    select coalesce(e.doc_id, n.doc_id) as doc_id, e.content_hash as stored_hash, n.content_hash as incoming_hash,
      case when n.doc_id is null then 'removed' when e.doc_id is null then 'new'
        when e.content_hash = n.content_hash then 'unchanged' else 'changed' end as status
    from earlier e full join now_docs n on e.doc_id = n.doc_id),
  now_chunks as (
    select doc_id || '-' || (i - 1) as chunk_id, doc_id, i - 1 as chunk_index, text from (
      select doc_id, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) as i from now_docs)),
  old_chunks as (
    select doc_id || '-' || (i - 1) as chunk_id, doc_id, i - 1 as chunk_index, text from (
      select doc_id, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) as i from earlier))"""


def diff_of(spark, folder, full_refresh: bool = False) -> DataFrame:
    return changes.classify(earlier_documents(spark, folder), now_documents(spark, folder), full_refresh=full_refresh)


@query("src_table_state", f"with {STATES} select doc_id, content_hash from earlier")
def src_table_state(spark, folder):
    """Ids and hashes of a stored table; the texts are not read."""
    path = scratch_path(spark, "state")
    earlier_documents(spark, folder).write.parquet(path)
    return tables.read(spark, path).select("doc_id", "content_hash")


@query("jon_hash_diff", f"with {STATES} select doc_id, stored_hash, incoming_hash, status from diff")
def jon_hash_diff(spark, folder):
    return diff_of(spark, folder)


@query("jon_semi_changed", f"with {STATES} select chunk_id, doc_id, md5(text) as digest from now_chunks where doc_id in (select doc_id from diff where status in ('new', 'changed'))")
def jon_semi_changed(spark, folder):
    chunks = line_chunks(now_documents(spark, folder))
    return changes.rows_of(chunks, changes.to_write(diff_of(spark, folder))).select("chunk_id", "doc_id", F.md5("text").alias("digest"))


@query(
    "agg_write_stats",
    f"""with {STATES} select count(*) filter (where status <> 'removed') as documents_seen,
      count(*) filter (where status in ('new', 'changed')) as documents_changed,
      count(*) filter (where status = 'removed') as documents_removed,
      count(*) filter (where status = 'unchanged') as documents_unchanged,
      (select count(*) from now_chunks where doc_id in (select doc_id from diff where status in ('new', 'changed'))) as chunks_written,
      (select count(*) from labels where toxic = 1) as quarantined, 0::bigint as errors from diff""",
)
def agg_write_stats(spark, folder):
    held = table(spark, folder, "labels").where("toxic = 1")
    return changes.write_stats(diff_of(spark, folder), line_chunks(now_documents(spark, folder)), held)


@query("set_diff_union", f"with {STATES}, removed as (select doc_id from earlier except select doc_id from now_docs) select doc_id from removed union select doc_id from diff where status = 'changed'")
def set_diff_union(spark, folder):
    """Ids to delete: those gone (set difference) and those changed (union)."""
    old, now = earlier_documents(spark, folder).select("doc_id"), now_documents(spark, folder).select("doc_id")
    changed = diff_of(spark, folder).where("status = 'changed'").select("doc_id")
    return old.subtract(now).union(changed).distinct()


@query("inc_apply", f"with {STATES} select doc_id, content_hash, md5(text) as digest from now_docs")
def inc_apply(spark, folder):
    """Diff applied to a stored table, bucket by bucket: the result is today's documents."""
    path = scratch_path(spark, "bucketed")
    earlier = earlier_documents(spark, folder)
    tables.with_bucket(earlier, 16).write.partitionBy(tables.BUCKET).parquet(path)
    stored = spark.read.parquet(path).drop(tables.BUCKET)
    now = now_documents(spark, folder)
    tables.replace_changed(path, now, changes.classify(stored, now), buckets=16)
    return spark.read.parquet(path).select("doc_id", "content_hash", F.md5("text").alias("digest"))


@query("inc_full_refresh", f"with {STATES} select doc_id, case when stored_hash is null then 'new' when incoming_hash is null then 'removed' else 'changed' end as status from diff")
def inc_full_refresh(spark, folder):
    return diff_of(spark, folder, full_refresh=True).select("doc_id", "status")


FEED = f"""{STATES},
  met as (select coalesce(o.chunk_id, n.chunk_id) as chunk_id, o.chunk_id as o, n.chunk_id as n, o.text as old_text, n.text as new_text
    from old_chunks o full join now_chunks n on o.chunk_id = n.chunk_id)"""


@query(
    "inc_change_feed",
    f"""with {FEED} select chunk_id, 'insert' as _change_type, md5(new_text) as digest from met where o is null
      union all select chunk_id, 'delete', md5(old_text) from met where n is null
      union all select chunk_id, 'update_preimage', md5(old_text) from met where old_text <> new_text
      union all select chunk_id, 'update_postimage', md5(new_text) from met where old_text <> new_text""",
)
def inc_change_feed(spark, folder):
    before, after = line_chunks(earlier_documents(spark, folder)), line_chunks(now_documents(spark, folder))
    return changes.change_feed(before, after).select("chunk_id", "_change_type", F.md5("text").alias("digest"))


@query("snk_roundtrip_overwrite", f"with {STATES} select doc_id, content_hash from now_docs where content_hash not in (select content_hash from earlier)")
def snk_roundtrip_overwrite(spark, folder):
    """A table replaced by a part of itself: the rows are staged before the old ones go."""
    path = scratch_path(spark, "table")
    now_documents(spark, folder).write.parquet(path)
    stored = tables.read(spark, path)
    old = earlier_documents(spark, folder).select("content_hash").distinct()
    tables.overwrite(stored.join(old, "content_hash", "left_anti").select("doc_id", "content_hash"), path, staged=True)
    return tables.read(spark, path)


@query("snk_roundtrip_append", f"with {STATES} select doc_id, content_hash from earlier union all select doc_id, content_hash from now_docs")
def snk_roundtrip_append(spark, folder):
    path = scratch_path(spark, "table")
    for part in (earlier_documents(spark, folder), now_documents(spark, folder)):
        tables.append(part.select("doc_id", "content_hash"), path)
    return tables.read(spark, path)


@query("snk_schema_evolution", f"with {STATES} select doc_id, content_hash, null::int as chars from earlier union all select doc_id, content_hash, length(text)::int from now_docs")
def snk_schema_evolution(spark, folder):
    """A column that came later: rows written before it read as NULL."""
    path = scratch_path(spark, "table")
    tables.append(earlier_documents(spark, folder).select("doc_id", "content_hash"), path)
    tables.append(now_documents(spark, folder).select("doc_id", "content_hash", F.length("text").alias("chars")), path)
    return tables.read(spark, path, merge=True)


@query("stm_triggered_sync", f"with {STATES} select chunk_id, doc_id, chunk_index, md5(text) as digest from now_chunks")
@longs("chunk_index")
def stm_triggered_sync(spark, folder):
    """Three triggered runs over the change feed: the third finds only changes that are older than what is there."""
    feed, target, checkpoint = (scratch_path(spark, n) for n in ("feed", "published", "progress"))
    before, after = line_chunks(earlier_documents(spark, folder)), line_chunks(now_documents(spark, folder))
    feeds.publish_feed(before.withColumn("_change_type", F.lit("insert")), feed, 1)
    feeds.sync(spark, feed, target, checkpoint, buckets=8)
    feeds.publish_feed(changes.change_feed(before, after), feed, 2)
    feeds.sync(spark, feed, target, checkpoint, buckets=8)
    late = before.withColumn("text", F.lit("late")).withColumn("_change_type", F.lit("update_postimage"))
    feeds.publish_feed(late.unionByName(after.withColumn("_change_type", F.lit("delete")), allowMissingColumns=True), feed, 0)
    feeds.sync(spark, feed, target, checkpoint, buckets=8)
    return feeds.current(spark, target).select("chunk_id", "doc_id", "chunk_index", F.md5("text").alias("digest"))
