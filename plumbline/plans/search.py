"""Search queries. A vector question is the mean vector of a label, with the benchmark passage of
the same number as its text; the corpus is all embeddings, and all documents for keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import vectors
from plumbline.operators import search
from plumbline.operators.joins import skew_safe_join
from plumbline.operators.shape import merged_filter
from plumbline.plans.base import longs, query, table
from plumbline.session import pinned

DIMS = 64


def centroids(spark: SparkSession, folder: str) -> DataFrame:
    """One vector per label: the mean per dimension, a partial aggregate on (label, dimension)."""
    parts = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # collects as many entries as there are dimensions
    gathered = means.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "m"))).alias("v"))
    # one small row per label: written once, as a search reads its questions more than once
    return pinned(
        gathered.select(
            F.col("label").cast("bigint").alias("query_id"), F.transform("v", lambda e: e.getField("m")).alias("vector")
        ),
        "questions",
    )


def asked(spark, folder) -> DataFrame:
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return centroids(spark, folder).join(items, "query_id")


def vector_corpus(spark, folder) -> DataFrame:
    return table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


def full_corpus(spark, folder, how: str = "inner") -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")
    return vector_corpus(spark, folder).join(docs, "id", how)


MEANS = """cent as (
    select label::bigint as query_id, list(m order by i) as qv from (
      select label, i, avg(x) as m from (
        select label, unnest(embedding::double[]) as x, generate_subscripts(embedding, 1) as i from embeddings) group by label, i)
    group by label),
  asked as (select query_id, qv, text as qtext from cent join benchmark on item_id = query_id),
  vec_corpus as (select vec_id as id, embedding::double[] as v from embeddings)"""


def cosine_sql(a: str, b: str) -> str:
    return (
        f"round(list_dot_product({a}, {b}) / (greatest(sqrt(list_dot_product({a}, {a})), 1e-12) "
        f"* greatest(sqrt(list_dot_product({b}, {b})), 1e-12)), 6)"
    )


def top_sql(source: str, k: int) -> str:
    return f"""select query_id, id, score, rank from (
      select *, row_number() over (partition by query_id order by score desc, id) as rank from {source}) where rank <= {k}"""


@query(
    "sea_cosine_topk",
    f"with {MEANS}, scored as (select query_id, id, {cosine_sql('qv', 'v')} as score from cent, vec_corpus) {top_sql('scored', 10)}",
)
@longs("rank")
def sea_cosine_topk(spark, folder):
    return search.exact_topk(centroids(spark, folder), vector_corpus(spark, folder), 10)


@query(
    "sea_filtered_topk",
    f"""with {MEANS}, part as (select id, v from vec_corpus join documents on doc_id = id where lang = 'en'),
      scored as (select query_id, id, {cosine_sql('qv', 'v')} as score from cent, part) {top_sql('scored', 5)}""",
)
@longs("rank")
def sea_filtered_topk(spark, folder):
    """The filter is on the corpus, below the ranking: five rows per question remain five."""
    corpus = full_corpus(spark, folder)
    return search.search(centroids(spark, folder), corpus, 5, "EXACT", condition=merged_filter({"lang": "en"}, defaults={}))


def sketch_sql(queries: str, corpus: str, name: str, k: int) -> str:
    """CTEs from (query_id, qv) and (id, v) to (query_id, id, score): the candidates by sketch, compared exactly."""
    digit = "('0x' || substr(md5(p || ':' || (i // 128)), (i % 128) // 4 + 1, 1))::int"
    return f"""
  {name}_n as (select count(*) as n, greatest(2, 2 * ceil(log2(count(*)))::int) * 64 as bits, max(len(v)) as dims from {corpus}),
  {name}_planes as (select list(plane order by p) as planes from (
    select p, list(case when ({digit} >> (i % 4)) & 1 = 1 then 1.0::double else -1.0::double end order by i) as plane
    from (select unnest(range(bits)) as p, dims from {name}_n), lateral (select unnest(range(dims)) as i) group by p)),
  {name}_rows as (select id, v, list_transform(planes, lambda pl: case when list_dot_product(v, pl) > 0 then 1.0::double else -1.0::double end) as sides
    from {corpus}, {name}_planes),
  {name}_asked as (select query_id, qv, list_transform(planes, lambda pl: list_dot_product(qv, pl) / sqrt(list_dot_product(qv, qv)) / len(planes)) as far
    from {queries}, {name}_planes),
  {name}_near as (select query_id, id, qv, v, row_number() over (partition by query_id order by round(list_dot_product(far, sides), 6) desc, id) as place
    from {name}_asked, {name}_rows),
  {name} as (select query_id, id, {cosine_sql('qv', 'v')} as score from {name}_near, {name}_n where place <= greatest({2 * k}, least({32 * k}, n // 25)))"""


@query("sea_ann", f"with {MEANS}, {sketch_sql('cent', 'vec_corpus', 'sketched', 10)} {top_sql('sketched', 10)}")
@longs("rank")
def sea_ann(spark, folder):
    return search.approximate_topk(centroids(spark, folder), vector_corpus(spark, folder), 10)


@query(
    "sea_ann_recall",
    f"""with {MEANS}, {sketch_sql('cent', 'vec_corpus', 'sketched', 10)}, near as (select query_id, id, {cosine_sql('qv', 'v')} as score from cent, vec_corpus),
      exact as ({top_sql('near', 10)}), approx as ({top_sql('sketched', 10)})
      select e.query_id, count(a.id) / count(*) as recall from exact e left join approx a using (query_id, id) group by e.query_id""",
)
def sea_ann_recall(spark, folder):
    """Share of the exact neighbours that the approximate search finds, per question."""
    questions, corpus = centroids(spark, folder), vector_corpus(spark, folder)
    exact = search.exact_topk(questions, corpus, 10)
    found = search.approximate_topk(questions, corpus, 10)
    met = exact.join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return met.groupBy("query_id").agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))


def bm25_sql(queries: str, corpus: str, name: str) -> str:
    """CTEs from (query_id, qtext) and (id, text) to (query_id, id, score)."""
    return f"""
  {name}_tok as (select id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') as ts from {corpus}),
  {name}_len as (select id, len(ts) as dl from {name}_tok),
  {name}_stat as (select count(*) as n, sum(dl) / count(*) as avgdl from {name}_len),
  {name}_tf as (select id, term, count(*) as tf from (select id, unnest(ts) as term from {name}_tok) group by id, term),
  {name}_df as (select term, count(*) as df from {name}_tf group by term),
  {name}_q as (select distinct query_id, unnest(regexp_extract_all(lower(qtext), '[\\p{{L}}\\p{{N}}]+')) as term from {queries}),
  {name} as (
    select query_id, t.id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.2) / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) as score
    from {name}_q q join {name}_tf t using (term) join {name}_df using (term) join {name}_len l on l.id = t.id, {name}_stat
    group by query_id, t.id)"""


@query(
    "sea_fulltext_bm25",
    f"""with asked as (select item_id as query_id, text as qtext from benchmark), corpus as (select doc_id as id, text from documents),
      {bm25_sql('asked', 'corpus', 'words')} {top_sql('words', 10)}""",
)
@longs("rank")
def sea_fulltext_bm25(spark, folder):
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    return search.bm25_topk(items, search.keyword_index(docs), 10)


def hybrid_sql(asked: str) -> str:
    """CTEs from (query_id, qv, qtext) to `fused`; documents without a vector and vectors without a document take part."""
    return f"""corpus as (select doc_id as id, text from documents), {bm25_sql(asked, 'corpus', 'words')},
  near as (select query_id, id, {cosine_sql('qv', 'v')} as score from {asked}, vec_corpus),
  by_vector as ({top_sql('near', 50)}), by_words as ({top_sql('words', 50)}),
  fused as (select query_id, id, round(sum(1 / (60 + rank)), 6) as score from (
    select query_id, id, rank from by_vector union all select query_id, id, rank from by_words) group by query_id, id)"""


@query("sea_hybrid_rrf", f"with {MEANS}, {hybrid_sql('asked')} {top_sql('fused', 10)}")
@longs("rank")
def sea_hybrid_rrf(spark, folder):
    return search.search(asked(spark, folder), full_corpus(spark, folder, "full"), 10, "HYBRID")


def _auto_oracle() -> str:
    from plumbline.plans.documents import EXACT_SQL

    exact = EXACT_SQL.format("qtext")
    return f"""with {MEANS}, numbered as (select query_id, qv, case when query_id % 2 = 0 then qtext || ' ' || query_id else qtext end as qtext from asked),
      {hybrid_sql('numbered')}, {sketch_sql('numbered', 'vec_corpus', 'sketched', 10)}, routed as (select query_id, {exact} as exact_terms from numbered),
      mixed as ({top_sql('fused', 10)}), plain as ({top_sql('sketched', 10)})
      select m.*, 'HYBRID' as route from mixed m join routed using (query_id) where exact_terms
      union all select p.*, 'ANN' from plain p join routed using (query_id) where not exact_terms"""


@query("sea_auto", _auto_oracle())
@longs("rank")
def sea_auto(spark, folder):
    """Every other question names a number, so that both routes are taken."""
    named = F.when(F.col("query_id") % 2 == 0, F.concat_ws(" ", "text", "query_id")).otherwise(F.col("text"))
    return search.search(asked(spark, folder).withColumn("text", named), full_corpus(spark, folder, "full"), 10, "AUTO")


@query(
    "jon_rank_attach",
    f"""with {MEANS}, corpus as (select id, v, text, source, n_chars from vec_corpus join documents on doc_id = id),
      near as (select query_id, id, {cosine_sql('qv', 'v')} as score from cent, corpus), top as ({top_sql('near', 10)})
      select query_id, rank, top.id as chunk_id, source as source_type, md5(text) as digest, n_chars::int as page, score from top join corpus using (id)""",
)
@longs("rank")
def jon_rank_attach(spark, folder):
    """Ranked ids back to their rows; the page column arrives as text and leaves as integer."""
    corpus = full_corpus(spark, folder)
    ranked = search.exact_topk(centroids(spark, folder), corpus, 10)
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("chunk_id"),
        F.col("doc_id").cast("string").alias("doc_id"),
        F.lit(None).cast("string").alias("title"),
        F.col("lang").alias("section_path"),
        F.concat("n_chars", F.lit(".0")).alias("page"),
        F.col("source").alias("source_type"),
        "text",
    )
    found = search.hits(ranked, docs)
    return found.select("query_id", "rank", "chunk_id", "source_type", F.md5("text").alias("digest"), "page", "score")


@query(
    "jon_cache_missing",
    """with cached as (select sha1(text) as key from documents where doc_id in (select doc_id from labels where quality = 1))
      select distinct sha1(text) as key, length(text) as chars from documents where sha1(text) not in (select key from cached)""",
)
@longs("chars")
def jon_cache_missing(spark, folder):
    docs = table(spark, folder, "documents")
    good = table(spark, folder, "labels").where("quality = 1").select("doc_id")
    cache = docs.join(good, "doc_id", "left_semi").select(search.text_key(F.col("text")).alias("key"))
    return search.missing_texts(docs, cache).select("key", F.length("text").alias("chars"))


@query("jon_cache_attach", "select doc_id as id, min(doc_id) over (partition by text) as first_id from documents")
def jon_cache_attach(spark, folder):
    """Rows meet one entry per distinct text; a text with very many copies is spread by salt."""
    keyed = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), search.text_key(F.col("text")).alias("key"))
    cache = keyed.groupBy("key").agg(F.min("id").alias("first_id"))
    return skew_safe_join(keyed, cache, "key", spread=["id"]).select("id", "first_id")


def hashed_sql(source: str, name: str) -> str:
    """CTE of (id, dim, x): the hashing encoder on (id, text), stored as FLOAT."""
    return f"""{name} as (
    select id, dim, (x / sqrt(sum(x * x) over (partition by id)))::float::double as x from (
      select id, code % {DIMS} as dim, sum(case when (code >> 16) & 1 = 1 then 1.0::double else -1.0::double end) as x from (
        select id, ('0x' || left(md5(term), 8))::bigint as code from (
          select id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) as term from {source})) group by id, dim))"""


@query(
    "sea_embed_hashing",
    f"""with {hashed_sql("(select item_id as id, text from benchmark)", "qv")}, {hashed_sql("(select doc_id as id, text from documents)", "dv")},
      dots as (select qv.id as query_id, dv.id, sum(qv.x * dv.x) as s from qv join dv using (dim) group by 1, 2),
      qn as (select id, sqrt(sum(x * x)) as n from qv group by id), dn as (select id, sqrt(sum(x * x)) as n from dv group by id),
      near as (
        select b.item_id as query_id, d.doc_id as id, coalesce(round(s / (qn.n * dn.n), 6), 0) as score
        from benchmark b cross join documents d left join dots on query_id = item_id and dots.id = doc_id
        left join qn on qn.id = item_id left join dn on dn.id = doc_id)
      {top_sql('near', 5)}""",
)
@longs("rank")
def sea_embed_hashing(spark, folder):
    """Distinct texts through the encoder once, vectors attached to all copies, neighbours ranked."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    none = spark.createDataFrame([], "key string, vector array<float>")
    cache = search.hashed_vectors(search.missing_texts(docs, none), DIMS)
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    asked_cache = search.hashed_vectors(search.missing_texts(items, none), DIMS)
    questions = search.attach_vectors(items, asked_cache).select(F.col("id").alias("query_id"), "vector")
    return search.exact_topk(questions, search.attach_vectors(docs, cache), 5)


@query(
    "mth_l2_normalise",
    """select vec_id, i - 1 as i, round(x / greatest(norm, 1e-12), 6) as x from (
      select vec_id, sqrt(list_dot_product(embedding::double[], embedding::double[])) as norm,
        unnest(embedding::double[]) as x, generate_subscripts(embedding, 1) as i from embeddings)""",
)
@longs("i")
def mth_l2_normalise(spark, folder):
    unit = vectors.l2_normalise(F.col("embedding"))
    rows = table(spark, folder, "embeddings").select("vec_id", F.posexplode(unit).alias("i", "x"))
    return rows.select("vec_id", "i", F.round("x", 6).alias("x"))
