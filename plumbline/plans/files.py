"""Queries of files and whole loads. Rows of the tables are written to the shared folder in the form of the
raw files, and read back, loaded and stored by the operators under test."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import text as tx
from plumbline.operators import documents, waits
from plumbline.plans import jobs
from plumbline.plans.base import day, longs, query, table
from plumbline.plans.documents import FOLDED, paged_documents
from plumbline.plans.statistics import JUDGED, RULES, TODAY, raw_waits
from plumbline.session import scratch_path
from plumbline.sources import files, tables
from plumbline.sources.tables import Layout

RUN_AT = dt.datetime(2001, 4, 1, 12)


def csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    """Write a CSV with a header, quotes doubled as the readers expect."""
    df.write.option("encoding", encoding).option("escape", '"').csv(path, header=True)
    return path


def layout(spark: SparkSession) -> Layout:
    return Layout(scratch_path(spark, "layout"), "query")


# ------------------------------------------------------------------ readers

# A supplier's leaflet: front matter, a heading, text. Every fifth has no front matter to close.
LEAFLET = """concat('---\n', 'doc_id: "supplier-', s_suppkey, '"\n', 'title: ''', s_name, '''\n', 'service: nation-', s_nationkey, ' # where\n',
  if(s_suppkey % 3 = 0, 'effective_date: 2024-02-30\n', 'effective_date: 2024-02-28\n'), if(s_suppkey % 5 = 0, '', '---\n'),
  '# About\nBalance ', cast(floor(s_acctbal) as bigint), '.\n\n## Place\nNation ', s_nationkey, ' ')"""


FILES_PER_TASK = 250  # leaflets that one task writes, in a folder of its own


def leaflets(spark: SparkSession, folder: str) -> DataFrame:
    """A file per supplier key, written by many tasks: a folder is committed, and listed, per task and not per file."""
    root = scratch_path(spark, "leaflets")
    rows = table(spark, folder, "supplier").select("s_suppkey", F.expr(LEAFLET).alias("text"))
    # what has one key is one file, line after line
    lines = F.collect_list(F.coalesce("text", F.lit("")))
    whole = rows.groupBy("s_suppkey").agg(F.array_join(lines, "\n").alias("text"))
    tasks = max(1, math.ceil(rows.count() / FILES_PER_TASK))
    dealt = whole.repartition(tasks, "s_suppkey").select(F.spark_partition_id().alias("task"), "text")
    dealt.write.partitionBy("task").option("maxRecordsPerFile", 1).text(f"{root}/leaflets")
    return files.read_files(spark, root, {"leaflets": ".TXT", "missing": ".pdf"})


@query(
    "src_documents",
    """select 'supplier-' || s_suppkey as doc_id, s_name as title, 'nation-' || s_nationkey as service,
         case when s_suppkey % 3 <> 0 then '2024-02-28' end as effective_date, 'current' as status, x.path as heading_path, x.body as text
       from supplier, lateral (values ('About', 'Balance ' || floor(s_acctbal)::bigint || '.'), ('About > Place', 'Nation ' || s_nationkey)) as x(path, body)
       where s_suppkey % 5 <> 0""",
)
def src_documents(spark, folder):
    """Leaflets read from files and parsed; those without a closed front matter are not theirs to tell by id."""
    parsed = documents.parse_markdown(leaflets(spark, folder)).where(F.col("doc_id").startswith("supplier-"))
    rows = parsed.select("doc_id", "title", "service", day("effective_date").alias("effective_date"), "status", F.inline("sections"))
    return rows.select(*rows.columns[:5], F.array_join("heading_path", " > ").alias("heading_path"), "text")


@query(
    "src_unclosed_front_matter",
    """select count(*) as files, count(*) filter (where s_suppkey % 5 = 0) as without_front_matter, count(*) filter (where s_suppkey % 5 <> 0) as with_id from supplier""",
)
def src_unclosed_front_matter(spark, folder):
    """A block that is never closed is text: its file is named after itself."""
    parsed = documents.parse_markdown(leaflets(spark, folder))
    own = F.col("doc_id").startswith("supplier-")
    return parsed.agg(F.count("source_path").alias("files"), F.count_if(~own & F.col("raw_text").startswith("---")).alias("without_front_matter"), F.count_if(own).alias("with_id"))


@query(
    "src_manifest",
    """select 'part-' || p_partkey || '.pdf' as file_name, p_name || ' "' || p_brand || '"' || case when p_partkey % 4 = 0 then chr(10) || 'second line' else '' end as title,
         'http://parts/' || p_partkey as url, case when p_partkey % 3 <> 0 then p_type end as licence from part""",
)
def src_manifest(spark, folder):
    root = scratch_path(spark, "manifest")
    rows = table(spark, folder, "part").selectExpr(
        "concat('part-', p_partkey, '.pdf') as file_name",
        "concat(p_name, ' \"', p_brand, '\"', if(p_partkey % 4 = 0, '\nsecond line', '')) as title",
        "concat('http://parts/', p_partkey) as url",
        "if(p_partkey % 3 = 0, null, p_type) as licence",
    )
    csv(rows, f"{root}/policies/sources.csv")
    return files.read_manifest(spark, root).drop("_row")


@query("src_sites", """select p_partkey::varchar as clinic_id, p_name as name, p_type || ', "' || p_brand || '"' as address, p_size || ';xray' as services from part""")
def src_sites(spark, folder):
    rows = table(spark, folder, "part").selectExpr("p_partkey as clinic_id", "p_name as name", "concat(p_type, ', \"', p_brand, '\"') as address", "concat(p_size, ';xray') as services")
    return files.read_sites(spark, csv(rows, scratch_path(spark, "sites")))


@query(
    "src_text_csv",
    """select c_custkey as _id, case when c_custkey % 3 = 0 then '' else 'Café ' || c_name end as "Name é",
         case when c_custkey % 7 = 0 then 'one' || chr(10) || 'two' else c_mktsegment end as segment, c_acctbal::varchar as balance from customer""",
)
@longs("_id")
def src_text_csv(spark, folder):
    """Files of two encodings, some with line breaks in cells: every column as trimmed text, blanks stay ''."""
    rows = table(spark, folder, "customer").selectExpr(
        "c_custkey as _id",
        "if(c_custkey % 3 = 0, '  ', concat(' Café ', c_name, ' ')) as `Name é`",
        "if(c_custkey % 7 = 0, 'one\ntwo', c_mktsegment) as segment",
        "c_acctbal as balance",
    )
    root = scratch_path(spark, "customers")
    csv(rows.where("_id % 2 = 0"), f"{root}/a")
    csv(rows.where("_id % 2 = 1"), f"{root}/b", "ISO-8859-1")
    return files.read_text_csv(spark, f"{root}/*/*.csv").drop(files.PLACE)


@query(
    "src_question_labels",
    """select 'q' || item_id as question_id, case when item_id % 2 = 0 then 'exact' else 'paraphrase' end as kind, d.i::varchar as doc_id, left(text, 20 + d.i) as evidence
       from benchmark, range(2) as d(i) where item_id % 5 <> 0 or d.i = 0""",
)
def src_question_labels(spark, folder):
    """Questions from JSON lines, their kind defaulted, one row per label."""
    label = "named_struct('doc_id', cast({0} as string), 'evidence', left(text, 20 + {0}))"
    rows = table(spark, folder, "benchmark").selectExpr(
        "concat('q', item_id) as id", "text as question", "if(item_id % 2 = 0, 'exact', null) as kind",
        f"if(item_id % 5 = 0, array({label.format(0)}), array({label.format(0)}, {label.format(1)})) as relevant",
    )
    path = scratch_path(spark, "questions")
    rows.write.json(path)
    questions = files.load_questions(spark, path)
    return files.label_table(questions).join(questions.select(F.col("id").alias("question_id"), "kind"), "question_id")


@query(
    "src_cases",
    """select conv_id || '-' || turn as id, role as category, case when turn % 3 = 0 then -1 when turn % 3 = 1 then 0 else 1 end as n_tools,
         case when turn % 2 = 0 then 1 else 0 end as n_include, 0 as n_exclude from conversations""",
)
@longs("n_tools", "n_include", "n_exclude")
def src_cases(spark, folder):
    """No tools key means unchecked (-1 here), an empty list none; missing lists of words are empty."""
    rows = table(spark, folder, "conversations").selectExpr(
        "concat(conv_id, '-', turn) as id", "role as category", "text as question",
        "case turn % 3 when 0 then null when 1 then cast(array() as array<string>) else array('lookup') end as tools",
        "if(turn % 2 = 0, array('word'), null) as include",
    )
    path = scratch_path(spark, "cases")
    rows.write.json(path)
    size = lambda c: F.coalesce(F.size(c), F.lit(-1))
    return files.load_cases(spark, path).select("id", "category", *[F.when(F.col(c).isNull(), -1).otherwise(size(c)).alias(f"n_{c}") for c in ("tools", "include", "exclude")])


@query(
    "str_file_titles",
    r"""with p as (select p_partkey, replace(p_name, ' ', '-') || '_' || p_partkey || case when p_partkey % 4 = 0 then '.PDF' else '.pdf' end as f from part),
        s as (select *, case when f like '%.pdf' then left(f, length(f) - 4) else f end as stem from p)
        select p_partkey, f as file_name, stem as file_stem,
          list_aggregate(list_transform(regexp_extract_all(replace(stem, '-', ' '), '\p{L}+|\P{L}+'), lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '') as title from s""",
)
def str_file_titles(spark, folder):
    path = F.expr("concat('/a.b/', replace(p_name, ' ', '-'), '_', p_partkey, if(p_partkey % 4 = 0, '.PDF', '.pdf'))")
    return table(spark, folder, "part").select(
        "p_partkey", tx.file_name(path).alias("file_name"), tx.file_stem(path, ".pdf").alias("file_stem"), tx.title_from_file(path, ".pdf").alias("title")
    )


# ------------------------------------------------------------------ parsers


@query(
    "doc_paged_documents",
    f"""with recursive {FOLDED} select 'policy-d' || doc_id as doc_id, section_no, section_path, page, md5(body) as digest, 'http://d/' || doc_id as source_url from final_sections""",
)
@longs("section_no", "page")
def doc_paged_documents(spark, folder):
    """Pages and a manifest through the parser; of two entries for a file the last one counts."""
    docs = paged_documents(spark, folder)
    paged = docs.selectExpr("concat('/policies/d', doc_id, '.pdf') as path", "md5(title) as content_hash", "pages")
    entries = docs.selectExpr("concat('d', doc_id, '.pdf') as file_name", "title", "concat('http://d/', doc_id) as url", "'open' as licence", "doc_id * 2 + 1 as _row")
    older = entries.selectExpr("file_name", "'old title' as title", "'old' as url", "licence", "_row - 1 as _row")
    parsed = documents.parse_pages(paged, entries.unionByName(older))
    rows = parsed.select("doc_id", "source_url", F.posexplode("sections").alias("section_no", "s"))
    return rows.select("doc_id", "section_no", F.array_join("s.heading_path", " > ").alias("section_path"), "s.page", F.md5("s.text").alias("digest"), "source_url")


@query(
    "doc_parse_errors",
    """select '/l/' || doc_id || '.md' as source_path, 'not valid UTF-8' as error from documents where doc_id % 3 = 0 and text is not null
       union all select '/p/' || doc_id || '.pdf', 'no page text' from documents where doc_id % 5 = 0""",
)
def doc_parse_errors(spark, folder):
    """Bytes that are no text and files without pages, found by the parsers themselves."""
    docs = table(spark, folder, "documents")
    content = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("text").cast("binary"), F.unhex(F.lit("C328")))).otherwise(F.col("text").cast("binary"))
    markdown = docs.select(F.expr("concat('/l/', doc_id, '.md')").alias("path"), content.alias("content"))
    pages = F.when(F.col("doc_id") % 5 != 0, F.array("text"))
    paged = docs.select(F.expr("concat('/p/', doc_id, '.pdf')").alias("path"), F.lit("h").alias("content_hash"), pages.alias("pages"))
    return documents.error_rows(documents.parse_markdown(markdown).unionByName(documents.parse_pages(paged)))


# ------------------------------------------------------------------ tables


@query("snk_create", "select n_nationkey, n_name from nation")
def snk_create(spark, folder):
    """Created twice, appended to once: the second creation leaves the rows alone."""
    path = scratch_path(spark, "created")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    tables.create(spark, path, nation.schema)
    tables.append(nation, path)
    tables.create(spark, path, nation.schema)
    return tables.read(spark, path)


@query(
    "snk_run_log",
    """select run, 'top=' || k as params, o_orderpriority as kind, count(*) as n, null::bigint as o_orderkey from orders, (values ('r1', 5), ('r2', 10)) as r(run, k) group by all
       union all select run, null, null, null, o_orderkey from orders, (values ('r1'), ('r2')) as r(run)""",
)
def snk_run_log(spark, folder):
    """Two runs in the log: metrics with their parameters, and rows."""
    where, orders = layout(spark), table(spark, folder, "orders")
    for run, k in (("r1", 5), ("r2", 10)):
        tables.log_run(where, run, {"top": k}, orders.groupBy(F.col("o_orderpriority").alias("kind")).agg(F.count("*").alias("n")), orders.select("o_orderkey"))
    metrics = tables.read(spark, where.path("ops_eval_runs"))
    params = F.array_join(F.transform(F.map_entries("params"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    rows = tables.read(spark, where.path("ops_eval_rows"))
    return metrics.withColumn("params", params).unionByName(rows, allowMissingColumns=True)


@query("prj_lineage", "select l_orderkey, l_linenumber, 'lines' as source_file, 'r1' as run_id, '2001-04-01 12:00:00' as loaded_at from lineitem")
def prj_lineage(spark, folder):
    rows = waits.with_lineage(table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"), source_file="lines", run_id="r1", loaded_at=RUN_AT)
    return rows.withColumn("loaded_at", F.date_format("loaded_at", "yyyy-MM-dd HH:mm:ss"))


@query("prj_require_columns", "select o_orderkey, 'columns missing from the source: [''HBTQF'', ''MonthEnding'']' as error from orders")
def prj_require_columns(spark, folder):
    """A source that lost columns is refused before anything is read, and the message names them."""
    orders = table(spark, folder, "orders")
    try:
        waits.require_columns(orders, ["o_orderkey", "MonthEnding", "HBTQF"])
        error = None
    except waits.SchemaError as refused:
        error = str(refused)
    return waits.require_columns(orders, ["o_orderkey"]).select("o_orderkey", F.lit(error).alias("error"))


# ------------------------------------------------------------------ the load from files to tables


def raw_files(spark: SparkSession, folder: str) -> dict[str, str]:
    """The monthly file and its lookups as CSV."""
    root = scratch_path(spark, "raw")
    nation, region, orders = (table(spark, folder, t) for t in ("nation", "region", "orders"))
    specialties = orders.where("o_orderpriority not like '4%'").selectExpr("left(o_orderpriority, 1) as Specialty", "substr(o_orderpriority, 3) as SpecialtyName")
    sources = {
        "ongoing_waits": raw_waits(spark, folder, ordered=True),
        "health_boards": nation.selectExpr("concat('N', n_nationkey) as HB", "n_name as HBName"),
        "special_boards": region.selectExpr("concat('N', r_regionkey) as SHB", "r_name as SHBName"),
        "specialties": specialties.distinct(),
    }
    return {name: csv(df, f"{root}/{name}") for name, df in sources.items()}


def load(spark: SparkSession, folder: str) -> Layout:
    where = layout(spark)
    jobs.load_waits(spark, where, raw_files(spark, folder), TODAY, "r1", RUN_AT)
    return where


STORED = ("hbt", "patient_type", "specialty", "board_name", "specialty_name", "median_wait_days")
COUNTED = "trunc(number_waiting)::bigint as number_waiting, trunc(waiting_over_12_weeks)::bigint as waiting_over_12_weeks"


@query("job_silver", f"with {JUDGED} select strftime(month_ending, '%Y-%m-%d') as month_ending, {', '.join(STORED)}, {COUNTED}, 'r1' as run_id from kept")
def job_silver(spark, folder):
    """The silver table of a whole load, from raw files."""
    rows = tables.read(spark, load(spark, folder).path("silver_ongoing_waits"))
    return rows.select(day("month_ending").alias("month_ending"), *STORED, "number_waiting", "waiting_over_12_weeks", "run_id")


@query("job_rejects", f"with {JUDGED} select {', '.join(STORED)}, {COUNTED}, failed_expectations, 'r1' as run_id from judged where failed_expectations <> ''")
def job_rejects(spark, folder):
    rows = tables.read(spark, load(spark, folder).path("ops_rejects"))
    return rows.select(*STORED, "number_waiting", "waiting_over_12_weeks", "failed_expectations", "run_id")


@query(
    "job_history",
    f"with {JUDGED}, all_rows as (select count(*) as n, "
    + ", ".join(f"count(*) filter (where not ({check})) as {name}" for name, (_, check) in RULES.items())
    + """, count(*) filter (where failed_expectations = 'unique_key') as unique_key from judged)
       select run_id, expectation, failed_rows, n as total_rows from (values ('r1'), ('r3')) as r(run_id), (
         unpivot all_rows on columns(* exclude (n)) into name expectation value failed_rows)""",
)
def job_history(spark, folder):
    """Loaded, skipped as the file is the same, loaded again in full: the history has the two runs that worked."""
    where, sources = layout(spark), raw_files(spark, folder)
    for run in ("r1", "r2", "r3"):
        jobs.load_waits(spark, where, sources, TODAY, run, RUN_AT, full_refresh=run == "r3")
    rows = tables.read(spark, where.path("ops_dq_results")).where("expectation <> 'fresh_data'")
    return rows.select("run_id", "expectation", "failed_rows", "total_rows")


@query("job_digest", "select count(*) as rows, true as stored, true as same_split, false as same_changed from orders")
def job_digest(spark, folder):
    """The digest of the raw file: stored by the load, the same in smaller splits, another one when a line is lost."""
    where, sources = layout(spark), raw_files(spark, folder)
    path = sources["ongoing_waits"]
    jobs.load_waits(spark, where, sources, TODAY, "r1", RUN_AT)
    bronze = where.path("bronze_ongoing_waits")
    stored, size = tables.stored_digest(spark, bronze), spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
        split = files.source_digest(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    changed = files.source_digest(spark, csv(raw_waits(spark, folder, ordered=True).where("_id > 1"), scratch_path(spark, "changed")))
    flags = {"stored": stored is not None, "same_split": split == stored, "same_changed": changed == stored}
    return tables.read(spark, bronze).agg(F.count("*").alias("rows")).withColumns({k: F.lit(v) for k, v in flags.items()})
