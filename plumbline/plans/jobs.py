"""The two loads end to end, from files to tables, and the tables the lookups read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from plumbline.functions import lookups
from plumbline.operators import changes, documents, passages, quality, waits
from plumbline.session import pinned
from plumbline.sources import files, tables
from plumbline.sources.tables import Layout

# Name and code columns of each published lookup, later ones win.
BOARD_LOOKUPS = {
    "health_boards": ("HB", "HBName"),
    "special_boards": ("SHB", "SHBName"),
    "isd_boards": ("ISDHBT", "ISDHBTName"),
    "other_residential": ("CustomResidency", "CustomResidencyName"),
}
SPECIALTY_LOOKUP = ("Specialty", "SpecialtyName")


def load_waits(
    spark: SparkSession,
    layout: Layout,
    sources: dict[str, str],
    today: dt.date,
    run_id: str,
    run_at: dt.datetime,
    full_refresh: bool = False,
) -> dict:
    """Monthly file -> bronze, silver, rejects, quality history and latest-month table.

    The whole load is skipped when the file is the one loaded last. All history is rebuilt, as
    past months are revised. The rows are judged once, for silver, rejects, results and the report, which is
    returned, to share. Of two rows with one key the later in the file stays.
    """
    bronze_path = layout.path("bronze_ongoing_waits")
    digest = files.source_digest(spark, sources["ongoing_waits"])
    if not full_refresh and digest is not None and tables.stored_digest(spark, bronze_path) == digest:
        return {"skipped": True}
    raw = files.read_text_csv(spark, sources["ongoing_waits"])
    boards = waits.merge_lookups(
        *[(files.read_text_csv(spark, sources[n]), *c) for n, c in BOARD_LOOKUPS.items() if n in sources],
        constants={waits.NATIONAL: waits.NATIONAL_NAME},
    )
    specialties = waits.merge_lookups((files.read_text_csv(spark, sources["specialties"]), *SPECIALTY_LOOKUP))
    rules = quality.waits_rules(today)
    silver = waits.to_silver(raw, boards, specialties)

    judged = quality.judge_once(silver, rules)
    stamp = {"run_id": run_id, "loaded_at": run_at}
    silver_path = layout.path("silver_ongoing_waits")
    stored = waits.whole_counts(judged)
    tables.overwrite(waits.with_lineage(quality.kept(stored), **stamp), silver_path)
    tables.overwrite(waits.with_lineage(quality.rejects(stored), run_id=run_id), layout.path("ops_rejects"))
    history = pinned(
        waits.with_lineage(quality.results_of_judged(judged, rules, today), run_id=run_id, run_at=run_at, table_name=silver_path), "results"
    )
    tables.append(history, layout.path("ops_dq_results"))
    tables.overwrite(waits.latest_waits(tables.read(spark, silver_path)), layout.path(lookups.WAITS))
    # bronze last: its digest says that the load is complete
    lineage = {"source_file": sources["ongoing_waits"], "source_sha256": digest, "ingested_at": run_at}
    tables.overwrite(waits.with_lineage(raw.drop(*quality.ORDERS), **lineage), bronze_path)
    report = waits.load_report(judged).first().asDict(recursive=True)
    failed = {r["expectation"]: r["failed_rows"] for r in history.where("failed_rows > 0").collect()}  # a row per rule
    return {"skipped": False, "run_id": run_id, **report, "failed_expectations": failed}


def serve_lookups(spark: SparkSession, layout: Layout, sites_csv: str) -> None:
    """Sites table and table functions over the stored tables."""
    tables.overwrite(files.read_sites(spark, sites_csv), layout.path(lookups.SITES))
    for name in (lookups.SITES, lookups.WAITS):
        tables.read(spark, layout.path(name)).createOrReplaceTempView(name)
    lookups.create_functions(spark)


def ingest_documents(
    spark: SparkSession,
    layout: Layout,
    markdown: DataFrame,
    paged: DataFrame,
    manifest: DataFrame | None,
    run_at: dt.datetime,
    max_tokens: int = passages.MAX_TOKENS,
    overlap_tokens: int = passages.OVERLAP_TOKENS,
    full_refresh: bool = False,
    buckets: int = tables.BUCKETS,
) -> DataFrame:
    """Files -> documents, passages and quarantine, for what changed only. Returns the counts.

    A file that cannot be read keeps its stored version and is reported. One that is held back
    counts as removed.
    """
    found = documents.parse_markdown(markdown).unionByName(documents.parse_pages(paged, manifest))
    parsed = pinned(found, "parsed")
    errors = documents.error_rows(parsed)
    scanned = documents.scan(parsed)
    clean = documents.clean_documents(scanned)
    held = documents.quarantine_rows(scanned)
    state = tables.read(spark, layout.path("bronze_documents"), tables.schema_of("bronze_documents"))
    state = state.join(errors.select("source_path").distinct(), "source_path", "left_anti")
    diff = pinned(changes.classify(state, clean, full_refresh=full_refresh), "diff")
    # only what changed is cut into passages
    cut = passages.passages(changes.rows_of(clean, changes.to_write(diff)), max_tokens, overlap_tokens)
    stats = changes.write_stats(diff, cut, held, errors)
    tables.store_run(layout, clean, cut, held, diff, run_at, buckets)
    return stats
