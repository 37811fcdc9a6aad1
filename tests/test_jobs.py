import datetime as dt

import pytest

from plumbline.functions import lookups
from plumbline.operators import waits
from plumbline.plans import jobs
from plumbline.session import scratch_path
from plumbline.sources import files, tables

TODAY, NOW = dt.date(2026, 10, 9), dt.datetime(2026, 10, 9, 12)


@pytest.fixture()
def sources(tmp_path):
    header = "_id," + ",".join(waits.RAW_COLUMNS)
    rows = ["1,20260630,S92000003,,New Outpatient,Z9,d,600000,,300000,,90,,300,", "2,20260630,B1,,New Outpatient,C5,,-1,,,,80,,200,"]
    for name, text in {
        "ongoing_waits": "\n".join([header, *rows]),
        "health_boards": "HB,HBName\nB1,Lothian",
        "special_boards": "SHB,SHBName\nS1,Special",
        "specialties": "Specialty,SpecialtyName\nC5,ENT",
    }.items():
        (tmp_path / f"{name}.csv").write_text(text + "\n")
    return {p.stem: str(p) for p in tmp_path.glob("*.csv")}


def test_waits_from_file_to_lookup(spark, sources, tmp_path):
    layout = tables.Layout(scratch_path(spark, "base"), "dev")
    def load(run, **kw):
        return jobs.load_waits(spark, layout, sources, TODAY, run, NOW, **kw)
    first = load("r1")
    assert (first["skipped"], first["run_id"], first["raw_rows"], first["silver_rows"], first["rejected_rows"]) == (False, "r1", 2, 1, 1)
    assert first["months"] == "2026-06 to 2026-06" and first["boards"] == 1 and first["patient_types"] == ["New Outpatient"]
    assert first["scotland_all_specialty_rows"] == 1 and first["unknown_boards"] == [] and first["failed_expectations"]["non_negative_counts"] == 1
    assert load("r2") == {"skipped": True}
    assert not load("r3", full_refresh=True)["skipped"]
    assert tables.read(spark, layout.path("silver_ongoing_waits")).count() == 1
    assert [r["failed_expectations"] for r in tables.read(spark, layout.path("ops_rejects")).collect()] == ["non_negative_counts"]
    history = tables.read(spark, layout.path("ops_dq_results"))
    assert {r["run_id"] for r in history.collect()} == {"r1", "r3"} and history.count() == 22
    sites = tmp_path / "sites.txt"
    sites.write_text("clinic_id,name,site_type,town,postcode_district,address,phone,opening_hours,services\nC1,N,h,T,A,\"x, y\",1,24h,xray\n")
    jobs.serve_lookups(spark, layout, str(sites))
    answer = lookups.as_answer(lookups.call(spark, "get_waiting_times", {"specialty": "", "patient_type": "", "board": ""})).first()
    assert answer["source"] == lookups.SOURCE_LABEL and [r["number_waiting"] for r in answer["rows"]] == [600000]
    empty = lookups.as_answer(lookups.call(spark, "get_waiting_times", {"specialty": "x", "patient_type": "", "board": ""})).first()
    assert empty["source"] == lookups.SOURCE_LABEL and empty["rows"] == []
    assert lookups.call(spark, "find_clinic", {"service": "X-ray", "town": ""}).first()["address"] == "x, y"


def test_documents_from_files_to_passages(spark, tmp_path):
    layout = tables.Layout(scratch_path(spark, "base"), "dev")
    root = tmp_path / "raw"
    (root / "leaflets").mkdir(parents=True)
    leaflet = root / "leaflets" / "a.md"
    leaflet.write_text("---\ndoc_id: a\ntitle: A\n---\n# One\nSome words.\n")
    (root / "leaflets" / "held.md").write_text("CHI 0101601234 in here")
    (root / "leaflets" / "bad.md").write_text("fine at first")
    paged = spark.createDataFrame([("/p/rules.pdf", "h1", ["RULES\nAll the rules are here."])], "path string, content_hash string, pages array<string>")
    def ingest(**kw):
        found = files.read_files(spark, str(root)).where("kind = 'leaflets'")
        return jobs.ingest_documents(spark, layout, found, paged, None, NOW, **kw).first().asDict()
    def stored(name, column):
        return sorted({r[column] for r in tables.read(spark, layout.path(name)).collect()})
    first = ingest()
    assert (first["documents_changed"], first["quarantined"], first["errors"], first["chunks_written"]) == (3, 1, 0, 3)
    assert stored("bronze_documents", "doc_id") == ["a", "bad", "policy-rules"] == stored("silver_chunks", "doc_id")
    again = ingest()
    assert (again["documents_changed"], again["documents_unchanged"], again["chunks_written"]) == (0, 3, 0)
    leaflet.write_text("---\ndoc_id: a\ntitle: A\n---\n# One\nOther words.\n")
    (root / "leaflets" / "bad.md").write_bytes(b"\xff\xfe")
    third = ingest()
    assert (third["documents_changed"], third["documents_removed"], third["errors"]) == (1, 0, 1)
    texts = {r["doc_id"]: r["text"] for r in tables.read(spark, layout.path("silver_chunks")).collect()}
    assert texts["a"] == "One\n\nOther words." and texts["bad"] == "bad.md\n\nfine at first"
    leaflet.unlink()
    assert ingest()["documents_removed"] == 1 and stored("silver_chunks", "doc_id") == ["bad", "policy-rules"]
    assert tables.read(spark, layout.path("ops_pii_quarantine")).count() == 1
    assert ingest(full_refresh=True)["documents_changed"] == 1
