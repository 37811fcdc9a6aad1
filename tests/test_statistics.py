import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.operators import joins, quality, waits
from plumbline.operators.joins import join_sized, skew_safe_join
from plumbline.plans.statistics import raw_waits
from plumbline.sources import files

TODAY = dt.date(2026, 10, 9)
HEADER = "_id," + ",".join(waits.RAW_COLUMNS)
ROWS = [
    "1,20260630,S92000003,,New Outpatient,Z9,d,600000,,300000,,90,,300,",
    "2,20260630,S08000024,,New Outpatient,C5,,1200,,500,,80,,200,",
    "3,20260630,S08000024,,New Outpatient,A1,,-5,,,,80,,200,",
    "4,20260630,S08000024,,New Outpatient,A2,,10,,20,,80,,200,",
    "5,20990630,S08000024,,New Outpatient,C5,,10,,2,,80,,200,",
    "6,2026-06-30,S08000024,,New Outpatient,C5,,10,,2,,80,,200,",
    "7,20260531,X1,,Inpatient/Day case,C5,,10,,2,,300,,200,",
    "8,20260531,S08000024,,Inpatient/Day case,C5,,,:,,:,,:,,:",
    "9,20260630,S08000024,,New Outpatient,C5,,1300,,500,,80,,200,",
]


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("waits")
    (folder / "waits.csv").write_bytes(b"\xef\xbb\xbf" + "\n".join([HEADER, *ROWS]).encode() + b"\n")
    (folder / "boards.csv").write_bytes("HB,HBName\nS08000024,Lothian\n".encode())
    # an older lookup in Windows-1252: a non-breaking space, a dash and curly quotes
    (folder / "special.csv").write_bytes("SHB,SHBName\nSB1\xa0,Golden “Jubilee” – Board\n".encode("cp1252"))
    (folder / "specialties.csv").write_bytes("Specialty,SpecialtyName\nC5,ENT\nA1,General Medicine\nA2,Cardiology\n".encode())
    raw = files.read_text_csv(spark, str(folder / "waits.csv"))
    boards = waits.merge_lookups(
        (files.read_text_csv(spark, str(folder / "boards.csv")), "HB", "HBName"),
        (files.read_text_csv(spark, str(folder / "special.csv")), "SHB", "SHBName"),
        constants={waits.NATIONAL: waits.NATIONAL_NAME},
    )
    specialties = waits.merge_lookups((files.read_text_csv(spark, str(folder / "specialties.csv")), "Specialty", "SpecialtyName"))
    return raw, boards, waits.to_silver(raw, boards, specialties)


def test_reader_keeps_text_and_order(silver):
    raw, boards, _ = silver
    rows = raw.orderBy("_id").collect()
    assert [r["_id"] for r in rows] == list(range(1, 10))
    assert rows[7]["NumberWaiting"] == "" and rows[7]["NumberWaitingQF"] == ":"
    assert dict(boards.collect())["SB1"] == "Golden “Jubilee” – Board"


def test_every_defect_is_found(silver):
    _, _, df = silver
    judged = quality.judge(df, quality.waits_rules(TODAY))
    reasons = {r["_id"]: r[quality.REASONS] for r in judged.select("_id", quality.REASONS).collect()}
    assert reasons == {
        1: "", 2: "unique_key", 3: "non_negative_counts", 4: "over_12_weeks_within_total", 5: "month_not_in_future",
        6: "valid_month", 7: "", 8: "", 9: "",
    }
    assert quality.kept(judged).count() == 4 and quality.rejects(judged).count() == 5
    got = {r["expectation"]: (r["failed_rows"], r["total_rows"]) for r in quality.results(df, quality.waits_rules(TODAY), today=TODAY).collect()}
    assert got["unique_key"] == (1, 9) and got["median_not_above_p90"] == (1, 9)
    assert got["count_present"] == (1, 9) and got["known_board"] == (1, 9) and got["fresh_data"] == (0, 1)


def test_results_from_stored_rows_are_the_same(silver):
    _, _, df = silver
    rules = quality.waits_rules(TODAY)
    stored = quality.results_of_judged(quality.judge(df, rules), rules, TODAY)
    assert sorted(map(str, stored.collect())) == sorted(map(str, quality.results(df, rules, today=TODAY).collect()))


def test_flags_and_share(silver):
    _, _, df = silver
    first = df.where("_id = 1").first()
    assert first["is_scotland"] and first["is_all_specialties"] and first["share_over_12_weeks"] == 0.5
    assert df.where("_id = 8").first()["share_over_12_weeks"] is None


def test_freshness_depends_on_the_day(silver):
    _, _, df = silver
    kept = quality.kept(quality.judge(df, quality.waits_rules(TODAY)))
    fresh = quality.freshness(kept, TODAY).first()
    assert fresh["failed_rows"] == 0 and fresh["detail"] == "latest month 2026-06-30, 101 days old"
    assert quality.freshness(kept, dt.date(2027, 6, 1)).first()["failed_rows"] == 1
    assert quality.freshness(kept.limit(0), TODAY).first()["detail"] == "latest month None, None days old"


def test_empty_input_passes(silver):
    _, _, df = silver
    rows = quality.results(df.limit(0), quality.waits_rules(TODAY)).collect()
    assert all(r["pass_rate"] == 1.0 and r["total_rows"] == 0 for r in rows)
    # a rejects table without rows still has its columns
    assert quality.REASONS in quality.rejects(quality.judge(df.limit(0), quality.waits_rules(TODAY))).columns


def test_missing_columns_are_named(silver):
    raw, _, _ = silver
    with pytest.raises(waits.SchemaError, match="HBT"):
        waits.rename(raw.drop("HBT"), waits.RAW_COLUMNS)


def test_summary_and_latest(silver):
    _, _, df = silver
    kept = quality.kept(quality.judge(df, quality.waits_rules(TODAY)))
    row = waits.run_summary(kept).first()
    assert row["months"] == "2026-05 to 2026-06" and row["silver_rows"] == 4 and row["scotland_all_specialty_rows"] == 1
    assert row["patient_types"] == "Inpatient/Day case,New Outpatient"
    assert [tuple(r) for r in waits.unknown_boards(kept).collect()] == [("X1", 1)]
    assert [tuple(r) for r in waits.blank_counts(kept).collect()] == [("Inpatient/Day case", 1)]
    latest = {r["board_code"]: r for r in waits.latest_waits(kept).collect()}
    assert set(latest) == {"S92000003", "S08000024"} and latest["S08000024"]["pct_over_12_weeks"] == 38.5
    failed = waits.failed_map(quality.results(df, quality.waits_rules(TODAY))).first()[0]
    assert failed["valid_month"] == 1 and "board_present" not in failed


def test_numbers_and_dates_are_strict(spark):
    df = spark.createDataFrame([("1d",), ("NaN",), (" 12 ",), ("1e3",), ("",), (".5",), ("-7.",), ("inf",)], "x string")
    assert [r[0] for r in df.select(waits.to_number(F.col("x"))).collect()] == [None, None, 12.0, 1000.0, None, 0.5, -7.0, None]
    dates = spark.createDataFrame([("20260630",), ("2026-06-30",), ("20260631",), ("",)], "x string")
    assert [r[0] for r in dates.select(waits.to_date(F.col("x"))).collect()] == [dt.date(2026, 6, 30), None, None, None]


def test_keep_last_with_a_hot_key(spark):
    rows = [("hot", None, i) for i in range(1000)] + [(f"k{i}", "x", i) for i in range(50)] + [("k1", "x", 99)]
    df = spark.createDataFrame(rows, "a string, b string, seq bigint")
    got = {(r["a"], r["b"]): r["seq"] for r in quality.keep_last(df, ("a", "b"), "seq").collect()}
    assert got[("hot", None)] == 999 and got[("k1", "x")] == 99 and len(got) == 51


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 300)  # "hot" has seven times as many
    rows = [(i, "hot") for i in range(2000)] + [(i, None) for i in range(2000, 2500)] + [(i, f"k{i % 700}") for i in range(2500, 4000)]
    left = spark.createDataFrame(rows, "id bigint, key string")
    right = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(300)]], "key string, value int")
    expected = left.join(right, "key", how)
    for got in (skew_safe_join(left, right, "key", ["id"], how), join_sized(left, right, "key", ["id"], how)):
        assert sorted(map(str, got.select(expected.columns).collect())) == sorted(map(str, expected.collect()))


def test_each_file_is_read_in_its_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("_id,Name\n1,Caf\u00e9\n".encode())
    (tmp_path / "b.csv").write_bytes("_id,Name\n2,Caf\u00e9 \u20ac\n".encode("cp1252"))
    rows = files.read_text_csv(spark, str(tmp_path)).collect()
    assert {r["_id"]: r["Name"] for r in rows} == {1: "Caf\u00e9", 2: "Caf\u00e9 \u20ac"}
    (tmp_path / "c.csv").write_text('_id,Name\n3,"one\ntwo"\n4,"say ""x"""\n')
    rows = files.read_text_csv(spark, str(tmp_path / "c.csv")).collect()
    assert [(r["_id"], r["Name"]) for r in rows] == [(3, "one\ntwo"), (4, 'say "x"')]
    assert files.file_kinds(spark, str(tmp_path)).keys() == {(True, False), (False, False), (True, True)}
    assert {r["_id"] for r in files.read_text_csv(spark, str(tmp_path)).collect()} == {1, 2, 3, 4}


@pytest.fixture()
def small_splits(spark):
    """Files are read in ranges of about 2,000 bytes, many of them in one task."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "2000")
    spark.conf.set(names[1], "10")
    yield
    for n in names:
        spark.conf.set(n, before[n])


def test_lines_are_numbered_over_ranges(spark, tmp_path, small_splits):
    for name, n in (("a", 900), ("b", 3), ("c", 0), ("d", 400)):
        (tmp_path / f"{name}.txt").write_text("".join(f"line {name} {i}\n" for i in range(n)))
    lines = files.text_lines(spark, str(tmp_path))
    assert lines.select("file", "start").distinct().count() > 5
    got = {(r["file"][-5], r["number"], r["value"]) for r in files.numbered(lines).collect()}
    assert got == {(name, i, f"line {name} {i}") for name, n in (("a", 900), ("b", 3), ("d", 400)) for i in range(n)}


def test_digest_follows_lines_and_their_order(spark, tmp_path, small_splits):
    path = tmp_path / "x.csv"
    lines = [f"row {i}" for i in range(1000)]
    def digest(rows, size="2000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        path.write_text("\n".join(rows) + "\n")
        return files.source_digest(spark, str(path))
    first = digest(lines)
    assert first == digest(lines, "777") == digest(lines, "64m") and len(first) == 64
    swapped = [*lines[:400], lines[401], lines[400], *lines[402:]]
    assert len({first, digest(swapped), digest(lines[:-1]), digest([*lines, "more"]), digest([*lines[:5], "row 5!", *lines[6:]])}) == 5
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "empty.csv").write_text("")
    assert files.source_digest(spark, str(tmp_path / "none")) is None


@pytest.mark.parametrize("number", ["", "5", None])
def test_last_row_of_a_file_wins_without_a_number(spark, tmp_path, small_splits, number):
    """The publisher's number is blank, equal or not there at all."""
    rows = [(f"k{i % 70}", str(i)) for i in range(2000)]
    head = "key,seq" if number is None else "_id,key,seq"
    text = [",".join(r if number is None else (number, *r)) for r in rows]
    (tmp_path / "in.csv").write_text("\n".join([head, *text]) + "\n")
    raw = files.read_text_csv(spark, str(tmp_path / "in.csv"))
    assert raw.rdd.getNumPartitions() > 2 and quality.order_of(raw) == files.PLACE
    # a join shuffles the rows in between
    mixed = raw.repartition(5, "seq")
    got = {r["key"]: r["seq"] for r in quality.keep_last(mixed, ("key",), files.PLACE).collect()}
    assert got == dict(rows)


def test_exactly_one_row_of_a_key_stays(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), ("b", None), ("b", None), ("c", None), ("c", 2), (None, 3), (None, 3)]
    df = spark.createDataFrame(rows, "k string, _id bigint")
    for order in ("_id", None):
        assert sorted(r["k"] or "" for r in quality.keep_last(df, ("k",), order).collect()) == ["", "a", "b", "c"]
    assert {r["_id"] for r in quality.keep_last(df.where("k = 'c'"), ("k",), "_id").collect()} == {2}
    marked = quality.mark_superseded(df, ("k",), "_id", F.lit(True))
    assert marked.count() == len(rows) and marked.where("_superseded").count() == len(rows) - 4


def test_fractions_reach_the_rules(spark):
    columns = {c: "" for c in waits.RAW_COLUMNS}
    rows = [{**columns, "MonthEnding": "20260630", "HBT": "B", "NumberWaiting": a, "NumberWaitingOver12Weeks": b} for a, b in (("-0.5", "-1"), ("10.2", "10.7"), ("10.7", "10.2"))]
    raw = spark.createDataFrame(rows)
    none = spark.createDataFrame([], "code string, name string")
    judged = quality.judge(waits.to_silver(raw, none, none), quality.waits_rules(TODAY), key=("number_waiting",))
    found = {r["number_waiting"]: r for r in judged.collect()}
    assert found[-0.5][quality.REASONS] == "non_negative_counts"
    assert found[10.2][quality.REASONS] == "over_12_weeks_within_total" and found[10.7][quality.REASONS] == ""
    assert found[10.7]["share_over_12_weeks"] == 10.2 / 10.7
    assert [r["number_waiting"] for r in waits.whole_counts(quality.kept(judged)).collect()] == [10]


def test_load_report_of_nothing(spark, silver):
    _, _, df = silver
    none = quality.judge(df, quality.waits_rules(TODAY)).limit(0)
    row = waits.load_report(none).first()
    assert (row["raw_rows"], row["silver_rows"], row["rejected_rows"], row["months"], row["boards"], row["patient_types"]) == (0, 0, 0, None, 0, [])


def test_the_last_row_of_a_lookup_wins(spark):
    rows = spark.createDataFrame([("A", "old"), ("B", "b"), ("A", "new")], "c string, n string").coalesce(1)
    assert {r["code"]: r["name"] for r in waits.merge_lookups((rows, "c", "n")).collect()} == {"A": "new", "B": "b"}


def test_hot_keys_are_parted_by_their_size(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 100)
    left = spark.range(10000).select("id", F.when(F.col("id") % 10 < 4, "hot").when(F.col("id") < 200, "warm").otherwise(F.col("id").cast("string")).alias("key"))
    right = spark.createDataFrame([("hot", 1), ("warm", 2)], "key string, v int")
    out = skew_safe_join(left, right, "key", ["id"])
    assert out.where("key = 'hot'").count() == 4000 and out.where("key = 'warm'").count() == 120
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_judging_once_writes_few_last_rows_and_gives_what_judge_gives(spark, monkeypatch):
    from pathlib import Path

    from plumbline.session import shared_dir

    df = spark.range(400).selectExpr(
        "id as _id", "date'2001-01-31' as month_ending", "if(id % 7 = 0, '', concat('N', id % 3)) as hbt", "'a' as patient_type", "'1' as specialty",
        "double(id) as number_waiting", "0d as waiting_over_12_weeks", "1d as median_wait_days", "2d as p90_wait_days", "'b' as board_name",
        "'s' as specialty_name", "false as is_all_specialties",
    )
    rules = quality.waits_rules(TODAY)
    rows = lambda x: sorted(map(str, x.drop("_id").collect()))
    written = lambda: len(list(Path(shared_dir(spark)).glob("judged-*")))
    expected, before = rows(quality.judge(df, rules)), written()
    once = quality.judge_once(df, rules)
    assert rows(once) == expected and "_id" not in once.columns and written() == before
    assert quality.kept(once).count() == 3 and quality.rejects(once).count() == 397
    monkeypatch.setattr(quality, "is_small", lambda x: False)
    assert rows(quality.judge_once(df, rules)) == expected and written() == before + 1


def test_orders_are_sorted_before_their_texts_are_made(spark, tmp_path):
    """Only the columns of orders that are used are sorted, not the fifteen raw ones."""
    orders = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string, o_comment string"
    data = [(k, k, "F", 100.0 * k, dt.date(2001, 1, 5), "1-URGENT", "c") for k in (5, 3, 9, 1)]
    spark.createDataFrame(data, orders).write.parquet(f"{tmp_path}/orders.parquet")
    ordered = raw_waits(spark, str(tmp_path), ordered=True)
    assert [r["_id"] for r in ordered.collect()] == [1, 3, 5, 9]
    assert sorted(map(str, ordered.collect())) == sorted(map(str, raw_waits(spark, str(tmp_path)).collect()))
    plan = ordered._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MonthEnding") < plan.index("Sort [")


def test_only_cells_that_need_it_are_trimmed(spark):
    cells = ["", "a", "a b", " a", "a ", "\xa0", "a\xa0b", " é　", "é", "a\n", "\n", "\x00", "\x7f", "12.5", "\x1ca"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    wanted = [c.replace("\xa0", " ").strip("".join(files.SPACE_CHARS)) for c in cells]
    assert [r[0] for r in df.select(files._clean(F.col("c"))).collect()] == wanted
    assert "RLIKE" in str(files._clean(F.col("c"))).upper()
