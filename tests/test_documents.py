import random
import re

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text as tx
from plumbline.operators import documents, pages, passages
from plumbline.sources import files

LEAFLET = """---
doc_id: lf-1
title: "Making a complaint: how to"
status: superseded   # replaced in 2026
effective_date: 2026-04-01
service: feedback
---
Words before any heading.

# Complaints

First part.

### Deep

Below a skipped level.

## Time limits

**6 months** at most.

## Empty one
"""


def one(spark, value, column, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


def test_markdown_document(spark):
    df = spark.createDataFrame(
        [("/in/leaflets/a.md", bytearray(LEAFLET.encode())), ("/in/leaflets/b.md", bytearray(b"\xff\xfe")), ("/in/leaflets/c.md", bytearray(b"no meta"))],
        "path string, content binary",
    )
    parsed = documents.parse_markdown(df)
    rows = {r["source_path"][-4]: r for r in parsed.collect()}
    a = rows["a"]
    assert (a["doc_id"], a["title"], a["status"]) == ("lf-1", "Making a complaint: how to", "superseded")
    assert str(a["effective_date"]) == "2026-04-01" and a["service"] == "feedback" and a["audience"] is None
    assert [(s["heading_path"], s["text"]) for s in a["sections"]] == [
        (["Making a complaint: how to"], "Words before any heading."),
        (["Complaints"], "First part."),
        (["Complaints", "Deep"], "Below a skipped level."),
        (["Complaints", "Time limits"], "**6 months** at most."),
    ]
    assert rows["c"]["doc_id"] == "c" and rows["c"]["title"] == "c.md" and rows["c"]["status"] == "current"
    assert [tuple(r) for r in documents.error_rows(parsed).collect()] == [("/in/leaflets/b.md", "not valid UTF-8")]


PAGES = [
    "Board Policy\nPage 1 of 4\nContents\n1. Introduction ....... 2\n4.1 Communication with Patients 7\n1. Introduction\nThe commun-\nication plan is here. • one\n• two",
    "Board Policy\n2\nit goes on over the page.\nANNEX\nShort",
    "Board Policy\nPage 3 of 4\nDRAFT\nWAITING TIMES\nare not a heading here because the line goes on",
    "Board Policy\nPage 4 of 4\n2. Next Steps\nThe last words of it all.",
]


def test_pages_are_cleaned_and_cut(spark):
    df = spark.createDataFrame([("/in/policies/my-policy.pdf", "h", PAGES)], "path string, content_hash string, pages array<string>")
    doc = documents.parse_pages(df).first()
    assert doc["doc_id"] == "policy-my-policy" and doc["title"] == "My Policy"
    got = [(s["heading_path"][1:], s["text"], s["page"]) for s in doc["sections"]]
    assert got == [
        (["1. Introduction"], "Contents The communication plan is here.\n- one\n- two ⟦p2⟧ it goes on over the page.", 1),
        (["ANNEX"], "Short ⟦p3⟧ WAITING TIMES are not a heading here because the line goes on", 2),
        (["2. Next Steps"], "The last words of it all.", 4),
    ]
    manifest = spark.createDataFrame([("my-policy.pdf", "Real title", "P", "http://x", "OGL")], "file_name string, title string, publisher string, url string, licence string")
    named = documents.parse_pages(df, manifest).first()
    assert (named["title"], named["source_url"], named["licence"]) == ("Real title", "http://x", "OGL")


@pytest.mark.parametrize(
    "line, expected",
    [("Page 3 of 12", True), ("7", True), ("7 / 12", True), ("Introduction .... 12", True), ("Annex 4 - Exceptions to the rule 44", True),
     ("Official-Sensitive", True), ("The year 2026", False), ("4 apples", False), ("Draft text", False)],
)
def test_noise_lines(spark, line, expected):
    assert one(spark, line, pages.is_noise_line(F.col("x"))) is expected


@pytest.mark.parametrize(
    "line, expected",
    [("1.2 Waiting lists", True), ("Annex A", True), ("Annex B: Rules, all of them", True), ("WAITING TIMES", True), ("GP", True),
     ("Waiting times", False), ("1. it starts low", False), ("WAITING TIMES.", False), ("", False), ("123", False), ("A B C D E F G H I", False)],
)
def test_headings(spark, line, expected):
    assert one(spark, line, pages.is_heading(F.col("x"))) is expected


def test_repeated_lines_need_enough_pages(spark):
    df = spark.createDataFrame([(["a\nb", "a\nc", "a\nb"],), (["a", "a"],), ([*["x\ny"] * 4, *["x"] * 4],)], "pages array<string>")
    found = [r[0] for r in df.select(pages.repeated_lines(pages.trimmed_lines(F.col("pages")))).collect()]
    assert found == [["a"], [], ["x", "y"]]


def test_personal_data(spark):
    text = (
        "Ring 01632 960 100. CHI 0101601234 and 010160 1234.\nNI AB 12 34 56 C but not BG123456A.\n"
        "Patient name: Jane\nmail jane@home.com or help@board.nhs.scot"
    )
    found = one(spark, text, documents.find_personal_data(F.col("x")))
    assert [(f["kind"], f["severity"]) for f in found] == [
        ("chi_number", "high"), ("chi_number", "high"), ("ni_number", "high"), ("labelled_personal_field", "high"), ("email_address", "low"),
    ]
    values = ["0101601234", "010160 1234", "AB 12 34 56 C", "Patient name: Jane", "jane@home.com"]
    for f, value in zip(found, values, strict=True):
        at = text.index(value)
        around = text[max(0, at - 20) : at] + "[REDACTED]" + text[at + len(value) :][:20]
        assert f["excerpt"] == f"...{around}...".replace("\n", " ")


def test_quarantine_and_low_findings(spark):
    texts = [("a", "DOB: 01/02/1960"), ("b", "write to me@home.com"), ("c", "nothing here")]
    df = spark.createDataFrame([(i, f"/{i}", "h", t) for i, t in texts], "doc_id string, source_path string, content_hash string, raw_text string")
    scanned = documents.with_findings(df)
    assert [(r["doc_id"], r["findings"]) for r in documents.quarantine_rows(scanned).collect()] == [("a", "labelled_personal_field: ...[REDACTED]...")]
    assert [r["doc_id"] for r in documents.low_finding_rows(scanned).collect()] == ["b"]
    assert sorted(r["doc_id"] for r in documents.clean_documents(scanned).collect()) == ["b", "c"]


# ------------------------------------------------------------------ models written from the description


def tokens(n_words: int) -> int:
    return max(1, round(n_words * 1.3))


def model_pack(counts, budget, overlap):
    """Runs of units: fill up to the budget; then go back over as long a tail as overlap allows."""
    runs, first, i = [], 0, 0
    while i < len(counts):
        fits = [s for s in [first] if tokens(sum(counts[s : i + 1])) <= budget]
        if fits or i == first:
            i += 1
            continue
        runs.append((first, i - 1))
        tails = [s for s in range(first, i) if tokens(sum(counts[s:i])) <= overlap and tokens(sum(counts[s : i + 1])) <= budget]
        first = tails[0] if tails else i
        i += 1
    return runs + ([(first, len(counts) - 1)] if counts else [])


def test_packing_equals_the_model(spark):
    rng = random.Random(5)
    inputs = [[rng.choice((1, 3, 8, 15, 30)) for _ in range(rng.randint(0, 40))] for _ in range(400)]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(inputs)], "i int, w array<int>")
    for budget, overlap in ((40, 12), (20, 0), (60, 55)):
        got = {r["i"]: [tuple(x) for x in r["p"]] for r in df.select("i", passages.pack(F.col("w"), budget, overlap).alias("p")).collect()}
        assert got == {i: model_pack(w, budget, overlap) for i, w in enumerate(inputs)}


def model_fold(texts, least=4):
    out, waiting = [], []
    for n, t in enumerate(texts):
        waiting.append((n, t))
        joined = " ".join(x for _, x in waiting)
        if len(joined.split()) >= least:
            out.append((n, joined))
            waiting = []
    rest = " ".join(x for _, x in waiting)
    if rest and out:
        out[-1] = (out[-1][0], out[-1][1] + " " + rest)
    elif rest:
        out = [(len(texts) - 1, rest)]
    return out


def test_folding_equals_the_model(spark):
    rng = random.Random(6)
    inputs = [[" ".join("w" * rng.randint(1, 3) for _ in range(rng.choice((1, 2, 3, 6)))) for _ in range(rng.randint(0, 9))] for _ in range(300)]
    rows = [(i, [([str(n)], t, n) for n, t in enumerate(ts)]) for i, ts in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, s array<{pages.SECTION}>")
    folded = df.select("i", tx.let(F.col("s"), lambda s: pages.fold_tiny_sections(s)).alias("s")).collect()
    assert {r["i"]: [(x["page"], x["text"]) for x in r["s"]] for r in folded} == {i: model_fold(t) for i, t in enumerate(inputs)}


def model_paths(lines, title):
    """(path, text) pairs from a list of lines, with the path of every heading worked out anew."""
    heads = [(n, len(m[1]), m[2].strip()) for n, x in enumerate(lines) if (m := re.match(r"^(#{1,6})\s+(.+?)\s*$", x))]
    path_of, path = {-1: [title]}, []
    for n, level, name in heads:
        path = [*path[: level - 1], name]
        path_of[n] = path
    cuts = [-1, *[n for n, _, _ in heads], len(lines)]
    parts = [(path_of[a], "\n".join(lines[a + 1 : b]).strip()) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [(p, t) for p, t in parts if t]


def test_heading_paths_equal_the_model(spark):
    rng = random.Random(7)
    inputs = []
    for _ in range(200):
        lines = [rng.choice(("#", "##", "###", "######", "#######", "")) + rng.choice((" ", "")) + rng.choice(("A b", "c")) for _ in range(rng.randint(1, 12))]
        inputs.append([x.strip() or "plain" for x in lines])
    df = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(inputs)], "i int, x string")
    rows = df.select("i", documents.heading_sections(F.col("x"), F.lit("T")).alias("s")).collect()
    got = {r["i"]: [(s["heading_path"], s["text"]) for s in r["s"]] for r in rows}
    assert got == {i: model_paths(x, "T") for i, x in enumerate(inputs)}


def chunk(spark, sections, budget, overlap):
    df = spark.createDataFrame([("d", "Doc", sections)], f"doc_id string, title string, sections array<{pages.SECTION}>")
    return passages.passages(df, budget, overlap).orderBy("chunk_index").collect()


def test_passages_stay_in_budget_and_overlap(spark):
    text = "\n\n".join(f"Paragraph {i} " + "word " * 20 for i in range(12))
    rows = chunk(spark, [(["Doc", "A"], text, None), (["Doc", "B"], "short text", None)], 120, 45)
    assert [r["chunk_id"] for r in rows] == [f"d-{i:04d}" for i in range(len(rows))]
    assert all(r["token_count"] <= 120 for r in rows) and rows[-1]["text"] == "Doc > B\n\nshort text"
    bodies = [r["text"].split("\n\n")[1:] for r in rows[:-1]]
    assert all(a[-1] == b[0] for a, b in zip(bodies, bodies[1:], strict=False))


def test_long_sentences_are_sliced(spark):
    rows = chunk(spark, [(["D"], " ".join(f"w{i}" for i in range(100)), None)], 20, 0)
    assert [len(r["text"].split("\n\n", 1)[1].split()) for r in rows] == [15] * 6 + [10]
    many = chunk(spark, [(["D"], "\n\n".join("x" for _ in range(400)), None)], 50, 20)
    assert all(r["token_count"] <= 50 for r in many)
    with pytest.raises(ValueError):
        chunk(spark, [(["D"], "x", None)], 10, 10)


def test_pages_follow_the_markers(spark):
    text = "First words on one. ⟦p2⟧ Then more on two. Still here. ⟦p3⟧ And on three. ⟦p4⟧"
    rows = chunk(spark, [(["D"], text, 1)], 5, 0)
    assert [(r["text"].split("\n\n")[1], r["page"]) for r in rows] == [
        ("First words on one.", 1), ("Then more on two.", 2), ("Still here.", 2), ("And on three.", 3),
    ]


def test_text_functions(spark):
    assert one(spark, " a\xa0b\t c \r\n\n\n\n d ", tx.normalise_whitespace(F.col("x"))) == "a b c\n\nd"
    assert one(spark, "**It’s** “so”\n big", tx.normalise_evidence(F.col("x"))) == 'it\'s "so" big'
    assert [one(spark, " ".join("w" * n), tx.token_count(F.col("x"))) for n in (0, 1, 5, 15, 45)] == [1, 1, 6, 20, 58]
    assert one(spark, "a ⟦p3⟧ b", tx.token_count(F.col("x"))) == 3
    assert one(spark, "T > S > U", tx.section_of(F.col("x"))) == "S > U"
    assert one(spark, "ctx\n\nbody\n\nmore", tx.passage(F.col("x"))) == "body\n\nmore"
    assert one(spark, "srv__sch__find", tx.last_segment(F.col("x"))) == "find"
    assert one(spark, "/a/policy-of-2nd-care.pdf", tx.title_from_file(F.col("x"), ".pdf")) == "Policy Of 2Nd Care"


@pytest.mark.parametrize(
    "question, exact",
    [("What is 111 for?", True), ("How do I get my CHI record?", True), ("Where is Northbury?", True), ("Use the callBOARD app", True),
     ("Can my GP refer me to the NHS A&E?", False), ("I'm late. Can I rebook?", False), ("Where do I park? Is it free?", False), ("", False)],
)
def test_exact_terms(spark, question, exact):
    assert one(spark, question, tx.has_exact_terms(F.col("x"))) is exact
    assert one(spark, question, tx.route_query(F.col("x"), F.lit("AUTO"))) == ("HYBRID" if exact else "ANN")
    assert one(spark, question, tx.route_query(F.col("x"), F.lit("FULL_TEXT"))) == "FULL_TEXT"


def test_files_are_listed_by_folder(spark, tmp_path):
    (tmp_path / "leaflets").mkdir()
    (tmp_path / "leaflets" / "a.md").write_text("x")
    (tmp_path / "leaflets" / "b.MD").write_text("y")
    (tmp_path / "leaflets" / "c.txt").write_text("z")
    rows = files.read_files(spark, str(tmp_path)).orderBy("path").collect()
    assert [(r["path"].rsplit("/", 1)[1], r["kind"]) for r in rows] == [("a.md", "leaflets"), ("b.MD", "leaflets")]
    assert files.read_manifest(spark, str(tmp_path)) is None
    (tmp_path / "policies").mkdir()
    (tmp_path / "policies" / "sources.csv").write_bytes(b'\xef\xbb\xbffile_name,title,publisher,url,licence\np.pdf,"A, B",X,u,l\n')
    assert files.read_manifest(spark, str(tmp_path)).first()["title"] == "A, B"


def test_no_break_spaces_in_page_lines(spark):
    nbsp = "\u00a0"
    lines = [f"1.{nbsp}Introduction", f"Page{nbsp}12", f"4.1{nbsp}Communication with Patients{nbsp}7", f"Scope ..{nbsp}4", "plain text"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select(pages.is_heading(F.col("line")), pages.is_noise_line(F.col("line"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (False, True), (True, True), (False, True), (False, False)]


def test_units_carry_the_words_they_have_without_markers(spark):
    """Words are counted once, in the sentence: a paragraph that fits has the words of its sentences."""
    texts = [
        "One two. Three ⟦p2⟧ four.\n\nFive.⟦p3⟧ Six! ⟦p4⟧ Seven eight nine ten eleven. Twelve  of\tthem?",
        "w " * 40 + "end. Next one. " + "⟦p7⟧" + "x " * 9,
        "a\x1cb. C　d\n \n" + "long " * 11 + ".",
        "", " \n\n ",
    ]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for budget in (4, 13, 60):
        for r in df.select(passages.counted_units(F.col("x"), budget).alias("u"), passages.units(F.col("x"), budget).alias("t")).collect():
            assert [u["text"] for u in r["u"]] == list(r["t"])
            counted = [(u["n"], one(spark, u["text"], tx.word_count(tx.drop_markers(F.col("x"))))) for u in r["u"]]
            assert all(a == b for a, b in counted), counted


@pytest.mark.parametrize("text", ["a\nb\n\nc", "a\r\nb\rc", "a\x0bb\x0cc\x1cd\x1de\x1ef", "a\x85b c ", "", "\n", "a\x1fb"])
def test_lines_break_as_the_pattern_says(spark, text):
    assert one(spark, text, tx.break_lines(F.col("x"))) == one(spark, text, F.split("x", tx.LINE_BREAK))


@pytest.mark.parametrize(("line", "expected"), [("draft", True), ("oﬀicial", True), ("confidential　", False), ("Page 3 of 9 　", True), ("Introduction ... 12\x1c", False), ("a long line of text that ends in a number 7", False), ("٣", True)])
def test_noise_is_told_by_the_end_of_a_line(spark, line, expected):
    assert bool(one(spark, line, pages.is_noise_line(F.col("x")))) is expected
