"""Raw files -> document records with sections, and the personal-data scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import (
    SPACE,
    break_lines,
    file_name,
    file_stem,
    let,
    normalise_whitespace,
    strip,
    title_from_file,
)
from plumbline.operators.pages import clean_pages, page_sections
from plumbline.operators.shape import with_once

# A Markdown heading, the fence of front matter, and the identifiers searched for.
# CHI: birth date DDMMYY and four digits. NI: two letters, six digits, a letter.
MD_HEADING = "^(#{1,6})" + SPACE + "+(.+?)" + SPACE + "*$"
FENCE = "---"
CHI_NUMBER = r"\b(?:0[1-9]|[12]\d|3[01])(?:0[1-9]|1[0-2])\d{2}\s?\d{4}\b"
NI_NUMBER = r"\b(?!BG|GB|NK|KN|TN|NT|ZZ)[A-CEGHJ-PR-TY-Z]{2}\s?\d{2}\s?\d{2}\s?\d{2}\s?[A-D]\b"
LABELLED_FIELD = (
    r"\b(?:patient name|patient's name|date of birth|dob|chi number|chi no\.?|nhs number)\s*[:=]\s*[\w/.-]+"
)
EMAIL = r"\b[\w.+-]+@(?:[\w-]+\.)+[a-z]{2,}\b"
OWN_DOMAINS = (".example", "gov.scot", "nhs.scot", "nhs.net", "nhs.uk", "spso.org.uk")
EXCERPT_WIDTH = 20



@dataclass(frozen=True)
class Kind:
    """A kind of personal data. `needs` is a cheap pattern without which there can be no match."""

    name: str
    severity: str
    pattern: str
    needs: str
    own_domains: tuple[str, ...] = ()


PII_KINDS = (
    Kind("chi_number", "high", f"(?U:{CHI_NUMBER})", r"\p{Nd}{6}"),
    Kind("ni_number", "high", f"(?U:{NI_NUMBER})", r"[A-Z]{2}\s?\p{Nd}{2}"),
    Kind("labelled_personal_field", "high", f"(?iU:{LABELLED_FIELD})", "[:=]"),
    Kind("email_address", "low", f"(?iU:{EMAIL})", "@", OWN_DOMAINS),
)
FINDING = "struct<kind:string,severity:string,excerpt:string>"


def front_matter(text: Column) -> Column:
    """The `key: value` block between two fences, '' without one."""
    closing = F.locate(FENCE, text, len(FENCE) + 1)
    fenced = F.startswith(text, F.lit(FENCE)) & (closing > 0)
    return F.when(fenced, F.substr(text, F.lit(4), closing - 4)).otherwise(F.lit(""))


def body_after_front_matter(text: Column) -> Column:
    closing = F.locate(FENCE, text, len(FENCE) + 1)
    fenced = F.startswith(text, F.lit(FENCE)) & (closing > 0)
    return F.when(fenced, F.substr(text, closing + len(FENCE))).otherwise(text)


def meta_value(meta: Column, key: str) -> Column:
    """Value of a flat key, unquoted; NULL when missing, empty or a YAML null."""
    raw = F.regexp_extract(meta, rf"(?m)^{key}[ \t]*:[ \t]*(.*?)[ \t\r]*$", 1)
    quoted = F.regexp_extract(raw, r"^(?:\"(.*)\"|'(.*)')$", 1)
    single = F.regexp_extract(raw, r"^'(.*)'$", 1)
    plain = F.regexp_replace(raw, r"[ \t]+#.*$", "")
    value = F.when(raw.rlike('^".*"$'), F.replace(quoted, F.lit('\\"'), F.lit('"'))).when(
        raw.rlike("^'.*'$"), F.replace(single, F.lit("''"), F.lit("'"))
    ).otherwise(F.when(~plain.isin("~", "null", "Null", "NULL"), plain))
    return F.nullif(value, F.lit(""))


def heading_sections(body: Column, title: Column) -> Column:
    """Markdown -> sections keyed by heading path; text before any heading goes to the title.

    A heading of level n keeps the first n - 1 entries of the path; skipped levels are not filled.
    """

    def paths(lines: Column, at: Column) -> Column:
        start = F.struct(
            F.array().cast("array<string>").alias("path"),
            F.array().cast("array<array<string>>").alias("all"),
        )

        def step(state: Column, i: Column) -> Column:
            line = F.get(lines, i)
            level = F.length(F.regexp_extract(line, MD_HEADING, 1))
            name = strip(F.regexp_extract(line, MD_HEADING, 2))
            grown = F.concat(F.slice(state.getField("path"), F.lit(1), level - 1), F.array(name))
            return let(
                grown,
                lambda p: F.struct(
                    p.alias("path"), F.concat(state.getField("all"), F.array(p)).alias("all")
                ),
            )

        return F.aggregate(at, start, step, lambda s: s.getField("all"))

    def build(lines: Column, at: Column, path_of: Column) -> Column:
        def section(j: Column) -> Column:
            first = F.when(j == 0, F.lit(0)).otherwise(F.get(at, j - 1) + 1)
            last = F.coalesce(F.get(at, j), F.size(lines))
            text = normalise_whitespace(F.array_join(F.slice(lines, first + 1, last - first), "\n"))
            return F.struct(
                F.when(j == 0, F.array(title)).otherwise(F.get(path_of, j - 1)).alias("heading_path"),
                text.alias("text"),
                F.lit(None).cast("int").alias("page"),
            )

        found = F.transform(F.sequence(F.lit(0), F.size(at)), section)
        return F.filter(found, lambda s: s.getField("text") != "")

    def split_at_headings(lines: Column) -> Column:
        marks = F.transform(lines, lambda x, i: F.when(x.rlike(MD_HEADING), i))
        return let(
            F.filter(marks, lambda i: i.isNotNull()),
            lambda at: let(paths(lines, at), lambda path_of: build(lines, at, path_of)),
        )

    return let(break_lines(body), split_at_headings)


def _findings_of(text: Column, kind: Kind, width: int) -> Column:
    # the look-arounds capture `width` characters either side without consuming them; the first
    # one lets the search look back only where there is a match
    around = (
        rf"(?={kind.pattern})(?<=((?s:.{{{width}}}))|\A((?s:.{{0,{width - 1}}})))"
        rf"(?:{kind.pattern})(?=((?s:.{{0,{width}}})))"
    )
    names = ("value", "before", "at_start", "after")
    hits = F.arrays_zip(
        *[F.regexp_extract_all(text, F.lit(around), F.lit(g)).alias(n) for g, n in enumerate(names)]
    )
    if kind.own_domains:
        hits = F.filter(
            hits,
            lambda h: ~_ends_with_any(F.lower(F.substring_index(h.getField("value"), "@", -1)), kind.own_domains),
        )

    def finding(h: Column) -> Column:
        # Java keeps captures of earlier tries: `at_start` only counts when `before` is empty
        before = F.coalesce(F.nullif(h.getField("before"), F.lit("")), h.getField("at_start"))
        excerpt = F.concat(F.lit("..."), before, F.lit("[REDACTED]"), h.getField("after"), F.lit("..."))
        return F.struct(
            F.lit(kind.name).alias("kind"),
            F.lit(kind.severity).alias("severity"),
            F.translate(excerpt, "\n", " ").alias("excerpt"),
        )

    # most texts hold none: two plain searches, the cheap one first, decide
    return F.when(text.rlike(kind.needs) & text.rlike(kind.pattern), F.transform(hits, finding)).otherwise(
        F.array().cast(f"array<{FINDING}>")
    )


def find_personal_data(text: Column, kinds=PII_KINDS, width: int = EXCERPT_WIDTH) -> Column:
    """All findings of all kinds, each with its surroundings and the value masked."""
    return F.concat(*[_findings_of(text, kind, width) for kind in kinds])


def _ends_with_any(c: Column, suffixes) -> Column:
    out = F.lit(False)
    for s in suffixes:
        out = out | F.endswith(c, F.lit(s))
    return out


def is_quarantined(findings: Column) -> Column:
    return F.exists(findings, lambda f: f.getField("severity") == "high")


def findings_text(findings: Column) -> Column:
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(": ", f.getField("kind"), f.getField("excerpt"))), "; "
    )


def parse_markdown(files: DataFrame) -> DataFrame:
    """(path, content) -> document records. Unreadable files keep their row with an `error`."""
    text = F.col("content").cast("string")
    df = files.select(
        F.col("path").alias("source_path"),
        F.sha2("content", 256).alias("content_hash"),
        F.when(~F.is_valid_utf8(text), F.lit("not valid UTF-8")).alias("error"),
        F.when(F.is_valid_utf8(text), text).alias("_text"),
    )
    df = df.withColumns({"_meta": front_matter(F.col("_text")), "_body": body_after_front_matter(F.col("_text"))})

    def meta(key: str) -> Column:
        return meta_value(F.col("_meta"), key)

    df = df.withColumn("title", F.coalesce(meta("title"), file_name(F.col("source_path"))))
    df = with_once(df, sections=heading_sections(F.col("_body"), F.col("title")))
    return df.select(
        F.coalesce(meta("doc_id"), file_stem(F.col("source_path"), ".md")).alias("doc_id"),
        "source_path",
        F.lit("leaflet").alias("source_type"),
        "title",
        "content_hash",
        normalise_whitespace(F.col("_body")).alias("raw_text"),
        "sections",
        F.coalesce(meta("status"), F.lit("current")).alias("status"),
        F.try_to_date(meta("effective_date"), "yyyy-MM-dd").alias("effective_date"),
        F.try_to_date(meta("review_date"), "yyyy-MM-dd").alias("review_date"),
        meta("service").alias("service"),
        meta("audience").alias("audience"),
        F.lit(None).cast("string").alias("source_url"),
        meta("licence").alias("licence"),
        "error",
    )


def parse_pages(paged: DataFrame, manifest: DataFrame | None = None) -> DataFrame:
    """(path, content_hash, pages ARRAY<STRING>) -> document records.

    `manifest` has file_name, title, url, licence; a file without an entry gets a title made
    from its name.
    """
    df = paged.withColumn("_name", file_name(F.col("path")))
    if manifest is not None:
        # of several entries for a file the last one counts, as a whole
        entry = F.struct(*[F.col(c).alias(f"_{c}") for c in ("title", "url", "licence")])
        place = F.col("_row") if "_row" in manifest.columns else F.to_json(entry)
        info = manifest.groupBy(F.col("file_name").alias("_file")).agg(F.max_by(entry, place).alias("_entry")).select("_file", "_entry.*")
        df = df.join(info, F.col("_name") == F.col("_file"), "left")
    else:
        df = df.withColumns({f"_{c}": F.lit(None).cast("string") for c in ("title", "url", "licence")})
    df = df.withColumn("title", F.coalesce(F.nullif("_title", F.lit("")), title_from_file(F.col("_name"), ".pdf")))
    df = with_once(df, _clean=clean_pages(F.col("pages")))
    df = with_once(df, sections=page_sections(F.col("_clean"), F.col("title")))
    return df.select(
        F.concat(F.lit("policy-"), file_stem(F.col("_name"), ".pdf")).alias("doc_id"),
        F.col("path").alias("source_path"),
        F.lit("policy").alias("source_type"),
        "title",
        "content_hash",
        normalise_whitespace(F.array_join("_clean", "\n\n")).alias("raw_text"),
        "sections",
        F.lit("current").alias("status"),
        F.lit(None).cast("date").alias("effective_date"),
        F.lit(None).cast("date").alias("review_date"),
        F.lit(None).cast("string").alias("service"),
        F.lit(None).cast("string").alias("audience"),
        F.col("_url").alias("source_url"),
        F.col("_licence").alias("licence"),
        F.when(F.col("pages").isNull(), F.lit("no page text")).alias("error"),
    )


def error_rows(parsed: DataFrame) -> DataFrame:
    """Files that could not be read; the run goes on with the others."""
    return parsed.where(F.col("error").isNotNull()).select("source_path", "error")


def with_findings(df: DataFrame, text: str = "raw_text", kinds=PII_KINDS) -> DataFrame:
    """Add `findings` and `quarantined`."""
    scanned = with_once(df, findings=find_personal_data(F.col(text), kinds))
    return scanned.withColumn("quarantined", is_quarantined(F.col("findings")))


def scan(parsed: DataFrame) -> DataFrame:
    """Readable documents with their findings and whether they are held back."""
    return with_findings(parsed.where(F.col("error").isNull()).drop("error"))


def quarantine_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where("quarantined").select(
        "doc_id", "source_path", "content_hash", findings_text(F.col("findings")).alias("findings")
    )


def low_finding_rows(scanned: DataFrame) -> DataFrame:
    return scanned.where("not quarantined").select("doc_id", F.inline("findings")).drop("severity")


def clean_documents(scanned: DataFrame) -> DataFrame:
    return scanned.where("not quarantined").drop("findings", "quarantined")
