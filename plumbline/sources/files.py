"""Readers for raw files: documents, the manifest, text-only CSV and labelled sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from plumbline.functions.text import SPACE_CHARS
from plumbline.session import is_small, pinned

PLACE = "_place"  # orders rows as their files have them

# Folders, the extension read from each, the default question kind, and what
# Windows-1252 puts where ISO-8859-1 has control characters (0x80 to 0x9f, in order; the
# five bytes it leaves undefined map to themselves).
FOLDERS = {"leaflets": ".md", "policies": ".pdf"}
DEFAULT_KIND = "paraphrase"
CP1252_HIGH = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
LATIN1_HIGH = "".join(map(chr, range(0x80, 0xA0)))

FILES_SCHEMA = "path string, kind string, content binary"
QUESTIONS_SCHEMA = "id string, question string, kind string, relevant array<struct<doc_id:string,evidence:string>>"
CASES_SCHEMA = (
    "id string, category string, question string, tools array<string>, guard string, "
    "include array<string>, exclude array<string>"
)


def _any_case(extension: str) -> str:
    letters = extension.lstrip(".")
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in letters)


def read_files(spark: SparkSession, root: str, folders: dict[str, str] = FOLDERS) -> DataFrame:
    """(path, kind, content) of the files below each folder; a missing folder has none."""
    out = spark.createDataFrame([], FILES_SCHEMA)
    for kind, extension in folders.items():
        try:
            files = (
                spark.read.format("binaryFile")
                .option("pathGlobFilter", _any_case(extension))
                .load(f"{root.rstrip('/')}/{kind}")
            )
        except AnalysisException:
            continue
        out = out.unionByName(files.select("path", F.lit(kind).alias("kind"), "content"))
    return out


def read_manifest(spark: SparkSession, root: str) -> DataFrame | None:
    """The list of published files with title, address and licence, and `_row`, the place in the file, which
    is read in one piece; None when there is none."""
    try:
        found = spark.read.csv(f"{root.rstrip('/')}/policies/sources.csv", header=True, escape='"', multiLine=True)
        return found.withColumn("_row", F.monotonically_increasing_id())
    except AnalysisException:
        return None


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)


PLAIN = r"\A[!-~]*\z"  # visible ASCII: nothing that `_clean` would change


def _clean(c: Column) -> Column:
    """No-break spaces as blanks, and none at the ends. Few cells have any; trimming costs more than to see that."""
    return F.when(c.rlike(PLAIN), c).otherwise(F.btrim(F.translate(c, "\xa0", " "), F.lit(SPACE_CHARS)))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, row, value): the lines of text files as they are stored, byte ranges of a file apart. Within
    a range `row` ascends along the file."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    return spark.read.text(path).select(*place, F.monotonically_increasing_id().alias("row"), "value")


def numbered(lines: DataFrame) -> DataFrame:
    """(file, number, value): lines numbered from 0 within their file, whatever ranges it was read in. Lines are
    counted by range; a range begins where the counts before it in its file end."""
    ranges = lines.groupBy("file", "start").agg(F.min("row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = pinned(ranges.select("file", "start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), "ranges")
    ranges = F.broadcast(ranges) if is_small(ranges) else ranges
    number = F.col("_before") + F.col("row") - F.col("_first")
    return lines.join(ranges, ["file", "start"]).select("file", number.alias("number"), "value")


def file_kinds(spark: SparkSession, path: str) -> dict[tuple[bool, bool], list[str]]:
    """The files of a path by whether they are valid UTF-8 and whether a quoted cell has a line break: one entry
    per file, its path. Lines are judged in their tasks: no character of UTF-8 goes over a line break,
    and a cell that does leaves an odd number of quotes on its line."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    found = text_lines(spark, path).groupBy("file").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(quotes % 2 == 1).alias("broken")
    )
    kinds: dict[tuple[bool, bool], list[str]] = {}
    for r in sorted(found.collect()):
        kinds.setdefault((r["utf8"], r["broken"]), []).append(r["file"])
    return kinds


def read_text_csv(spark: SparkSession, path: str, order: str = "_id", utf8: bool | None = None, multiline: bool | None = None) -> DataFrame:
    """A CSV with every column as trimmed text; blanks stay ''.

    Each file is UTF-8 unless its bytes are not, then Windows-1252. One with quoted line breaks is read in
    one piece, others are split. `_place` is added: it orders the rows as the files have them, however they
    were split. A row number column of the publisher is kept as BIGINT.
    """
    kinds = file_kinds(spark, path) if utf8 is None or multiline is None else {(utf8, multiline): [path]}
    parts = [
        _read_encoded(spark, paths, order, own_utf8 if utf8 is None else utf8, broken if multiline is None else multiline)
        for (own_utf8, broken), paths in (kinds or {(True, False): [path]}).items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _read_encoded(spark: SparkSession, paths: list[str], order: str, utf8: bool, multiline: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
    reader = reader.option("encoding", "UTF-8" if utf8 else "ISO-8859-1").option("multiLine", multiline)
    df = reader.csv(paths)

    def name(c: str) -> str:
        c = c if utf8 else c.translate(str.maketrans(LATIN1_HIGH, CP1252_HIGH))
        return c.lstrip("﻿").replace("\xa0", " ").strip()

    out = []
    for c in df.columns:
        cell = F.coalesce(F.col(f"`{c}`"), F.lit(""))
        cell = cell if utf8 else F.translate(cell, LATIN1_HIGH, CP1252_HIGH)
        cell = _clean(cell)
        out.append((cell.try_cast("bigint") if name(c) == order else cell).alias(name(c)))
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row")
    )
    return df.select(*out, place.alias(PLACE))


def source_digest(spark: SparkSession, path: str) -> str | None:
    """Digest of a source's lines and their order; of several files, one that ignores the order of the files.

    Every line is hashed with its number, in the task that reads it, and the hashes are added up: the
    digest does not depend on how a file was split. A line break of another kind changes nothing.
    """
    line = F.struct("number", "value")
    per_file = numbered(text_lines(spark, path)).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(line).cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(1), line)).alias("mixed"),
        F.sum(F.hash(line).cast("bigint")).alias("low"),
    )
    digests = per_file.select(F.sha2(F.concat_ws(":", "n", "sum", "mixed", "low"), 256).alias("d"))
    mixed = F.xxhash64("d")
    several = F.sha2(
        F.concat_ws(":", F.count(F.lit(1)), F.bit_xor(mixed), F.sum(mixed.cast("decimal(38,0)"))), 256
    )
    return digests.agg(F.when(F.count(F.lit(1)) == 1, F.max("d")).when(F.count(F.lit(1)) > 1, several)).first()[0]


def load_questions(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(QUESTIONS_SCHEMA).json(path)
    return df.withColumn("kind", F.coalesce("kind", F.lit(DEFAULT_KIND)))


def load_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases; no tools key means unchecked, an empty list means none may be called."""
    df = spark.read.schema(CASES_SCHEMA).json(path)
    none = F.array().cast("array<string>")
    return df.withColumns({c: F.coalesce(c, none) for c in ("include", "exclude")})


def label_table(questions: DataFrame) -> DataFrame:
    """One row per question and label."""
    return questions.select(F.col("id").alias("question_id"), F.inline("relevant"))
