"""Document fingerprints as Merkle trees over sections and paragraphs.

A text is cut into sections at empty lines, sections into paragraphs at line breaks and paragraphs into pieces
of a few words, which end after each word whose own hash says so: an edit changes the pieces it touches and
no others, wherever it stands. The leaves are the SHA-256 of the pieces; a paragraph's digest is that of
its leaves, a section's that of its paragraphs' digests, the root's that of the sections' digests. Equal
roots mean equal texts; where roots differ, only sections and paragraphs with different digests have to be
looked at, which locates an edit. The likeness of two trees is the Dice coefficient of their distinct leaves.

Everything is a DataFrame expression: no Python runs on the rows.

`with_next` puts every document next to its successor by id. Ids are cut into ranges of about equal
size at quantiles (as many bounds as there are ranges, looked up in two steps), the texts are shuffled
once by range, and the first documents of a range are also sent to the range before, so no window spans
more than one range.

Defined results: a null text is the empty text. Two empty texts are alike (1), an empty and another
are not (0). Null ids come first. Documents with the same id follow each other in the order of a hash
of their text. The last document's successor is the first, a single document is its own. A word of more than
64 characters counts as several, in scripts without blanks every character as one. A very long text is one
row and one tree. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import let
from plumbline.llm.base import BLANK, partitions_for, query, table
from plumbline.operators.shape import with_once

WORD = 64  # characters after which a word is cut
BORDER = "4"  # a word whose MD5 in hex is lower ends a piece: one in four
SINGLE = r"\x{2E80}-\x{D7AF}\x{F900}-\x{FAFF}"  # characters of scripts without blanks between words
OTHERS = BLANK.replace("[", "[^").replace("]", SINGLE + "]")
RANGE_BYTES = 8 << 20  # text of one range of ids
TREE = ("root", "sections", "leaves")
FIRST = -(1 << 63)  # where null ids stand


def pieces(paragraph: Column) -> Column:
    """The pieces of a paragraph, which together are the paragraph."""
    pattern = F.lit(f"(?:[{SINGLE}]|{OTHERS}{{1,{WORD}}}+){BLANK}*+|{BLANK}++")
    # the paragraph has no line break, so one can mark the borders
    marked = lambda w: F.when(F.md5(w.cast("binary")) < BORDER, F.concat(w, F.lit("\n"))).otherwise(w)
    words = F.transform(F.regexp_extract_all(paragraph, pattern, F.lit(0)), marked)
    return F.filter(F.split(F.array_join(words, ""), "\n", -1), lambda x: x != "")


def tree(text: Column) -> Column:
    """root, for each section its digest and the digests of its paragraphs, and 64 bits of the distinct leaves."""
    digest = lambda parts: F.sha2(F.array_join(parts, ""), 256)

    def section(s: Column) -> Column:
        leaves = F.transform(F.split(s, "\n", -1), lambda p: F.transform(pieces(p), lambda x: F.sha2(x, 256)))

        def above(x: Column) -> Column:
            node = lambda d: F.struct(digest(d).alias("digest"), d.alias("paragraphs"))
            return F.struct(let(F.transform(x, digest), node).alias("node"), F.flatten(x).alias("leaves"))

        return let(leaves, above)

    def whole(s: Column) -> Column:
        root = digest(F.transform(s, lambda x: x["node"]["digest"])).alias("root")
        leaves = F.transform(F.flatten(F.transform(s, lambda x: x["leaves"])), lambda x: F.xxhash64(x))
        nodes = F.transform(s, lambda x: x["node"])
        return F.struct(root, nodes.alias("sections"), F.array_distinct(leaves).alias("leaves"))

    return let(F.transform(F.split(text, "\n\n", -1), section), whole)


def first_difference(a: Column, b: Column) -> Column:
    """(section, paragraph) from 0 of the first paragraph in which two trees differ; null for equal ones.

    Sections with the same digest are not looked into.
    """

    def unlike(x: Column, y: Column) -> Column:
        """Position of the first pair of unlike entries, null if there is none."""
        marks = F.zip_with(x, y, lambda p, q: ~p.eqNullSafe(q))
        return F.nullif(F.array_position(marks, True) - 1, F.lit(-1).cast("bigint"))

    digests = lambda t: F.transform(t["sections"], lambda s: s["digest"])
    none = F.array().cast("array<string>")
    leaves = lambda t, i: F.coalesce(F.get(t["sections"], i.cast("int"))["paragraphs"], none)
    at = let(
        unlike(digests(a), digests(b)),
        lambda i: F.struct(i.alias("section"), unlike(leaves(a, i), leaves(b, i)).alias("paragraph")),
    )
    return F.when(a["root"] != b["root"], at)


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of the leaves of two trees."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2 * F.size(F.array_intersect(a, b)) / both)


def with_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """(_id, _text, _root, _sections, _leaves, _next, _next_leaves): every document, its tree's parts, with the text that follows by id."""
    ids = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST)).alias("_key"))
    n = partitions_for(docs, text, RANGE_BYTES)
    shares = [i / n for i in range(1, n)]
    bounds = sorted(set(ids.agg(F.percentile_approx("_key", shares, 20 * n)).first()[0] or [])) if shares else []
    step = max(1, math.isqrt(len(bounds)))
    blocks = [bounds[i : i + step] for i in range(0, len(bounds), step)] or [[]]
    constant = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    starts, inner = constant([b[0] for b in blocks[1:]], "array<bigint>"), constant(blocks, "array<array<bigint>>")

    def range_of(key: Column) -> Column:
        below = lambda values: F.size(F.filter(values, lambda b: b <= key))
        return let(below(starts), lambda i: i * step + below(F.get(inner, i)))

    firsts = sorted(tuple(r) for r in ids.groupBy(range_of(F.col("_key")).alias("r")).agg(F.min("_key")).collect())
    first, before = {r: k for r, k in firsts}, {r: firsts[i - 1][0] for i, (r, _) in enumerate(firsts)}
    slots = range(len(bounds) + 1)
    first = constant([first.get(i) for i in slots], "array<bigint>")
    before = constant([before.get(i) for i in slots], "array<int>")

    rows = docs.select(
        F.col("doc_id").alias("_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(FIRST)).alias("_key"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).withColumn("_own", range_of(F.col("_key")))
    place = lambda r, copy: F.struct(r.cast("int").alias("_range"), F.lit(copy).alias("_copy"))
    own = place(F.col("_own"), 0)
    leads = F.col("_key") == F.get(first, F.col("_own"))
    places = F.when(leads, F.array(own, place(F.get(before, F.col("_own")), 1))).otherwise(F.array(own))
    placed = rows.select("_id", "_key", "_text", F.inline(places)).repartition("_range")
    placed = with_once(placed, _tree=tree(F.col("_text")))
    # columns of their own: fields of a struct that passes a generator are lost when a count prunes them
    placed = placed.select("*", *[F.col(f"_tree.{c}").alias(f"_{c}") for c in TREE]).drop("_tree")
    order = Window.partitionBy("_range").orderBy("_copy", "_key", F.xxhash64("_text"))
    return (
        placed.withColumn("_next", F.lead("_text").over(order))
        .withColumn("_next_leaves", F.lead("_leaves").over(order))
        .where("_copy = 0")
        .select("_id", "_text", *[f"_{c}" for c in TREE], "_next", "_next_leaves")
    )


PIECES_SQL = (
    "list_filter(string_split(coalesce(array_to_string(list_transform("
    f"regexp_extract_all({{0}}, '(?:[{SINGLE}]|{OTHERS}{{1,{WORD}}}){BLANK}*|{BLANK}+'), "
    f"lambda w: case when md5(w) < '{BORDER}' then w || chr(10) else w end), ''), ''), chr(10)), lambda x: x <> '')"
).replace("{0}", "p")
LEAVES_SQL = (
    "list_transform(string_split({0}, chr(10) || chr(10)), lambda s: "
    f"list_transform(string_split(s, chr(10)), lambda p: list_transform({PIECES_SQL.replace('{', '{{').replace('}', '}}')}, lambda x: sha256(x))))"
)
DIGESTS_SQL = "list_transform({0}, lambda s: list_transform(s, lambda p: sha256(coalesce(array_to_string(p, ''), ''))))"
SET_SQL = "list_distinct(flatten(flatten({0})))"
UNLIKE_SQL = "nullif(coalesce(list_position(list_transform(range(1, greatest(len({0}), len({1})) + 1), lambda k: coalesce({0}[k] = {1}[k], false)), false), 0) - 1, -1)"


def _dice_sql(a: str, b: str) -> str:
    return f"case when len({a}) + len({b}) = 0 then 1.0 else 2 * len(list_intersect({a}, {b})) / (len({a}) + len({b})) end::double"


SQL = f"""with d as (select doc_id, coalesce(text, '') as t from documents),
  n as (select *, coalesce(lead(t) over (order by doc_id), first_value(t) over (order by doc_id)) as following, length(t) as n_chars from d),
  e as (select *, substr(t, 1, n_chars - n_chars // 2) || substr(following, 1, n_chars // 2) as edited from n),
  l as (select *, {LEAVES_SQL.format('t')} as la, {LEAVES_SQL.format('edited')} as lb, {LEAVES_SQL.format('following')} as lc from e),
  x as (select *, {DIGESTS_SQL.format('la')} as a, {DIGESTS_SQL.format('lb')} as b,
    {SET_SQL.format('la')} as ps, {SET_SQL.format('lb')} as es, {SET_SQL.format('lc')} as fs from l),
  y as (select *, list_transform(a, lambda s: sha256(array_to_string(s, ''))) as da, list_transform(b, lambda s: sha256(array_to_string(s, ''))) as db from x),
  z as (select *, {UNLIKE_SQL.format('da', 'db')} as edit_section from y),
  s as (select *, coalesce(a[edit_section + 1], []) as sa, coalesce(b[edit_section + 1], []) as sb from z)
  select doc_id, n_chars, sha256(edited) as edited_sha256, sha256(array_to_string(da, '')) as fingerprint, sha256(array_to_string(db, '')) as edited_fingerprint,
    {_dice_sql('ps', 'es')} as near_edited, {_dice_sql('ps', 'fs')} as near_next, edit_section,
    case when edit_section is not null then {UNLIKE_SQL.format('sa', 'sb')} end as edit_paragraph from s"""


@query("op4_merkle", SQL)
def op4_merkle(spark, folder):
    rows = with_next(table(spark, folder, "documents"))
    n = F.length("_text")
    half = F.floor(n / 2).cast("int")
    rows = with_once(rows, _edited=F.concat(F.substring(F.col("_text"), F.lit(1), n - half), F.substring(F.col("_next"), F.lit(1), half)))
    rows = with_once(rows, _edited_tree=tree(F.col("_edited")))
    rows = with_once(rows, _edit=first_difference(F.struct(*[F.col(f"_{c}").alias(c) for c in TREE]), F.col("_edited_tree")))
    return rows.select(
        F.col("_id").alias("doc_id"),
        F.length("_text").cast("bigint").alias("n_chars"),
        F.sha2("_edited", 256).alias("edited_sha256"),
        F.col("_root").alias("fingerprint"),
        F.col("_edited_tree.root").alias("edited_fingerprint"),
        likeness(F.col("_leaves"), F.col("_edited_tree.leaves")).alias("near_edited"),
        likeness(F.col("_leaves"), F.col("_next_leaves")).alias("near_next"),
        F.col("_edit.section").alias("edit_section"),
        F.col("_edit.paragraph").alias("edit_paragraph"),
    )
