"""License scan: ordered signature rules behind a keyword prefilter.

A text is reduced to its words, one blank between two. One pass of an Aho-Corasick automaton finds the
keywords of all rules; a rule's regular expression runs only around the places of its keyword, as far
as a match can reach, so the result is that of running every rule over the whole text. Every match is an
interval of words. A match that lies inside the interval of a stronger one goes: stronger is the smaller
priority, among equals the longer interval, then the earlier rule. A sentence of a license's text beats
a tag or notice around it, that the name in it, that a general statement. The phrases that every scan
reports are rules too; they are reported whether they lie inside a stronger match or not.

Everything happens on the row of the text: no shuffle, no collected group.

Defined results: a null or blank text has no word and no match. Repeated rows get equal results. An
empty table gives an empty table. Columns of any name are carried in `_row`. A very long text is held
as its normalised form and the list of its matches, both in proportion to the text.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.base import carried, query, table
from plumbline.llm.license_rules import RULES, Rule
from plumbline.llm.words import TO_WORDS

REACH = 600  # bytes on each side of a keyword; no match is as long (tested)
FOUND = pa.list_(pa.struct([("label", pa.string()), ("kind", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("confidence", pa.float64()), ("kept", pa.bool_())]))
SCAN = pa.struct([("n_words", pa.int64()), ("found", FOUND)])


def normalised(text: str | None) -> str:
    """The words of a text, A-Z in lower case, one blank between two; UTF-8 read as Latin-1."""
    low = (text or "").encode("utf-8", "surrogatepass").translate(TO_WORDS).decode("latin-1")
    return re.sub("  +", " ", low).strip(" ")


class Scanner:
    """The rules, compiled, with the automaton of their keywords."""

    def __init__(self, rules: tuple[Rule, ...]):
        import ahocorasick

        self.rules = rules
        self.compiled = [re.compile(r.pattern) for r in rules]
        self.gated: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            self.gated.setdefault(rule.keyword, []).append(number)
        self.keywords = ahocorasick.Automaton()
        for keyword in self.gated:
            self.keywords.add_word(keyword, keyword)
        self.keywords.make_automaton()

    def matches(self, words: str) -> list[tuple[int, int, int]]:
        """(start, end, rule) of every match, as offsets. A rule's matches do not overlap each other."""
        windows: dict[str, list[list[int]]] = {}
        for end, keyword in self.keywords.iter(words):
            near = windows.setdefault(keyword, [])
            lo, hi = max(0, end - REACH), min(len(words), end + REACH)
            if near and lo <= near[-1][1]:
                near[-1][1] = hi
            else:
                near.append([lo, hi])
        out = []
        for keyword, near in windows.items():
            for number in self.gated[keyword]:
                rule = self.compiled[number]
                group = rule.groupindex.get("at", 0)
                out += [(*m.span(group), number) for lo, hi in near for m in rule.finditer(words, lo, hi)]
        return out

    def suppressed(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
        """(start, end, rule, kept), ordered by place. One sweep for each priority: all matches of that
        priority or stronger, by start and with the longer before the shorter one, against the farthest end
        so far."""
        rank = lambda m: (m[0], -m[1], self.rules[m[2]].priority, m[2])
        ordered = sorted(matches, key=rank)
        kept = [True] * len(ordered)
        for level in {self.rules[number].priority for _, _, number in ordered}:
            farthest = -1
            for i, (_, end, number) in enumerate(ordered):
                if (own := self.rules[number].priority) > level:
                    continue
                if own == level and end <= farthest:
                    kept[i] = False
                farthest = max(farthest, end)
        return [(*m, k) for m, k in zip(ordered, kept)]

    def scan(self, text: str | None) -> dict:
        """The number of words and the matches, by words: the first one and the one after the last."""
        words = normalised(text)
        found = self.suppressed(self.matches(words))
        offsets = sorted({o for start, end, _, _ in found for o in (start, end)})
        place, before, at = [], 0, 0
        for offset in offsets:  # blanks are counted from one offset to the next
            before += words.count(" ", at, offset)
            at = offset
            place.append(before)
        word_of = lambda offset: place[bisect_left(offsets, offset)]
        rows = []
        for start, end, number, kept in found:
            rule = self.rules[number]
            rows.append({"label": rule.label, "kind": rule.kind, "first_word": word_of(start), "end_word": word_of(end) + 1, "confidence": rule.confidence, "kept": kept})
        return {"n_words": words.count(" ") + 1 if words else 0, "found": rows}


def scanned(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """struct(n_words, found): the scan of a text. `found` has every match with `kept`, whether it stands
    after suppression; phrases count either way."""
    held: list[Scanner] = []

    @F.arrow_udf("struct<n_words: bigint, found: array<struct<label: string, kind: string, first_word: bigint, end_word: bigint, confidence: double, kept: boolean>>>")
    def scan(texts: pa.Array) -> pa.Array:
        if not held:
            held.append(Scanner(rules))
        return pa.array([held[0].scan(t.as_py()) for t in texts], SCAN)

    return scan(text)


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(_row, _n_words, _found): every row with its words counted and its matches that stand, phrases included."""
    found = carried(docs).withColumn("_scan", scanned(F.col(f"_row.{text}"), rules))
    stands = F.filter("_scan.found", lambda m: m["kept"] | (m["kind"] == "phrase"))
    return found.select("_row", F.col("_scan.n_words").alias("_n_words"), stands.alias("_found"))


def summary(found: Column) -> dict[str, Column]:
    """The columns of a report from `_found`. The score is the highest confidence of what was found, or 0."""
    phrases = F.filter(found, lambda m: m["kind"] == "phrase")
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda m: m["label"]))), ",")
    starts = F.transform(phrases, lambda m: m["first_word"])
    return {
        "n_base": F.size(phrases).cast("bigint"),
        "first_word": F.array_min(starts),
        "last_word": F.array_max(starts),
        "base_labels": names(phrases),
        "labels": names(found),
        "score": F.coalesce(F.array_max(F.transform(found, lambda m: m["confidence"])), F.lit(0.0)),
    }


@query("op11_licenses")
def op11_licenses(spark, folder):
    found = scan(table(spark, folder, "documents").select("doc_id", "text"))
    report = summary(F.col("_found"))
    return found.select(F.col("_row.doc_id").alias("doc_id"), F.col("_n_words").alias("n_words"), *[c.alias(k) for k, c in report.items()])
