"""Text expressions. All are built-in Spark expressions, so they run without Python workers."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space (Unicode White_Space plus the four
# information separators), as a set for trim() and as a regular expression.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"(?U:[\s\x1c-\x1f])"
OTHER_BREAK = r"[\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
NOT_SPACE = r"(?U:[^\s\x1c-\x1f])"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"

# Inline page marker, tokens per word, acronyms too common to be exact terms,
# everyday words for a specialty and the name pattern each group stands for.
PAGE_MARKER = "⟦p%d⟧"
PAGE_MARKER_PATTERN = SPACE + r"*⟦p(\d+)⟧" + SPACE + "*"
TOKENS_PER_WORD = 1.3
COMMON_ACRONYMS = ("NHS", "GP", "A&E")
SPECIALTY_ALIASES = {
    "%ear%nose%throat%": ("ent", "ear", "ears"),
    "%orthopaedic%": ("bones", "joint", "joints", "knee", "hip", "ortho", "orthopedic", "orthopedics"),
    "%ophthalmolog%": ("eye", "eyes", "cataract", "cataracts"),
    "%dermatolog%": ("skin",),
    "%cardiolog%": ("heart",),
}
MAX_PASSAGE_CHARS = 1200


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it in `body`, also inside the lambdas `body` builds.

    A column used inside a lambda can be inlined by the optimizer and evaluated again for
    every element; a lambda variable cannot.
    """
    # element_at settles the type once; an index works it out from the whole of `body` for every row
    return F.element_at(F.transform(F.array(value), body), 1)


def replace_all(c: Column, pairs: dict[str, str]) -> Column:
    """Plain replacements. A byte search each, which beats translate() on long texts."""
    for old, new in pairs.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def where_found(c: Column, needles: tuple[str, ...], change: Callable[[Column], Column]) -> Column:
    """`change` where one of the needles occurs. A byte search tells most texts apart from those that a regular
    expression would go through without changing them."""

    def guarded(x: Column) -> Column:
        found = reduce(lambda a, b: a | b, [F.contains(x, F.lit(n)) for n in needles])
        return F.when(found, change(x)).otherwise(x)

    return let(c, guarded)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE_CHARS))


def break_lines(c: Column) -> Column:
    """Lines of a text. Only one with other line breaks than LF needs the regular expression."""
    return let(c, lambda x: F.when(x.rlike(OTHER_BREAK), F.split(x, LINE_BREAK)).otherwise(F.split(x, "\n")))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(NOT_SPACE + "+"))


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(NOT_SPACE + "+"), F.lit(0))


def tokens_for(n_words: Column) -> Column:
    """Token estimate of a word count: 1.3 per word, half to even, at least 1."""
    return F.greatest(F.lit(1), F.rint(n_words * F.lit(TOKENS_PER_WORD)).cast("int"))


def drop_markers(c: Column) -> Column:
    # texts without a marker, the common case, skip the regular expression
    return F.when(F.contains(c, F.lit("⟦p")), F.regexp_replace(c, PAGE_MARKER_PATTERN, " ")).otherwise(c)


def token_count(c: Column) -> Column:
    return tokens_for(word_count(drop_markers(c)))


def single_blanks(c: Column) -> Column:
    return where_found(c, ("  ", "\t"), lambda x: F.regexp_replace(x, "[ \t]+", " "))


def normalise_whitespace(c: Column) -> Column:
    """CRLF to LF, runs of blanks to one, none around line breaks, at most one empty line."""
    c = where_found(c, ("\r\n", "\xa0"), lambda x: replace_all(x, {"\r\n": "\n", "\xa0": " "}))
    c = single_blanks(c)
    c = where_found(c, (" \n", "\n "), lambda x: F.regexp_replace(x, " *\n *", "\n"))
    return strip(where_found(c, ("\n\n\n",), lambda x: F.regexp_replace(x, "\n{3,}", "\n\n")))


def normalise_evidence(c: Column) -> Column:
    """Form in which evidence is compared: no emphasis stars, straight quotes, lower case."""
    c = replace_all(c, {"*": "", "’": "'", "‘": "'", "“": '"', "”": '"'})
    return F.lower(strip(F.regexp_replace(c, SPACE + "+", " ")))


def contains_evidence(text: Column, evidence: Column) -> Column:
    return F.contains(normalise_evidence(text), normalise_evidence(evidence))


def has_exact_terms(query: Column, common: tuple[str, ...] = COMMON_ACRONYMS) -> Column:
    """Does a question hold terms that keyword search finds better than meaning does?"""
    plain = [*common, "I"]

    def marks_exact(word: Column, i: Column) -> Column:
        letters = F.translate(word, "-&", "")
        acronym = (F.length(letters) >= 2) & (letters == F.upper(letters))
        mixed = F.substring(letters, 2, 1 << 30).rlike("[A-Z]")
        name = (i > 0) & word.rlike("^[A-Z]")
        return ~word.isin(plain) & (acronym | mixed | name)

    def in_sentence(sentence: Column) -> Column:
        shortened = F.regexp_replace(sentence, r"\bI'[\p{L}\p{N}_]+", "I")
        found = F.regexp_extract_all(shortened, F.lit("[A-Za-z][A-Za-z&-]*"), F.lit(0))
        return F.size(F.filter(found, marks_exact)) > 0

    return query.rlike(r"\p{Nd}") | F.exists(F.split(query, r"[.?!]+" + SPACE + "*"), in_sentence)


def route_query(query: Column, query_type: Column) -> Column:
    """AUTO becomes HYBRID for questions with exact terms and ANN otherwise."""
    return (
        F.when(query_type != "AUTO", query_type)
        .when(has_exact_terms(query), F.lit("HYBRID"))
        .otherwise(F.lit("ANN"))
    )


def alias_pattern(argument: Column, aliases: dict[str, tuple[str, ...]] = SPECIALTY_ALIASES) -> Column:
    """LIKE pattern of the first alias group with a word of the argument; NULL if none."""
    asked = F.split(F.lower(F.trim(argument)), "[^a-z]+")
    hits = [
        F.when(F.arrays_overlap(asked, F.array(*[F.lit(w) for w in group])), F.lit(pattern))
        for pattern, group in aliases.items()
    ]
    return F.coalesce(*hits)


def after(c: Column, separator: str) -> Column:
    """Text after the first separator, or all of it without one."""
    at = F.locate(separator, c)
    return F.when(at > 0, F.substr(c, at + len(separator))).otherwise(c)


def passage(text: Column, limit: int = MAX_PASSAGE_CHARS) -> Column:
    """A stored passage without its context line, cut to what is shown."""
    return F.substring(after(text, "\n\n"), 1, limit)


def section_of(section_path: Column) -> Column:
    return after(section_path, " > ")


def has_alternative(text: Column, fact: Column) -> Column:
    """Does any of the `|`-separated alternatives occur, whatever the case?"""
    return let(
        F.lower(text),
        lambda t: F.exists(F.split(fact, r"\|"), lambda a: F.contains(t, F.lower(strip(a)))),
    )


def last_segment(c: Column, separator: str = "__") -> Column:
    return F.substring_index(c, separator, -1)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_stem(path: Column, extension: str) -> Column:
    # the extension is removed as written, in this case only
    name = file_name(path)
    return F.when(F.endswith(name, F.lit(extension)), F.substr(name, F.lit(1), F.length(name) - len(extension))).otherwise(name)


def title_from_file(path: Column, extension: str) -> Column:
    """Every run of letters starts with a capital, dashes become blanks."""
    runs = F.regexp_extract_all(
        F.translate(file_stem(path, extension), "-", " "), F.lit(r"\p{L}+|\P{L}+"), F.lit(0)
    )
    return F.array_join(F.transform(runs, F.initcap), "")


def fingerprint(c: Column) -> Column:
    return F.left(F.sha2(c, 256), F.lit(12))
