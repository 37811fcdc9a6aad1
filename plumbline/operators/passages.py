"""Sections -> passages within a token budget, with bounded overlap.

Each section is packed on its own row by expressions: no shuffle and no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import (
    PAGE_MARKER_PATTERN,
    TOKENS_PER_WORD,
    drop_markers,
    let,
    single_blanks,
    strip,
    tokens_for,
    word_count,
    words,
)

# Budget and overlap in tokens, where a paragraph ends, where a sentence ends.
MAX_TOKENS = 400
OVERLAP_TOKENS = 60
PARAGRAPH_BREAK = r"(?U:\n\s*\n)"
# White space first, what is before it second: a look behind at every character takes longer.
SENTENCE_BREAK = r"(?U)\s(?<=[.!?]\s)\s*(?=[A-Z0-9\"'(⟦])"


def units(text: Column, max_tokens: int) -> Column:
    """Paragraphs; those over the budget as sentences; those still over it as word slices."""
    return F.transform(counted_units(text, max_tokens), lambda u: u.getField("text"))


def counted_units(text: Column, max_tokens: int) -> Column:
    """Units with n, their words without page markers. Every word is counted once, in its sentence: a break
    between sentences is one between words, so a paragraph has the words of its sentences."""
    step = int(max_tokens / TOKENS_PER_WORD)

    def parts(text: Column, pattern: str) -> Column:
        return F.filter(F.transform(F.split(text, pattern), strip), lambda x: x != "")

    def slices(sentence: Column) -> Column:
        return let(
            words(sentence),
            lambda ws: F.transform(
                F.sequence(F.lit(1), F.size(ws), F.lit(step)),
                lambda i: F.array_join(F.slice(ws, i, F.lit(step)), " "),
            ),
        )

    def counted(x: Column) -> Column:
        return F.struct(x.alias("text"), word_count(drop_markers(x)).alias("n"))

    def fits(u: Column) -> Column:
        return tokens_for(u.getField("n")) <= max_tokens

    def of_sentence(s: Column) -> Column:
        return F.when(fits(s), F.array(s)).otherwise(F.transform(slices(s.getField("text")), counted))

    def of_paragraph(p: Column) -> Column:
        def cut(sentences: Column) -> Column:
            longer = F.flatten(F.transform(sentences, of_sentence))
            # where all sentences fit, as nearly always, they are the units as they stand
            longer = F.when(F.forall(sentences, fits), sentences).otherwise(longer)
            n = F.aggregate(sentences, F.lit(0), lambda a, s: a + s.getField("n"))
            return let(n, lambda n: F.when(tokens_for(n) <= max_tokens, F.array(F.struct(p.alias("text"), n.alias("n")))).otherwise(longer))

        # words and the blanks between them: 2n - 1 characters at least
        short = F.length(p) < 2 * step
        return F.when(short, F.array(counted(p))).otherwise(let(F.transform(parts(p, SENTENCE_BREAK), counted), cut))

    return F.flatten(F.transform(parts(text, PARAGRAPH_BREAK), of_paragraph))


def paged_units(unit_list: Column, first_page: Column) -> Column:
    """Counted units, stripped, without page markers, each with the page its first word is on."""

    def pages_in(u: Column) -> Column:
        return F.regexp_extract_all(u, F.lit(PAGE_MARKER_PATTERN), F.lit(1))

    def unit(u: Column, text: Column, page: Column) -> Column:
        return F.struct(single_blanks(text).alias("text"), u.getField("n").alias("n"), page.cast("int").alias("page"))

    start = F.struct(
        first_page.cast("int").alias("page"), F.array().cast("array<struct<text:string,n:int,page:int>>").alias("out")
    )

    def step(state: Column, u: Column) -> Column:
        # a marker before the first word says where the unit starts
        leading = F.regexp_extract(u.getField("text"), "^" + PAGE_MARKER_PATTERN, 1).try_cast("int")
        own = F.coalesce(leading, state.getField("page"))
        last = F.try_element_at(pages_in(u.getField("text")), F.lit(-1)).try_cast("int")
        return F.struct(
            F.coalesce(last, state.getField("page")).alias("page"),
            F.concat(state.getField("out"), F.array(unit(u, strip(drop_markers(u.getField("text"))), own))).alias("out"),
        )

    marked = F.exists(unit_list, lambda u: F.contains(u.getField("text"), F.lit("⟦p")))
    tracked = F.when(
        marked, F.aggregate(unit_list, start, step, lambda s: s.getField("out"))
    ).otherwise(F.transform(unit_list, lambda u: unit(u, u.getField("text"), first_page)))
    return F.filter(tracked, lambda x: x.getField("text") != "")


def pack(word_counts: Column, max_tokens: int, overlap_tokens: int) -> Column:
    """Word counts of the units of one section -> [start, end] intervals of units, greedily.

    Joining units adds no words, so a run of units is as long as the sum of its words. The
    overlap carried into the next passage is always a run that ends where the last one ended.
    """

    start = F.struct(
        F.lit(0).alias("first"),
        F.lit(0).alias("words"),
        F.array().cast("array<struct<first:int,last:int>>").alias("done"),
    )

    def carried(first: Column, i: Column, w: Column) -> Column:
        """Units and words of the longest run before unit i that fits the overlap, and the budget with unit i.
        Units are added from the last one back; once a run is too long, so are all longer ones."""

        def extend(state: Column, x: Column) -> Column:
            def longer(n: Column) -> Column:
                fits = (tokens_for(n) <= overlap_tokens) & (tokens_for(n + w) <= max_tokens)
                units, kept = state.getField("units"), state.getField("words")
                return F.struct(n.alias("seen"), F.when(fits, units + 1).otherwise(units).alias("units"), F.when(fits, n).otherwise(kept).alias("words"))

            return let(state.getField("seen") + x, longer)

        none = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("units"), F.lit(0).alias("words"))
        return F.aggregate(F.reverse(F.slice(word_counts, first + 1, i - first)), none, extend)

    def step(state: Column, unit: Column) -> Column:
        i, w = unit.getField("i"), unit.getField("w")
        first, n, done = (state.getField(f) for f in ("first", "words", "done"))
        full = (i > first) & (tokens_for(n + w) > max_tokens)
        emitted = F.concat(done, F.array(F.struct(first.alias("first"), (i - 1).alias("last"))))
        return F.when(
            full,
            let(
                carried(first, i, w),
                lambda c: F.struct(
                    (i - c.getField("units")).alias("first"),
                    (c.getField("words") + w).alias("words"),
                    emitted.alias("done"),
                ),
            ),
        ).otherwise(F.struct(first.alias("first"), (n + w).alias("words"), done.alias("done")))

    indexed = F.transform(word_counts, lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    n = F.size(word_counts)

    def finish(state: Column) -> Column:
        rest = F.array(F.struct(state.getField("first").alias("first"), (n - 1).alias("last")))
        return F.when(n > 0, F.concat(state.getField("done"), rest)).otherwise(state.getField("done"))

    return F.aggregate(indexed, start, step, finish)


def section_passages(section: Column, max_tokens: int, overlap_tokens: int) -> Column:
    """Passages of one section: body, token count, page of the first unit."""
    path = F.array_join(section.getField("heading_path"), " > ")

    def build(us: Column) -> Column:
        def cut(counts: Column) -> Column:
            def passage(run: Column) -> Column:
                first, last = run.getField("first"), run.getField("last")
                taken = F.slice(us, first + 1, last - first + 1)
                body = F.array_join(F.transform(taken, lambda u: u.getField("text")), "\n\n")
                size = F.aggregate(
                    F.slice(counts, first + 1, last - first + 1), F.lit(0), lambda a, x: a + x
                )
                return F.struct(
                    path.alias("section_path"),
                    F.concat(path, F.lit("\n\n"), body).alias("text"),
                    tokens_for(size).alias("token_count"),
                    F.get(us, first).getField("page").alias("page"),
                )

            return F.transform(pack(counts, max_tokens, overlap_tokens), passage)

        return let(F.transform(us, lambda u: u.getField("n")), cut)

    return let(
        counted_units(section.getField("text"), max_tokens),
        lambda raw: let(paged_units(raw, section.getField("page")), build),
    )


def passages(docs: DataFrame, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS) -> DataFrame:
    """One row per passage, numbered through each document."""
    if overlap_tokens >= max_tokens:
        raise ValueError("overlap_tokens must be smaller than max_tokens")
    cut = F.flatten(
        F.transform("sections", lambda s: section_passages(s, max_tokens, overlap_tokens))
    )
    carried = [
        c
        for c in ("title", "source_type", "status", "effective_date", "service", "audience", "source_url")
        if c in docs.columns
    ]
    rows = docs.select("doc_id", *carried, F.posexplode(cut).alias("chunk_index", "p"))
    return rows.select(
        F.format_string("%s-%04d", F.col("doc_id").cast("string"), F.col("chunk_index")).alias("chunk_id"),
        "doc_id",
        "chunk_index",
        *carried,
        "p.section_path",
        "p.text",
        "p.token_count",
        "p.page",
        F.lit(max_tokens).alias("chunk_max_tokens"),
        F.lit(overlap_tokens).alias("chunk_overlap_tokens"),
    )
