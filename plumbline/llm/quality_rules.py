"""Quality rules whose cutoffs come from labelled holdouts with a bound on false rejection.

Every text is measured by a few counts. A fixed base rule fails short and repetitive texts. Beyond
it, each rule compares one ratio with a cutoff that is chosen per stratum (by default the language):
the lowest cutoff of a grid for which an exact binomial test on labelled good texts shows that at
most a `risk` share of them is rejected. The tests share the error `delta`: Bonferroni over strata and
rules. Along a grid no share is needed: a higher cutoff rejects fewer texts, so the cutoffs that break
the promise are the lowest ones, and one of them is chosen only if the highest that breaks it passes its
own test (a fixed sequence from the highest cutoff down). The rules of a stratum share the risk, so with
probability 1 - `delta` no stratum loses more than `risk` of its good texts to these rules.

Everything is a DataFrame expression: no Python runs on the rows.

Defined results: a null text has no words (all counts 0, base rule failed). A stratum without
enough labels gets no cutoff, so only the base rule rejects there. A null stratum is a stratum of
its own. Labels with a null id or quality, and labels of unknown documents, are ignored; documents
without a label are judged all the same. Repeated labels count as often as they occur, repeated
documents are judged alike; a labelled document that is repeated counts once for each of its rows, in the
row's stratum. A very long text is one row, in memory a multiple of its length. An empty table gives an empty result; empty labels give no cutoffs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import let
from plumbline.llm.base import BLANK, BLANKS, carried, query, table, unpacked, word_list
from plumbline.operators.joins import join_sized, skew_safe_join
from plumbline.session import pinned

# The characters counted as symbols, the least number of words, and the share of
# words in repeated three-word windows (in per cent) above which a text fails.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50

GRID = tuple(round(0.02 * i, 2) for i in range(1, 6)) + (0.15, 0.2, 0.3, 0.4, 0.5, 0.75, 1.0)
LENGTH_GRID = tuple(float(x) for x in (7, 8, 9, 10, 11, 12, 14, 16, 20, 30))


def default_rules() -> dict[str, tuple[Callable, tuple[float, ...]]]:
    """Rule name to (ratio of the counts, grid of cutoffs). A ratio above the cutoff rejects; a text
    without words has no ratios."""

    def per(part: str, whole: str) -> Callable:
        return lambda m: F.try_divide(m(part), m(whole))

    return {
        "symbols_per_word": (per("n_symbols", "n_words"), GRID),
        "exclamations_per_word": (per("n_exclamations", "n_words"), GRID),
        "repeated_words": (per("n_repeat_words", "n_words"), GRID),
        "repeated_lines": (per("n_dup_lines", "n_lines"), GRID),
        "chars_per_word": (per("word_chars", "n_words"), LENGTH_GRID),
    }


@dataclass(frozen=True)
class RiskControl:
    """risk: the share of good texts of a stratum that the rules may reject. delta: the chance that
    any stratum is rejected more than that. All labelled rows count."""

    risk: float = 0.02
    delta: float = 0.05
    stratum: str = "lang"
    rules: dict = field(default_factory=default_rules)



def _occurrences(text: Column, characters: str) -> Column:
    """How often the given ASCII characters occur, by the bytes their removal saves."""
    rest = text
    for c in characters:
        rest = F.replace(rest, F.lit(c))
    return (F.octet_length(text) - F.octet_length(rest)).cast("bigint")


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are compared by a 64-bit hash chained over their words. Equal ones stand next to each
    other once sorted with their position; the positions, sorted again, cover three words each, less
    what the next one covers too. Texts without a repeated window, the common case, skip the sort.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            n = F.size(s)
            same = F.transform(
                s,
                lambda x, k: F.when(
                    ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | ((k < n - 1) & (F.get(s, k + 1)["h"] == x["h"])),
                    x["i"],
                ),
            )
            return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

        def total(p: Column) -> Column:
            steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
            return F.aggregate(steps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

        return let(pairs, lambda s: let(positions(s), total))

    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(
            F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )
        zero = F.lit(0).cast("bigint")
        return F.when(n < 4, zero).otherwise(
            let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), zero).otherwise(covered(h)))
        )

    return of(words)


def measure(docs: DataFrame, text: str = "text", into: str = "_m") -> DataFrame:
    """Add a struct column `into` of the counts of each text. One row in, one row out, no shuffle."""
    value = F.coalesce(F.col(text), F.lit(""))

    def counts(x: Column) -> Column:
        lines = F.filter(F.split(x, "\n", -1), lambda y: F.btrim(y, F.lit(BLANKS)) != "")
        bare = x
        for c in BLANKS:
            bare = F.replace(bare, F.lit(c))

        def struct(words: Column) -> Column:
            return let(
                lines,
                lambda line: F.struct(
                    F.size(words).cast("bigint").alias("n_words"),
                    F.length(bare).cast("bigint").alias("word_chars"),
                    _occurrences(x, SYMBOLS).alias("n_symbols"),
                    _occurrences(x, "!").alias("n_exclamations"),
                    F.size(line).cast("bigint").alias("n_lines"),
                    (F.size(line) - F.size(F.array_distinct(line))).cast("bigint").alias("n_dup_lines"),
                    _repeated_words(words).alias("n_repeat_words"),
                ),
            )

        return let(word_list(x), struct)

    return docs.withColumn(into, F.explode(F.array(let(value, counts))))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEATED * n_words)


def binomial_tail(rejected: Column, n: Column, share: Column) -> Column:
    """P(Binomial(n, share) <= rejected), exactly; 1 where `rejected` is at least the mean.

    The terms are summed from zero up to `rejected`, which is below n * share there. `log` is the logarithm of
    a term and `sum` the sum of all so far in units of it, so that neither leaves the range of a double.
    """
    odds = share / (1 - share)

    def step(acc: Column, i: Column) -> Column:
        ratio = (n - i + 1) / i * odds
        return F.struct((acc["log"] + F.ln(ratio)).alias("log"), (acc["sum"] / ratio + 1).alias("sum"))

    start = F.struct((n * F.log1p(-share)).alias("log"), F.lit(1.0).alias("sum"))
    terms = F.when(rejected < 1, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("bigint"), rejected))
    tail = F.aggregate(terms, start, step, lambda acc: F.exp(acc["log"] + F.ln(acc["sum"])))
    return F.when(rejected >= n * share, F.lit(1.0)).otherwise(tail)


def measured_rows(docs: DataFrame, control: RiskControl) -> DataFrame:
    """(_id, _stratum, counts): every text measured once and written without the text, under 100 bytes a row."""
    stratum = F.coalesce(F.col(control.stratum).cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").alias("_id"), stratum.alias("_stratum"), "text")
    return pinned(measure(rows).select("_id", "_stratum", "_m.*"), "measured")


def _cutoffs_below(value: Column, grid: tuple[float, ...]) -> Column:
    """How many cutoffs of a grid a value is above."""
    return F.size(F.filter(F.array(*map(F.lit, grid)), lambda c: value > c))


def choose_cutoffs(measured: DataFrame, labels: DataFrame, control: RiskControl | None = None) -> DataFrame:
    """(_stratum, _rule, _cutoff): the cutoffs that keep the promise, at most one per stratum and rule, from
    `measured_rows`. Labels meet the counts by id; no text is moved."""
    control = control or RiskControl()
    rules = control.rules
    good = labels.where("doc_id is not null and quality = 1").select(F.col("doc_id").alias("_id"))
    m = skew_safe_join(measured, good, "_id", ["n_words", "word_chars"])
    m = m.where(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    levels = [
        F.struct(
            F.lit(name).alias("_rule"),
            _cutoffs_below(ratio(F.col), grid).alias("_level"),
        )
        for name, (ratio, grid) in rules.items()
    ]
    counts = (
        m.select("_stratum", F.explode(F.array(*levels)).alias("_x"))
        .groupBy("_stratum", "_x._rule", "_x._level")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_n", F.sum("_c").over(Window.partitionBy("_stratum", "_rule")))
    )
    grids = F.create_map(*[x for name, (_, grid) in rules.items() for x in (F.lit(name), F.array(*map(F.lit, grid)))])
    tried = (
        counts.groupBy("_stratum", "_rule")
        .agg(F.max("_n").alias("_n"), F.collect_list(F.struct("_level", "_c")).alias("_levels"))
        .withColumn("_strata", F.size(F.collect_set("_stratum").over(Window.partitionBy("_rule"))))
        .select("*", F.posexplode(F.element_at(grids, F.col("_rule"))).alias("_k", "_cutoff"))
        .withColumn(
            "_rejected",
            # a text of level L is above the first L cutoffs, so cutoff k rejects the levels over k
            F.aggregate("_levels", F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(x["_level"] > F.col("_k"), x["_c"]).otherwise(0)),
        )
    )
    share = F.lit(control.risk / len(rules))
    p = binomial_tail(F.col("_rejected"), F.col("_n"), share)
    passed = tried.where(p <= F.lit(control.delta / len(rules)) / F.col("_strata"))
    return passed.groupBy("_stratum", "_rule").agg(F.min("_cutoff").alias("_cutoff"))


def cutoffs_by_stratum(measured: DataFrame, labels: DataFrame, control: RiskControl) -> DataFrame:
    """(_stratum, _cutoffs): a map from rule to cutoff for each stratum that has any. Written once."""
    entries = F.map_from_entries(F.collect_list(F.struct("_rule", "_cutoff"))).alias("_cutoffs")
    return pinned(choose_cutoffs(measured, labels, control).groupBy("_stratum").agg(entries), "cutoffs")


def _verdict(rows: DataFrame, cutoffs: DataFrame, control: RiskControl, count: Callable[[str], Column], spread: list[str]) -> DataFrame:
    """Add `_base_failed`, `_failed` and `_kept` to rows with `_stratum` and counts, which `count` names."""
    judged = join_sized(rows, cutoffs, "_stratum", spread, "left")
    broken = [
        F.when(ratio(count) > F.col("_cutoffs").getItem(name), F.lit(name)) for name, (ratio, _) in control.rules.items()
    ]
    judged = judged.withColumn("_base_failed", base_failed(count("n_words"), count("n_repeat_words")))
    judged = judged.withColumn("_failed", F.array_compact(F.array(*broken)))
    return judged.withColumn("_kept", ~F.col("_base_failed") & (F.size("_failed") == 0))


def verdicts(docs: DataFrame, labels: DataFrame, control: RiskControl | None = None) -> DataFrame:
    """(_id, _stratum, counts, _base_failed, _failed, _kept): a row for each document, without its text. Every
    text is measured once, for the cutoffs and the verdicts."""
    control = control or RiskControl()
    measured = measured_rows(docs, control)
    return _verdict(measured, cutoffs_by_stratum(measured, labels, control), control, F.col, ["_id"]).drop("_cutoffs")


def judge(docs: DataFrame, labels: DataFrame, control: RiskControl | None = None) -> DataFrame:
    """The documents with `_m` (counts), `_base_failed`, `_failed` (names of the rules broken) and `_kept`; columns
    of the same names are replaced. Texts are measured again where they are judged, which is cheaper than
    bringing their verdicts to them."""
    control = control or RiskControl()
    cutoffs = cutoffs_by_stratum(measured_rows(docs, control), labels, control)
    stratum = F.coalesce(F.col("_row")[control.stratum].cast("string"), F.lit(""))
    rows = measure(carried(docs), "_row.text").withColumn("_stratum", stratum)
    judged = _verdict(rows, cutoffs, control, lambda c: F.col(f"_m.{c}"), ["_row.doc_id"])
    added = ("_m", "_base_failed", "_failed", "_kept")
    return judged.select(*unpacked(docs, added), *added)


WORDLIKE = BLANK.replace("[", "[^")
RATIOS = {
    "symbols_per_word": "n_symbols / n_words",
    "exclamations_per_word": "n_exclamations / n_words",
    "repeated_words": "n_repeat_words / n_words",
    "repeated_lines": "n_dup_lines / n_lines",
    "chars_per_word": "word_chars / n_words",
}

# The whole query.
SQL = f"""with d as (select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t from documents),
  w as (select *, regexp_extract_all(t, '{WORDLIKE}+') as ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORDLIKE}')) as lines from d),
  grams as (select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as c
    from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w)),
  covered as (select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i + 1, i + 2]) as j from grams where c > 1) group by doc_id),
  m as (select doc_id, stratum, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
      len(regexp_extract_all(t, '[{SYMBOLS}]')) as n_symbols, len(regexp_extract_all(t, '!')) as n_exclamations,
      len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n, 0) as n_repeat_words
    from w left join covered using (doc_id)),
  b as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words as base_failed from m),
  rules as ({" union all ".join(f"select '{name}' as rule, {k} as nth, unnest({list(grid)}::double[]) as cutoff" for k, (name, (_, grid)) in enumerate(default_rules().items()))}),
  r as (select doc_id, stratum, base_failed, unnest({list(RATIOS)}) as rule, unnest([{", ".join(f"case when n_words > 0 then {x} end" for x in RATIOS.values())}]) as value from b),
  held as (select r.* from r join labels using (doc_id) where quality = 1 and not base_failed),
  tried as (select stratum, rule, cutoff, count(*) as n, count(*) filter (value > cutoff) as k from held join rules using (rule) group by all),
  tested as (select *, case when k >= n * {0.02 / 5} then 1 else list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({0.02 / 5}) + (n - i) * ln(1 - {0.02 / 5})))) end as p from tried),
  cutoffs as (select stratum, rule, min(cutoff) as cutoff from tested
    where p <= 0.05 / 5 / (select count(distinct stratum) from held) group by all),
  broken as (select doc_id, string_agg(rule, ',' order by nth) as failed_rules
    from r join cutoffs using (stratum, rule) join (select distinct rule, nth from rules) using (rule) where value > cutoffs.cutoff group by doc_id)
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and failed_rules is null as kept, coalesce(failed_rules, '') as failed_rules from b left join broken using (doc_id)"""


@query("op6_quality_rules", SQL)
def op6_quality_rules(spark, folder):
    found = verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return found.select(
        F.col("_id").alias("doc_id"),
        *names,
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.array_join("_failed", ",").alias("failed_rules"),
    )
