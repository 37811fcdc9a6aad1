"""Mixing sources to target weights by Pfair scheduling.

A source's documents, in a hashed order, form blocks of `block_rows`. With weight w its block j may
come from slot floor(j / w) on and has to be placed before slot ceil((j + 1) / w). Placing in each slot
the released block with the earliest deadline keeps every source, after any number of slots, less than
one block away from its weight times that number.

The schedule of `period` slots is worked out from the weights as they are (period x sources steps, however
many rows there are) and then repeats; a block's slot is its place in the period plus whole periods. So after t
slots a source is less than 1 + t // period blocks away from its weight times t, within the first period less
than one. Blocks are always full: a pass through a source ends inside a block, and its next pass goes on there.
The mix ends when every source has been through once: a source whose weight asks for more than it has starts
over (epoch 1, 2, ...), none loses a document.

Everything is a DataFrame expression: no Python runs on the rows. Documents are numbered per source by
counts of (source, hash range), so a source that holds most rows is spread over many tasks.

Defined results: a null source is a source of its own. A source that `weights` does not name, or gives
0, is left out; names without documents are ignored. Repeated rows are documents of their own. Without
weights, a source of n documents weighs n ** temperature, but at least a block a period. An empty table gives
an empty mix. Texts are carried along, whatever their length.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import let
from plumbline.llm.base import carried, query, table, unpacked
from plumbline.session import pinned

RANGE_ROWS = 5000  # rows of a source that are numbered together, about


@dataclass(frozen=True)
class Mix:
    """weights: source to weight (any positive numbers). temperature: see above. period: slots after which
    the schedule repeats, raised to eight times the number of sources and until the smallest of the given
    weights has a block of its own. block_rows: documents of a block."""

    weights: dict | None = None
    temperature: float = 0.9
    period: int = 10_000
    block_rows: int = 32
    source: str = "source"


def _key(source: Column) -> Column:
    """Sources as keys that are never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(_key, n, w, period): the weights as shares of one, and the slots after which the schedule repeats."""
    if mix.weights is None:
        weighted = sizes.withColumn("w", F.pow(F.col("n"), mix.temperature))
    else:
        named = [x for s, w in mix.weights.items() for x in (F.lit("null") if s is None else F.lit(f"={s}"), F.lit(float(w)))]
        weighted = sizes.withColumn("w", F.element_at(F.create_map(*named), F.col("_key")) if named else F.lit(None).cast("double"))
    all_rows = Window.partitionBy(F.lit(0))  # over sources, not rows
    share = weighted.where("w > 0").withColumn("w", F.col("w") / F.sum("w").over(all_rows))
    slots = F.greatest(F.lit(mix.period), 8 * F.count(F.lit(1)).over(all_rows))
    if mix.weights is None:  # the rarest sources weigh a block a period
        share = share.withColumn("_slots", slots).withColumn("w", F.greatest("w", 1 / F.col("_slots")))
        share = share.withColumn("_sum", F.sum("w").over(all_rows))
        period = F.ceil(F.col("_slots") * F.col("_sum"))
        share = share.withColumn("period", period).withColumn("w", F.col("w") / F.col("_sum"))
    else:
        share = share.withColumn("period", F.greatest(slots, F.ceil(1 / F.min("w").over(all_rows))))
    return share.select("_key", "n", "w", F.col("period").cast("bigint").alias("period"))


CHUNK = 1000  # slots that are gathered in one array while it grows


def one_period(weights: Column, period: Column) -> Column:
    """Which source (its place in the array of weights) gets each slot of a period: earliest deadline first."""

    def slot(state: Column, t: Column) -> Column:
        def bid(w: Column, s: Column) -> Column:
            placed = F.get(state["placed"], s)
            early = F.floor(placed / w) > t  # not yet released
            return F.struct(early.alias("early"), F.ceil((placed + 1) / w).alias("deadline"), s.alias("s"))

        return let(
            F.array_min(F.transform(weights, bid))["s"],
            lambda best: F.struct(
                F.transform(state["placed"], lambda n, s: n + (s == best).cast("bigint")).alias("placed"),
                F.array_append(state["order"], best).alias("order"),
            ),
        )

    def chunk(state: Column, c: Column) -> Column:
        begin = F.struct(state["placed"].alias("placed"), F.array().cast("array<int>").alias("order"))
        slots = F.sequence(c * CHUNK, F.least((c + 1) * CHUNK, period) - 1)
        return let(
            F.aggregate(slots, begin, slot),
            lambda done: F.struct(done["placed"].alias("placed"), F.array_append(state["chunks"], done["order"]).alias("chunks")),
        )

    nothing = F.transform(weights, lambda _: F.lit(0).cast("bigint"))
    start = F.struct(nothing.alias("placed"), F.array().cast("array<array<int>>").alias("chunks"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((period - 1) / CHUNK))
    return F.flatten(F.aggregate(chunks, start, chunk)["chunks"])


def plan(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per source: _key, n, w, period, slots (of its blocks in a period), quota (their number), rows (in the mix)."""
    shares = targets(sizes, mix)
    entries = F.array_sort(F.collect_list(F.struct("_key", "n", "w")))  # one entry per source
    gathered = shares.agg(entries.alias("all"), F.max("period").alias("period"))
    order = one_period(F.col("all.w"), F.col("period"))
    slots = (
        gathered.where(F.size("all") > 0)
        .select("all", "period", F.posexplode(order).alias("slot", "s"))
        .groupBy("s")
        .agg(F.array_sort(F.collect_list(F.col("slot").cast("bigint"))).alias("slots"), F.first("all").alias("all"), F.first("period").alias("period"))
        .select(F.get("all", F.col("s")).alias("x"), "slots", "period", F.size("slots").cast("bigint").alias("quota"))
        .select("x.*", "slots", "period", "quota")
    )
    last = F.ceil(F.col("n") / mix.block_rows) - 1  # the block in which the first pass ends
    ends = slot_of(last, F.col("quota"), F.col("slots"), F.col("period")) + 1
    end = F.max(ends).over(Window.partitionBy(F.lit(0)))
    inside = F.size(F.filter("slots", lambda x: x < F.col("end") % F.col("period")))
    return (
        slots.withColumn("end", end)
        .withColumn("total", F.floor(F.col("end") / F.col("period")) * F.col("quota") + inside)
        .withColumn("rows", F.when(ends == end, F.col("n")).otherwise(F.col("total") * mix.block_rows))
        .select("_key", "n", "w", "quota", "period", "slots", "rows")
    )


def slot_of(block: Column, quota: Column, slots: Column, period: Column) -> Column:
    return F.floor(block / quota) * period + F.get(slots, (block % quota).cast("int"))


def schedule(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The rows of `docs`, as often as the mix has them, with a struct `_mix` (which replaces a column of
    that name): slot, place (in the slot), epoch, block, release, deadline, weight. Ordering by slot and
    place gives the mix."""
    return _scheduled(docs, mix or Mix()).select(*unpacked(docs, ("_mix",)), "_mix")


def _scheduled(docs: DataFrame, mix: Mix) -> DataFrame:
    keyed = carried(docs).withColumn("_key", _key(F.col("_row")[mix.source]))
    keyed = keyed.withColumn("_id", F.col("_row.doc_id")).withColumn("_hash", F.xxhash64("_id", F.lit("mix")))
    total = docs.count()
    ranges = max(1, 1 << max(0, (total // RANGE_ROWS).bit_length() - 1))
    # the upper bits of the hash, so that ranges follow each other in the order of the hash
    keyed = keyed.withColumn("_range", F.floor((F.col("_hash").cast("double") / 2.0**64 + 0.5) * ranges).cast("bigint"))
    counts = pinned(keyed.groupBy("_key", "_range").agg(F.count(F.lit(1)).alias("_n")), "mix-counts")
    sources = pinned(plan(counts.groupBy("_key").agg(F.sum("_n").alias("n")), mix), "mix-plan")
    before = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_key", "_range").orderBy("_hash", "_id")
    numbered = keyed.withColumn("_nth", F.row_number().over(within) - 1).join(offsets, ["_key", "_range"])
    numbered = numbered.withColumn("_nth", F.col("_nth") + F.col("_before"))
    # the plan has a row per source and a slot number per slot of the period: bounded by the period
    packed = sources.select(F.col("_key").alias("_plan_key"), F.struct("n", "w", "quota", "period", "slots", "rows").alias("_plan"))
    planned = numbered.join(F.broadcast(packed), F.col("_key") == F.col("_plan_key"))
    p = lambda c: F.col(f"_plan.{c}")
    epochs = F.floor((p("rows") - 1 - F.col("_nth")) / p("n"))
    each = planned.withColumn("_epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), epochs)))
    at = F.col("_nth") + F.col("_epoch") * p("n")  # place in the endless repetition of the source
    block = F.floor(at / mix.block_rows)
    round_, turn = F.floor(block / p("quota")) * p("period"), block % p("quota")
    found = F.struct(
        slot_of(block, p("quota"), p("slots"), p("period")).alias("slot"),
        (at % mix.block_rows).alias("place"),
        F.col("_epoch").alias("epoch"),
        block.alias("block"),
        (round_ + F.floor(turn / p("w"))).alias("release"),
        (round_ + F.ceil((turn + 1) / p("w"))).alias("deadline"),
        p("w").alias("weight"),
    )
    return each.select("_row", found.alias("_mix"))


def mixed(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """The documents of the mix, repeated as it asks, in its order."""
    return _scheduled(docs, mix or Mix()).orderBy("_mix.slot", "_mix.place").select(*unpacked(docs))


@query("op5_mixing")
def op5_mixing(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return schedule(docs).select("doc_id", "source", "_mix.*")
