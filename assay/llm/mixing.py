"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in the order of a hash of their ids, form blocks of equal numbers of
documents. In a round every source of integer weight w has w unit blocks; the round has Q slots,
the sum over the sources that still have blocks. Block k (from 0) of a source with c blocks in the
round is released at slot floor(k Q / c) and due by slot ceil((k + 1) Q / c). Filling each slot
with the released block of the earliest deadline keeps every source, after any number of slots,
less than one block away from its share. Rounds end with all shares even, so a round's order
depends on the block counts alone: at most two rounds per source differ from the one before, and
each different round is scheduled once, whatever the number of documents.

When a source runs out, the others go on in proportion to their weights, so every document has a
place. Sources that ``weights`` does not name, null among them, share one weight, ``rest``, and are
scheduled as one. With ``rest`` None, as in the query and the pipeline, each of them is scheduled as
a source of its own, of weight 1, null as one source. Its one block in a round may take any slot of
it, so these sources, numbered by falling block counts, take the slots that the named blocks leave
free, however many sources there are. The schedule has the named sources' blocks only (MAX_SLOTS),
once for each different round; other sources add a different round per distinct block count, which
are fewer than the square root of twice the number of blocks. No document sees all of these: rounds
meet the (source, hash prefix) groups below by ranges, and a group's documents get its own few.

Ranks inside a source come from counts per (source, hash prefix), so no source is ranked in one
task; prefixes are as long as the number of documents asks for and do not change the result. Rows
with a null or repeated ``doc_id`` each get a place; equal ids lie side by side in any order.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_SLOTS = 4096  # of a round: the sum of the weights
ROWS_PER_PREFIX = 10_000
SPAN = 1024  # rounds in a range by which schedules and documents meet
WEIGHTS = {"src0": 6, "src1": 3, "src2": 3, "src3": 3, "src4": 3, "src5": 2, "src6": 2,
           "src7": 2, "src8": 2, "src9": 2}
REST = 5
BLOCK_DOCS = 8


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _round_order(counts: Column, slots: Column) -> Column:
    """For an array of block counts, in a round of ``slots``: the slot and source of each block, by
    earliest deadline among released blocks; ties go to the first source. Slots in which no block
    is released stay free, for the sources of one block."""
    def step(state: Column, _: Column) -> Column:
        due = F.transform(counts, lambda c, i: F.when(F.get(state["done"], i) < c, F.struct(
            F.floor(F.get(state["done"], i) * slots / c).alias("release"),
            F.ceil((F.get(state["done"], i) + 1) * slots / c).alias("due"), i.alias("source"))))
        return _let(due, lambda d: _let(
            F.greatest(state["t"], F.array_min(F.transform(d, lambda x: x["release"]))),
            lambda t: _let(
                F.array_min(F.transform(d, lambda x: F.when(
                    x["release"] <= t, F.struct(x["due"], x["source"]))))["source"],
                lambda pick: F.struct(
                    F.transform(state["done"], lambda n, i: n + (i == pick).cast("bigint"))
                    .alias("done"),
                    (t + 1).alias("t"),
                    F.concat(state["order"], F.array(F.struct(
                        t.alias("slot"), pick.alias("source")))).alias("order")))))

    start = F.struct(F.transform(counts, lambda c: F.lit(0).cast("bigint")).alias("done"),
                     F.lit(0).cast("bigint").alias("t"),
                     F.array().cast("array<struct<slot: bigint, source: int>>").alias("order"))
    total = F.aggregate(counts, F.lit(0), lambda a, c: a + c)
    return F.aggregate(F.array_repeat(F.lit(0), total), start, step, lambda s: s["order"])


def round_plan(blocks: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """For each source of ``blocks`` (pool, weight, n_blocks) and each different round: ``pool`` and
    ``r``, which has first round, next round, slots before it, slots per round, blocks per round,
    slot of each block. ``others`` (n_blocks, n) counts the sources of weight 1 by their blocks;
    they share the rows of pool 0, with the number of free slots before each taken one as last
    field. One row per different round, all in one task."""
    none = F.array().cast("array<struct<n_blocks: bigint, n: bigint>>")
    one = blocks.where("n_blocks > 0").agg(F.array_sort(F.collect_list(
        F.struct("pool", "weight", "n_blocks"))).alias("s"))
    one = one.withColumn("o", none) if others is None else one.crossJoin(
        others.agg(F.collect_list(F.struct("n_blocks", "n")).alias("o")))
    full = F.transform("s", lambda x: F.floor(x["n_blocks"] / x["weight"]))
    cuts = F.array_sort(F.array_distinct(F.concat(
        F.array(F.lit(0).cast("bigint")), full, F.transform(full, lambda f: f + 1),
        F.transform("o", lambda x: x["n_blocks"]))))
    spans = one.withColumn("cuts", cuts).select("s", F.posexplode(F.transform(
        "cuts", lambda c, i: F.struct(c.alias("first"), F.get("cuts", i + 1).alias("next"),
                                      F.aggregate("o", F.lit(0).cast("bigint"), lambda a, x: a
                                                  + F.when(x["n_blocks"] > c, x["n"])
                                                  .otherwise(0)).alias("ones"))))) \
        .select("s", F.col("pos").alias("span"), "col.*").where("next IS NOT NULL")
    counted = spans.withColumn("counts", F.transform("s", lambda x: F.greatest(
        F.lit(0), F.least(x["weight"].cast("bigint"),
                          x["n_blocks"] - F.col("first") * x["weight"])).cast("int"))) \
        .withColumn("slots", F.aggregate("counts", F.col("ones"), lambda a, c: a + c)) \
        .where("slots > 0")
    ordered = counted.withColumn("order", _round_order(F.col("counts"), F.col("slots"))) \
        .withColumn("before", F.coalesce(F.sum(
            (F.col("next") - F.col("first")) * F.col("slots")).over(
            Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    shared = F.struct(F.lit(0).cast("bigint").alias("pool"), F.lit(1).alias("weight"),
                      F.lit(0).cast("bigint").alias("n_blocks"))
    count = F.get(F.concat("counts", F.array(F.least("ones", F.lit(1)).cast("int"))), F.col("i"))
    each = ordered.select("*", F.posexplode(F.concat("s", F.array(shared))).alias("i", "x")) \
                  .where(count > 0)
    place = F.when(F.col("i") == F.size("s"), F.transform(
        "order", lambda p, t: p["slot"] - t)).otherwise(F.transform(
            F.filter("order", lambda p: p["source"] == F.col("i")), lambda p: p["slot"]))
    return each.select(F.col("x.pool").alias("pool"), F.struct(
        "first", "next", "before", "slots", count.alias("count"), place.alias("place")).alias("r"))


def _bases(sizes: DataFrame, keys: list[str]) -> DataFrame:
    """For ``sizes`` (keys, __prefix, n) its rows with the number of rows of the same keys before
    each prefix."""
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("__prefix")
                             .rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select(*keys, "__prefix", "n", F.coalesce(before, F.lit(0)).alias("__base"))


def _with_rounds(bases: DataFrame, plan: DataFrame, keys: list[str], weight: Column,
                 block_docs: int) -> DataFrame:
    """``bases`` with ``__weight`` and ``__rounds``, the rounds of ``plan`` in which blocks of the
    group's documents lie. Both sides are cut into ranges of SPAN rounds and meet by range."""
    def round_of(rank: Column) -> Column:
        return F.floor(F.floor(rank / block_docs) / F.col("__weight"))

    def ranges(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / SPAN), F.floor(high / SPAN)))

    group = [*keys, "__prefix"]
    reach = bases.withColumn("__weight", weight).withColumns(
        {"__low": round_of(F.col("__base")), "__high": round_of(F.col("__base") + F.col("n") - 1)})
    cut = plan.select(F.col("pool").alias("__pool"), "r",
                      ranges(F.col("r.first"), F.col("r.next") - 1).alias("__span"))
    met = reach.withColumn("__span", ranges(F.col("__low"), F.col("__high"))) \
        .join(cut, ["__pool", "__span"]) \
        .where((F.col("r.first") <= F.col("__high")) & (F.col("r.next") > F.col("__low"))) \
        .where(F.col("__span") == F.floor(F.greatest("r.first", "__low") / SPAN))  # met once
    return reach.drop("n", "__low", "__high").join(
        met.groupBy(*group).agg(F.collect_list("r").alias("__rounds")), group)


def _source_numbers(blocks: DataFrame, levels: DataFrame, digits: int) -> DataFrame:
    """A number from 0 for each source of ``blocks`` (__pool, __own, n_blocks), those of more blocks
    first, so that the sources that still have blocks in a round are those of the lowest numbers."""
    above = levels.select("n_blocks", F.coalesce(F.sum("n").over(
        Window.orderBy(F.desc("n_blocks")).rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("above"))
    keyed = blocks.withColumn("__order", F.md5("__own")) \
                  .withColumn("__prefix", F.substring("__order", 1, digits))
    bases = _bases(keyed.groupBy("n_blocks", "__prefix").agg(F.count("*").alias("n")),
                   ["n_blocks"]).drop("n")
    return keyed.join(bases, ["n_blocks", "__prefix"]).join(above, "n_blocks").select(
        "__pool", "__own", (F.col("above") + F.col("__base") - 1 + F.row_number().over(
            Window.partitionBy("n_blocks", "__prefix").orderBy("__order"))).alias("__number"))


def mix(docs: DataFrame, weights: Mapping[str, int] = WEIGHTS, rest: int | None = REST,
        block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Every row of ``docs`` with ``__mix``: its ``block`` in its source, the block's ``release``,
    ``deadline`` and ``slot`` in the whole order, and its ``position``, by which to sort. With
    ``rest`` None every source that ``weights`` does not name has a weight of 1 of its own."""
    each = rest is None
    if min([1 if each else rest, *weights.values()]) < 1 \
            or sum(weights.values()) + (rest or 0) > MAX_SLOTS:
        raise ValueError(f"weights are positive integers with a sum of at most {MAX_SLOTS}")
    names = sorted(weights)
    pool = F.coalesce(F.array_position(F.array(*map(F.lit, names)), F.col("source")), F.lit(0)) \
        if names else F.lit(0).cast("bigint")
    weight = F.get(F.array(F.lit(1 if each else rest), *[F.lit(weights[n]) for n in names]),
                   F.col("__pool").cast("int"))
    n, digits = docs.count(), 1
    while n > ROWS_PER_PREFIX * 16 ** digits:
        digits += 1
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = docs.withColumns({"__pool": pool, "__order": order}) \
                .withColumn("__prefix", F.substring("__order", 1, digits))
    keys = ["__pool"]
    if each:
        keys.append("__own")
        keyed = keyed.withColumn("__own", F.when(F.col("__pool") == 0, F.concat(
            F.lit("="), F.col("source"))))
        keyed = keyed.withColumn("__own", F.coalesce("__own", F.lit("")))
    sizes = keyed.groupBy(*keys, "__prefix").agg(F.count("*").alias("n"))
    bases = _bases(sizes, keys)
    blocks = sizes.groupBy(*keys).agg(F.sum("n").alias("n")).select(
        *keys, weight.alias("weight"), F.ceil(F.col("n") / block_docs).alias("n_blocks"))
    levels = None
    if each:
        others = blocks.where("__pool = 0")
        levels = others.groupBy("n_blocks").agg(F.count("*").alias("n"))
        bases = bases.join(_source_numbers(others, levels, digits), keys, "left")
        blocks = blocks.where("__pool > 0")
    plan = round_plan(blocks.select(F.col("__pool").alias("pool"), "weight", "n_blocks"), levels)
    bases = _with_rounds(bases, plan, keys, weight, block_docs)
    ranked = keyed.join(bases, [*keys, "__prefix"]).withColumn(
        "__rank", F.col("__base") - 1 + F.row_number().over(
            Window.partitionBy(*keys, "__prefix").orderBy("__order", "doc_id")))
    placed = ranked \
        .withColumn("__block", F.floor(F.col("__rank") / block_docs)) \
        .withColumns({"__round": F.floor(F.col("__block") / F.col("__weight")),
                      "__k": (F.col("__block") % F.col("__weight")).cast("int")}) \
        .withColumn("__r", F.get(F.filter("__rounds", lambda r: (
            F.col("__round") >= r["first"]) & (F.col("__round") < r["next"])), F.lit(0)))
    r, k = F.col("__r"), F.col("__k")
    start = r["before"] + (F.col("__round") - r["first"]) * r["slots"]
    place = F.get(r["place"], k)
    if each:
        place = F.when(F.col("__pool") == 0, F.col("__number") + F.size(F.filter(
            r["place"], lambda free: free <= F.col("__number")))).otherwise(place)
    slot = start + place
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(
        F.col("__block").alias("block"),
        (start + F.floor(k * r["slots"] / r["count"])).alias("release"),
        (start + F.ceil((k + 1) * r["slots"] / r["count"])).alias("deadline"),
        slot.alias("slot"),
        (slot * block_docs + F.col("__rank") % block_docs).alias("position")).alias("__mix"))


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, sorted over all partitions into the mixture's order."""
    mixed = mix(docs, **options)
    return mixed.sort(F.col("__mix.position")).select(*docs.columns)
